"""Operators that prepare text for training language models.

Nothing else in the library imports this subpackage. Executors import it by
name, so ship the package with ``--py-files`` or install it on the cluster.
"""

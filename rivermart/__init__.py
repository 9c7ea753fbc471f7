"""Real-time retail pipeline as PySpark DataFrame functions."""

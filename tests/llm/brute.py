"""Plain Python versions of what the operators find."""

import collections
import hashlib
import re


def removed(rows, width=50):
    first = {}
    docs = [(k, (t or "").encode()) for k, t in rows]
    for key, raw in docs:
        for i in range(len(raw) - width + 1):
            if key is not None:
                first[raw[i:i + width]] = min(key, first.get(raw[i:i + width], key))
    out = []
    for key, raw in docs:
        gone, end = bytearray(len(raw)), 0
        for i in range(len(raw) - width + 1):
            if key is not None and first[raw[i:i + width]] < key:
                gone[max(i, end):i + width] = b"\1" * (i + width - max(i, end))
                end = i + width
        kept = bytes(x for x, g in zip(raw, gone) if not g)
        spans = sum(1 for i in range(len(raw)) if gone[i] and not (i and gone[i - 1]))
        out.append((key, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def shingles(text, size=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1)))


def components(rows, percent=75):
    sets = {key: shingles(text) for key, text in rows}
    holders, parent = collections.defaultdict(list), {key: key for key in sets}
    for key, own in sets.items():
        for token in own:
            holders[token].append(key)

    def root(key):
        while parent[key] != key:
            key = parent[key]
        return key

    for key, own in sets.items():
        for other, both in collections.Counter(o for t in own for o in holders[t] if o < key).items():
            if 100 * both >= percent * (len(own) + len(sets[other]) - both):
                a, b = sorted((root(key), root(other)))
                parent[b] = a
    return {key: (len(own), root(key)) for key, own in sets.items()}

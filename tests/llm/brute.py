"""Plain versions of the operators, for small inputs."""

import hashlib
import re
from collections import defaultdict

import numpy as np
import xxhash

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def lower(text):
    return (text or "").translate(LOWER)


def exact(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[lower(text)].append(doc_id)
    out = []
    for doc_id, text in rows:
        ids = [i for i in groups[lower(text)] if i is not None]
        keep = max(ids) if ids else None
        sha = hashlib.sha256(lower(text).encode()).hexdigest()
        out.append((doc_id, keep, len(groups[lower(text)]), doc_id == keep, sha))
    return out


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def contamination(rows, items, width=10):
    windows = defaultdict(set)
    for item_id, text in items:
        w = words(text)
        n = min(width, len(w))
        for s in range(len(w) - n + 1) if w else []:
            windows[tuple(w[s : s + n])].add(None if item_id is None else str(item_id))
    out = []
    for doc_id, text in rows:
        w, hit, found = words(text), set(), set()
        for n in {len(k) for k in windows}:
            for s in range(len(w) - n + 1):
                names = windows.get(tuple(w[s : s + n]))
                if names:
                    hit.update(range(s, s + n))
                    found |= names
        found = sorted(x for x in found if x is not None)
        sha = hashlib.sha256(",".join(found).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(found), sha, bool(hit)))
    return out


def fingerprint(text):
    w = re.findall(rb"[^\x20\x09-\x0D]+", lower(text).encode())
    if not w:
        return 0
    size = min(3, len(w))
    hashes = [xxhash.xxh64_intdigest(b" ".join(w[i : i + size]), 42) for i in range(len(w) - size + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked(codes, distance):
    """The place of the first code reachable, for each code."""
    codes = np.asarray(codes, np.uint64)
    near = np.bitwise_count(codes[:, None] ^ codes[None, :]) <= distance
    label = np.arange(len(codes))
    while True:
        new = np.array([label[row].min() for row in near], int) if len(codes) else label
        if (new == label).all():
            return label
        label = new


def simhash(rows, distance=2):
    rows = sorted(rows)
    codes = [fingerprint(t) for _, t in rows]
    label = linked(codes, distance)
    return [(i, f"{c:016x}", rows[at][0]) for (i, _), c, at in zip(rows, codes, label, strict=True)]


def substrings(rows, window=13):
    split = [(i, re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode())) for i, t in rows]
    owner = {}
    for doc_id, w in split:
        for s in range(len(w) - window + 1) if doc_id is not None else []:
            key = tuple(w[s : s + window])
            owner[key] = min(owner.get(key, doc_id), doc_id)
    out = []
    for doc_id, w in split:
        gone = set()
        for s in range(len(w) - window + 1) if doc_id is not None else []:
            if owner[tuple(w[s : s + window])] < doc_id:
                gone.update(range(s, s + window))
        kept = b" ".join(x for p, x in enumerate(w) if p not in gone)
        out.append((doc_id, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return out

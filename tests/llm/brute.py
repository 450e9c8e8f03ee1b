"""Plain restatements of the operators on a handful of rows."""

import re
from collections import Counter

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def components(size, linked):
    """Least member of each place's component; ``linked`` tells whether two places are linked."""
    label = list(range(size))
    changed = True
    while changed:
        changed = False
        for i in range(size):
            for j in range(size):
                if label[j] < label[i] and linked(i, j):
                    label[i] = label[j]
                    changed = True
    return label


def kept_words(texts, window):
    """(words, removed, kept text) of each text."""
    words = [WORD.findall(t or "") for t in texts]
    starts = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = set()
        for i in range(len(w) - window + 1):
            if starts[tuple(w[i : i + window])] > 1:
                gone |= set(range(i, i + window))
        out.append((len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def fingerprint(text, shingle=3):
    words = WORD.findall((text or "").translate(LOWER))
    shingles = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def benchmark_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def contamination(texts, items, window=13):
    """(words, hit words, items) of each text. ``items``: (id, text)."""
    out = []
    for text in texts:
        words, hit, found = benchmark_words(text), set(), set()
        for item, body in items:
            terms = benchmark_words(body)
            n = min(window, len(terms))
            for a in range(max(0, len(terms) - n + 1) if n else 0):
                for i in range(len(words) - n + 1):
                    if words[i : i + n] == terms[a : a + n]:
                        hit |= set(range(i, i + n))
                        if item is not None:
                            found.add(str(item))
        out.append((len(words), len(hit), sorted(found)))
    return out


def cosine(x, y):
    if any(v is None or not len(v) or any(c is None or not np.isfinite(c) for c in v) or not any(v) for v in (x, y)):
        return -1.0
    if len(x) != len(y):
        return -1.0
    x, y = (np.array(v, float) / max(map(abs, v)) for v in (x, y))
    return float(x @ y / np.sqrt(x @ x) / np.sqrt(y @ y))

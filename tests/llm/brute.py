"""Plain versions of the operators, for comparison."""

import hashlib
import re
from collections import Counter

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def simhash(text, n=3):
    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(w[i:i + n]) for i in range(len(w) - n + 1)] if len(w) >= n else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def united(nodes, links):
    """Smallest node reachable from each."""
    low = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            m = min(low[a], low[b])
            if low[a] != m or low[b] != m:
                low[a] = low[b] = m
                changed = True
    return low


def word_dedup(rows, window=20):
    """{index of row: (n_words, n_removed, kept text)}; rows in order of place."""
    seen, out = set(), []
    for text in rows:
        w = words(text)
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            key = tuple(w[i:i + window])
            if key in seen:
                gone[i:i + window] = [True] * window
            seen.add(key)
        out.append((len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return out


def byte_dedup(rows, length):
    data = [(t or "").encode() for t in rows]
    count = Counter(d[i:i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if count[d[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        runs = sum(1 for i in range(len(d)) if gone[i] and (not i or not gone[i - 1]))
        out.append((len(d), sum(gone), runs, bytes(x for x, g in zip(d, gone) if not g)))
    return out


def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def ids_digest(ids):
    return hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()

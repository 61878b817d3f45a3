"""Plain versions of what the operators compute."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import tiktoken
import xxhash

from civicstat.llm import bpe

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")
TOKENIZER = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                              mergeable_ranks=bpe.read_ranks(VOCABULARY))


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def tokens(text):
    ids = TOKENIZER.encode_ordinary(text or "")
    return len(ids), sha(" ".join(map(str, ids)).encode()), sha((text or "").encode())


def fingerprint(text):
    words = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode()).split()
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i:i + 4]), seed=42) for i in range(max(1, len(words) - 3))]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def components(rows, bits=4):
    """rows: (id, fingerprint) -> Counter of (id, smallest id reachable)."""
    f = np.array([x for _, x in rows], np.uint64)
    group = list(range(len(rows)))

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in np.flatnonzero(np.bitwise_count(f[i + 1:] ^ f[i]) <= bits) + i + 1:
            a, b = top(i), top(int(j))
            group[max(a, b)] = min(a, b)
    least = {}
    for k, (i, _) in enumerate(rows):
        seen = least.get(top(k))
        least[top(k)] = i if seen is None else seen if i is None else min(seen, i)
    return Counter((i, least[top(k)]) for k, (i, _) in enumerate(rows))


def substrings(rows, window=50):
    """rows: (id, text) -> Counter of (id, words, removed, hash of the rest)."""
    last = 1 << 62
    first = {}
    split = [(last if i is None else i, i, (t or "").encode().split()) for i, t in rows]
    for order, _, w in split:
        for k in range(len(w) - window + 1):
            x = tuple(w[k:k + window])
            first[x] = min(first.get(x, last), order)
    out = Counter()
    for order, i, w in split:
        gone = set()
        for k in range(len(w) - window + 1):
            if first[tuple(w[k:k + window])] < order:
                gone.update(range(k, k + window))
        out[i, len(w), len(gone), sha(b" ".join(x for k, x in enumerate(w) if k not in gone))] += 1
    return out


def repeated_words(words):
    windows = list(zip(words, words[1:], words[2:]))
    counts = Counter(windows)
    return len({i + k for i, x in enumerate(windows) if counts[x] > 1 for k in range(3)})

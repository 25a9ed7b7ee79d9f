"""Plain Python answers for small tables."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words_of(text):
    return WORD.findall(text or "")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def substring(docs, n=50):
    """{row number: (doc_id, n_words, n_removed, kept_sha256)}"""
    least = {}
    split = [words_of(t) for _, t in docs]
    for (d, _), w in zip(docs, split):
        if d is not None:
            for i in range(len(w) - n + 1):
                key = tuple(w[i:i + n])
                least[key] = min(d, least.get(key, d))
    out = []
    for (d, _), w in zip(docs, split):
        gone = set()
        for i in range(len(w) - n + 1):
            if d is not None and least[tuple(w[i:i + n])] < d:
                gone.update(range(i, i + n))
        out.append((d, len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone))))
    return out


def fingerprint(text, k=3):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash(docs, k=3, radius=2):
    prints = [fingerprint(t, k) for _, t in docs]
    up = list(range(len(docs)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(docs)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                up[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return [(d, f"{prints[i]:016x}", least.get(root(i))) for i, (d, _) in enumerate(docs)]


def base_rules(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words"""
    words = words_of(text)
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if words_of(line):
            dup += line in seen
            seen.add(line)
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    count = Counter(grams)
    covered = {j for i, g in enumerate(grams) if count[g] > 1 for j in (i, i + 1, i + 2)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(covered))

"""Small fixtures and brute-force versions for the corpus operators."""

from __future__ import annotations

import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def docs(spark, texts, sources=None, langs=None, ids=None):
    rows = [(ids[i] if ids else i, t, langs[i] if langs else None, sources[i] if sources else "s", None if t is None else len(t)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def odd_texts():
    """Nulls, empty and blank texts, ties, one word, control characters, other scripts, a very long text and a very long word."""
    rng = random.Random(4)
    words = ["alpha", "beta", "Gamma", "delta", "été", "中文", "a", "x" * 40]
    return [
        None, "", " ", "\n\t\x0b\x0c\r ", "one", "One", "one ", "\x00", "中文 中文", "💥" * 5, "a b c", "A  b\tc", "<|endoftext|> x",
        " ".join(rng.choice(words) for _ in range(30_000)), "y" * 200_000, " ".join(rng.choice(words) for _ in range(700)),
    ]


def shingles(text, k):
    w = WORD.findall((text or "").translate(LOWER))
    if len(w) < k:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1))


def components(texts, k, num, den):
    """(set size, smallest place reachable) of every text, by all pairs."""
    sets = [shingles(t, k) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            common = len(a & b)
            if a and b and den * common >= num * (len(a) + len(b) - common):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [(len(s), find(i)) for i, s in enumerate(sets)]

"""Sets of word shingles of whole texts, as sorted 64-bit fingerprints, vectorised over batches of texts."""

from __future__ import annotations

import numpy as np

#: Bytes hashed at a time; a chunk ends at white space, so memory does not depend on a text's length.
CHUNK = 1 << 19

_random = np.random.default_rng(20240229)
_BYTE = _random.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = _random.integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)

LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(h: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base & (1 << 64) - 1, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


_up = _powers(CHUNK + 4096, _BASE)
_down = _powers(CHUNK + 4096, _INVERSE)


def _word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, hash) of each word of a chunk of bytes: a polynomial over the word's bytes, finalised with its length."""
    global _up, _down
    if len(data) > len(_up):  # a single word longer than a chunk
        _up, _down = _powers(len(data) + 1, _BASE), _powers(len(data) + 1, _INVERSE)
    word = ~_SPACE[data]
    edge = np.diff(np.concatenate([[False], word, [False]]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * _up[: len(data)], out=sums[1:])
    h = (sums[ends] - sums[starts]) * _down[starts]
    return starts, mix(h + (ends - starts).astype(np.uint64) * np.uint64(_PLACE[63]))


def sets(texts: list[str | None], k: int) -> list[np.ndarray]:
    """For each text the sorted distinct fingerprints of its k-word shingles.

    A-Z are lower-cased and words are separated by ASCII white space. Fewer words than k are one shingle as a whole; null
    and wordless texts have the empty set.
    """
    parts = [(t or "").encode("utf-8", "replace").translate(LOWER) + b" " for t in texts]
    ends = np.cumsum([len(p) for p in parts])
    data = np.frombuffer(b"".join(parts), np.uint8)
    del parts
    at, starts, hashes = 0, [], []
    while at < len(data):
        to = min(len(data), at + CHUNK)
        if to < len(data):
            back = np.flatnonzero(_SPACE[data[at:to]])
            if len(back):
                to = at + int(back[-1]) + 1
            else:
                ahead = data[to:].tobytes().find(b" ")  # each text ends with a space
                to += ahead + 1
        s, h = _word_hashes(data[at:to])
        starts.append(s + at)
        hashes.append(h)
        at = to
    starts = np.concatenate(starts) if starts else np.zeros(0, np.int64)
    words = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    bounds = np.r_[0, np.searchsorted(starts, ends)]
    run = np.zeros(max(0, len(words) - k + 1), np.uint64)
    for i in range(k):
        run += words[i : i + len(run)] * _PLACE[i]
    run = mix(run).view(np.int64)
    out = []
    for a, b in zip(bounds, bounds[1:], strict=False):
        if b - a >= k:
            out.append(np.unique(run[a : b - k + 1]))
        elif b > a:
            short = sum((int(w) * int(p) for w, p in zip(words[a:b], _PLACE, strict=False)), int(b - a) * int(_PLACE[62])) & (1 << 64) - 1
            out.append(mix(np.array([short], np.uint64)).view(np.int64))
        else:
            out.append(np.zeros(0, np.int64))
    return out

"""Sets of word shingles as sorted 64-bit hashes, computed with numpy for whole texts.

Words are runs of characters other than blank, tab and the line breaks ``\\n \\v \\f \\r``; A-Z are
lower-cased. A word's hash is a polynomial over random byte values modulo 2**64, taken from prefix
sums over a batch of texts, so a text of any length needs a fixed number of array passes.
"""

from __future__ import annotations

import numpy as np

_RNG = np.random.default_rng(20240229)
_BYTES = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 2**64)
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
SLICE = 1_000_000  # bytes of texts that are hashed at once; arrays and tables have eight times as many
KEPT_POWERS = 1 << 20  # tables that a worker keeps: enough for a slice and its line breaks
_kept: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values one to one."""
    x = np.asarray(x, dtype=np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _tables(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse, n of each at least."""
    global _kept
    if _kept and len(_kept[0]) >= n:
        return _kept
    out = []
    for base in (_BASE, _BASE_INVERSE):
        t = np.ones(1, dtype=np.uint64)
        while len(t) < n:
            t = np.concatenate([t, t * np.uint64(pow(base, len(t), 2**64))])
        out.append(t)
    if n <= KEPT_POWERS:
        _kept = out
    return out


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """One 64-bit hash per word of all texts, and where each text's words begin (one more)."""
    parts = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b"\n".join(parts).lower(), dtype=np.uint8)
    lengths = np.array([len(p) + 1 for p in parts], dtype=np.int64)
    begins = np.concatenate([[0], np.cumsum(lengths)])
    space = np.ones(len(data) + 2, dtype=bool)
    np.take(_IS_SPACE, data, out=space[1:-1])
    edge = np.flatnonzero(space[1:] != space[:-1])
    starts, ends = edge[0::2], edge[1::2]
    powers, inverses = _tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTES[data] * powers[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverses[starts]), np.searchsorted(starts, begins)


def shingle_sets(texts: list[str | None], words: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text.

    A text of fewer words is one shingle; one without words, or null, has the empty set.
    """
    h, begins = word_hashes(texts)
    n = max(0, len(h) - words + 1)
    full = np.full(n, words, dtype=np.uint64)
    for i in range(words):
        full = mix(full * np.uint64(_BASE) + h[i : i + n])
    out = []
    for a, b in zip(begins[:-1].tolist(), begins[1:].tolist()):
        if b - a >= words:
            s = np.sort(full[a : b - words + 1])
            keep = np.ones(len(s), dtype=bool)
            np.not_equal(s[1:], s[:-1], out=keep[1:])
            out.append(s[keep])
        elif b > a:
            one = np.full(1, b - a, dtype=np.uint64)
            for i in range(a, b):
                one = mix(one * np.uint64(_BASE) + h[i])
            out.append(one)
        else:
            out.append(h[:0])
    return out

"""Sets of hashed word shingles of whole texts, a batch of texts at a time in numpy.

Words are runs of bytes other than ASCII white space, with A-Z lower-cased. A set holds the distinct 64-bit hashes of
the runs of five words; a text with one to four words has one element, the hash of all of them; no words, no elements.
"""

from __future__ import annotations

import numpy as np

SIZE = 5
_rng = np.random.default_rng(20240511)
BYTE = _rng.integers(1, 2**63, 256, dtype="uint64") * np.uint64(2) + np.uint64(1)
PLACE = _rng.integers(1, 2**63, SIZE + 1, dtype="uint64") * np.uint64(2) + np.uint64(1)
BASE = np.uint64(0x9E3779B97F4A7C15)
LOWER = np.arange(256, dtype="uint8")
LOWER[65:91] += 32
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[32, 9, 10, 11, 12, 13]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (the splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and the number of the text each one is in."""
    ends = np.cumsum([len(t) + 1 for t in texts])
    data = LOWER[np.frombuffer(b" ".join(texts) + b" ", dtype="uint8")]
    inside = ~IS_SPACE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.zeros(0, dtype="uint64"), np.zeros(0, dtype="int64")
    at = np.flatnonzero(inside)
    place = at - np.repeat(starts, np.diff(np.append(np.searchsorted(at, starts), len(at))))
    powers = np.ones(int(place.max()) + 1, dtype="uint64")
    powers[1:] = BASE
    powers = np.cumprod(powers)
    sums = np.add.reduceat(BYTE[data[at]] * powers[place], np.searchsorted(at, starts))
    return mix(sums), np.searchsorted(ends, starts, side="right")


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text, as unsigned 64-bit numbers."""
    words, owner = word_hashes(texts)
    bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
    runs = np.zeros(0, dtype="uint64")
    if len(words) >= SIZE:
        runs = words[: len(words) - SIZE + 1] * PLACE[0]
        for j in range(1, SIZE):
            runs = runs + words[j : len(words) - SIZE + 1 + j] * PLACE[j]
        runs = mix(runs)
    out = []
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        if b - a >= SIZE:
            out.append(np.unique(runs[a : b - SIZE + 1]))
        elif b > a:
            whole = np.append(words[a:b] * PLACE[: b - a], PLACE[SIZE:] * np.uint64(b - a))
            out.append(mix(whole.sum(dtype="uint64", keepdims=True)))
        else:
            out.append(np.zeros(0, dtype="uint64"))
    return out


def fingerprint(found: np.ndarray) -> int:
    """A signed 64-bit identity of a set."""
    total = mix(found ^ np.uint64(0xD6E8FEB86659FD93)).sum(dtype="uint64", keepdims=True)
    return int(mix(total + np.uint64(len(found))).view("int64")[0])


def blocks_of(column, most: int = 1 << 18):
    """(first row, texts as bytes) of an Arrow string column, about most bytes at a time; null counts as empty."""
    import pyarrow as pa

    texts, size, begin = [], 0, 0
    for i, t in enumerate(column.cast(pa.binary())):
        t = t.as_py() or b""
        texts.append(t)
        size += len(t)
        if size >= most:
            yield begin, texts
            texts, size, begin = [], 0, i + 1
    if texts:
        yield begin, texts

"""Hashes of words and word runs of many texts at once, in numpy."""

from __future__ import annotations

import numpy as np

#: A random odd multiplier per purpose and a random number per byte.
_DRAWS = np.random.default_rng(20240229).integers(1, 1 << 63, 300, dtype=np.uint64)
MARKS = _DRAWS[:256] | np.uint64(1)
STEP, RUN_STEP = _DRAWS[256] | np.uint64(1), _DRAWS[257] | np.uint64(1)

#: Bytes of the words of decontamination, A to Z folded: digits, letters and all beyond ASCII.
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = True
ALNUM[128:] = True
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(step: np.uint64, n: int) -> np.ndarray:
    out = np.ones(max(n, 1), np.uint64)
    out[1:] = step
    return np.multiply.accumulate(out)


def words(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, inside: np.ndarray = ALNUM, fold: np.ndarray = FOLD
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of consecutive texts: each word's hash, text, first byte and the number of words per text.

    The texts lie back to back in ``data``; ``inside`` marks the bytes that words consist of.
    """
    n_texts = len(starts)
    first = int(starts[0]) if n_texts else 0
    codes = data[first : int(ends[-1])] if n_texts else data[:0]
    solid = inside[codes]
    opens = solid.copy()
    opens[1:] &= ~solid[:-1]
    borders = (starts - first)[starts < ends]
    opens[borders] = solid[borders]
    begin = np.flatnonzero(opens)
    if not len(begin):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), begin, np.zeros(n_texts, np.int64)
    edges = np.append(begin, len(codes))
    place = np.arange(begin[0], len(codes)) - np.repeat(begin, np.diff(edges))
    # The gap behind a word counts with it but adds nothing.
    reach = int(np.diff(edges).max())
    marks = MARKS[fold[codes[begin[0] :]]] * powers(STEP, reach)[place]
    marks[~solid[begin[0] :]] = 0
    hashes = mixed(np.add.reduceat(marks, begin - begin[0]))
    owner = np.searchsorted(ends - first, begin, "right")
    return hashes, owner, begin + first, np.bincount(owner, minlength=n_texts)


def runs(hashes: np.ndarray, size: int, salt: int = 0) -> np.ndarray:
    """Hash of each ``size`` consecutive words, also across texts; empty if there are fewer."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(n, salt, np.uint64)
    step = np.uint64(1)
    for i in range(size):
        total += hashes[i : i + n] * step
        with np.errstate(over="ignore"):
            step = step * RUN_STEP
    return mixed(total)

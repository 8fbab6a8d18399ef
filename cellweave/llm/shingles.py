"""Sets of word shingles as 64-bit hashes, many texts at a time."""

from __future__ import annotations

import numpy as np

_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) << np.uint64(1) | np.uint64(1)
_BASE = np.uint64(0x5851F42D4C957F2D)
_STEP = np.uint64(0x9FB21C651E98DF25)


def mixed(x: np.ndarray) -> np.ndarray:
    """Bijective mixing of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    return np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(n, base)]), dtype=np.uint64)


_POWERS = _powers(_BASE, 1 << 16)
_INVERSE = _powers(np.uint64(pow(int(_BASE), -1, 1 << 64)), 1 << 16)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word of all texts, number of words of each text).

    Words are runs of bytes other than blank, tab, line feed, vertical tab, form feed and carriage
    return, with A-Z in lower case.
    """
    data = np.frombuffer(b" ".join(t.lower() for t in texts) + b" ", np.uint8)
    gap = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.flatnonzero(np.diff(np.concatenate([[True], gap])))
    starts, ends = edge[0::2], edge[1::2]
    lens = np.array([len(t) + 1 for t in texts])
    counts = np.diff(np.searchsorted(starts, np.concatenate([[0], np.cumsum(lens)])))
    # sums of byte values times powers of the byte's place in a piece of 2**16 bytes; a word over an edge is summed by piece
    value = _BYTE[data]
    out = np.zeros(len(starts), np.uint64)
    wide = len(_POWERS) - 1
    for lo in range(0, len(data), wide):
        hi = min(lo + wide, len(data))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(value[lo:hi] * _POWERS[: hi - lo], dtype=np.uint64)])
        a, b = np.searchsorted(ends, lo, "right"), np.searchsorted(starts, hi)
        s, e = np.maximum(starts[a:b], lo) - lo, np.minimum(ends[a:b], hi) - lo
        part = (sums[e] - sums[s]) * _INVERSE[s]
        before = np.maximum(lo - starts[a:b], 0)
        out[a:b] += part * _POWERS[np.minimum(before, wide)] if not before.any() else part * _long_powers(before)
    return mixed(out ^ (ends - starts).astype(np.uint64)), counts


def _long_powers(n: np.ndarray) -> np.ndarray:
    return np.array([pow(int(_BASE), int(k), 1 << 64) for k in n], np.uint64)


def shingle_sets(words: np.ndarray, counts: np.ndarray, size: int = 5) -> list[np.ndarray]:
    """Each text's distinct shingles in order; of fewer words than size, the whole sequence as one; of none, nothing."""
    rolled = np.zeros(max(0, len(words) - size + 1), np.uint64)
    for k in range(size):
        rolled = rolled * _STEP + words[k : k + len(rolled)]
    rolled, out, at = mixed(rolled), [], 0
    for n in counts.tolist():
        if n >= size:
            out.append(np.unique(rolled[at : at + n - size + 1]))
        elif n:
            h = np.array([n], np.uint64)
            for w in words[at : at + n]:
                h = h * _STEP + w
            out.append(mixed(h ^ _BASE))
        else:
            out.append(np.zeros(0, np.uint64))
        at += n
    return out


def sequence_keys(words: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of each text's word sequence, as two signed 64-bit columns."""
    ends = np.cumsum(counts)
    starts, place = ends - counts, np.arange(len(words), dtype=np.uint64)
    place -= np.repeat(starts, counts).astype(np.uint64)
    out = []
    for salt in (np.uint64(0x2545F4914F6CDD1D), np.uint64(0xD1342543DE82EF95)):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(words ^ mixed(place * salt + salt)), dtype=np.uint64)])
        out.append(mixed((sums[ends] - sums[starts]) ^ (counts.astype(np.uint64) * salt)).view(np.int64))
    return out[0], out[1]


def min_max_signatures(sets: list[np.ndarray], permutations: int, seed: int = 7) -> np.ndarray:
    """For each set and permutation, the smallest and the largest hash: sets by 2 * permutations."""
    rng = np.random.default_rng(seed)
    factor = rng.integers(0, 1 << 63, permutations, dtype=np.uint64) << np.uint64(1) | np.uint64(1)
    salt = rng.integers(0, 1 << 63, permutations, dtype=np.uint64)
    out = np.zeros((len(sets), 2 * permutations), np.uint64)
    for i, s in enumerate(sets):
        for lo in range(0, len(s), 4096):
            x = s[lo : lo + 4096]
            x = ((x ^ (x >> np.uint64(29)))[None, :] ^ salt[:, None]) * factor[:, None]
            low, high = x.min(axis=1), x.max(axis=1)
            if lo:
                low, high = np.minimum(low, out[i, 0::2]), np.maximum(high, out[i, 1::2])
            out[i, 0::2], out[i, 1::2] = low, high
    return out


def band_keys(signatures: np.ndarray, rows: int) -> np.ndarray:
    """One signed 64-bit key for each band of ``rows`` values of as many permutations, the band's number mixed in.

    Bands of smallest values come first; those of largest ones join the permutations otherwise.
    """
    half = signatures.shape[1] // 2 // rows
    n, used = 2 * half, half * rows
    values = np.concatenate([signatures[:, 0::2][:, :used], np.roll(signatures[:, 1::2], rows // 2, axis=1)[:, :used]], axis=1)
    keys = np.zeros((len(signatures), n), np.uint64)
    for r in range(rows):
        keys = mixed(keys * _STEP + values[:, r : n * rows : rows])
    return mixed(keys ^ (np.arange(n, dtype=np.uint64) * _BASE)[None, :]).view(np.int64)


def sketch_bits(signatures: np.ndarray, planes: int) -> np.ndarray:
    """``planes`` bits of each value, 64 values to a signed word, one plane after the other: sets by planes * values / 64."""
    values = mixed(signatures)
    return np.concatenate([np.packbits(((values >> np.uint64(k)) & np.uint64(1)).astype(np.uint8), axis=1).view(np.int64) for k in range(planes)], axis=1)

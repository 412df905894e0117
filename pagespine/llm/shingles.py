"""Word shingles as 64-bit numbers, and their circulant MinHash signatures."""

import numpy as np

from pagespine.llm.texts import SLICE_BYTES

#: Words of a shingle.
WORDS = 5

_BASE = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xC2B2AE3D27D4EB4F)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base), np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_tables: dict = {}


def _power_tables(n: int):
    """Powers of the base and of its inverse, modulo 2**64."""
    if len(_tables.get("up", ())) < n:
        size = max(n, 1 << 20)
        _tables["up"] = _powers(int(_BASE), size)
        _tables["down"] = _powers(pow(int(_BASE), -1, 1 << 64), size)
    return _tables["up"], _tables["down"]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hashed(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and hash of each word of ``data``, bytes that end with white space."""
    space = _SPACE[data]
    edges = np.flatnonzero(space[1:] != space[:-1]) + 1
    starts = edges[0::2] if space[0] else np.concatenate(([0], edges[1::2]))
    ends = edges[1::2] if space[0] else edges[0::2]
    starts = starts[: len(ends)]
    up, down = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    return starts, mixed((sums[ends] - sums[starts]) * down[starts])


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """First byte and hash of every word, a few megabytes at a time."""
    data = data.translate(_LOWER) + b" "
    whole, at, starts, hashes = np.frombuffer(data, np.uint8), 0, [], []
    while at < len(data):
        stop = at + (SLICE_BYTES >> 2)
        if stop < len(data):
            # The next white space from there on; words are not cut.
            while not _SPACE[data[stop - 1]]:
                stop += 1
        first, found = _hashed(whole[at:stop])
        starts.append(first + at)
        hashes.append(found)
        at = stop
    return np.concatenate(starts), np.concatenate(hashes)


def _combined(words: np.ndarray, size: int) -> np.ndarray:
    """A number for each run of ``size`` word hashes."""
    n = len(words) - size + 1
    total = np.full(n, np.uint64(size), np.uint64)
    for k in range(size):
        total = total * _STEP + words[k : k + n]
    return mixed(total)


def shingle_sets(texts: list) -> list:
    """The sorted distinct shingles of each text; a text of fewer words has one, one without words none."""
    coded = [(text or "").encode() for text in texts]
    starts, words = word_hashes(b"\n".join(coded))
    offsets = np.cumsum([0, *(len(c) + 1 for c in coded)])
    borders = np.searchsorted(starts, offsets)
    sets = []
    for a, b in zip(borders[:-1], borders[1:], strict=True):
        mine = words[a:b]
        sets.append(np.unique(_combined(mine, min(WORDS, len(mine)))) if len(mine) else np.zeros(0, np.uint64))
    return sets


def _mix32(x: np.ndarray) -> np.ndarray:
    """A permutation of the 32-bit numbers, in place."""
    x ^= x >> np.uint32(16)
    x *= np.uint32(0x7FEB352D)
    x ^= x >> np.uint32(15)
    x *= np.uint32(0x846CA68B)
    x ^= x >> np.uint32(16)
    return x


def signature(shingles: np.ndarray, coordinates: int) -> np.ndarray:
    """Circulant MinHash of a set that is not empty.

    The first permutation scatters the elements over the 32-bit numbers; the second one, shifted
    by k, gives coordinate k, so two permutations serve for all coordinates.
    """
    scattered = _mix32((shingles >> np.uint64(32)).astype(np.uint32) ^ shingles.astype(np.uint32))
    shifts = np.arange(coordinates, dtype=np.uint32)[:, None]
    least = np.full(coordinates, 2**32 - 1, np.uint32)
    for start in range(0, len(scattered), 2048):
        part = scattered[None, start : start + 2048] + shifts
        np.minimum(least, _mix32(part).min(axis=1), out=least)
    return least


def bands(least: np.ndarray, rows: int) -> np.ndarray:
    """A number for each band of ``rows`` coordinates."""
    table = least.reshape(-1, rows).astype(np.uint64)
    total = np.arange(len(table), dtype=np.uint64)
    for column in table.T:
        total = total * _STEP + column
    return mixed(total).view(np.int64)

"""Stretches of a text that repeat themselves: maximal runs of words with a period, by internal pattern matching.

Texts of a task are taken together, a few megabytes at a time, as one sequence of word numbers that differ between texts.
Prefix doubling sorts its positions into a suffix array and names, at every power of two, the equal blocks: those of one
name are neighbours in the array. A wavelet tree over the array answers, for whole lists of blocks at once, where a block
occurs next at or after a place (range successor). A run of period q holds a dyadic block whose copy lies q
words further, in a window as long as the block, so the occurrences there give the candidate periods. Three and more
of them are a progression; its candidates follow from where the progression ends beside the block and beside its copies.
Every candidate is then extended word by word to both sides, which decides.

A run is kept if it has 24 words and three periods or more, with its smallest period.

Cases: a null or empty text has no words and no runs and collapses to an empty text. Null doc_ids and repeated rows stay, one
result row per input row. Very long texts are read a part at a time, in memory in proportion to their words. Ties:
runs are listed by start, then period. An empty table gives an empty result; other columns of the input are ignored.
"""

import re
import zlib
from collections import defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagespine.llm.texts import over_texts

LEAST_WORDS = 24
LEAST_PERIODS = 3
#: The shortest blocks. A run of LEAST_WORDS holds one of them and its copy, whatever the period.
BLOCK = 8
#: Bytes of a text that are split at a time, and cells of a comparison.
PART_BYTES = 4 << 20
CELLS = 1 << 20

_SPACE = re.compile(rb"[ \t-\r]")
FOUND = "n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def parts(data: bytes, limit: int = PART_BYTES):
    """Lists of the words of a text; bytes split at exactly the six ASCII white space characters."""
    at = 0
    while at < len(data):
        cut = _SPACE.search(data, at + limit) if len(data) > at + limit else None
        end = cut.start() if cut else len(data)
        yield data[at:end].split()
        at = end


class WaveletTree:
    """Bits of all values, from the highest, each level ordered by the bits above; counts of ones by machine words."""

    def __init__(self, values: np.ndarray):
        self.size = len(values)
        self.levels = []
        for bit in range(max(1, int(self.size).bit_length()) - 1, -1, -1):
            ones = (values >> bit & 1).astype(bool)
            packed = np.packbits(ones, bitorder="little")
            words = np.zeros(len(ones) // 64 + 1, np.uint64)
            words.view(np.uint8)[: len(packed)] = packed
            before = np.r_[0, np.cumsum(np.bitwise_count(words), dtype=np.int64)[:-1]]
            zeros = len(ones) - int(ones.sum())
            self.levels.append((bit, words, before, zeros))
            values = np.r_[values[~ones], values[ones]]

    @staticmethod
    def _ones(level, at: np.ndarray) -> np.ndarray:
        """Set bits before each place."""
        _, words, before, _ = level
        word = at >> 6
        below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return before[word] + np.bitwise_count(words[word] & below)

    def successor(self, low: np.ndarray, high: np.ndarray, least: np.ndarray) -> np.ndarray:
        """The smallest value of at least ``least`` among the places low to high of the array, or ``size`` if none is."""
        a, b, rank = low.copy(), high.copy(), np.zeros(len(low), np.int64)
        for level in self.levels:
            bit, _, _, zeros = level
            one_a, one_b = self._ones(level, a), self._ones(level, b)
            one = (least >> bit & 1).astype(bool)
            rank += np.where(one, (b - one_b) - (a - one_a), 0)
            a, b = np.where(one, zeros + one_a, a - one_a), np.where(one, zeros + one_b, b - one_b)
        there = rank < high - low
        a, b, rank = low[there], high[there], rank[there]
        value = np.zeros(len(a), np.int64)
        for level in self.levels:
            bit, _, _, zeros = level
            one_a, one_b = self._ones(level, a), self._ones(level, b)
            n_zeros = (b - one_b) - (a - one_a)
            one = rank >= n_zeros
            rank -= np.where(one, n_zeros, 0)
            value |= one.astype(np.int64) << bit
            a, b = np.where(one, zeros + one_a, a - one_a), np.where(one, zeros + one_b, b - one_b)
        found = np.full(len(low), self.size, np.int64)
        found[there] = value
        return found


def _named_blocks(words: np.ndarray, ends: np.ndarray, longest: int) -> tuple[np.ndarray, dict]:
    """The suffix array, and for each block length the places, first and last row there, of the aligned blocks that occur twice."""
    n, size, blocks = len(words), 1, {}
    places = np.arange(n)
    names, order = words, None
    while True:
        if order is None:
            key = names
        else:
            following = np.full(n, -1, np.int64)
            following[: n - size] = names[size:]
            following[places + size >= ends] = -1
            key = names * np.int64(n + 1) + (following + 1)
            size *= 2
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        new = np.r_[True, ordered[1:] != ordered[:-1]]
        starts = np.flatnonzero(new)
        group = np.cumsum(new) - 1
        names = np.empty(n, np.int64)
        names[order] = starts[group]
        counts = np.empty(n, np.int64)
        counts[order] = np.diff(np.r_[starts, n])[group]
        if size >= BLOCK:
            aligned = places[::size]
            aligned = aligned[(counts[aligned] > 1) & (aligned + size <= ends[aligned])]
            blocks[size] = aligned, names[aligned], names[aligned] + counts[aligned]
        if len(starts) == n or LEAST_PERIODS * 2 * size > max(longest, LEAST_PERIODS * BLOCK):
            return order, blocks


class _Padded:
    """Word numbers with room on both sides, to compare words a period apart without looking at the borders."""

    def __init__(self, words: np.ndarray):
        self.words, self.n = words, len(words)

    def agree(self, at: np.ndarray, other: np.ndarray) -> np.ndarray:
        inside = (np.minimum(at, other) >= 0) & (np.maximum(at, other) < self.n)
        return inside & (self.words.take(at, mode="clip") == self.words.take(other, mode="clip"))

    def reach(self, at: np.ndarray, distance: np.ndarray, limit: int, step: int) -> np.ndarray:
        """How many words from ``at`` on (backwards, before ``at``, if ``step`` is -1) equal those ``distance`` further, up to ``limit``."""
        reached = np.empty(len(at), np.int64)
        rows = max(1, CELLS // limit)
        offsets = np.arange(limit) if step > 0 else -1 - np.arange(limit)
        for i in range(0, len(at), rows):
            here = at[i : i + rows, None] + offsets
            differ = ~self.agree(here, here + distance[i : i + rows, None])
            reached[i : i + rows] = np.where(differ.any(axis=1), differ.argmax(axis=1), limit)
        return reached

    def extend(self, start: int, end: int, period: int) -> tuple[int, int]:
        """The whole stretch around start to end in which words equal those ``period`` further."""
        words, n, step = self.words, self.n, 64
        while True:
            low = max(0, start - step)
            differ = np.flatnonzero(words[low:start] != words[low + period : start + period])
            if differ.size:
                start = low + int(differ[-1]) + 1
                break
            start = low
            if low == 0:
                break
            step *= 2
        step = 64
        while True:
            high = min(n - period, end + step)
            differ = np.flatnonzero(words[end:high] != words[end + period : high + period])
            if differ.size:
                end += int(differ[0])
                break
            end = max(end, high)
            if high == n - period:
                break
            step *= 2
        return start, end


def _candidates(size: int, block, tree: WaveletTree, text: _Padded) -> tuple[np.ndarray, np.ndarray]:
    """Places of blocks and periods of which their neighbouring windows speak."""
    place, low, high = block
    found = []
    if size == BLOCK:
        first = tree.successor(low, high, place + 1)
        near = first < place + size
        found.append((place[near], first[near] - place[near]))

    def inside(occurrence, at):
        return occurrence < at + 2 * size

    first = tree.successor(low, high, place + size)
    some = inside(first, place)
    place, low, high, first = place[some], low[some], high[some], first[some]
    second = tree.successor(low, high, first + 1)
    two = inside(second, place)
    third = np.full(len(place), tree.size, np.int64)
    third[two] = tree.successor(low[two], high[two], second[two] + 1)
    many = two & inside(third, place)
    found.append((place[~many], first[~many] - place[~many]))
    pair = two & ~many
    found.append((place[pair], second[pair] - place[pair]))
    if many.any():
        place, first = place[many], first[many]
        step = second[many] - first
        right = text.reach(place, step, 3 * size, 1)
        right_copy = text.reach(first, step, 5 * size, 1)
        left = text.reach(place, step, size, -1)
        left_copy = text.reach(first, step, 3 * size, -1)
        for period, sure in (
            (first + right_copy - place - right, (right < 3 * size) & (right_copy < 5 * size)),
            (first - left_copy - place + left, (left < size) & (left_copy < 3 * size)),
        ):
            sure &= (period >= size) & (period < 2 * size)
            at, period = place[sure], period[sure]
            copied = text.reach(at, period, size, 1) == size
            found.append((at[copied], period[copied]))
    return np.concatenate([p for p, _ in found]), np.concatenate([q for _, q in found])


def runs_of(words: np.ndarray, sizes: np.ndarray) -> list:
    """(start, end, period) of all runs in a sequence of texts whose word numbers differ from text to text."""
    if not len(words):
        return []
    ends = np.repeat(np.cumsum(sizes), sizes)
    order, blocks = _named_blocks(words, ends, int(sizes.max()))
    tree, text, smallest = WaveletTree(order), _Padded(words), {}
    for size, block in blocks.items():
        place, period = _candidates(size, block, tree, text)
        by = np.lexsort((place, period))
        place, period = place[by], period[by]
        # Blocks one after another with one period belong together.
        begins = np.r_[True, (np.diff(period) != 0) | (np.diff(place) > size)] if len(place) else np.zeros(0, bool)
        first = np.flatnonzero(begins)
        last = np.r_[first[1:] - 1, len(place) - 1] if len(place) else first
        done_period, done_end = 0, 0
        for i, j in zip(first.tolist(), last.tolist(), strict=True):
            q = int(period[i])
            if q == done_period and place[i] < done_end:
                continue
            start, end = text.extend(int(place[i]), int(place[j]) + size, q)
            done_period, done_end = q, end
            stretch = (start, end + q)
            if end + q - start >= max(LEAST_WORDS, LEAST_PERIODS * q):
                smallest[stretch] = min(q, smallest.get(stretch, q))
    return sorted((start, end, q) for (start, end), q in smallest.items())


def _may_repeat(words: np.ndarray, owner: np.ndarray, n_texts: int) -> np.ndarray:
    """Texts in which some BLOCK words may stand twice; all others have no runs."""
    may = np.zeros(n_texts, bool)
    if len(words) < BLOCK:
        return may
    sums, factor = words.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), 0xD6E8FEB86659FD93
    for size in (1, 2, 4):
        sums = sums[:-size] * np.uint64(factor) + (sums[size:] ^ (sums[size:] >> np.uint64(29)))
        factor = factor * factor % 2**64
    order = np.argsort(sums)
    twice = np.flatnonzero(sums[order[1:]] == sums[order[:-1]])
    may[owner[order[twice]]] = True
    return may


def find(texts: list) -> list:
    """Number of words, runs and the collapsed text of each text."""
    texts = [(text or "").encode() for text in texts]
    numbers = defaultdict(count().__next__)
    coded = [np.concatenate([np.fromiter(map(numbers.__getitem__, part), np.int64, len(part)) for part in parts(t)] or [np.zeros(0, np.int64)]) for t in texts]
    sizes = np.array([len(c) for c in coded], np.int64)
    owner = np.repeat(np.arange(len(texts)), sizes)
    words = np.concatenate(coded) + owner * max(1, len(numbers)) if coded else np.zeros(0, np.int64)
    del coded, numbers
    may = _may_repeat(words, owner, len(texts))
    chosen, sizes_chosen = np.flatnonzero(may), sizes[may]
    starts = np.r_[0, np.cumsum(sizes_chosen)]
    found = [[] for _ in texts]
    for start, end, period in runs_of(words[may[owner]], sizes_chosen):
        at = int(np.searchsorted(starts, start, "right")) - 1
        found[chosen[at]].append((start - int(starts[at]), end - start, period))
    return [
        (int(n), [{"start": s, "length": length, "period": q} for s, length, q in runs], _collapsed(text, int(n), runs))
        for text, n, runs in zip(texts, sizes, found, strict=True)
    ]


def _collapsed(text: bytes, n: int, runs: list) -> str:
    """The text's words with one space between; of each run only the first period stays."""
    if not runs:
        return b" ".join(b" ".join(part) for part in parts(text)).decode()
    change = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    kept, at, lists = np.cumsum(change[:n]) == 0, 0, []
    for part in parts(text):
        chosen = [word for word, keep in zip(part, kept[at : at + len(part)].tolist(), strict=True) if keep]
        at += len(part)
        if chosen:
            lists.append(b" ".join(chosen))
    return b" ".join(lists).decode()


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, runs (start, length, period) and collapsed (the text without repetitions) of every text."""
    found = over_texts(find, FOUND)("text").alias("r")
    return docs.select("doc_id", found).select("doc_id", "r.n_words", "r.runs", "r.collapsed")


def with_periodic_tails(docs: DataFrame) -> DataFrame:
    """doc_id and text, where a tenth of the ids, chosen by checksum, have the words from some place on replaced by repetitions.

    A null id keeps its text, and so does a text without words.
    """

    def planted(texts: pa.Array, sums: pa.Array) -> pa.Array:
        return pa.array([_tailed(text, h) for text, h in zip(texts.to_pylist(), sums.to_pylist(), strict=True)], pa.string())

    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    return docs.select("doc_id", F.arrow_udf(planted, "string").asNondeterministic()(F.col("text"), chosen).alias("text"))


def _tailed(text: str | None, checksum: int | None) -> str | None:
    if text is None or checksum is None or checksum % 10:
        return text
    words, g = text.encode().split(), checksum // 10
    if not words:
        return text
    n = len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    tail = words[a : a + p]
    whole, rest = divmod(n - a, p)
    return b" ".join(words[:a] + tail * whole + tail[:rest]).decode()


def checksum(doc_id) -> int:
    """The checksum that chooses and places a tail."""
    return zlib.crc32(str(doc_id).encode())

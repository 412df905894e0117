"""Byte-level BPE: texts to token ids and back, in matrices of many words at once.

A text is cut by the vocabulary's pattern. The distinct words that a task does not know yet are laid out as rows of
token ids, in matrices by length and padded to the width of their bucket. In each round every row looks up
the ranks of all its adjacent pairs in a hash table, merges the leftmost pair of least rank and closes the gap, so that
the matrix becomes one column narrower; rows without a pair left leave it. Very long words are rows of their own, in which
a round merges all places of the least rank that single merges would take next, one after another.

Cases: a null or empty text has no ids and decodes to no bytes. Null doc_ids and repeated rows stay, one result row per
input row. Very long texts are cut a part at a time, and single words of any length are merged in memory in
proportion to them. Ties between equal pairs go to the leftmost. An empty table gives an empty result; other columns of the
input are ignored. Strings that look like special tokens are ordinary text.
"""

import base64
import re
import sys
import unicodedata
from functools import lru_cache
from itertools import islice

import numpy as np
import public_tokenizers
import regex
import tiktoken
from pyspark.sql import DataFrame

from pagespine.llm.texts import over_texts

VOCABULARY = "byte_bpe_50k.tiktoken"
#: Rows wider than this are merged by themselves.
WIDEST = 256
#: Cells of one matrix.
CELLS = 1 << 17
#: Words whose ids a task remembers. Only speed depends on it.
REMEMBERED = 100_000
#: Words of a text that are cut at a time.
WORDS_AT_ONCE = 200_000

NONE = np.int32(2**31 - 1)
PAD = np.int64(-1)
_EMPTY = np.int64(-(2**63))
_LATE = re.compile("[\u0530-\U0010ffff]")


class PairTable:
    """Open addressing with linear probing: (left id, right id) to the rank of their merge, for whole arrays at a time."""

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray):
        bits = max(4, int(2 * len(left)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, _EMPTY, np.int64)
        self.ranks = np.full(1 << bits, NONE, np.int32)
        keys = (left.astype(np.int64) << 32) | right.astype(np.int64)
        at, waiting = self._slot(keys), np.arange(len(keys))
        while waiting.size:
            free = self.keys[at] == _EMPTY
            self.keys[at[free]] = keys[waiting[free]]
            placed = self.keys[at] == keys[waiting]
            self.ranks[at[placed]] = rank[waiting[placed]]
            waiting, at = waiting[~placed], (at[~placed] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def look_up(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, NONE where the two do not merge or one of them is padding."""
        keys = ((left << 32) + right).ravel()
        found = np.full(keys.size, NONE, np.int32)
        at = self._slot(keys)
        seen = self.keys[at]
        hit = seen == keys
        found[hit] = self.ranks[at[hit]]
        open_ = np.flatnonzero(~hit & (seen != _EMPTY))
        at = at[open_]
        while open_.size:
            at = (at + 1) & self.mask
            seen = self.keys[at]
            hit = seen == keys[open_]
            found[open_[hit]] = self.ranks[at[hit]]
            go_on = ~hit & (seen != _EMPTY)
            open_, at = open_[go_on], at[go_on]
        return found.reshape(left.shape)


def merge_rows(ids: np.ndarray, pairs: PairTable) -> list:
    """Final ids of each row of a padded matrix, as little-endian 32-bit numbers. Takes the matrix over."""
    done = [b""] * len(ids)
    rows, ranks = np.arange(len(ids)), pairs.look_up(ids[:, :-1], ids[:, 1:])
    while True:
        best = ranks.min(axis=1, initial=NONE)
        ended = best == NONE
        if ended.any():
            for row, final in zip(rows[ended].tolist(), ids[ended].astype("<i4"), strict=True):
                done[row] = final[final >= 0].tobytes()
            stay = ~ended
            rows, ids, ranks, best = rows[stay], ids[stay], ranks[stay], best[stay]
        if not rows.size:
            return done
        n, width = ids.shape
        line, at = np.arange(n), ranks.argmin(axis=1)
        ids[line, at] = best
        kept = np.ones((n, width), bool)
        kept[line, at + 1] = False
        ids = ids[kept].reshape(n, width - 1)
        kept = np.ones((n, width - 1), bool)
        kept[line, at] = False
        ranks = ranks[kept].reshape(n, width - 2)
        for pair in (at - 1, at):
            here = np.flatnonzero((pair >= 0) & (pair < width - 2))
            ranks[here, pair[here]] = pairs.look_up(ids[here, pair[here]], ids[here, pair[here] + 1])


def merge_long(ids: np.ndarray, pairs: PairTable) -> bytes:
    """Final ids of one long row. Takes the row over.

    All places of the least rank merge in one round, from the left, up to the first one after which
    a new pair of a lower rank would come first.
    """
    ranks = pairs.look_up(ids[:-1], ids[1:])
    while ranks.size:
        best = ranks.min()
        if best == NONE:
            break
        places = np.flatnonzero(ranks == best)
        # Of places one after another, every second one is left over when its left neighbour has merged.
        start = np.r_[True, np.diff(places) > 1]
        first = places[start][np.cumsum(start) - 1]
        places = places[(places - first) % 2 == 0]
        before = ids[np.maximum(places - 1, 0)]
        before[1:][places[1:] - places[:-1] == 2] = best
        before[places == 0] = PAD
        after = np.r_[ids, PAD][places + 2]
        merged = np.full(len(places), np.int64(best))
        earlier = np.minimum(pairs.look_up(before, merged), pairs.look_up(merged, after)) < best
        if earlier.any():
            places = places[: int(earlier.argmax()) + 1]
        ids[places] = best
        kept = np.ones(len(ids), bool)
        kept[places + 1] = False
        ids = ids[kept]
        kept = np.ones(len(ranks), bool)
        kept[places] = False
        ranks = ranks[kept]
        now = places - np.arange(len(places))
        touched = np.unique(np.r_[now - 1, now])
        touched = touched[(touched >= 0) & (touched < len(ranks))]
        ranks[touched] = pairs.look_up(ids[touched], ids[touched + 1])
    return ids.astype("<i4").tobytes()


class ByteBpe:
    """A vocabulary of ranks, and the words met so far."""

    def __init__(self, path: str | None, pattern: str):
        self.ranks = _ranks(path)
        self.single = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        made = [
            (self.ranks[token[:cut]], self.ranks[token[cut:]], rank)
            for token, rank in self.ranks.items()
            for cut in range(1, len(token))
            if token[:cut] in self.ranks and token[cut:] in self.ranks
        ]
        self.pairs = PairTable(*np.array(made, np.int64).reshape(-1, 3).T)
        self.pattern, self.usual = pattern, regex.compile(pattern)
        self.new, self.old = {}, {}

    def _splitter(self, text: str):
        if text.isascii() or not _LATE.search(text) or not any(unicodedata.category(c) == "Cn" for c in set(text)):
            return self.usual
        return _adapted(self.pattern)

    def words(self, text: str):
        """The text's words, in lists of bounded length."""
        splitter = self._splitter(text)
        if len(text) < 4 * WORDS_AT_ONCE:
            yield splitter.findall(text)
            return
        found = splitter.finditer(text)
        while part := [m.group() for m in islice(found, WORDS_AT_ONCE)]:
            yield part

    def _learn(self, words) -> None:
        """Ids of words that are not remembered: matrices by length, long words alone."""
        buckets = {}
        for word in words:
            data = word.encode()
            whole = self.ranks.get(data)
            if whole is not None:
                self.new[word] = whole.to_bytes(4, "little")
            elif len(data) > WIDEST:
                self.new[word] = merge_long(self.single[np.frombuffer(data, np.uint8)], self.pairs)
            else:
                buckets.setdefault((len(data) - 1).bit_length(), []).append((word, data))
        for bits, rows in buckets.items():
            width = 1 << bits
            for at in range(0, len(rows), max(1, CELLS // width)):
                part = rows[at : at + max(1, CELLS // width)]
                flat = np.frombuffer(b"".join(data.ljust(width, b"\0") for _, data in part), np.uint8).reshape(-1, width)
                sizes = np.array([len(data) for _, data in part])
                ids = np.where(np.arange(width) < sizes[:, None], self.single[flat], PAD)
                self.new.update(zip((word for word, _ in part), merge_rows(ids, self.pairs), strict=True))

    def _know(self, parts: list) -> None:
        """All words of these lists at once, so that matrices have many rows."""
        unknown = set().union(*parts).difference(self.new)
        for word in unknown & self.old.keys():
            self.new[word] = self.old[word]
        self._learn(unknown - self.old.keys())

    def encode(self, texts: list) -> list:
        """The ids of each text as little-endian 32-bit numbers."""
        ids, parts, owners, held = [[] for _ in texts], [], [], 0

        def settle():
            self._know(parts)
            for owner, words in zip(owners, parts, strict=True):
                ids[owner].append(b"".join(map(self.new.__getitem__, words)))
            if len(self.new) > REMEMBERED:
                self.old, self.new = self.new, {}

        for i, text in enumerate(texts):
            for words in self.words(text or ""):
                parts.append(words)
                owners.append(i)
                held += len(words)
                if held >= WORDS_AT_ONCE:
                    settle()
                    parts, owners, held = [], [], 0
        settle()
        return [b"".join(one) for one in ids]


def _ranks(path: str | None) -> dict:
    """Rank of every token; None is the public vocabulary of the machine that asks."""
    with open(path or public_tokenizers.path(VOCABULARY), "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


@lru_cache(maxsize=2)
def _adapted(pattern: str):
    """The pattern without letters and numbers that only this process's regular expressions know.

    The public library's character classes are of an older Unicode version. Only characters younger than
    the standard library's tables can differ, so it is asked about those, once, when a text has such characters.
    """
    ranks = {bytes([b]): b for b in range(256)}
    young = [c for c in map(chr, range(128, sys.maxunicode + 1)) if unicodedata.category(c) == "Cn"]
    every = ""
    for kind in (r"\p{L}", r"\p{N}"):
        own = regex.compile(kind)
        theirs = tiktoken.Encoding("class", pat_str=kind, mergeable_ranks=ranks, special_tokens={})
        chars = "".join(c for c in young if own.match(c) and not theirs.encode_ordinary(c))
        if chars:
            pattern = pattern.replace(f" ?{kind}+", f" ?(?:(?![{chars}]){kind})+")
            every += chars
    if every:
        pattern = pattern.replace(r" ?[^\s\p{L}\p{N}]+", rf" ?(?:[^\s\p{{L}}\p{{N}}]|[{every}])+")
    return regex.compile(pattern)


@lru_cache(maxsize=2)
def vocabulary(path: str | None = None, pattern: str = public_tokenizers.PATTERN) -> ByteBpe:
    """Loaded where it is used, once per worker."""
    return ByteBpe(path, pattern)


@lru_cache(maxsize=2)
def token_bytes(path: str | None = None) -> dict:
    """The bytes of each id; all that decoding needs."""
    return {rank: token for token, rank in _ranks(path).items()}


def decode(ids: bytes, path: str | None = None) -> bytes:
    return b"".join(map(token_bytes(path).__getitem__, np.frombuffer(ids, "<u4").tolist()))


def encoded(docs: DataFrame, path: str | None = None, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """doc_id, n_tokens and ids (little-endian 32-bit numbers) of every text."""

    def kernel(texts):
        return [(len(ids) // 4, ids) for ids in vocabulary(path, pattern).encode(texts)]

    made = over_texts(kernel, "n_tokens long, ids binary")
    return docs.select("doc_id", made("text").alias("r")).select("doc_id", "r.n_tokens", "r.ids")


def decoded(tokens: DataFrame, path: str | None = None) -> DataFrame:
    """The rows of ``encoded`` with the bytes that their ids stand for."""
    back = over_texts(lambda rows: [(decode(ids or b"", path),) for ids in rows], "bytes binary")
    return tokens.select("doc_id", "n_tokens", "ids", back("ids").alias("r")).select("doc_id", "n_tokens", "ids", "r.bytes")


def round_trip(docs: DataFrame, path: str | None = None, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """What ``decoded(encoded(docs))`` gives, in one pass of the same workers."""

    def kernel(texts):
        return [(len(ids) // 4, ids, decode(ids, path)) for ids in vocabulary(path, pattern).encode(texts)]

    made = over_texts(kernel, "n_tokens long, ids binary, bytes binary")
    return docs.select("doc_id", made("text").alias("r")).select("doc_id", "r.n_tokens", "r.ids", "r.bytes")

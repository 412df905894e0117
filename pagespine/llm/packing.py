"""Packing documents into token sequences of fixed length.

Documents become token ids and are cut every ``LENGTH`` ids; all but the last piece of a document
fill a sequence each. Pieces are dealt into random groups, and in each group they are packed
first fit decreasing: a tournament tree over the free room of all sequences leads to the
first one that a piece fits into.

Cases: a null or empty text is the end id alone, one piece of length 1. Null ids and repeated
rows are packed like others, each row for itself. An empty table gives an empty result; other
columns of the input are ignored.
"""

import re
import uuid
import zlib
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pagespine.llm.texts import over_texts
from pagespine.session import checkpoint_dir

LENGTH = 2048
END_ID = 1
#: Pieces of a group: large enough that the last sequences of a group, which stay open, do not matter.
GROUP_PIECES = 20_000
#: Words whose ids a task remembers. Only speed depends on it.
REMEMBERED = 300_000

TOKENS = "doc_tokens long, pieces array<struct<start: long, length: long, ids_crc32: long>>"
PACKED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"

# Words of ASCII and Latin-1 letters in lower case, as the tokenizer's own rule splits them.
_PLAIN = re.compile(r"[\x21-\x7eß-öø-ÿ]+")
_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")


def _byte_letters() -> dict:
    """Fixed values of byte-level vocabularies: the character that stands for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class WordIds:
    """Ids of a text, word by word.

    The tokenizer drops white space and treats what stands between it separately, so ids of
    words can be remembered. A word of letters, digits and signs is split here and goes to the tokenizer's model;
    any other one goes to the whole tokenizer.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self.new, self.old = {}, {}

    def _ids(self, word: bytes) -> bytes:
        text = word.decode()
        lower = text.lower()
        if "<|" in text or not _PLAIN.fullmatch(lower):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        ids = []
        for piece in _PIECES.findall(lower):
            if not piece.isascii():
                piece = piece.encode().decode("latin-1").translate(self.letters)
            ids += [token.id for token in self.model.tokenize(piece)]
        return np.array(ids, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        """The ids as little-endian 32-bit numbers."""
        # ASCII letters in lower case: words differ less, ids do not. Special tokens are in lower case anyway.
        words = text.encode().lower().split() if "<|" not in text else text.encode().split()
        found = list(map(self.new.get, words))
        if None in found:
            for i, ids in enumerate(found):
                if ids is None:
                    word = words[i]
                    ids = self.new.get(word)
                    if ids is None:
                        ids = self.old.get(word)
                        if ids is None:
                            ids = self._ids(word)
                        self.new[word] = ids
                    found[i] = ids
            if len(self.new) > REMEMBERED:
                self.old, self.new = self.new, {}
        return b"".join(found)


@lru_cache(maxsize=2)
def _word_ids(path: str) -> WordIds:
    return WordIds(path)


class _Cut:
    """Kernel: token count and pieces of each text."""

    def __init__(self, path: str, length: int):
        self.path, self.length = path, length

    def __call__(self, texts: list) -> list:
        words, rows, step = _word_ids(self.path), [], 4 * self.length
        for text in texts:
            data = words.encode(text or "") + END_ID.to_bytes(4, "little")
            pieces = []
            for at in range(0, len(data), step):
                part = data[at : at + step]
                pieces.append({"start": at // 4, "length": len(part) // 4, "ids_crc32": zlib.crc32(part)})
            rows.append((len(data) // 4, pieces))
        return rows


def pieces(docs: DataFrame, length: int = LENGTH, tokenizer: str | None = None) -> DataFrame:
    """doc_id, start, length, ids_crc32 and doc_tokens of every piece."""
    path = tokenizer or public_tokenizers.path("word_bpe_49k.json")
    cut = docs.select("doc_id", over_texts(_Cut(path, length), TOKENS)("text").alias("r"))
    return cut.select("doc_id", "r.doc_tokens", F.explode("r.pieces").alias("p")).select("doc_id", "p.*", "doc_tokens")


class RoomTree:
    """Tournament tree: leaves hold the free room of sequences, inner nodes the larger of their two."""

    def __init__(self, sequences: int, room: int):
        self.width = 1 << max(0, sequences - 1).bit_length()
        self.tree = [room] * (2 * self.width)

    def place(self, size: int) -> tuple[int, int]:
        """The first sequence with room for ``size``, and the room it had; the room is taken."""
        tree, node = self.tree, 1
        while node < self.width:
            node *= 2
            if tree[node] < size:
                node += 1
        had = tree[node]
        tree[node] = had - size
        sequence = node - self.width
        while node > 1:
            node //= 2
            best = max(tree[2 * node], tree[2 * node + 1])
            if tree[node] == best:
                break
            tree[node] = best
        return sequence, had


def first_fit_decreasing(lengths: np.ndarray, room: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each piece; longer pieces are placed first, equal ones in their order."""
    tree = RoomTree(len(lengths), room)
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for i in np.argsort(-lengths, kind="stable").tolist():
        sequence[i], had = tree.place(int(lengths[i]))
        offset[i] = room - had
    return sequence, offset


def _packer(room: int):
    def packed(table: pa.Table) -> pa.Table:
        table = table.sort_by([("place", "ascending")])
        sequence, offset = first_fit_decreasing(table["length"].to_numpy(), room)
        ids = pa.array((table["part"].to_numpy().astype(np.int64) << 32) + sequence)
        kept = table.select(["doc_id", "start", "length", "ids_crc32", "doc_tokens"])
        return kept.append_column("sequence_id", ids).append_column("offset", pa.array(offset))

    return packed


def pack(docs: DataFrame, length: int = LENGTH, tokenizer: str | None = None, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Every piece with its sequence and its offset there.

    The pieces (a few numbers each, no ids) are stored once, so that their count gives the number of groups and a
    lost task finds the same groups again.
    """
    spark = docs.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/pieces-{uuid.uuid4().hex}"
    pieces(docs, length, tokenizer).withColumn("place", F.monotonically_increasing_id()).write.parquet(path)
    stored = spark.read.parquet(path)
    groups = max(1, -(-stored.count() // group_pieces))
    dealt = stored.withColumn("part", F.pmod(F.xxhash64("place", F.lit(11)), F.lit(groups)).cast("int"))
    return dealt.groupBy("part").applyInArrow(_packer(length), PACKED)

"""Language of texts by hyperdimensional profiles.

Every letter has a random vector of +1 and -1. A run of three letters is bound into one vector:
its letters' vectors, permuted by their place, are multiplied. A text is the bundle (sum) of the vectors of its runs,
a language that of its texts, and a text gets the language whose prototype has the largest cosine with it.

Counts of runs are summed before any vector is made: bundling is linear, so a language's
prototype is its counts times the vectors of the runs.

Cases: a null text, or one without a letter, is ``und`` with score 0, and so is every text
where nothing was learned. Null ids are not held out; repeated rows count as often as they
occur. An empty table gives an empty result; other columns of the input are ignored. Of several languages
with the same cosine, the first in alphabetical order is taken.
"""

import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagespine.llm.texts import over_texts, slices

#: Length of the vectors, letters that are told apart (0 is a gap; rarer letters share numbers), seed of the letters' vectors.
DIMENSIONS, SYMBOLS, SEED = 1024, 64, 20
UNKNOWN = "und"

_COUNTS = "lang string, run int, n long"


@lru_cache(maxsize=1)
def _symbols() -> np.ndarray:
    """Number of each code point: 1 to 26 for a to z in either case, 27 to 63 for other letters, else 0."""
    table = np.zeros(0x110000, np.uint8)
    for point in range(0x110000):
        letter = chr(point)
        if letter.isalpha():
            lower = unicodedata.normalize("NFC", letter.lower())[0]
            table[point] = ord(lower) - 96 if "a" <= lower <= "z" else 27 + ord(lower) * 31 % (SYMBOLS - 27)
    return table


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Vectors of the symbols at the first, second and third place: the letter's vector turned by two, one and no steps."""
    vectors = np.random.default_rng(SEED).choice(np.array([-1, 1], np.int8), (SYMBOLS, DIMENSIONS))
    return np.stack([np.roll(vectors, 2, axis=1), np.roll(vectors, 1, axis=1), vectors])


def run_vectors(runs: np.ndarray) -> np.ndarray:
    first, second, third = _letters()
    return first[runs >> 12] * second[runs >> 6 & 63] * third[runs & 63]


def _runs(text: str) -> np.ndarray:
    """Numbers of a text's runs of three symbols; gaps count once, and the text stands between two gaps."""
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    symbols = np.zeros(len(points) + 2, np.uint8)
    symbols[1:-1] = _symbols()[points]
    kept = symbols[np.concatenate(([True], (symbols[1:] > 0) | (symbols[:-1] > 0)))].astype(np.int32)
    return (kept[:-2] << 12) + (kept[1:-1] << 6) + kept[2:]


def _counted(texts: list, owners) -> tuple:
    """Owner, run and count of all runs of ``texts``, sorted by owner and run."""
    runs = [_runs(text or "") for text in texts]
    if not runs:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    keys = np.concatenate([(np.int64(owner) << 18) + run for owner, run in zip(owners, runs, strict=True)])
    keys, counts = np.unique(keys, return_counts=True)
    return keys >> 18, keys & (1 << 18) - 1, counts


def _bundles(owner, run, count, owners: int, dtype=np.float32) -> np.ndarray:
    """Sum of the run vectors of each owner. Whole numbers, exact in ``dtype`` up to its precision."""
    total = np.zeros((owners, DIMENSIONS), dtype)
    distinct, column = np.unique(run, return_inverse=True)
    for start in range(0, len(distinct), 2048):
        part = distinct[start : start + 2048]
        inside = (column >= start) & (column < start + 2048)
        weights = np.zeros((owners, len(part)), dtype)
        weights[owner[inside], column[inside] - start] = count[inside]
        total += weights @ run_vectors(part).astype(dtype)
    return total


def _learn(batches):
    """Counts of runs by language, summed over a task's texts before they leave it."""
    names, total = [], {}
    for batch in batches:
        langs, at = batch["lang"].to_pylist(), 0
        for texts in slices(batch["text"]):
            for lang in langs[at : at + len(texts)]:
                if lang not in total:
                    total[lang] = np.zeros(SYMBOLS**3, np.int64)
                    names.append(lang)
            owner, run, count = _counted(texts, [names.index(lang) for lang in langs[at : at + len(texts)]])
            for number in np.unique(owner).tolist():
                total[names[number]][run[owner == number]] += count[owner == number]
            at += len(texts)
    for lang in names:
        (runs,) = np.nonzero(total[lang])
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(runs), pa.string()), pa.array(runs, pa.int32()), pa.array(total[lang][runs], pa.int64())], ["lang", "run", "n"]
        )


def _bundle(table: pa.Table) -> pa.Table:
    runs = table["run"].to_numpy()
    total = _bundles(np.zeros(len(runs), np.int64), runs, table["n"].to_numpy(), 1, np.float64)
    return pa.table({"lang": table["lang"][:1], "prototype": pa.array([total[0].tolist()], pa.list_(pa.float64()))})


def prototypes(docs: DataFrame) -> DataFrame:
    """A vector per language, learned from all rows of ``docs`` that have text and language."""
    rows = docs.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    counts = rows.filter("text IS NOT NULL AND lang IS NOT NULL").mapInArrow(_learn, _COUNTS)
    summed = counts.groupBy("lang", "run").agg(F.sum("n").alias("n"))
    return summed.groupBy("lang").applyInArrow(_bundle, "lang string, prototype array<double>")


class _Predict:
    """Kernel: language and cosine of each text."""

    def __init__(self, learned: dict):
        self.names = sorted(learned)
        vectors = np.array([learned[n] for n in self.names], np.float64).reshape(len(self.names), DIMENSIONS)
        self.units = vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)

    def __call__(self, texts: list) -> list:
        rows = [(UNKNOWN, 0.0)] * len(texts)
        owner, run, count = _counted(texts, range(len(texts)))
        if not self.names or not len(owner):
            return rows
        found, place = np.unique(owner, return_inverse=True)
        for start in range(0, len(found), 256):
            inside = (place >= start) & (place < start + 256)
            here = min(256, len(found) - start)
            bundles = _bundles(place[inside] - start, run[inside], count[inside], here).astype(np.float64)
            norms = np.maximum(np.linalg.norm(bundles, axis=1), 1e-9)
            cosines = np.round(bundles @ self.units.T / norms[:, None], 9)
            for text, best in zip(found[start : start + here].tolist(), cosines, strict=True):
                rows[text] = (self.names[int(best.argmax())], float(min(1.0, max(0.0, best.max()))))
        return rows


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that are never learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def identify(docs: DataFrame, learned: DataFrame | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred and score.

    Only the prototypes come to the driver: DIMENSIONS numbers for each language.
    """
    learned = prototypes(docs.filter(~held_out())) if learned is None else learned
    vectors = {row.lang: row.prototype for row in learned.collect()}
    predict = over_texts(_Predict(vectors), "lang_pred string, score double")
    return docs.select("doc_id", held_out().alias("held_out"), predict("text").alias("r")).select("doc_id", "held_out", "r.*")

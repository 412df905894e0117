"""Benchmark passages in documents, by suffix arrays.

A shard of documents becomes one sequence of word numbers; its suffix array orders the places
by the words that follow, up to the length of a window. Every suffix of every benchmark item
is looked up by binary search, in all shards. What it finds are verbatim matches, which are
then extended along item and document to their full length.

Only words of the benchmark have a number, and a place followed by fewer of them than the
shortest window has words cannot match, so it stays out of the array.

The benchmark travels to the tasks in blocks of at most ``BLOCK_BYTES`` of text (one item at
least); a benchmark of more blocks takes one pass each, and hits are united.

Cases: a null or empty text has no words, and neither hits nor items. Null ids and repeated
rows stay, one result per input row. Items without words are never found; repeated item ids
count once; a null item id is named ``null``. No documents or no items give no hits. Other
columns of the input are ignored by ``scan`` and kept by ``clean``.
"""

import uuid

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagespine.llm.licenses import words_of
from pagespine.llm.texts import fresh, over_texts
from pagespine.session import stage_table

WINDOW = 10
BLOCK_BYTES = 16 << 20

_MATCH = "struct<item_id: string, start: long, item_start: long, length: long>"
HITS = f"n_words long, hits array<struct<s: long, e: long>>, items array<string>, matches array<{_MATCH}>"


class TestSuffixes:
    """The windows of a block of items, ready to be looked up."""

    def __init__(self, items: list, window: int):
        self.window, self.numbers = window, {}
        starts, sizes, owners, places, self.names = [], [], [], [], []
        sequence = []
        for name, text in items:
            words = words_of(text or "")
            size = min(window, len(words))
            for place in range(len(words) - size + 1 if words else 0):
                starts.append(len(sequence) + place)
                sizes.append(size)
                owners.append(len(self.names))
                places.append(place)
            sequence += [self.numbers.setdefault(w, len(self.numbers) + 1) for w in words] + [0] * window
            self.names.append(name)
        self.sizes = np.array(sizes, np.int64)
        self.owners, self.places = np.array(owners, np.int64), np.array(places, np.int64)
        sequence = np.array(sequence + [0] * window, np.int64)
        rows = sequence[np.array(starts, np.int64)[:, None] + np.arange(window)]
        beyond = np.arange(window) >= self.sizes[:, None]
        self.low, self.high = keys(np.where(beyond, 0, rows)), keys(np.where(beyond, 2**32 - 1, rows))
        self.shortest = int(self.sizes.min()) if sizes else 0


def keys(rows: np.ndarray) -> np.ndarray:
    """Rows of word numbers as byte strings that sort in the same order."""
    width = rows.shape[1]
    return np.ascontiguousarray(rows.astype(">u4")).view(f"S{4 * width}").ravel()


def suffix_array(numbers: np.ndarray, shortest: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in the order of the words that follow them, and their keys; places that cannot match are left out."""
    stops = np.flatnonzero(numbers == 0)
    places = np.flatnonzero(numbers)
    places = places[stops[np.searchsorted(stops, places)] - places >= shortest]
    found = keys(numbers[places[:, None] + np.arange(window)])
    order = np.argsort(found, kind="stable")
    return places[order], found[order]


#: The block that a worker has at hand, by its name.
_ready: dict = {}


def _suffixes(name: str, block, window: int) -> TestSuffixes:
    if name not in _ready:
        _ready.clear()
        _ready[name] = TestSuffixes(block.value, window)
    return _ready[name]


def _maximal(owner, place, start, size):
    """Matches (item, start in document, start in item, length) from windows that follow each other in both."""
    order = np.lexsort((start, start - place, owner))
    owner, place, start, size = owner[order], place[order], start[order], size[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (start[1:] - place[1:] != start[:-1] - place[:-1]) | (start[1:] != start[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(owner)) - 1
    return owner[first], start[first], place[first], start[last] + size[last] - start[first]


class _Find:
    """Kernel: hits, items and matches of each text; a list of texts is a shard."""

    def __init__(self, block, window: int):
        self.name, self.block, self.window = uuid.uuid4().hex, block, window

    def __call__(self, texts: list) -> list:
        tests = _suffixes(self.name, self.block, self.window)
        words = [words_of(text or "") for text in texts]
        counts = np.array([len(w) for w in words], np.int64)
        rows = [(int(n), [], [], []) for n in counts]
        if not tests.shortest or not counts.sum():
            return rows
        get = tests.numbers.get
        gap = [0] * self.window
        numbers = np.array([n for w in words for n in (*(get(x, 0) for x in w), *gap)], np.int64)
        begins = np.concatenate(([0], np.cumsum(counts + self.window)))[:-1]
        places, found = suffix_array(numbers, tests.shortest, self.window)
        low, high = np.searchsorted(found, tests.low, "left"), np.searchsorted(found, tests.high, "right")
        hit = np.flatnonzero(high > low)
        times = (high - low)[hit]
        test = np.repeat(hit, times)
        at = places[np.repeat(low[hit], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)]
        document = np.searchsorted(begins, at, "right") - 1
        order = np.argsort(document, kind="stable")
        document, test, at = document[order], test[order], at[order]
        for i in np.unique(document).tolist():
            first, last = np.searchsorted(document, [i, i + 1])
            mine, start = test[first:last], at[first:last] - begins[i]
            owner, begin, item_start, length = _maximal(tests.owners[mine], tests.places[mine], start, tests.sizes[mine])
            matches = sorted(
                (tests.names[o], b, s, n) for o, b, s, n in zip(owner.tolist(), begin.tolist(), item_start.tolist(), length.tolist(), strict=True)
            )
            spans = _united(sorted({(b, b + n) for _, b, _, n in matches}))
            rows[i] = (
                rows[i][0], [{"s": s, "e": e} for s, e in spans], sorted({name for name, *_ in matches}),
                [dict(zip(("item_id", "start", "item_start", "length"), m, strict=True)) for m in matches],
            )
        return rows


def _united(spans: list) -> list:
    out = []
    for start, end in spans:
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return out


def _blocks(benchmark: DataFrame, limit: int):
    """Lists of (item id, text) of at most ``limit`` bytes of text, one after the other."""
    block, size = [], 0
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")), F.coalesce("text", F.lit("")))
    for name, text in items.toLocalIterator():
        here = len(text.encode())
        if block and size + here > limit:
            yield block
            block, size = [], 0
        block.append((name, text))
        size += here
    yield block


def _union(one: Column, other: Column) -> Column:
    """Both lists of word spans as one, without overlaps."""
    def add(spans, x):
        last = F.element_at(spans, -1)
        longer = F.struct(last["s"].alias("s"), F.greatest(last["e"], x["e"]).alias("e"))
        joins = (F.size(spans) > 0) & (F.try_element_at(spans, F.lit(-1))["e"] >= x["s"])
        return F.when(joins, F.concat(F.slice(spans, 1, F.size(spans) - 1), F.array(longer))).otherwise(F.concat(spans, F.array(x)))

    empty = F.array().cast("array<struct<s: bigint, e: bigint>>")
    return F.aggregate(F.array_sort(F.concat(one, other)), empty, add)


def with_hits(docs: DataFrame, benchmark: DataFrame, name: str, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` and a column ``name`` with n_words, hits, items and matches."""
    spark, found = docs.sparkSession, None
    for block in _blocks(benchmark, block_bytes):
        find = over_texts(_Find(spark.sparkContext.broadcast(block), window), HITS)
        if found is None:
            found = docs.withColumn(name, find("text"))
            continue
        more = fresh(found, "more")
        a, b = (lambda field, c=c: F.col(c)[field] for c in (name, more))
        united = F.struct(
            a("n_words").alias("n_words"), _union(a("hits"), b("hits")).alias("hits"),
            F.array_sort(F.array_union(a("items"), b("items"))).alias("items"), F.concat(a("matches"), b("matches")).alias("matches"),
        )
        found = stage_table(found, "contamination").withColumn(more, find("text")).withColumn(name, united).drop(more)
    return found


def scan(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_words, hits (spans of words inside windows), items and matches."""
    return with_hits(docs.select("doc_id", "text"), benchmark, "r", window, block_bytes).select("doc_id", "r.*")


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs`` without any window of the benchmark."""
    name = fresh(docs, "contamination")
    return with_hits(docs, benchmark, name, window, block_bytes).filter(F.size(F.col(name)["hits"]) == 0).drop(name)

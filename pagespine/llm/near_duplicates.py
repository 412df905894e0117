"""Near-duplicate documents by circulant MinHash, banding and exact verification.

1. Documents with the same set of shingles become one node. Its signature is cut into bands;
   nodes with an equal band share a bucket.
2. In each bucket the node with the smallest set is compared with all others (a star, not all pairs). Links
   are confirmed on the full sets, and linked nodes become parts of one component.
3. Buckets that still hold several parts: small ones have the pairs between their parts compared. The nodes
   of larger ones (documents around one common passage, or rough copies of one text) meet by the rarest quarter of their
   shingles instead. That is exact: linked sets have at least three quarters of either in common, hence one of the rarest
   quarter and one more, in any order of shingles. What many share comes last in the order. Nodes that meet so form
   crowds, which are compared in blocks of bounded size; a block pair gives back a few edges that join its parts.

No pair within one part is ever formed as a row, so a group of copies costs one comparison per node.
Two sets of similarity 0.75 meet in no bucket of the first kind with probability 1e-6; nothing else loses a link.

Cases: a null text, or one without words, has no shingles and is linked with nothing; a text of fewer than five
words has its whole sequence as its only shingle. Repeated rows stay, each with the same result. Null ids
are passed over when the smallest id is sought; a component of such rows only has a null
component id and keeps all its rows. An empty table gives an empty result. Other columns of the input are ignored by
``scan`` and kept by ``deduplicated``.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagespine.llm.components import contracted, merged
from pagespine.llm.joins import LEAST_HEAVY, heavy_keys, join_spread
from pagespine.llm.shingles import bands, shingle_sets, signature
from pagespine.llm.texts import fresh, over_texts, stored
from pagespine.session import stage_table

#: Share of the union, in percent, that a link needs.
SIMILARITY = 75
#: Rows of a band and number of bands.
ROWS, BANDS = 4, 36
#: Nodes of larger buckets meet by their rarest shingles.
SMALL = 8
#: Shingles that come last in the order of shingles: so many nodes have them, and no more are listed. Any list gives
#: the same links; it only saves comparisons.
FREQUENT, LISTED = 8, 200_000
#: Nodes and shingles of a block, about. Two blocks are compared in one task.
BLOCK_NODES, BLOCK_SHINGLES = 1_000, 1_000_000
#: Nodes that are held against all others of two blocks at a time.
COMPARED = 256
#: A star's or a pair's side is spread over so many tasks.
SALTS = 32
#: Keys (16 bytes each) that may be broadcast, once they have been counted.
BROADCAST_KEYS = 500_000

_SIGNED = "n_shingles long, node binary, bands array<long>"
_SETS = "node binary, shingles array<long>"


def _sign(texts: list) -> list:
    rows = []
    for shingles in shingle_sets(texts):
        if len(shingles):
            rows.append((len(shingles), _name(shingles), bands(signature(shingles, ROWS * BANDS), ROWS)))
        else:
            rows.append((0, None, None))
    return rows


def _sets(texts: list) -> list:
    return [(_name(s) if len(s) else None, s.view(np.int64)) for s in shingle_sets(texts)]


def _name(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.tobytes())


def _rarest(sets: DataFrame):
    """A column function: the shingles of a set (of ``sets``) by which it must meet every set that it is linked with."""
    counts = sets.select(F.explode("shingles").alias("shingle")).groupBy("shingle").count().filter(F.col("count") >= FREQUENT)
    listed = [r.shingle for r in counts.orderBy(F.desc("count"), "shingle").limit(LISTED).collect()]
    last = sets.sparkSession.sparkContext.broadcast(np.array(listed[::-1], np.int64))

    def rarest(shingles: pa.Array) -> pa.Array:
        order = np.argsort(last.value, kind="stable")
        names, found = last.value[order], []
        for one in shingles:
            one = one.values.to_numpy()
            place = np.searchsorted(names, one)
            place[place == len(names)] = 0
            rank = np.where(names[place] == one, order[place] + 1, 0) if len(names) else np.zeros(len(one), np.int64)
            enough = len(one) - -(-SIMILARITY * len(one) // 100) + 1
            found.append(one[np.lexsort((one, rank))[:enough]])
        return pa.array(found, pa.list_(pa.int64()))

    return F.arrow_udf(rarest, "array<long>").asNondeterministic()


def _row_key() -> Column:
    """The id, or a number of the text where there is none."""
    return F.coalesce(F.col("doc_id").cast("long"), F.xxhash64("text"))


def _sizes_allow() -> Column:
    """A smaller set cannot reach the similarity."""
    return 100 * F.least("a_size", "b_size") >= SIMILARITY * F.greatest("a_size", "b_size")


def _shared(buckets: DataFrame) -> DataFrame:
    """Members of the buckets with several nodes, with the bucket's smallest set and its number of nodes."""
    smallest = buckets.groupBy("bucket").agg(F.min(F.struct("size", "node")).alias("first"), F.count("*").alias("n")).filter("n > 1")
    smallest = stage_table(smallest, "smallest")
    found = join_spread(buckets, smallest, "bucket", heavy_keys(smallest, "bucket"), "node")
    return found.select("bucket", "n", "node", "size", F.col("first.node").alias("head"), F.col("first.size").alias("head_size"))


def _stars(shared: DataFrame) -> DataFrame:
    """Each member with the first node of its bucket."""
    pairs = shared.filter("node != head").select(
        F.col("head").alias("a"), F.col("node").alias("b"), F.col("head_size").alias("a_size"), F.col("size").alias("b_size")
    )
    return pairs.filter(_sizes_allow()).select("a", "b").distinct()


def _divided(shared: DataFrame, labels: DataFrame) -> DataFrame:
    """Members, with their parts, of the buckets that hold several parts."""
    labelled = shared.join(labels, "node")
    several = labelled.groupBy("bucket").agg(F.min("part").alias("low"), F.max("part").alias("high"), F.first("n").alias("n")).filter("low != high")
    # A row knows how many its bucket has, so the members of large buckets go to several tasks.
    large = F.col("n") > LEAST_HEAVY
    copies = F.explode(F.when(large, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0))))
    dealt = labelled.withColumn("salt", F.when(large, F.pmod(F.hash("node"), F.lit(SALTS))).otherwise(0))
    return dealt.join(several.select("bucket", copies.alias("salt")), ["bucket", "salt"]).drop("salt")


def _across(divided: DataFrame) -> DataFrame:
    """Pairs of a bucket between different parts."""
    a, b = (divided.select("bucket", *[F.col(c).alias(f"{end}_{c}") for c in ("node", "size", "part")]) for end in "ab")
    pairs = a.join(b, "bucket").filter((F.col("a_node") < F.col("b_node")) & (F.col("a_part") != F.col("b_part")) & _sizes_allow())
    return pairs.select(F.col("a_node").alias("a"), F.col("b_node").alias("b")).distinct()


def _untried(pairs: DataFrame, tried: DataFrame) -> DataFrame:
    low, high = F.least("a", "b"), F.greatest("a", "b")
    keyed = pairs.withColumns({"low": low, "high": high})
    return keyed.join(tried.select(low.alias("low"), high.alias("high")), ["low", "high"], "left_anti").select("a", "b")


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose full sets are similar enough.

    The sets of ``b`` go to their pairs' tasks; a set that many pairs need as ``a`` is copied to several tasks.
    """
    salted = pairs.withColumn("salt", F.pmod(F.hash("b"), F.lit(SALTS)))
    copies = salted.select("a", "salt").distinct().join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("a_set")), "a")
    full = salted.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("b_set")), "b").join(copies, ["a", "salt"])
    common = F.size(F.array_intersect("a_set", "b_set"))
    counted = full.select("a", "b", common.alias("common"), (F.size("a_set") + F.size("b_set")).alias("both"))
    return counted.filter(F.expr(f"100 * common >= {SIMILARITY} * (both - common)")).select("a", "b")


def _crowd_links(members: DataFrame) -> DataFrame:
    """Edges that join the parts of each crowd (``root``) as all confirmed links between its nodes would.

    Nodes are dealt into blocks by hash; every two blocks of a crowd meet once.
    """
    sizes = members.groupBy("root").agg(F.count("*").alias("nodes"), F.sum("size").alias("shingles_in"))
    blocks = F.ceil(F.greatest(F.col("nodes") / BLOCK_NODES, F.col("shingles_in") / BLOCK_SHINGLES)).cast("int")
    dealt = members.join(sizes.select("root", blocks.alias("blocks")), "root")
    dealt = dealt.withColumn("block", F.pmod(F.hash("node"), F.col("blocks")))
    met = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pair = [F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two")]
    return met.select("root", *pair, "node", "part", "shingles").groupBy("root", "one", "two").applyInArrow(_joined, "a binary, b binary")


def _joined(table: pa.Table) -> pa.Table:
    """Edges between nodes of ``table`` that unite its parts: a spanning forest of the links on full sets."""
    nodes, parts = table["node"].to_pylist(), table["part"].to_pylist()
    sets = [s.values.to_numpy() for s in table["shingles"]]
    numbers = {part: i for i, part in enumerate(dict.fromkeys(parts))}
    part = np.array([numbers[p] for p in parts])
    common = _common(sets)
    size = np.array([len(s) for s in sets])
    root = list(range(len(numbers)))

    def find(x):
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    edges = []
    for start in range(0, len(nodes), COMPARED):
        rows = slice(start, start + COMPARED)
        now = np.array([find(x) for x in range(len(numbers))])[part]
        shared = common[rows].astype(np.int64)
        linked = 100 * shared >= SIMILARITY * (size[rows, None] + size[None, :] - shared)
        a, b = np.nonzero(np.triu(linked & (now[rows, None] != now[None, :]), start + 1))
        a += start
        _, first = np.unique(now[a] * len(numbers) + now[b], return_index=True)
        for i in first.tolist():
            x, y = find(part[a[i]]), find(part[b[i]])
            if x != y:
                root[x] = y
                edges.append((nodes[a[i]], nodes[b[i]]))
    return pa.table({end: pa.array([e[k] for e in edges], pa.binary()) for k, end in enumerate("ab")})


def _common(sets: list, often: int = 16) -> np.ndarray:
    """How many elements two sets share, in the upper half: matrix products for what is frequent, counting for the rest."""
    n = len(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    element, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)[1:]
    total = np.zeros((n, n), np.float32)
    frequent = np.flatnonzero(count >= often)
    for start in range(0, len(frequent), 1024):
        column = np.full(len(count), -1)
        column[frequent[start : start + 1024]] = np.arange(len(frequent[start : start + 1024]))
        here = column[element] >= 0
        present = np.zeros((n, min(1024, len(frequent) - start)), np.float32)
        present[owner[here], column[element[here]]] = 1
        total += present @ present.T
    rare = count[element] < often
    element, owner = element[rare], owner[rare]
    order = np.lexsort((owner, element))
    element, owner = element[order], owner[order]
    for shift in range(1, often - 1):
        same = element[shift:] == element[:-shift]
        if not same.any():
            break
        keys, times = np.unique(owner[:-shift][same] * n + owner[shift:][same], return_counts=True)
        # Owners ascend within an element: this fills the upper half, the only one that is read.
        total.ravel()[keys] += times
    return total


def _full_sets(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The shingles of ``nodes`` (node, row_key), from the texts of one of their rows."""
    wanted = nodes.select("row_key").distinct()
    if nodes.count() <= BROADCAST_KEYS:
        wanted = F.broadcast(wanted)
    texts = docs.select(_row_key().alias("row_key"), "text").join(wanted, "row_key", "left_semi")
    found = texts.select(over_texts(_sets, _SETS)("text").alias("r")).select("r.*")
    return found.join(nodes.select("node"), "node", "left_semi").groupBy("node").agg(F.first("shingles").alias("shingles"))


def _signed(docs: DataFrame) -> DataFrame:
    signed = docs.select("doc_id", _row_key().alias("row_key"), over_texts(_sign, _SIGNED)("text").alias("r"))
    return stored(signed.select("doc_id", "row_key", "r.*"), "signed")


def _labels(docs: DataFrame, nodes: DataFrame) -> DataFrame | None:
    """``node`` and ``part`` of all nodes that share a bucket; None if there are none."""
    buckets = nodes.select("node", F.col("n_shingles").alias("size"), F.explode("bands").alias("bucket"))
    shared = stage_table(_shared(buckets), "shared")
    if shared.isEmpty():
        return None
    members = shared.select("node").distinct()
    sets = stored(_full_sets(docs, nodes.select("node", "row_key").join(members, "node", "left_semi")), "sets")
    labels = sets.select("node", F.col("node").alias("part"))

    stars = stage_table(_stars(shared), "stars")
    labels = merged(labels, _confirmed(stars, sets))
    divided = stage_table(_divided(shared, labels), "divided")
    pairs = _across(divided.filter(F.col("n") <= SMALL))

    labels = merged(labels, _confirmed(_untried(pairs, stars), sets))

    large = divided.filter(F.col("n") > SMALL).select("node", "size").distinct()
    large = stage_table(large.join(sets, "node"), "large")
    rarest = large.select("node", "size", F.explode(_rarest(large)("shingles")).alias("bucket"))
    close = _divided(_shared(stored(rarest, "rarest")), labels)
    crowds = contracted(close.select(F.col("head").alias("a"), F.col("node").alias("b")))
    if crowds is None:
        return labels
    return merged(labels, _crowd_links(crowds.join(labels, "node").join(large, "node")))


def _components(docs: DataFrame) -> DataFrame:
    """Every row with its component."""
    signed = _signed(docs)
    nodes = signed.filter("node IS NOT NULL").groupBy("node").agg(
        F.min("doc_id").alias("first_id"), F.min("row_key").alias("row_key"), F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands"),
        F.count("*").alias("n"),
    )
    nodes = stage_table(nodes, "nodes")
    labels = _labels(docs, nodes)
    found = nodes.select("node", "first_id")
    if labels is not None:
        first = labels.join(found, "node").groupBy("part").agg(F.min("first_id").alias("least_id"), F.count("*").alias("n"))
        first = stage_table(first, "least")
        least = join_spread(labels, first, "part", heavy_keys(first, "part"), "node").select("node", "least_id")
        found = found.join(least, "node", "left").select("node", F.coalesce("least_id", "first_id").alias("first_id"))
    # Rows without words find nothing; their key only spreads them.
    key = F.coalesce("node", F.col("doc_id").cast("string").cast("binary"), F.lit(b""))
    heavy = heavy_keys(nodes, "node").withColumnRenamed("node", "key")
    rows = join_spread(signed.drop("bands").withColumn("key", key), found.withColumnRenamed("node", "key"), "key", heavy, "row_key", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("first_id"))
    rows = rows.withColumn("component_id", component)
    return rows.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()))


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id of the component) and kept, a row per row of ``docs``."""
    return _components(docs).select("doc_id", "n_shingles", "component_id", "kept")


def deduplicated(docs: DataFrame) -> DataFrame:
    """One row of each component; of rows with one id, one."""
    kept = _components(docs).filter("kept").select("row_key").distinct()
    name = fresh(docs, "row_key")
    keyed = docs.withColumn(name, _row_key())
    return keyed.join(kept.withColumnRenamed("row_key", name), name, "left_semi").dropDuplicates([name]).drop(name)

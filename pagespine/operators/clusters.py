"""Labels for documents of varied style: k-means per document, then rank by font size.

Coordinates are z-scores in steps of 1/100000, held as whole numbers. Their
sums are exact, so a result does not depend on how rows were split, and the two
ways to run the rounds agree to the last block:

* Documents that fit a task are grouped, and each group runs its rounds in place.
* Larger documents advance together, one job per round. Their points are stored
  once; a round brings the few centers to the points and averages again, combining
  before the shuffle. A round's centers are stored as files, so that the next one is planned by their
  size: a checkpoint keeps the estimate of its plan, which squares from round to round until it fills the driver.

Rounds go on until no center of the document moves. Whole-number means can in principle
return to an earlier state; such a document stops there and is marked as not settled.
"""

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from pagespine.constants import BLOCKS_PER_TASK, BROADCAST_BYTES, N_CLUSTERS, RANKED_LABELS
from pagespine.operators.spread import BUCKET, PLACE, attach, by_extent, dealt, meet, with_bucket, with_facts
from pagespine.session import read_table, stage_path, stage_table, unkept_table, write_table

DOC = "document_name"
DIMS = 7
AXES = [f"z{i}" for i in range(DIMS)]
STEPS = 100000.0


def moment_columns() -> list[Column]:
    """Aggregates that scaling needs, to be computed along with other facts of a document."""
    value = [F.col("feature_vector")[i] for i in range(DIMS)]
    return [F.avg(v).alias(f"mean{i}") for i, v in enumerate(value)] + [
        F.round(F.stddev_pop(v), 9).alias(f"std{i}") for i, v in enumerate(value)
    ]


MOMENTS = [f"{m}{i}" for m in ("mean", "std") for i in range(DIMS)]


def scale(rows: DataFrame) -> DataFrame:
    """Coordinates from vectors and moments; a constant feature is only centered."""
    def scaled(i):
        std = F.when(F.col(f"std{i}") == 0, 1.0).otherwise(F.col(f"std{i}"))
        z = (F.col("feature_vector")[i] - F.col(f"mean{i}")) / std
        return F.floor(z * STEPS + 0.5).cast("double")

    return rows.withColumns({a: scaled(i) for i, a in enumerate(AXES)}).drop(*MOMENTS)


def scaled_features(blocks: DataFrame) -> DataFrame:
    """Center and scale each feature within its document."""
    return scale(with_facts(blocks, moments))


def moments(blocks: DataFrame, by: list[str]) -> DataFrame:
    """What scaling asks of a document."""
    return blocks.groupBy(*by).agg(F.count("*").alias("n_blocks"), *moment_columns())


def _point_labeller(n_clusters: int):
    """Arrow UDF that labels the points of each row's document, given in reading order, and tells whether they settled.

    Its functions are local ones and travel with the plan, so executors need
    NumPy and Arrow but no copy of this package.
    """
    def distances(points, centers):
        return ((points[:, None, :] - centers[None, :, :]) ** 2).sum(axis=2)

    def label_points(points, start):
        k = min(n_clusters, len(points))
        chosen = [start]
        for _ in range(1, k):
            chosen.append(int(distances(points, points[chosen]).min(axis=1).argmax()))
        centers, seen, settled = points[chosen], set(), False
        while not settled and centers.tobytes() not in seen:
            seen.add(centers.tobytes())
            labels = distances(points, centers).argmin(axis=1)
            counts = np.bincount(labels, minlength=k)
            sums = np.stack([np.bincount(labels, weights=axis, minlength=k) for axis in points.T], axis=1)
            means = np.floor(sums / np.maximum(counts, 1)[:, None] + 0.5)
            moved = np.where(counts[:, None] > 0, means, centers)
            settled = bool((moved == centers).all())
            centers = moved
        return distances(points, centers).argmin(axis=1), settled

    def label(points: pa.Array, sizes: pa.Array) -> pa.Array:
        ends = points.offsets.to_numpy() - points.offsets[0].as_py()
        coordinates = points.flatten().flatten().to_numpy().reshape(-1, DIMS)
        heights = sizes.flatten().fill_null(0.0).to_numpy()
        found = [label_points(coordinates[a:b], int(np.argmax(heights[a:b]))) for a, b in zip(ends[:-1], ends[1:])]
        flat = np.concatenate([labels for labels, _ in found]).astype(np.int32) if found else np.empty(0, np.int32)
        labels = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))
        return pa.StructArray.from_arrays([labels, pa.array([settled for _, settled in found], pa.bool_())], ["labels", "settled"])

    return F.arrow_udf(label, "labels array<int>, settled boolean")


def _member_labeller(n_clusters: int):
    """The point labeller, which also tells the place of each row's cluster by mean font size, as ``cluster_ranks`` counts it."""
    label = _point_labeller(n_clusters).func

    def ranks_of(own, heights, known):
        n_known = np.bincount(own, weights=known, minlength=n_clusters)
        mean = np.round(np.bincount(own, weights=heights * known, minlength=n_clusters) / np.maximum(n_known, 1), 6)
        absent = np.bincount(own, minlength=n_clusters) == 0
        rank = np.empty(n_clusters, np.int32)
        rank[np.lexsort((np.arange(n_clusters), -mean, n_known == 0, absent))] = np.arange(n_clusters)
        return rank[own]

    def ranked(points: pa.Array, sizes: pa.Array) -> pa.Array:
        found = label(points, sizes)
        labels, flat_sizes = found.field("labels"), sizes.flatten()
        ends, own = labels.offsets.to_numpy(), labels.flatten().to_numpy()
        known, heights = flat_sizes.is_valid().to_numpy(zero_copy_only=False), flat_sizes.fill_null(0.0).to_numpy()
        parts = [ranks_of(own[a:b], heights[a:b], known[a:b]) for a, b in zip(ends[:-1], ends[1:])]
        ranks = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(parts) if parts else own, pa.int32()))
        return pa.StructArray.from_arrays([labels, found.field("settled"), ranks], ["labels", "settled", "ranks"])

    return F.arrow_udf(ranked, "labels array<int>, settled boolean, ranks array<int>")


def cluster_small(scaled: DataFrame, n_clusters: int = N_CLUSTERS, by: list[str] = [DOC]) -> DataFrame:
    """Documents of bounded size: one packed row each, whose points alone go to NumPy.

    Documents of one bucket, which may be packed by ``PLACE``, stay where they are stored.
    """
    label = _point_labeller(n_clusters)
    kept = [c for c in scaled.columns if c not in (*by, "seq", *AXES)]
    row = F.struct("seq", *kept, F.array(*AXES).alias("point"))
    packed = scaled.groupBy(*by).agg(F.sort_array(F.collect_list(row)).alias("rows"))
    labelled = packed.select(*by, "rows", label(F.col("rows.point"), F.col("rows.fontsize")).alias("found"))
    labelled = labelled.select(*by, "rows", "found.labels", "found.settled")
    pair = labelled.select(*by, "settled", F.explode(F.arrays_zip("rows", "labels")).alias("pair"))
    return pair.select(
        *by, F.col("pair.rows.seq").alias("seq"), *[F.col(f"pair.rows.{c}").alias(c) for c in kept],
        F.col("pair.labels").alias("cluster_label"), "settled",
    )


def small_members(scaled: DataFrame, n_clusters: int = N_CLUSTERS, by: list[str] = [DOC]) -> DataFrame:
    """The labels alone, and the name that a cluster's rank stands for: rows without anything else of the block meet in a document's row."""
    bucket = [] if BUCKET in by else [BUCKET]
    row = F.struct("seq", *bucket, "fontsize", F.array(*AXES).alias("point"))
    packed = scaled.groupBy(*by).agg(F.sort_array(F.collect_list(row)).alias("rows"))
    found = packed.select(*by, "rows", _member_labeller(n_clusters)(F.col("rows.point"), F.col("rows.fontsize")).alias("found"))
    member = found.select(*by, F.col("found.settled").alias("settled"), F.explode(
        F.arrays_zip(F.col("rows.seq"), *[F.col(f"rows.{c}") for c in bucket], F.col("found.labels"), F.col("found.ranks"))).alias("m"))
    names = F.array(*[F.lit(label) for label in RANKED_LABELS])
    return member.select(
        *by, *[f"m.{c}" for c in bucket], "m.seq", F.col("m.labels").alias("cluster_label"), "settled",
        F.coalesce(F.get(names, F.col("m.ranks")), F.lit(RANKED_LABELS[-1])).alias("cluster_name"),
    )


def _distance(center: str) -> Column:
    """Squared distance of a point to a center; null when the document has no such center."""
    return F.expr(" + ".join(f"({a} - {center}.{a}) * ({a} - {center}.{a})" for a in AXES))


class LargeDocumentKMeans:
    """The same rounds as jobs over all documents of ``scaled``."""

    def __init__(
        self,
        scaled: DataFrame,
        n_clusters: int = N_CLUSTERS,
        broadcast_bytes: int = BROADCAST_BYTES,
    ):
        self.n_clusters = n_clusters
        self.names = [f"c{j}" for j in range(n_clusters)]
        self.rows = scaled
        self.points = stage_table(dealt(scaled.select(DOC, BUCKET, "seq", "fontsize", "n_blocks", *AXES)), "points", PLACE)
        documents = self.points.select(DOC).distinct()
        # A document's row holds n_clusters points and its name.
        most = broadcast_bytes // (256 + n_clusters * DIMS * 8)
        self.few = documents.limit(most + 1).count() <= most
        self.places = None if self.few else stage_table(self.points.select(*PLACE).distinct(), "places", PLACE)

    def _meet(self, centers: DataFrame) -> DataFrame:
        """Points beside the centers of their document.

        The centers of a counted few documents are broadcast. Those of many
        are copied to the buckets of their documents and joined there.
        """
        if self.few:
            return self.points.join(F.broadcast(centers), DOC)
        return self.points.join(self.places.join(centers, DOC), [DOC, BUCKET])

    def _measure(self, centers: DataFrame, names: list[str]) -> DataFrame:
        """Points with their distance to each named center and to the nearest of them."""
        apart = [f"to_{name}" for name in names]
        met = self._meet(centers).withColumns({d: _distance(name) for d, name in zip(apart, names)})
        return met.withColumn("nearest", F.least(*apart) if len(apart) > 1 else F.col(apart[0])).drop(*names)

    def seeds(self) -> DataFrame:
        """Start from the block in the largest type, then take the farthest block each time."""
        point, earlier = F.struct(*AXES), -F.col("seq")
        start = self.points.groupBy(DOC).agg(
            F.max("n_blocks").alias("size"),
            F.max_by(point, F.struct(F.coalesce("fontsize", F.lit(0.0)), earlier)).alias("c0"),
        )
        centers = unkept_table(start, "centers")
        for j in range(1, self.n_clusters):
            farthest = (
                self._measure(centers.filter(F.col("size") > j), self.names[:j])
                .groupBy(DOC)
                .agg(F.max_by(point, F.struct("nearest", earlier)).alias(f"c{j}"))
            )
            centers = unkept_table(centers.join(farthest, DOC, "left"), "centers")
        return centers.select(DOC, *self.names)

    def assign(self, centers: DataFrame) -> DataFrame:
        """The nearest center of each point; a tie goes to the lower number."""
        label = F.coalesce(*[F.when(F.col(f"to_{name}") == F.col("nearest"), j) for j, name in enumerate(self.names)])
        measured = self._measure(centers, self.names).withColumn("cluster_label", label.cast("int"))
        return measured.drop("nearest", *[f"to_{name}" for name in self.names])

    def move(self, centers: DataFrame) -> DataFrame:
        """Centers at the mean of their points; one without points stays where it is."""
        means = (
            self.assign(centers)
            .groupBy(DOC, "cluster_label")
            .agg(*[F.floor(F.sum(a) / F.count("*") + 0.5).cast("double").alias(a) for a in AXES])
            .groupBy(DOC)
            .agg(F.map_from_entries(F.collect_list(F.struct("cluster_label", F.struct(*AXES)))).alias("means"))
        )
        moved = [f"coalesce(means[{j}], {name})" for j, name in enumerate(self.names)]
        steady = " AND ".join(f"{new} <=> {name}" for new, name in zip(moved, self.names))
        return centers.join(means, DOC, "left").selectExpr(
            DOC, *[f"{new} AS {name}" for new, name in zip(moved, self.names)], f"{steady} AS steady"
        )

    def settle(self, centers: DataFrame | None = None) -> DataFrame:
        """Centers that move no more, with ``settled``; false where a document came back to an earlier state.

        A document that is done leaves the rounds, so the last ones work on few points.
        """
        state = F.xxhash64(*self.names)
        centers = self.seeds() if centers is None else centers
        spark = centers.sparkSession
        moving = unkept_table(centers.select(DOC, *self.names, F.array(state).alias("seen")), "centers")
        rounds = []
        while not moving.isEmpty():
            moved = self.move(moving.drop("seen")).join(moving.select(DOC, "seen"), DOC)
            moved = moved.withColumn("back", ~F.col("steady") & F.array_contains("seen", state))
            rounds.append(stage_path(spark, "moved"))
            write_table(moved, rounds[-1])
            stored = read_table(spark, rounds[-1], moved.schema, None, 0)
            moving = stored.filter("NOT steady AND NOT back").select(DOC, *self.names, F.concat("seen", F.array(state)).alias("seen"))
        if not rounds:
            return moving.select(DOC, *self.names, F.lit(True).alias("settled"))
        every = spark.read.schema(moved.schema).parquet(*rounds)
        return every.filter("steady OR back").select(DOC, *self.names, F.col("steady").alias("settled"))

    def labels(self, centers: DataFrame | None = None) -> DataFrame:
        """``cluster_label`` and ``settled`` of each point."""
        centers = unkept_table(self.settle(centers), "centers")
        return self.assign(centers).select(DOC, BUCKET, "seq", "fontsize", "cluster_label", "settled")

    def fit(self, centers: DataFrame | None = None) -> DataFrame:
        """Blocks with ``cluster_label`` and ``settled``."""
        return self.rows.drop(*AXES).join(self.labels(centers).drop("fontsize"), [DOC, BUCKET, "seq"])


def cluster_scaled(
    scaled: DataFrame,
    n_clusters: int = N_CLUSTERS,
    task_blocks: int = BLOCKS_PER_TASK,
    any_large: bool | None = None,
    by: list[str] = [DOC],
) -> DataFrame:
    """Add ``cluster_label`` and ``settled``, each document in the way that suits its size."""
    large = scaled.filter(F.col("n_blocks") > task_blocks)
    if any_large is None:
        any_large = not large.isEmpty()
    small = cluster_small(scaled.filter(F.col("n_blocks") <= task_blocks), n_clusters, by)
    if not any_large:
        return small
    return small.unionByName(LargeDocumentKMeans(large, n_clusters).fit())


def cluster_members(
    scaled: DataFrame,
    n_clusters: int = N_CLUSTERS,
    task_blocks: int = BLOCKS_PER_TASK,
    any_large: bool | None = None,
    by: list[str] = [DOC],
) -> DataFrame:
    """``cluster_label``, ``settled`` and ``cluster_name`` of each block, each document in the way that suits its size."""
    large = scaled.filter(F.col("n_blocks") > task_blocks)
    if any_large is None:
        any_large = not large.isEmpty()
    small = small_members(scaled.filter(F.col("n_blocks") <= task_blocks), n_clusters, by)
    if not any_large:
        return small
    found = stage_table(LargeDocumentKMeans(large, n_clusters).labels(), "large")
    named = cluster_labels(found).withColumnRenamed("predicted_label", "cluster_name")
    return small.unionByName(named.select(*small.columns))


def cluster_blocks(blocks: DataFrame, n_clusters: int = N_CLUSTERS, task_blocks: int = BLOCKS_PER_TASK) -> DataFrame:
    """Scale and cluster. Give it a stored table."""
    return placed_clusters(blocks, n_clusters, task_blocks).drop(BUCKET)


def placed_clusters(blocks: DataFrame, n_clusters: int = N_CLUSTERS, task_blocks: int = BLOCKS_PER_TASK) -> DataFrame:
    """The same, with rows that lie by document and bucket; on a stored table, documents of one bucket are worked on where they lie."""
    alone, others = by_extent(blocks if BUCKET in blocks.columns else with_bucket(blocks))
    found = cluster_scaled(scale(meet(alone, moments(alone, PLACE), PLACE)), n_clusters, task_blocks, by=PLACE)
    if others is not None:
        scaled = scale(meet(others, moments(others, [DOC]), [DOC]))
        found = found.unionByName(dealt(cluster_scaled(scaled, n_clusters, task_blocks)))
    return found.drop("n_blocks")


def clustering_state(blocks: DataFrame) -> DataFrame:
    """How a given clustering of each document stands: blocks, clusters, inertia, and the blocks that another round would move.

    Centers are the means of the given clusters on scaled features. A block moves if another center is strictly nearer than its own; a
    settled clustering moves none. Give it a stored table with ``cluster_label``; documents of one bucket are worked on where they lie.
    """
    alone, others = by_extent(blocks if BUCKET in blocks.columns else with_bucket(blocks))
    state = _state(alone, PLACE)
    return state if others is None else state.unionByName(_state(others, [DOC]))


def _state(blocks: DataFrame, by: list[str]) -> DataFrame:
    points = scale(meet(blocks, moments(blocks, by), by)).select(*PLACE, "cluster_label", *AXES)
    means = points.groupBy(*by, "cluster_label").agg(*[F.avg(a).alias(a) for a in AXES])
    centers = means.groupBy(*by).agg(F.collect_list(F.struct("cluster_label", *AXES)).alias("centers"))

    def apart(center):
        return reduce(Column.__add__, [(F.col(a) - center[a]) * (F.col(a) - center[a]) for a in AXES])

    met = meet(points, centers, by)
    own = F.get(F.transform(F.filter("centers", lambda c: c["cluster_label"] == F.col("cluster_label")), apart), F.lit(0))
    measured = met.select(*by, "cluster_label", own.alias("own"), F.array_min(F.transform("centers", apart)).alias("nearest"))
    return measured.groupBy(*by).agg(
        F.count("*").alias("n_blocks"), F.count_distinct("cluster_label").alias("n_clusters"),
        F.sum((F.col("nearest") < F.col("own")).cast("bigint")).alias("n_moved"), F.round(F.sum("own") / STEPS / STEPS, 4).alias("inertia"),
    ).drop(BUCKET)


def cluster_fonts(blocks: DataFrame) -> DataFrame:
    """Mean font size of each cluster present."""
    return blocks.groupBy(DOC, "cluster_label").agg(F.round(F.avg("fontsize"), 6).alias("mean_size"))


def cluster_ranks(fonts: DataFrame) -> DataFrame:
    """Clusters of a document from the largest type to the smallest, ties by number.

    The window holds one row per cluster, not per block.
    """
    by_size = W.partitionBy(DOC).orderBy(F.desc("mean_size"), "cluster_label")
    return fonts.withColumn("size_rank", F.row_number().over(by_size))


def cluster_labels(blocks: DataFrame) -> DataFrame:
    """Label blocks by the rank of their cluster; ranks past the last label are body."""
    names = F.array(*[F.lit(label) for label in RANKED_LABELS])
    label = F.coalesce(F.get(names, F.col("size_rank") - 1), F.lit(RANKED_LABELS[-1]))
    labels = cluster_ranks(cluster_fonts(blocks)).groupBy(DOC).agg(
        F.map_from_entries(F.collect_list(F.struct("cluster_label", label))).alias("labels")
    )
    return (
        attach(blocks, labels, [DOC])
        .withColumn("predicted_label", F.coalesce(F.col("labels")[F.col("cluster_label")], F.lit(RANKED_LABELS[-1])))
        .drop("labels")
    )

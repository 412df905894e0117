"""Connected components of a graph of links, by contraction."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagespine.llm.joins import join_facts
from pagespine.session import stage_table


def contracted(edges: DataFrame) -> DataFrame | None:
    """``node`` and ``root`` for every node of ``edges`` (columns a and b); None if there are none.

    In each round a node moves to its smallest neighbour if that is smaller, and the edges that still join different
    places go on. Edges shrink in every round, as every end that isn't the smallest of its edge moves.
    The moves are stored, so a round depends on files and not on the rounds before it.
    """
    edges = stage_table(edges.filter("a != b").distinct(), "edges")
    mapping = None
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        nearest = both.groupBy("a").agg(F.min("b").alias("b"))
        moves = stage_table(nearest.select(F.col("a").alias("node"), F.least("a", "b").alias("root")), "moves")
        if mapping is None:
            mapping = moves
        else:
            further = moves.select(F.col("node").alias("root"), F.col("root").alias("next"))
            mapping = mapping.join(further, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
        mapping = stage_table(mapping, "roots")
        ends = edges
        for end, other in (("a", "b"), ("b", "a")):
            # A star's head is the end of very many edges.
            ends = join_facts(ends, moves.select(F.col("node").alias(end), F.col("root").alias(f"{end}_root")), end, other)
        edges = stage_table(ends.select(F.col("a_root").alias("a"), F.col("b_root").alias("b")).filter("a != b").distinct(), "edges")
    return mapping


def merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (node, part) after ``links`` (a, b) between nodes have united their parts."""
    edges = links
    for end in ("a", "b"):
        edges = edges.join(labels.select(F.col("node").alias(end), F.col("part").alias(f"{end}_part")), end)
    mapping = contracted(edges.select(F.col("a_part").alias("a"), F.col("b_part").alias("b")))
    if mapping is None:
        return labels
    moved = join_facts(labels, mapping.withColumnRenamed("node", "part"), "part", "node", "left")
    return stage_table(moved.select("node", F.coalesce("root", "part").alias("part")), "labels")

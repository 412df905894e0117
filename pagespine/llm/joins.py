"""Joining facts to many rows when some facts belong to a large share of the rows."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes that may be broadcast, after the facts' rows (and the entries of their arrays) have been counted.
BROADCAST_BYTES = 24 << 20
SALTS = 16


def join_facts(rows: DataFrame, facts: DataFrame, on: str, spread_by: str, how: str = "inner", array: str | None = None, weight: int = 1) -> DataFrame:
    """``facts`` (stored, one row per ``on``) joined to ``rows``.

    Facts whose size has been measured and is small are broadcast; ``weight`` makes them count for more. Others are copied to SALTS tasks
    each, among which the rows of one fact are dealt by ``spread_by``.
    """
    entries = F.sum(F.size(array)) if array else F.lit(0)
    n, inside = facts.agg(F.count("*"), F.coalesce(entries, F.lit(0))).first()
    if (n * 24 * len(facts.columns) + inside * 8) * weight <= BROADCAST_BYTES:
        return rows.join(F.broadcast(facts), on, how)
    salt = "join_salt"
    copies = facts.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn(salt, F.pmod(F.hash(spread_by), F.lit(SALTS))).join(copies, [on, salt], how).drop(salt)


#: A key is heavy if it has more than one in so many of all rows (and at least LEAST_HEAVY): there can be no more heavy keys.
HEAVY, LEAST_HEAVY = 100_000, 256


def heavy_keys(counts: DataFrame, on: str) -> DataFrame:
    """The keys of ``counts`` (stored; ``on`` and the number ``n`` of its rows) that hold a large share of all rows."""
    total = counts.agg(F.sum("n")).first()[0] or 0
    return counts.filter(F.col("n") > max(LEAST_HEAVY, total // HEAVY)).select(on)


def join_spread(rows: DataFrame, facts: DataFrame, on: str, heavy: DataFrame, spread_by: str, how: str = "inner") -> DataFrame:
    """``facts`` (one row per ``on``) joined to ``rows``; facts of ``heavy`` keys are copied to SALTS tasks, among which their rows are dealt.

    The heavy keys may be broadcast: ``heavy_keys`` gives HEAVY of them at most.
    """
    marked, salt = F.broadcast(heavy.withColumn("join_heavy", F.lit(True))), "join_salt"
    dealt = F.when(F.col("join_heavy"), F.pmod(F.hash(spread_by), F.lit(SALTS))).otherwise(0)
    copies = F.explode(F.when(F.col("join_heavy"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0))))
    left = rows.join(marked, on, "left").withColumn(salt, dealt).drop("join_heavy")
    right = facts.join(marked, on, "left").withColumn(salt, copies).drop("join_heavy")
    return left.join(right, [on, salt], how).drop(salt)

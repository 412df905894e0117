"""Where every row of a run went: counts that Spark takes while it writes the stages, and the sums they must keep.

Counts are observed above the last shuffle of a stage only, in the tasks that write it, so a task that is run again after
a lost executor is not counted twice.
"""

from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

_open: ContextVar = ContextVar("account", default=None)


class RowsLost(ValueError):
    """Rows went missing between two stages, or came from nowhere."""


class Account:
    """Counts per stage, of the stages written while it is open."""

    def __init__(self):
        self._observed: dict[str, Observation] = {}
        self._told: dict[str, dict[str, int]] = {}
        self.stored: dict[str, DataFrame] = {}

    def enter(self, stage: str, **counts: int) -> None:
        """Counts taken elsewhere."""
        self._told.setdefault(stage, {}).update(counts)

    def watch(self, df: DataFrame, stage: str, **sums: Column) -> DataFrame:
        observed = self._observed[stage] = Observation()
        added = [F.coalesce(F.sum(c.cast("bigint")), F.lit(0)).alias(name) for name, c in sums.items()]
        return df.observe(observed, F.count(F.lit(1)).alias("rows"), *added)

    def totals(self) -> dict[str, dict[str, int]]:
        """All counts. Every stage that is watched must have been written."""
        found = {stage: dict(observed.get) for stage, observed in self._observed.items()}
        for stage, counts in self._told.items():
            found.setdefault(stage, {}).update(counts)
        return found

    def settle(self) -> dict[str, dict[str, int]]:
        """The counts, if rows in and out agree from stage to stage."""
        at = self.totals()
        sums = {
            "lines that are not blank, lines folded into blocks": (at["lines"]["nonblank"], at["blocks"]["lines"]),
            "blocks, routed blocks": (at["blocks"]["rows"], at["routed"]["rows"]),
            "blocks of varied documents, clustered blocks": (at["routed"]["rows"] - at["routed"]["uniform"], at["clusters"]["rows"]),
            "routed blocks, scored blocks": (at["routed"]["rows"], at["scored"]["rows"]),
            "scored blocks but noise, labelled blocks": (at["scored"]["rows"] - at["scored"]["noise"], at["labels"]["rows"]),
            "labelled documents, outlines": (at["labels"]["documents"], at["outlines"]["rows"]),
        }
        wrong = [f"{name}: {a} and {b}" for name, (a, b) in sums.items() if a != b]
        if wrong:
            raise RowsLost("; ".join(wrong))
        return at


@contextmanager
def account():
    """Stages written inside are counted."""
    opened = Account()
    token = _open.set(opened)
    try:
        yield opened
    finally:
        _open.reset(token)


def watched(df: DataFrame, stage: str, **sums: Column) -> DataFrame:
    """``df``, counted under this name if an account is open. Call it above the last shuffle of a stage."""
    opened = _open.get()
    return df if opened is None else opened.watch(df, stage, **sums)


def remember(stage: str, stored: DataFrame) -> None:
    """Hand a stored stage to the open account, if there is one, for counts that take a pass of their own."""
    opened = _open.get()
    if opened is not None:
        opened.stored[stage] = stored

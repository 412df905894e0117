"""Runs that can be taken up again where they broke off.

A run has a folder of its own on shared storage. Every stage table is written there, and after it a line of
the manifest: stage, fingerprint of the inputs, rows, place and layout. A run that starts in a folder with a manifest of
the same inputs reads the stages it finds and goes on at the first one missing. A stage without a line is not there, whatever
files a broken attempt left.
"""

import json
import uuid
from collections import Counter
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pagespine.session import exists, kept_by, parts_of, read_table, remove, write_table

LINE = "stage string, fingerprint string, n_rows long, path string, columns string, keys array<string>, n_buckets int"


def file_fingerprint(*tables: DataFrame) -> str:
    """Stands for the files that these tables read: their places, sizes and times. No file's rows are decoded."""
    facts = ("file_path", "file_size", "file_modification_time")
    sums = []
    for table in tables:
        files = table.select(*[F.col(f"_metadata.{fact}").alias(fact) for fact in facts]).distinct()
        code = F.sum(F.xxhash64(*facts).cast("decimal(38,0)"))
        sums.append(files.agg(F.count("*").alias("n"), code.alias("code")).first())
    return ",".join(f"{r.n}:{r.code}" for r in sums)


@dataclass
class Ledger:
    """The manifest of a run, and its stage tables."""

    spark: SparkSession
    folder: str
    fingerprint: str

    def __post_init__(self):
        self.folder = self.folder.rstrip("/")
        self.uses, self.reused, self.written = Counter(), [], []

    def manifest(self) -> DataFrame:
        """One line per stage of these inputs that is complete, the last one written if there are several."""
        lines = f"{self.folder}/manifest"
        if not exists(self.spark, lines):
            return self.spark.createDataFrame([], LINE)
        return self.spark.read.schema(LINE).json(f"{lines}/*").filter(F.col("fingerprint") == self.fingerprint)

    def _line(self, stage: str):
        return self.manifest().filter(F.col("stage") == stage).first()

    def stage(self, df: DataFrame, name: str, by: list[str] | None) -> DataFrame:
        """The stored stage, if the manifest has it, or else ``df``, which is stored now."""
        self.uses[name] += 1
        stage = name if self.uses[name] == 1 else f"{name}-{self.uses[name]}"
        line = self._line(stage)
        if line is None:
            path = f"{self.folder}/stages/{stage}-{uuid.uuid4().hex}"
            write_table(df, path, by)
            line = self._enter(stage, path, df.schema, by)
            self.written.append(stage)
        else:
            self.reused.append(stage)
        return read_table(self.spark, line["path"], StructType.fromJson(json.loads(line["columns"])), line["keys"], line["n_buckets"])

    def _enter(self, stage: str, path: str, schema: StructType, by: list[str] | None):
        """Add the stage's line. Rows are counted from the files' footers."""
        n_rows = self.spark.read.schema(schema).parquet(path).count()
        row = (stage, self.fingerprint, n_rows, path, schema.json(), by, parts_of(self.spark))
        line = self.spark.createDataFrame([row], LINE)
        line.coalesce(1).write.mode("overwrite").json(f"{self.folder}/manifest/{stage}")
        return line.first()

    def close(self) -> None:
        """Take the stage tables away, and then their lines. What the run returns must be stored elsewhere by now."""
        remove(self.spark, f"{self.folder}/manifest")
        remove(self.spark, f"{self.folder}/stages")


def open_run(spark: SparkSession, folder: str, fingerprint: str):
    """A context in which stage tables are kept in ``folder`` and taken up from there."""
    return kept_by(Ledger(spark, folder, fingerprint))

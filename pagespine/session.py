"""Session defaults and the places where intermediate tables are kept."""

import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def local_session(cores="*", partitions=8) -> SparkSession:
    """A session for one machine; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("pagespine")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names; a temporary one only on a single machine."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        folder = tempfile.mkdtemp(prefix="pagespine-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


@contextmanager
def setting(spark: SparkSession, key: str, value: str):
    """A session setting for the time of a job that starts inside."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


#: How stage tables are compressed: they are written once, read a few times and often as large as the input.
STORED_AS = "zstd"


def parts_of(spark: SparkSession) -> int:
    """Tasks of a shuffle, and buckets of a table that is stored by key."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    system, place = _file_system(spark, path)
    return system.exists(place)


def remove(spark: SparkSession, path: str) -> None:
    system, place = _file_system(spark, path)
    system.delete(place, True)


def stage_path(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/pagespine-{name}-{uuid.uuid4().hex}"


def stage_table(df: DataFrame, name: str, by: list[str] | None = None) -> DataFrame:
    """Write a table that later steps read several times, a few columns at a time.

    The written files end the lineage, so losing an executor costs a re-read
    and not the steps before. A table stored ``by`` keys is bucketed and sorted by them: joins and
    aggregates on these keys, among tables stored by the same ones, need no shuffle. Rows of ``df`` should
    already lie together by the keys (``spread.dealt``), or every task writes to every bucket.
    """
    spark, ledger = df.sparkSession, _ledger.get()
    if ledger is not None:
        return ledger.stage(df, name, by)
    path = stage_path(spark, name)
    write_table(df, path, by)
    return read_table(spark, path, df.schema, by, parts_of(spark))


#: The run whose ledger keeps the stage tables, if one is open (see ``runs``).
_ledger: ContextVar = ContextVar("ledger", default=None)


@contextmanager
def kept_by(ledger):
    """Stage tables made inside are kept, and found again, by this ledger."""
    token = _ledger.set(ledger)
    try:
        yield ledger
    finally:
        _ledger.reset(token)


def write_table(df: DataFrame, path: str, by: list[str] | None = None) -> None:
    if by is None:
        df.write.mode("overwrite").option("compression", STORED_AS).parquet(path)
        return
    # Tables stored by the first of a join's keys stay where they are.
    with setting(df.sparkSession, "spark.sql.requireAllClusterKeysForCoPartition", "false"):
        write_bucketed(df, path, by)


def read_table(spark: SparkSession, path: str, schema, by: list[str] | None, n_buckets: int) -> DataFrame:
    return spark.read.schema(schema).parquet(path) if by is None else read_bucketed(spark, path, schema, by, n_buckets)


def write_bucketed(df: DataFrame, path: str, by: list[str]) -> None:
    """Bucketed files are written through a table; its name goes as soon as the files are there."""
    name = f"pagespine_{uuid.uuid4().hex}"
    try:
        df.write.bucketBy(parts_of(df.sparkSession), *by).sortBy(*by).option("path", path).option("compression", STORED_AS).saveAsTable(name, format="parquet")
    finally:
        df.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")


def read_bucketed(spark: SparkSession, path: str, schema, by: list[str], n_buckets: int) -> DataFrame:
    """A table written by ``write_bucketed``; its name is needed only until Spark has resolved it."""
    name, keys = f"pagespine_{uuid.uuid4().hex}", ", ".join(f"`{k}`" for k in by)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet OPTIONS (path '{path}') CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {n_buckets} BUCKETS"
    )
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return table


def unkept_table(df: DataFrame, name: str) -> DataFrame:
    """A stage table that no run takes up again, as those of single rounds."""
    path = stage_path(df.sparkSession, name)
    write_table(df, path)
    return read_table(df.sparkSession, path, df.schema, None, 0)

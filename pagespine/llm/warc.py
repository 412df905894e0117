"""Web archives: writing records, reading them back, and one ordered index of all captures.

``write`` turns pages into WARC records: one response per payload, and revisits that refer to
it. Spark's own text writer puts the records into gzip files, so a lost task is repeated and
nothing appears twice. ``read`` parses the files by their content lengths. ``index`` is an
external merge: each archive gives a run of captures sorted by URL key and time; the runs are
dealt out by ranges of that order, and in each range a loser tree merges them.

Cases: a null page is an empty payload; a null URL has no target and an empty key; null ids
are kept (a payload whose ids are all null has responses only). Rows repeated with the
largest id of their payload are all responses. No pages give no records. Other columns of the
input are ignored.
"""

import gzip
import hashlib
import io
import uuid
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from pagespine.session import checkpoint_dir

#: Payloads of fewer bytes are stored again each time.
LEAST_BYTES = 1000
#: Records of an archive file; bounds what the reader holds at once.
RECORDS_PER_FILE = 4_000
#: A payload's rows meet its response in as many tasks.
SALTS = 16

CAPTURE = StructType()
for _name in "page_id url captured record_type payload_bytes payload_digest refers_to urlkey archive record_offset".split():
    CAPTURE.add(_name, "long" if _name in ("page_id", "payload_bytes", "refers_to", "record_offset") else "string")
_ORDER = ("urlkey", "captured", "page_id", "record_offset")


def captures(pages: DataFrame) -> DataFrame:
    """Pages with payload, size, digest and time of capture.

    The time comes from a ``captured`` column (``yyyy-MM-ddTHH:mm:ssZ``) if there is one, and
    else counts the seconds of the id.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    seconds = F.timestamp_seconds(F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(10**9)) + 1_500_000_000)
    time = F.col("captured").cast("string") if "captured" in pages.columns else F.date_format(seconds, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return pages.select(
        "page_id", "url", time.alias("captured"), payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("payload_bytes"), F.sha1(payload.cast("binary")).alias("payload_digest"),
    )


def responses(found: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """The response's id of each payload that several records share; counted before the shuffle."""
    same = found.filter(F.col("payload_bytes") >= least_bytes).groupBy("payload_digest", "payload_bytes")
    return same.agg(F.max("page_id").alias("first_id"), F.count("*").alias("n")).filter("n > 1 AND first_id IS NOT NULL").drop("n")


def _record():
    """One record as text, without its last line feed, which the text writer adds."""
    size = F.col("payload_bytes").cast("string")
    revisit = F.col("refers_to").isNotNull()
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), size, F.lit("\r\n\r\n"))
    block = F.when(revisit, http).otherwise(F.concat(http, "payload"))
    url = F.regexp_replace("url", r"[\x00-\x20]", "")
    lines = F.concat_ws(
        "\r\n", F.lit("WARC/1.1"), F.when(revisit, F.lit("WARC-Type: revisit")).otherwise(F.lit("WARC-Type: response")),
        F.concat(F.lit("WARC-Record-ID: <urn:uuid:"), F.uuid(), F.lit(">")), F.concat(F.lit("WARC-Page-ID: "), F.col("page_id").cast("string")),
        F.concat(F.lit("WARC-Date: "), "captured"), F.concat(F.lit("WARC-Target-URI: "), url),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), "payload_digest"), F.concat(F.lit("WARC-Payload-Length: "), size),
        F.when(revisit, F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        F.concat(F.lit("WARC-Refers-To-Page: "), F.col("refers_to").cast("string")),
        F.lit("Content-Type: application/http;msgtype=response"), F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")),
    )
    return F.concat(lines, F.lit("\r\n\r\n"), block, F.lit("\r\n\r"))


def write(pages: DataFrame, path: str, least_bytes: int = LEAST_BYTES, records_per_file: int = RECORDS_PER_FILE) -> None:
    """Archive ``pages`` under ``path``."""
    found = captures(pages)
    salted = responses(found, least_bytes).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rows = found.withColumn("salt", F.pmod(F.hash("page_id"), F.lit(SALTS)))
    decided = rows.join(salted, ["payload_digest", "payload_bytes", "salt"], "left")
    later = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    decided = decided.withColumn("refers_to", F.when(later, F.col("first_id")))
    decided.select(_record().alias("value")).write.option("maxRecordsPerFile", records_per_file).option("compression", "gzip").text(path)


def url_key(url: str) -> str:
    """Host labels from the last to the first, then the path and query, in lower case."""
    try:
        parts = urlsplit(url)
        labels = (parts.hostname or "").removeprefix("www.").split(".")
    except ValueError:
        return url.lower()
    return ",".join(reversed(labels)) + ")" + (parts.path or "/").lower() + ("?" + parts.query.lower() if parts.query else "")


def _records(stream):
    """(offset, headers, block) of each record in an open archive."""
    offset = 0
    while line := stream.readline():
        start, headers = offset, {}
        offset += len(line)
        if not line.startswith(b"WARC/1."):
            raise ValueError(f"no record at byte {start}")
        while (line := stream.readline()).strip():
            offset += len(line)
            name, _, value = line.decode().partition(":")
            headers[name] = value.strip()
        size = int(headers["Content-Length"])
        block = stream.read(size)
        if len(block) != size or stream.read(4) != b"\r\n\r\n":
            raise ValueError(f"the record at byte {start} is cut")
        offset += len(line) + size + 4
        yield start, headers, block


def _capture(archive: str, offset: int, headers: dict, block: bytes) -> tuple:
    kind, digest = headers["WARC-Type"], headers["WARC-Payload-Digest"].removeprefix("sha1:")
    size = int(headers["WARC-Payload-Length"])
    if kind == "response":
        payload = block[block.index(b"\r\n\r\n") + 4 :]
        if hashlib.sha1(payload).hexdigest() != digest or len(payload) != size:
            raise ValueError(f"{archive}: damaged payload at byte {offset}")
    url, page, first = (headers.get(n) for n in ("WARC-Target-URI", "WARC-Page-ID", "WARC-Refers-To-Page"))
    return (
        None if page is None else int(page), url, headers.get("WARC-Date"), kind, size, digest,
        None if first is None else int(first), url_key(url) if url else "", archive, offset,
    )


def _table(rows: list) -> pa.RecordBatch:
    schema = to_arrow_schema(CAPTURE)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)


def _key(row: tuple) -> tuple:
    """Sort key of a capture; nulls come first."""
    return row[7], row[2] or "", row[0] is not None, row[0] or 0, row[8], row[9]


def _runs(batches):
    """The captures of each archive, sorted."""
    for batch in batches:
        for path, content in zip(batch["path"], batch["content"], strict=True):
            archive = path.as_py().rpartition("/")[2]
            with gzip.GzipFile(fileobj=io.BytesIO(content.as_buffer())) as stream:
                run = sorted((_capture(archive, *record) for record in _records(stream)), key=_key)
            if run:
                yield _table(run)


def read(spark: SparkSession, path: str) -> DataFrame:
    """All captures under ``path``, a sorted run for each archive."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return files.select("path", "content").mapInArrow(_runs, CAPTURE)


class LoserTree:
    """Merges sorted iterators: each inner node keeps the loser of its match, so a step replays one path."""

    def __init__(self, sources, key):
        self.sources, self.key = [iter(s) for s in sources], key
        self.heads = [self._next(i) for i in range(len(self.sources))]
        self.losers = [-1] * max(1, len(self.sources))
        for i in range(len(self.sources)):
            self._replay(i)

    def _next(self, i):
        row = next(self.sources[i], None)
        return None if row is None else (self.key(row), i, row)

    def _beats(self, a, b):
        if b == -1 or self.heads[a] is None:
            return False
        return self.heads[b] is None or self.heads[a][:2] < self.heads[b][:2]

    def _replay(self, i):
        node, winner = (i + len(self.sources)) // 2, i
        while node > 0:
            if self.losers[node] == -1:
                # While the tree is built, the first to arrive waits for its match.
                self.losers[node], winner = winner, -1
                break
            if self._beats(self.losers[node], winner):
                self.losers[node], winner = winner, self.losers[node]
            node //= 2
        if winner != -1:
            self.losers[0] = winner

    def __iter__(self):
        while self.sources and self.heads[self.losers[0]] is not None:
            winner = self.losers[0]
            yield self.heads[winner][2]
            self.heads[winner] = self._next(winner)
            self._replay(winner)


def _merged(batches, rows_per_batch: int = 10_000):
    """A range's rows, which arrive archive by archive, in the order of the index."""
    runs: dict = {}
    for batch in batches:
        for row in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            runs.setdefault(row[8], []).append(row)
    out = []
    for row in LoserTree(runs.values(), _key):
        out.append(row)
        if len(out) == rows_per_batch:
            yield _table(out)
            out = []
    if out:
        yield _table(out)


def index(found: DataFrame) -> DataFrame:
    """Captures in the order of URL key and time: each partition is a range, ordered in itself."""
    ranges = found.repartitionByRange(*[F.col(c).asc_nulls_first() for c in ("urlkey", "captured", "page_id", "archive", "record_offset")])
    local = ranges.sortWithinPartitions("archive", *[F.col(c).asc_nulls_first() for c in _ORDER])
    return local.select(*CAPTURE.names).mapInArrow(_merged, CAPTURE)


def archive(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``pages`` as archives, by default under the shared folder, and return the index read back from them."""
    spark = pages.sparkSession
    path = path or f"{checkpoint_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    write(pages, path)
    return index(read(spark, path))

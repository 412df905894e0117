"""Running a kernel over whole texts, a few megabytes at a time, inside Spark's tasks.

Only the text goes to Python; all other columns of a row stay in the JVM, so a kernel's
results join their rows without a key, whatever else the table holds.
"""

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from pagespine.session import setting, stage_table

#: Texts are handed to a kernel in lists of about this many bytes (one text at least).
SLICE_BYTES = 4 << 20


def slices(texts, limit=SLICE_BYTES):
    """Lists of texts of at most ``limit`` bytes together; a longer text is a list of its own."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
    start = total = 0
    for i, size in enumerate(sizes):
        if total and total + size > limit:
            yield texts[start:i].to_pylist()
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield texts[start:].to_pylist()


def over_texts(kernel, ddl: str):
    """A column function; ``kernel(list of texts)`` gives one tuple per text, of the fields in ``ddl``.

    Marked as not deterministic so that Spark never evaluates it twice for one row.
    """
    kind = StructType.fromDDL(ddl)
    types = [to_arrow_type(field.dataType) for field in kind.fields]
    names = [field.name for field in kind.fields]

    def run(texts: pa.Array) -> pa.Array:
        parts = []
        for part in slices(texts):
            columns = list(zip(*kernel(part), strict=True))
            parts.append(pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names))
        if not parts:
            return pa.StructArray.from_arrays([pa.array([], t) for t in types], names)
        return pa.concat_arrays(parts)

    return F.arrow_udf(run, kind).asNondeterministic()


def stored(df, name: str):
    """A stage table whose texts and sets reach Python in batches of about SLICE_BYTES, however long a partition is."""
    with setting(df.sparkSession, "spark.sql.execution.arrow.maxBytesPerBatch", str(SLICE_BYTES)):
        return stage_table(df, name)


def fresh(df, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name

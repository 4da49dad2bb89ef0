"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared folder of ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage with columnar, compressed files that every executor can
    reach, so a lost executor costs only its running tasks.
    """
    path = scratch_path(df.sparkSession, "llm", name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_KEPT: dict = {}


def kept_in_worker(key, make):
    """What ``make`` gives, kept by this worker process for the key's next tasks.

    Workers outlive a query and go on with the tasks of others, so they keep one thing at a time.
    """
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = make()
    return _KEPT[key]


def release_kept() -> None:
    """Drop what this worker process keeps of other tasks: for tasks that need the memory themselves."""
    if _KEPT:
        import pyarrow as pa

        _KEPT.clear()
        pa.default_memory_pool().release_unused()


def literal_rows(spark: SparkSession, names: list[str], rows: list[tuple]) -> DataFrame:
    """A small fixed table as literals in the plan (of known size, so it may be broadcast)."""
    structs = [F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def fold(doc_id: Column | str, modulus: int) -> Column:
    """The deterministic fold of a document: crc32 of its id as text, modulo ``modulus``.

    A null id falls into the fold of the empty string (0).
    """
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")) % modulus


def next_power_of_two(n: float) -> int:
    return 1 << max(0, int(-(-n // 1) - 1)).bit_length() if n > 1 else 1


#: a slice of texts: at most so many rows and so many bytes; a longer text is a slice of its own
SLICE_ROWS, SLICE_BYTES = 256, 1 << 22
#: whole texts go to Python in batches of as many rows; Spark's own 10,000 texts are tens of MB, in the JVM and in Python
TEXT_BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": SLICE_ROWS}


def slices(batch, texts):
    """An Arrow batch in slices of bounded length, by the texts of its rows."""
    import numpy as np
    import pyarrow.compute as pc

    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(ends):
        most = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SLICE_BYTES, side="right")) - at
        n = max(1, min(SLICE_ROWS, most))
        yield batch.slice(at, n)
        at += n


def map_text(df: DataFrame, text: str, keep: list[str], make, fields: str) -> DataFrame:
    """Run Python over the text of every row, in Arrow slices of bounded length.

    ``make()`` is called once per task and returns a function from a list of
    texts (UTF-8 bytes, or None for null) to the list of columns named in the
    DDL ``fields``. The result has the struct ``row`` of the kept input columns
    and those fields, so input names never clash with them.
    """
    import pyarrow as pa
    from pyspark.sql.types import StructType

    carried = text in keep
    source = df.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"),
                       *([] if carried else [F.col(f"`{text}`").cast("binary").alias("_text")]))
    added = StructType.fromDDL(fields)
    schema = StructType([source.schema["row"], *added.fields])
    types = [_arrow_type(f.dataType) for f in added.fields]
    names = schema.names

    def run(batches):
        fn = make()
        for batch in batches:
            # a slice of a struct array keeps the whole children
            whole = batch.column(0).field(text) if carried else batch.column(1)
            for part in slices(batch, whole.slice(batch.column(0).offset, batch.num_rows) if carried else whole):
                row = part.column(0)
                texts = row.field(text) if carried else part.column(1)
                if carried and len(texts) != len(row):
                    texts = texts.slice(row.offset, len(row))
                cols = fn(texts.cast(pa.binary()).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [row, *(c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(cols, types))], names)

    return source.mapInArrow(run, schema)


def _arrow_type(kind):
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)

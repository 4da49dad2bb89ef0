"""File and console writers.

Streams write through ``foreachBatch``: each micro-batch goes to its own
``batch_id=<n>`` folder with mode ``overwrite``, so a batch replayed after a
failure rewrites the same folder instead of duplicating rows (exactly-once
output for several sinks off one state store).
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from racestream.operators.gaps import CSV_COLUMNS, CSV_HEADER
from racestream.session import path_exists


def write_lines(df: DataFrame, path: str, column: str = "line", mode: str = "overwrite",
                max_records_per_file: int | None = None) -> None:
    """One text line per row (UTF-8), like a row-format text sink."""
    w = df.select(F.col(column).cast("string").alias("value")).write.mode(mode)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    w.text(path)


def csv_header_names() -> list:
    """The gap CSV's column titles, from the job's header line."""
    return [h.strip() for h in CSV_HEADER.split(",")]


def write_csv(csv_rows: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """The gap CSV: the 11 fields with the job's header, once per file.

    Fails when the path exists, as the job's default write mode does.
    """
    out = csv_rows.select(*[F.col(c).alias(h) for c, h in zip(CSV_COLUMNS, csv_header_names())])
    out.write.mode(mode).option("header", True).csv(path)


def write_text_dump(df: DataFrame, path: str, column: str = "hex") -> None:
    """Text dump that replaces what is there."""
    write_lines(df, path, column=column, mode="overwrite")


def fan_out(branches: dict[str, Callable[[DataFrame], DataFrame]],
            writers: dict[str, Callable[[DataFrame, int], None]]):
    """A ``foreachBatch`` function sending each micro-batch to several sinks.

    The batch is persisted once so the branches do not recompute it, and
    released after the last write.
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for name, branch in branches.items():
                writers[name](branch(batch), batch_id)
        finally:
            batch.unpersist()

    return run


def batch_folder(bucket: str, batch_id) -> str:
    """The folder of one bucket and batch, the same for streams and batch runs."""
    return f"bucket={bucket}/batch_id={batch_id}"


def batch_folder_writer(base: str, bucket: str, column: str = "line",
                        max_records_per_file: int | None = None):
    """Writer for ``fan_out``: ``<base>/bucket=<bucket>/batch_id=<n>``, idempotent."""
    def write(df: DataFrame, batch_id: int) -> None:
        write_lines(df, f"{base.rstrip('/')}/{batch_folder(bucket, batch_id)}", column=column,
                    mode="overwrite", max_records_per_file=max_records_per_file)
    return write


def require_matching_checkpoint(spark: SparkSession, output_base: str, buckets, checkpoint: str) -> None:
    """Refuse a fresh checkpoint on existing output: its batch ids would start at 0
    again and replace the earlier batches."""
    if not path_exists(spark, f"{checkpoint.rstrip('/')}/offsets"):
        refuse_existing(spark, output_base, buckets)


def refuse_existing(spark: SparkSession, output_base: str, buckets) -> None:
    """Raise if one of the buckets is there already."""
    if any(path_exists(spark, f"{output_base.rstrip('/')}/bucket={b}") for b in buckets):
        raise ValueError(f"{output_base} holds output of another run: give that run's checkpoint or another folder")


def _print(text: str) -> None:
    print(text, flush=True)


def print_rows(df: DataFrame, emit: Callable[[str], None] = _print) -> None:
    """Print every row, each on the executor that holds it (``emit``: what takes a row's text)."""
    def one(row) -> None:
        emit(str(row[0]) if len(row) == 1 else ", ".join(f"{k}={v}" for k, v in row.asDict().items()))

    df.foreach(one)


def console_writer(emit: Callable[[str], None] = _print):
    """Writer for ``fan_out`` and ``foreachBatch``: every row of the batch is printed."""
    def write(df: DataFrame, batch_id: int) -> None:
        print_rows(df, emit)
    return write

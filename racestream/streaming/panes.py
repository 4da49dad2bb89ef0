"""Sliding windows of a click stream by panes, with the late clicks as an output of their own.

Spark's window aggregation copies each click into its windows, and what is late for a window vanishes. Two
aggregations in a row (panes, then windows; ``windowed_counts_stream(chained=True)``) avoid the copies but drop a
click as soon as its pane has closed, though some of its windows are open. Here each micro-batch is a batch job:

* clicks are aggregated into panes; open panes are a table, one version per batch id, read and written anew;
* a window is put out once, by the batch whose watermark passes its end, from all its panes;
* a click is tested against the watermark per window: it counts in the windows still open, and for each
  window already closed it goes to ``late`` with that window.

The watermark of batch ``n`` is the latest time of the records up to batch ``n`` less the delay, whatever the
record (also anonymous or unparsable ones). A batch that is run again reads the version before it and replaces its
own folders, so it gives the same rows. Versions before the last two are deleted.
"""

from __future__ import annotations

from math import gcd

from pyspark.sql import DataFrame, SparkSession, functions as F

from racestream.operators import clicks as C
from racestream.options import ClickOptions
from racestream.session import delete_path, path_exists

FINAL = "final"


class PaneWindows:
    """The ``foreachBatch`` function; ``batch`` has clicks (``value, ts, seq``)."""

    def __init__(self, spark: SparkSession, opts: ClickOptions, output: str, state: str):
        self.spark, self.opts = spark, opts
        self.output, self.state = output.rstrip("/"), state.rstrip("/")
        self.size, self.slide = opts.window_size_mins * 60, opts.window_slide_secs
        self.pane = gcd(self.size, self.slide)

    def _version(self, table: str, batch_id: int) -> str:
        return f"{self.state}/{table}/version={batch_id}"

    def _read(self, table: str, batch_id: int, schema) -> DataFrame | None:
        if batch_id < 0:
            return None
        path = self._version(table, batch_id)
        if not path_exists(self.spark, path):
            raise RuntimeError(f"{path} is missing: batch {batch_id} left no state, or it was deleted")
        return self.spark.read.schema(schema).parquet(path)

    def _windows(self, rows: DataFrame, at: str) -> DataFrame:
        """Rows copied into the windows that cover the pane start ``at``."""
        return C.into_windows(rows, self.opts, F.col(at))

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        if batch_id == 0 or not path_exists(self.spark, f"{self.output}/windows/batch_id={batch_id}"):
            delete_path(self.spark, f"{self.output}/windows/batch_id={FINAL}")  # the input goes on after all
        fresh = self._version("new", batch_id)
        C.parse_clicks(batch).write.mode("overwrite").parquet(fresh)  # parsed once
        parsed = self.spark.read.parquet(fresh)
        kind = parsed.schema["ts"].dataType.simpleString()
        before = self._read("mark", batch_id - 1, "mark string")
        old = F.lit(before.first()["mark"] if before is not None else None).cast(kind)
        mark = F.greatest(old, (F.max("ts") - F.expr(f"INTERVAL {self.opts.watermark_delay}")).cast(kind))
        parsed.agg(mark.cast("string").alias("mark")).write.mode("overwrite").parquet(self._version("mark", batch_id))
        now = F.lit(self._read("mark", batch_id, "mark string").first()["mark"]).cast(kind)
        clicks = C.authenticated(parsed).withColumn("pane_start", F.window("ts", f"{self.pane} seconds")["start"])
        # only clicks before the watermark can be late for a window
        late = self._windows(clicks.where(F.col("pane_start") < old), "pane_start").where(F.col("window_end") <= old)
        late.drop("pane_start").write.mode("overwrite").parquet(f"{self.output}/late/batch_id={batch_id}")
        first = F.struct("ts", "seq", "raw")
        panes = clicks.groupBy("account_id", "pane_start").agg(F.count(F.lit(1)).alias("n"), F.min(first).alias("first"))
        schema = panes.schema
        earlier = self._read("panes", batch_id - 1, schema)
        if earlier is not None:
            panes = (panes.unionByName(earlier).groupBy("account_id", "pane_start")
                     .agg(F.sum("n").alias("n"), F.min("first").alias("first")))
        merged = self._version("merged", batch_id)
        panes.write.mode("overwrite").parquet(merged)
        panes = self.spark.read.schema(schema).parquet(merged)
        ends = F.coalesce(F.col("window_end") <= now, F.lit(False)) & F.coalesce(F.col("window_end") > old, F.lit(True))
        self._put_out(panes, ends, str(batch_id))
        last_end = F.window("pane_start", self.opts.slide_duration)["start"] + F.expr(f"INTERVAL '{self.size}' SECOND")
        (panes.where(F.coalesce(last_end > now, F.lit(True)))
         .write.mode("overwrite").parquet(self._version("panes", batch_id)))
        for path in (fresh, merged, self._version("mark", batch_id - 2), self._version("panes", batch_id - 2)):
            delete_path(self.spark, path)

    def _put_out(self, panes: DataFrame, ends, folder: str) -> None:
        windows = (self._windows(panes.repartition("account_id"), "pane_start").where(ends)
                   .groupBy("account_id", "window_start", "window_end").agg(F.sum("n").alias("n"), F.min("first").alias("first")))
        (windows.select("account_id", "window_start", "window_end", "n", F.col("first.raw").alias("first_raw"))
         .write.mode("overwrite").parquet(f"{self.output}/windows/batch_id={folder}"))

    def finish(self, last_batch_id: int) -> None:
        """At the end of a finite input: put out the windows still open, into ``batch_id=final``. May be repeated."""
        mark = self.spark.read.parquet(self._version("mark", last_batch_id)).first()["mark"]
        panes = self.spark.read.parquet(self._version("panes", last_batch_id))
        kind = panes.schema["pane_start"].dataType.simpleString()
        self._put_out(panes, F.coalesce(F.col("window_end") > F.lit(mark).cast(kind), F.lit(True)), FINAL)

    def windows(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.output}/windows").drop("batch_id")

    def late(self) -> DataFrame:
        """Late clicks, once for each window they are late for."""
        return self.spark.read.parquet(f"{self.output}/late").drop("batch_id")

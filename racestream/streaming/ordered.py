"""Neighbour tracking in streams for keys of any size and events in any order.

``applyInPandasWithState`` gives a key to one task and takes events as they
arrive. Here each micro-batch is instead a batch job over slices
(``neighbours_split``), so one race may be the whole stream, and events wait
until the watermark passes them, so they are taken in event-time order.

What is carried lives in tables below ``state``, one version per batch id:

* ``states/version=<n>``: the state of every key after batch ``n``;
* ``held/version=<n>``: events later than the watermark, waiting (any number:
  they are rows of a table, not of a task's memory);
* ``mark/version=<n>``: the watermark: the latest event time so far less ``delay``.

Batch ``n`` reads version ``n - 1`` and writes version ``n`` and the folders
``rows/batch_id=<n>`` and ``late/batch_id=<n>`` of the output, each with
``overwrite``: a batch that is replayed after a failure gives the same rows, as
nothing it reads has changed. Versions before the last two are deleted.

An event at or before the watermark of the batch before is late: it goes to
``late`` and not into the state. Without a ``delay`` nothing waits and nothing
is late: batches are taken as they arrive, each in order by itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from racestream.operators.neighbours_split import advance_neighbours, last_states
from racestream.operators.telemetry import decode_telemetry
from racestream.session import delete_path, path_exists

STATES = "session_id string, target_id string, state string"
FINAL = "final"


class OrderedNeighbours:
    """The ``foreachBatch`` function and its tables; ``batch`` holds messages in the Kafka layout."""

    def __init__(self, spark: SparkSession, targets, output: str, state: str, delay: str | None = None,
                 num_slices: int | None = None):
        self.spark, self.targets, self.delay, self.num_slices = spark, targets, delay, num_slices
        self.output, self.state = output.rstrip("/"), state.rstrip("/")

    def _version(self, table: str, batch_id: int) -> str:
        return f"{self.state}/{table}/version={batch_id}"

    def _read(self, table: str, batch_id: int, schema) -> DataFrame | None:
        if batch_id < 0:
            return None
        path = self._version(table, batch_id)
        if not path_exists(self.spark, path):
            raise RuntimeError(f"{path} is missing: batch {batch_id} left no state, or it was deleted")
        return self.spark.read.schema(schema).parquet(path)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        if batch_id == 0 or not path_exists(self.spark, f"{self.output}/rows/batch_id={batch_id}"):
            delete_path(self.spark, f"{self.output}/rows/batch_id={FINAL}")  # the input goes on after all
        events = decode_telemetry(batch)
        if self.delay is None:
            self._advance(events, batch_id, str(batch_id))
            return
        # decoded once: the rows are read by the watermark, the late rows, the held rows and the advance
        fresh = self._version("new", batch_id)
        events.write.mode("overwrite").parquet(fresh)
        new = self.spark.read.schema(events.schema).parquet(fresh)
        kind = events.schema["event_time"].dataType.simpleString()
        before = self._read("mark", batch_id - 1, "mark string")
        old = F.lit(before.first()["mark"] if before is not None else None).cast(kind)
        mark = F.greatest(old, (F.max("event_time") - F.expr(f"INTERVAL {self.delay}")).cast(kind)).cast("string")
        new.agg(mark.alias("mark")).write.mode("overwrite").parquet(self._version("mark", batch_id))
        now = F.lit(self._read("mark", batch_id, "mark string").first()["mark"]).cast(kind)
        late = F.coalesce(F.col("event_time") <= old, F.lit(False))
        new.where(late).write.mode("overwrite").parquet(f"{self.output}/late/batch_id={batch_id}")
        waiting = new.where(~late)
        held = self._read("held", batch_id - 1, events.schema)
        if held is not None:
            waiting = waiting.unionByName(held)
        ready = F.coalesce(F.col("event_time") <= now, F.lit(False))
        waiting.where(~ready).write.mode("overwrite").parquet(self._version("held", batch_id))
        self._advance(waiting.where(ready), batch_id, str(batch_id))
        delete_path(self.spark, fresh)

    def _advance(self, events: DataFrame, batch_id: int, folder: str, keep: bool = True) -> None:
        """Take ``events`` from the states before ``batch_id`` on; ``keep``: write the states after it."""
        states = self._read("states", batch_id - 1, STATES)
        touched = None
        if states is not None:
            sessions = events.select(F.col("session_id").alias("_s")).distinct()
            same = F.col("session_id").eqNullSafe(F.col("_s"))
            touched = states.join(sessions, same, "left_semi")
        path = self._version("advanced", batch_id)
        advance_neighbours(events, self.targets, touched, self.num_slices).write.mode("overwrite").parquet(path)
        advanced = self.spark.read.parquet(path)
        (advanced.where("state is null").drop("state", "slice")
         .write.mode("overwrite").parquet(f"{self.output}/rows/batch_id={folder}"))
        if keep:
            after = last_states(advanced)
            if states is not None:
                key = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in ("session_id", "target_id")]
                after = after.unionByName(states.alias("a").join(after.alias("b"), key, "left_anti"))
            after.write.mode("overwrite").parquet(self._version("states", batch_id))
            for table in ("states", "held", "mark"):
                delete_path(self.spark, self._version(table, batch_id - 2))
        delete_path(self.spark, path)

    def finish(self, last_batch_id: int) -> None:
        """At the end of a finite input: take what is still held, into ``rows/batch_id=final``.

        The states stay as they are, so it may be repeated; if the stream goes on, its next batch drops the folder.
        """
        schema = self.spark.read.parquet(self._version("held", last_batch_id)).schema if self.delay else None
        if schema is not None:
            self._advance(self._read("held", last_batch_id, schema), last_batch_id + 1, FINAL, keep=False)

    def rows(self) -> DataFrame:
        """All rows written so far."""
        return self.spark.read.parquet(f"{self.output}/rows").drop("batch_id")

    def late(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.output}/late").drop("batch_id")


def start_ordered_neighbours(messages: DataFrame, targets, output: str, state: str, checkpoint: str,
                             delay: str | None = None, available_now: bool = False, processing_time: str = "15 seconds",
                             num_slices: int | None = None) -> tuple[StreamingQuery, OrderedNeighbours]:
    """Run ``OrderedNeighbours`` over a stream of messages. ``state`` and ``output`` belong to the checkpoint."""
    job = OrderedNeighbours(messages.sparkSession, targets, output, state, delay, num_slices)
    w = messages.writeStream.option("checkpointLocation", checkpoint).foreachBatch(job)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    return w.start(), job

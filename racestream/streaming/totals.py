"""Running totals of skipped records over all batches and restarts of a stream."""

from __future__ import annotations

import json
import logging
import threading
from collections.abc import Callable

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from racestream.session import path_exists, read_text, write_text

LOG = logging.getLogger("racestream")
LOG_EVERY = 500_000


class SkipTotals(StreamingQueryListener):
    """Adds up the observed metrics ``metrics`` (say ``click_quality``) of one query.

    Each finished micro-batch reports its counts (``observe``); they are added once per batch id, so a batch that is
    run again counts once. ``path`` keeps the totals and the last batch id, so a restart on the same checkpoint goes
    on from there. Whenever the skipped records (the sum of all counts) pass another ``every``, ``emit`` gets a line.

    Attach before the query starts and detach when it has ended; several queries may run in the session, this
    listener hears the one named ``query_name`` (all, if None).
    """

    def __init__(self, spark: SparkSession, path: str, metrics: str, query_name: str | None = None, every: int = LOG_EVERY,
                 emit: Callable[[str], None] = LOG.info):
        self.spark, self.path, self.metrics = spark, path, metrics
        self.query_name, self.every, self.emit = query_name, every, emit
        self.lock = threading.Lock()
        saved = json.loads(read_text(spark, path)) if path_exists(spark, path) else {}
        self.batch_id: int = saved.get("batch_id", -1)
        self.totals: dict[str, int] = saved.get("totals", {})

    @property
    def skipped(self) -> int:
        return sum(self.totals.values())

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        row = (progress.observedMetrics or {}).get(self.metrics)
        if row is None or self.query_name not in (None, progress.name):
            return
        with self.lock:
            if progress.batchId <= self.batch_id:
                return
            before = self.skipped
            for name, n in row.asDict().items():
                self.totals[name] = self.totals.get(name, 0) + (n or 0)
            self.batch_id = progress.batchId
            write_text(self.spark, self.path, json.dumps({"batch_id": self.batch_id, "totals": self.totals}))
            for passed in range(before // self.every + 1, self.skipped // self.every + 1):
                self.emit(f"filtered-out another {self.every:,}, {passed * self.every:,} so far: {json.dumps(self.totals)}")

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def attach(self) -> "SkipTotals":
        self.spark.streams.addListener(self)
        return self

    def detach(self) -> None:
        """Stop listening, after what is under way has been heard."""
        self.spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        self.spark.streams.removeListener(self)

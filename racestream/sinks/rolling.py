"""Text sink with rolling parts for streams: few finished files from many small batches, each line once.

A bucket is a folder ``bucket=<name>`` with

* ``_pending/batch_id=<n>``: the lines of batch ``n``, in progress (readers of the bucket skip names that begin
  with ``_``);
* ``part=<k>``: finished parts, which never change; each is one or more files of at most the part size.

A part is finished from all pending lines when the policy says so: the oldest pending line is ``roll_seconds`` old,
nothing came for ``idle_seconds``, or ``max_bytes`` are pending. What is pending and what is finished stands in a
manifest, ``_manifest/<bucket>/<n>.json``, one per batch.

Replay: batch ``n`` starts from the manifest of batch ``n - 1`` whatever an earlier attempt left. Parts that this
manifest does not know are deleted first, and pending lines go only in the batch *after* the one that finished
them, when Spark has committed it. So at any stop between two steps a line is pending, in one part, or in a part
that is about to be deleted and written again.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from racestream.session import delete_path, path_exists, path_size, read_text, write_text


# The original job's rolling policy.
@dataclass(frozen=True)
class RollingPolicy:
    roll_seconds: float = 60
    idle_seconds: float = 180
    max_bytes: int = 1024 * 1024 * 1024


class RollingSink:
    """One bucket. ``write(df, batch_id)`` is the writer for ``fan_out``; ``finish`` ends the last part."""

    def __init__(self, spark: SparkSession, base: str, bucket: str, policy: RollingPolicy = RollingPolicy(),
                 column: str = "line", clock: Callable[[], float] = time.time):
        self.spark, self.policy, self.column, self.clock = spark, policy, column, clock
        self.folder = f"{base.rstrip('/')}/bucket={bucket}"
        self.manifests = f"{base.rstrip('/')}/_manifest/{bucket}"

    # -- manifest -----------------------------------------------------------------

    def _manifest(self, batch_id: int) -> dict:
        path = f"{self.manifests}/{batch_id}.json"
        if path_exists(self.spark, path):
            return json.loads(read_text(self.spark, path))
        if batch_id >= 0:
            raise RuntimeError(f"{path} is missing: give the checkpoint that belongs to this output")
        return {"pending": [], "done": [], "parts": 0}

    def _save(self, batch_id: int, manifest: dict) -> None:
        write_text(self.spark, f"{self.manifests}/{batch_id}.json", json.dumps(manifest))

    def _pending(self, batch_id: int) -> str:
        return f"{self.folder}/_pending/batch_id={batch_id}"

    # -- writing ------------------------------------------------------------------

    def __call__(self, df: DataFrame, batch_id: int) -> None:
        self.write(df, batch_id)

    def write(self, df: DataFrame, batch_id: int) -> None:
        manifest = self._manifest(batch_id - 1)
        for n in manifest["done"]:  # their part belongs to a batch that is committed
            delete_path(self.spark, self._pending(n))
        manifest["done"] = []
        delete_path(self.spark, f"{self.folder}/part={manifest['parts']}")  # of an attempt that did not get through
        now = self.clock()
        path = self._pending(batch_id)
        df.select(F.col(self.column).cast("string").alias("value")).write.mode("overwrite").text(path)
        size = path_size(self.spark, path)
        if size:
            manifest["pending"].append({"batch_id": batch_id, "bytes": size, "since": now})
        else:
            delete_path(self.spark, path)
        if self._due(manifest["pending"], now):
            self._roll(manifest)
        self._save(batch_id, manifest)
        delete_path(self.spark, f"{self.manifests}/{batch_id - 2}.json")

    def _due(self, pending: list[dict], now: float) -> bool:
        p = self.policy
        return bool(pending) and (now - pending[0]["since"] >= p.roll_seconds or now - pending[-1]["since"] >= p.idle_seconds
                                  or sum(x["bytes"] for x in pending) >= p.max_bytes)

    def _roll(self, manifest: dict) -> None:
        """Write all pending lines as the next part."""
        pending = manifest["pending"]
        files = -(-sum(x["bytes"] for x in pending) // self.policy.max_bytes)
        lines = self.spark.read.text([self._pending(x["batch_id"]) for x in pending])
        lines.coalesce(files).write.mode("overwrite").text(f"{self.folder}/part={manifest['parts']}")
        manifest["parts"] += 1
        manifest["done"] = [x["batch_id"] for x in pending]
        manifest["pending"] = []

    def finish(self, batch_id: int | None = None) -> None:
        """When the query has ended: finish what is pending. May be repeated; the query may go on afterwards.

        ``batch_id``: the last batch (default: of the newest manifest).
        """
        if batch_id is None:
            batch_id = self.last_batch()
        if batch_id < 0:
            return
        manifest = self._manifest(batch_id)
        for n in manifest["done"]:
            delete_path(self.spark, self._pending(n))
        if manifest["pending"]:
            delete_path(self.spark, f"{self.folder}/part={manifest['parts']}")
            self._roll(manifest)
            self._save(batch_id, manifest)

    def last_batch(self) -> int:
        """The batch of the newest manifest, -1 if there is none."""
        if not path_exists(self.spark, self.manifests):
            return -1
        names = self.spark.read.format("binaryFile").option("pathGlobFilter", "*.json").load(self.manifests).select("path")
        return max((int(r.path.rsplit("/", 1)[1].removesuffix(".json")) for r in names.collect()), default=-1)  # two at most

    # -- reading ------------------------------------------------------------------

    def lines(self) -> DataFrame:
        """The finished lines."""
        schema = "value string"
        parts = self._manifest(self.last_batch())["parts"]
        if not parts:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).text([f"{self.folder}/part={k}" for k in range(parts)])

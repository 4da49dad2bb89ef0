"""A partitioned message log in files, as a Spark data source: offsets per partition, batch and stream.

Layout: ``<path>/partition=<p>/<first offset>.jsonl``, one segment after the other, one message a line
(``{"offset", "timestamp" in microseconds, "key", "value"}``, the last two in base64 or null), offsets increasing.
Any file system that Arrow reaches may hold it.

``spark.readStream.format("racestream_log")`` gives the columns of the Kafka source. Options: ``path``;
``startingOffsets`` (``earliest``, ``latest`` or JSON ``{"<partition>": offset}``) for a new query, a restarted one
goes on at its checkpointed offsets; ``maxOffsetsPerTrigger`` bounds one micro-batch, shared over the
partitions, and needs ``progressPath`` (see ``LogStreamReader``); with ``availableNow`` a start then takes one such
batch. Every segment that a batch needs is one task, so a partition is read by many.
"""

from __future__ import annotations

import base64
import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

NAME = "racestream_log"
SCHEMA = ("key binary, value binary, topic string, partition int, offset long, timestamp timestamp_ntz, timestampType int")
BATCH_ROWS = 10_000


@dataclass
class Segment(InputPartition):
    """Messages of one file with ``start <= offset < end``."""

    path: str
    partition: int
    start: int
    end: int


class LogFiles:
    """The files below ``path`` (driver and executors)."""

    def __init__(self, path: str, topic: str = ""):
        self.path, self.topic = path.rstrip("/"), topic

    def _fs(self):
        from pyarrow.fs import FileSystem

        uri = self.path if "://" in self.path or self.path.startswith("file:") else f"file://{self.path}"
        return FileSystem.from_uri(uri)

    def segments(self) -> dict[int, list[tuple[int, str]]]:
        """First offset and path of every segment by partition, in order."""
        from pyarrow.fs import FileSelector, FileType

        fs, root = self._fs()
        out: dict[int, list[tuple[int, str]]] = {}
        for info in fs.get_file_info(FileSelector(root, allow_not_found=True, recursive=True)):
            if info.type == FileType.File and info.path.endswith(".jsonl"):
                folder, name = info.path.rsplit("/", 2)[1:]
                out.setdefault(int(folder.removeprefix("partition=")), []).append((int(name.removesuffix(".jsonl")), info.path))
        return {p: sorted(s) for p, s in sorted(out.items())}

    def lines(self, path: str):
        fs, _ = self._fs()
        with fs.open_input_stream(path, compression=None) as f:
            rest = b""
            while chunk := f.read(1 << 20):
                *whole, rest = (rest + chunk).split(b"\n")
                yield from whole
            if rest:
                yield rest

    def ends(self) -> dict[str, int]:
        """The offset after the last message of every partition (reads the last segment of each)."""
        out = {}
        for p, segments in self.segments().items():
            first, path = segments[-1]
            last = first - 1
            for line in self.lines(path):
                last = json.loads(line)["offset"]
            out[str(p)] = last + 1
        return out

    def starts(self) -> dict[str, int]:
        return {str(p): segments[0][0] for p, segments in self.segments().items()}

    def plan(self, start: dict, end: dict) -> list[Segment]:
        out = []
        for p, segments in self.segments().items():
            lo, hi = start.get(str(p), segments[0][0]), end.get(str(p), 0)
            for (first, path), after in zip(segments, [s[0] for s in segments[1:]] + [None]):
                a, b = max(lo, first), hi if after is None else min(hi, after)
                if a < b:
                    out.append(Segment(path, p, a, b))
        return out

    def load(self) -> dict | None:
        """The JSON in the file ``path``, None if there is none."""
        from pyarrow.fs import FileType

        fs, path = self._fs()
        if fs.get_file_info(path).type == FileType.NotFound:
            return None
        return json.loads(b"".join(self.lines(path)))

    def save(self, data: dict) -> None:
        fs, path = self._fs()
        fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
        with fs.open_output_stream(f"{path}.tmp") as out:
            out.write(json.dumps(data).encode())
        fs.move(f"{path}.tmp", path)

    def read(self, part: Segment):
        import pyarrow as pa

        schema = pa.schema([("key", pa.binary()), ("value", pa.binary()), ("topic", pa.string()), ("partition", pa.int32()),
                            ("offset", pa.int64()), ("timestamp", pa.timestamp("us")), ("timestampType", pa.int32())])
        rows: list[tuple] = []

        def batch():
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

        for line in self.lines(part.path):
            m = json.loads(line)
            if m["offset"] >= part.end:
                break
            if m["offset"] >= part.start:
                rows.append((_bytes(m["key"]), _bytes(m["value"]), self.topic, part.partition, m["offset"], m["timestamp"], 0))
                if len(rows) == BATCH_ROWS:
                    yield batch()
                    rows.clear()
        if rows:
            yield batch()


def _bytes(text: str | None) -> bytes | None:
    return None if text is None else base64.b64decode(text)


class LogReader(DataSourceReader):
    """All messages there are when the query is planned."""

    def __init__(self, files: LogFiles):
        self.files = files

    def partitions(self):
        return self.files.plan(self.files.starts(), self.files.ends()) or [Segment("", 0, 0, 0)]

    def read(self, partition):
        if partition.path:
            yield from self.files.read(partition)


class LogStreamReader(DataSourceStreamReader):
    """``progress``: a file with the end of the batch planned last, so that batches are bounded after a restart too.

    Spark logs a batch's offsets before it plans the batch, so the file is never behind them when the next
    end is asked for.
    """

    def __init__(self, files: LogFiles, starting: str, limit: int | None, progress: LogFiles | None = None):
        self.files, self.starting, self.limit, self.progress = files, starting, limit, progress
        self.first: dict | None = None
        self.at: dict | None = progress.load() if progress else None

    def initialOffset(self) -> dict:
        if self.first is None:
            if self.starting == "latest":
                self.first = self.files.ends()
            else:
                self.first = self.files.starts() | ({} if self.starting == "earliest" else json.loads(self.starting))
        return self.first

    def latestOffset(self) -> dict:
        ends = self.files.ends()
        if self.limit is None:
            return ends
        return bounded(self.files.starts() | (self.at or self.initialOffset()), ends, self.limit)

    def partitions(self, start: dict, end: dict):
        self.at = end
        if self.progress:
            self.progress.save(end)
        return self.files.plan(start, end)

    def read(self, partition):
        return self.files.read(partition)

    def commit(self, end: dict) -> None:
        pass


def bounded(start: dict, end: dict, limit: int) -> dict:
    """Offsets at most ``limit`` messages after ``start`` in all, in proportion to what each partition has."""
    behind = {p: max(0, e - start.get(p, e)) for p, e in end.items()}
    total = sum(behind.values())
    if total <= limit:
        return end
    share = {p: n * limit // total for p, n in behind.items()}
    for p in sorted(behind, key=behind.get, reverse=True):  # the rest of the rounding, so that it always goes on
        if sum(share.values()) < limit and share[p] < behind[p]:
            share[p] += 1
    return {p: end[p] - behind[p] + share[p] for p in end}


class LogDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def _files(self) -> LogFiles:
        if not self.options.get("path"):
            raise ValueError("the log source needs the option path")
        return LogFiles(self.options["path"], self.options.get("topic", ""))

    def reader(self, schema) -> LogReader:
        return LogReader(self._files())

    def streamReader(self, schema) -> LogStreamReader:
        limit, progress = self.options.get("maxOffsetsPerTrigger"), self.options.get("progressPath")
        if limit and not progress:
            raise ValueError("maxOffsetsPerTrigger needs progressPath, a file beside the query's checkpoint")
        return LogStreamReader(self._files(), self.options.get("startingOffsets", "earliest"), int(limit) if limit else None,
                               LogFiles(progress) if progress else None)


def read_log(spark: SparkSession, path: str, stream: bool = False, **options) -> DataFrame:
    """The messages of a log (see the module), static or as a stream."""
    spark.dataSource.register(LogDataSource)
    reader = (spark.readStream if stream else spark.read).format(NAME)
    return reader.options(**{k: str(v) for k, v in options.items()}).load(path)


def append_log(messages: DataFrame, path: str, segments: int = 8) -> None:
    """Append messages in the Kafka layout to a log; their offsets must follow those that are there.

    Messages are cut into ``segments`` ranges of (partition, offset); each task writes one file per partition it holds,
    under its final name only when it is whole, so an attempt that is repeated replaces its own.
    """
    files = LogFiles(path)

    def write(batches):
        import pyarrow as pa

        fs, root = files._fs()
        out = name = current = None
        written = 0

        def close():
            out.close()
            fs.move(f"{name}.tmp", name)

        for b in batches:
            for r in b.to_pylist():
                if r["partition"] != current:
                    if out is not None:
                        close()
                    current = r["partition"]
                    fs.create_dir(f"{root}/partition={current}", recursive=True)
                    name = f"{root}/partition={current}/{r['offset']:020d}.jsonl"
                    out = fs.open_output_stream(f"{name}.tmp")
                message = {"offset": r["offset"], "timestamp": r["micros"], **{
                    k: None if r[k] is None else base64.b64encode(r[k]).decode() for k in ("key", "value")}}
                out.write(json.dumps(message).encode() + b"\n")
                written += 1
        if out is not None:
            close()
        yield pa.RecordBatch.from_pydict({"n": [written]}, schema=pa.schema([("n", pa.int64())]))

    # the difference in microseconds, whether the column has a time zone or not
    micros = F.expr("timestampdiff(MICROSECOND, CAST('1970-01-01 00:00:00' AS TIMESTAMP_NTZ), CAST(timestamp AS TIMESTAMP_NTZ))")
    (messages.select("key", "value", "partition", "offset", micros.alias("micros"))
     .repartitionByRange(segments, "partition", "offset").sortWithinPartitions("partition", "offset")
     .mapInArrow(write, "n long").agg(F.sum("n")).collect())

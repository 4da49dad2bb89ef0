"""Session construction and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.errors import PySparkAttributeError, PySparkNotImplementedError
from pyspark.sql import SparkSession


ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "racestream", extra: dict | None = None,
                  rocksdb_state: bool = False) -> SparkSession:
    """A session for local runs and tests (a cluster passes its own).

    ``rocksdb_state`` keeps streaming state (open click windows, neighbour
    state per race and target) in RocksDB instead of the JVM heap, for state
    larger than executor memory. It applies to queries started afresh.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.driver.memory": "16g",
        "spark.checkpoint.compress": "true",
        # checkpoints go when nothing refers to them any more
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    if rocksdb_state:
        conf["spark.sql.streaming.stateStore.providerClass"] = ROCKSDB_PROVIDER
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the operator and every executor can reach it.
    Only when it is unset and everything runs in this process (local runs, tests)
    is a private folder created.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        current = sc.getCheckpointDir()
        if current:
            return current
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="racestream-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root


def _scratch_root(spark: SparkSession) -> str:
    """This application's folder below the shared one."""
    return f"{checkpoint_root(spark).rstrip('/')}/racestream/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh path below the shared folder, unique per call."""
    return "/".join([_scratch_root(spark), *parts, uuid.uuid4().hex])


def clear_scratch(spark: SparkSession) -> None:
    """Delete this application's scratch tables.

    For the end of a job, when its results are written: frames that read a
    scratch table (results of the registered stream queries and of the
    training-data operators) cannot be read afterwards.
    """
    delete_path(spark, _scratch_root(spark))


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path, of any file system that Spark reaches, exists."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def path_size(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a path."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(p).getLength()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Replace a small file: written beside it first, so that a reader never finds half of it."""
    jvm = spark._jvm
    target, fresh = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(f"{path}.new")
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    out = fs.create(fresh, True)
    out.write(bytearray(text.encode()))
    out.close()
    fs.delete(target, False)
    fs.rename(fresh, target)


def read_text(spark: SparkSession, path: str) -> str:
    """The text of a small file."""
    return "\n".join(r.value for r in spark.read.text(path).collect())


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder, if it is there."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def _context(spark: SparkSession):
    """The SparkContext, or None in a Spark Connect session."""
    try:
        return spark.sparkContext
    except (AttributeError, PySparkAttributeError, PySparkNotImplementedError):
        return None


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``racestream`` importable in Python workers (once per context).

    Zips the installed package and adds it with ``addPyFile``, which copies it
    to every executor; a no-op when already shipped.
    """
    import zipfile

    sc = _context(spark)
    if sc is None:  # a Spark Connect session: the package is installed server-side
        return
    key = sc.applicationId
    if key in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    out_dir = tempfile.mkdtemp(prefix="racestream-pkg-")
    zpath = os.path.join(out_dir, "racestream.zip")
    with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as zf:
        for root, _dirs, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    zf.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    sc.addPyFile(zpath)
    _SHIPPED.add(key)


class scoped_conf:
    """Set SQL settings for the duration of a ``with`` block, then restore them.

    Streaming queries snapshot the session settings when they start (the
    number of state partitions, for one, is then fixed in the checkpoint), so
    wrapping ``start()`` is enough.
    """

    def __init__(self, spark: SparkSession, settings: dict):
        self.spark = spark
        self.settings = {k: str(v) for k, v in settings.items() if v is not None}
        self.old: dict = {}

    def __enter__(self):
        for k, v in self.settings.items():
            self.old[k] = self.spark.conf.get(k, None)
            self.spark.conf.set(k, v)
        return self

    def __exit__(self, *exc):
        for k, v in self.old.items():
            if v is None:
                self.spark.conf.unset(k)
            else:
                self.spark.conf.set(k, v)
        return False


def cores(spark: SparkSession) -> int:
    """Cores of the cluster (default parallelism); the shuffle setting when the
    session has no SparkContext (Spark Connect)."""
    sc = _context(spark)
    return sc.defaultParallelism if sc is not None else int(spark.conf.get("spark.sql.shuffle.partitions"))

"""Session construction and the shared scratch location.

Jobs that must cut lineage or stage data write tables under the folder the
cluster names in ``spark.checkpoint.dir``.  A local folder is created only
when that setting is absent (tests, single-machine runs).
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings the library relies on for planning quality, not for correctness.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # target size of coalesced shuffle partitions and of rebalanced write tasks;
    # honour it rather than maximise parallelism (which yields many small files)
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    # No broadcast from file-size guesses; AQE broadcasts a side only after its
    # shuffle has measured it.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.sources.partitionOverwriteMode": "static",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "stratiform", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def _configured_checkpoint_dir(spark: SparkSession) -> str | None:
    try:
        d = spark.sparkContext.getCheckpointDir()
        if d:
            return d
    except Exception:  # Spark Connect has no SparkContext
        pass
    try:
        d = spark.conf.get("spark.checkpoint.dir", None)
        if d:
            return d
    except Exception:
        pass
    try:
        return spark.sparkContext.getConf().get("spark.checkpoint.dir")
    except Exception:
        return None


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for staged tables; falls back to a local one only when unset."""
    d = _configured_checkpoint_dir(spark)
    if d:
        return d.rstrip("/")
    try:
        master = spark.conf.get("spark.master", "local")
    except Exception:
        master = "local"
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="stratiform-ckpt-")
    try:
        spark.sparkContext.setCheckpointDir(local)
        return spark.sparkContext.getCheckpointDir().rstrip("/")
    except Exception:
        return local


_scopes: list[list[str]] = []


def new_scratch_dir(spark: SparkSession, tag: str) -> str:
    """A fresh, never reused sub-folder of the shared scratch root."""
    path = f"{scratch_root(spark)}/{tag}-{uuid.uuid4().hex[:12]}"
    if _scopes:
        _scopes[-1].append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession, remove: Iterable[str | None] = ()) -> Iterator[None]:
    """Delete the scratch folders named inside the block when it ends, and those in ``remove`` when it ends well.

    Frames read from them must have been written elsewhere by then.
    """
    _scopes.append([])
    try:
        yield
        _scopes[-1].extend(p for p in remove if p)
    finally:
        for path in _scopes.pop():
            hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hpath, True)

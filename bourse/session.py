"""Session construction and the shared scratch folder.

Library code never builds its own session: callers pass ``spark``.
``get_session`` exists for tests, ``bench.py`` and the job entry point.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app: str = "bourse") -> SparkSession:
    """Session for tests, bench and the job.

    On a cluster call it without arguments: master, shuffle partitions and
    file split sizes come from the cluster's configuration (with AQE on, a
    high shuffle partition count is coalesced at run time). Tests and the
    bench pass ``master`` and a small ``shuffle_partitions``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = (
        builder
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _checkpoint_root(spark: SparkSession) -> str:
    """The cluster's shared folder: ``spark.checkpoint.dir`` as configured.

    Only when nothing is configured (local tests) do we set one ourselves.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # sessions without a local SparkContext
        sc = None
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        if sc is not None:
            sc.setCheckpointDir(conf)
            return sc.getCheckpointDir()
        return conf
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    # local runs (tests) only: a fresh folder on this machine
    local = tempfile.mkdtemp(prefix="bourse-ckpt-", dir="/tmp")
    if sc is not None:
        sc.setCheckpointDir(local)
        return sc.getCheckpointDir()
    return local


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique folder below the shared checkpoint folder.

    Every call returns a new path, so runs never collide and nothing has to
    be cleared before reuse.
    """
    root = _checkpoint_root(spark).rstrip("/")
    return "/".join([root, *parts, uuid.uuid4().hex])


# Folders staged inside each open ``scratch`` block.
_OPEN: ContextVar[list[str] | None] = ContextVar("scratch", default=None)


def scratch_dir(spark: SparkSession, *parts: str) -> str:
    """``shared_dir`` for a table that only later steps read: an enclosing
    ``scratch`` block removes it."""
    path = shared_dir(spark, *parts)
    held = _OPEN.get()
    if held is not None:
        held.append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Removes, at its end, the tables that were staged inside it. Write what
    the block computes before it ends: frames that still read those tables
    are of no use after it. Without such a block staged tables stay."""
    token = _OPEN.set([])
    try:
        yield
    finally:
        path, conf = spark._jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration()
        for folder in _OPEN.get():
            path(folder).getFileSystem(conf).delete(path(folder), True)
        _OPEN.reset(token)


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a fresh shared folder and read back: cuts the
    lineage and survives lost executors."""
    path = scratch_dir(df.sparkSession, "bourse", "staged", name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme for callers that need a plain path."""
    return path[len("file:"):] if path.startswith("file:") else path

"""Session defaults and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

_private: dict[str, str] = {}

# How a plan cuts its lineage: a frame and a label in, an equal frame out.
Stage = Callable[[DataFrame, str], DataFrame]


def build_session(app_name: str = "frostline", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the engine's defaults: UTC, ANSI, adaptive execution.

    Partition counts are left to the adaptive planner: a generous initial number that
    it coalesces from, so the same job fits a laptop and a large cluster.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # a daily series of many decades still fits a window's row buffer without spilling
        .config("spark.sql.windowExec.buffer.in.memory.threshold", "32768")
    )
    if master:
        builder = builder.master(master)
    if not (master or "").startswith("local"):
        # the stamps a stream remembers while they may still repeat belong on disk, not on the heap
        builder = builder.config("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> None:
    """Day boundaries are UTC everywhere in the engine."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def work_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, for materialised stages and stream checkpoints.

    The cluster names it in ``spark.checkpoint.dir``. Only where that is unset (tests, a
    laptop) a private folder is made, one per application.
    """
    folder = spark.conf.get(CHECKPOINT_CONF, None)
    if not folder:
        context = spark.sparkContext
        if not context.master.startswith("local"):
            raise RuntimeError(f"{CHECKPOINT_CONF} must name a shared folder on a cluster")
        folder = _private.setdefault(context.applicationId, "") or tempfile.mkdtemp(prefix="frostline-")
        _private[context.applicationId] = folder
    return folder.rstrip("/")


_scopes: ContextVar[tuple[list[str], ...]] = ContextVar("scopes", default=())


@contextmanager
def run_scope(spark: SparkSession) -> Iterator[list[str]]:
    """A run whose working folders are removed at its end, also when it fails.

        with run_scope(spark):
            daily_ingest(...).write.parquet(target)

    What the run returns must be consumed inside. Scopes nest; the yielded list names the folders so far.
    """
    folders: list[str] = []
    token = _scopes.set((*_scopes.get(), folders))
    try:
        yield folders
    finally:
        _scopes.reset(token)
        for path in folders:
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def new_folder(spark: SparkSession, label: str) -> str:
    """A path under the working folder that no other run uses; the innermost ``run_scope`` removes it."""
    path = f"{work_dir(spark)}/{label}-{uuid.uuid4().hex}"
    if _scopes.get():
        _scopes.get()[-1].append(path)
    return path


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write a stage to the shared folder and read it back.

    Used where one stage feeds several consumers: it is not repeated, a lost executor costs a
    re-read of files instead of the whole lineage, and the planner knows its true size.
    """
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

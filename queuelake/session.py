"""Session settings the engine relies on, and the shared folder used to cut lineage."""

from __future__ import annotations

import os
import shutil
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path, PurePosixPath
from uuid import uuid4

from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession

_RUNTIME_CONF = {
    # Landed text becomes an instant only through an explicit offset or zone; UTC keeps the rest neutral.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Whole texts go to Python tasks: a batch is bounded by its bytes, not by rows alone.
    "spark.sql.execution.arrow.maxBytesPerBatch": "4194304b",
    # HotSpot never compiles methods above 8000 bytes of bytecode. The wide typed projections here would
    # otherwise be fused into one such method and run interpreted.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # A task that writes into several folders has a file open in each; it sorts its rows only beyond so many.
    "spark.sql.maxConcurrentOutputFileWriters": "128",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings every job here expects to an existing session."""
    for key, value in _RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    _ship(spark)
    return spark


def _ship(spark: SparkSession) -> None:
    """Send this package to the Python tasks, unless their path or working folder has it anyway."""
    root = Path(__file__).resolve().parent.parent
    known = [os.getcwd(), *filter(None, os.environ.get("PYTHONPATH", "").split(os.pathsep))]
    if any(Path(p).resolve() == root for p in known) or spark.conf.get("spark.queuelake.shipped", None):
        return
    folder = Path(SparkFiles.getRootDirectory()) / "shipped"
    folder.mkdir(exist_ok=True)
    spark.sparkContext.addPyFile(shutil.make_archive(str(folder / "queuelake"), "zip", root, "queuelake"))
    spark.conf.set("spark.queuelake.shipped", "true")


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    """A session with the engine's settings; `master` and sizes come from spark-submit on a cluster."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**_RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session.

    The cluster names it in `spark.checkpoint.dir`. Where that is unset, a folder below the session's warehouse
    serves on every master: executors write tables there too.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(configured)
        return configured
    existing = context.getCheckpointDir()
    if existing:
        return existing
    context.setCheckpointDir(f"{spark.conf.get('spark.sql.warehouse.dir')}/_scratch")
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared checkpoint folder for one written intermediate table."""
    base = checkpoint_dir(spark)
    scheme, _, rest = base.rpartition("://")
    joined = str(PurePosixPath(rest) / f"{name}-{uuid4().hex}")
    return f"{scheme}://{joined}" if scheme else joined


_open_scope: ContextVar[list[str] | None] = ContextVar("scratch_scope", default=None)


def stored(frame: DataFrame, name: str) -> DataFrame:
    """The rows, written once to the shared folder and read back: what follows starts from files, not from the lineage."""
    path = scratch_path(frame.sparkSession, name)
    if (scope := _open_scope.get()) is not None:
        scope.append(path)
    frame.write.option("compression", "zstd").parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """What is `stored` inside is deleted at the end: for work whose results are written elsewhere by then."""
    paths: list[str] = []
    token = _open_scope.set(paths)
    try:
        yield
    finally:
        _open_scope.reset(token)
        for path in paths:
            delete(spark, path)


def file_system(spark: SparkSession, location: str):  # noqa: ANN201
    """The file system of a location, and its path there."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(location)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def delete(spark: SparkSession, location: str) -> None:
    files, path = file_system(spark, location)
    files.delete(path, True)

"""Session settings and the one place where intermediate tables are written."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Runtime settings every job relies on. Weeks and ingest dates are UTC days, so the session
# zone is part of the result; the rest lets adaptive execution coalesce, split and re-plan.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

def configure(spark: SparkSession) -> SparkSession:
    for name, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    return spark


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``, or the session's checkpoint directory.

    There is no other place: a folder of one machine would be invisible to the executors.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return folder.rstrip("/")


def scratch_root(spark: SparkSession) -> str:
    return f"{checkpoint_folder(spark)}/advertlake/{spark.conf.get('spark.app.id', 'app')}"


_scope: ContextVar[str | None] = ContextVar("scratch folder of the job at hand", default=None)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below one folder per application, which can be removed once the application ended, or, within a
    ``scratch_scope``, below that one's folder."""
    return f"{_scope.get() or scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def scratch_scope(spark: SparkSession, label: str) -> Iterator[str]:
    """Everything staged inside goes to one folder, which is removed at the end, also of a job that fails.

    Frames that are read later must not rest on it: write them under a path of their own.
    """
    folder = scratch_path(spark, label)
    token = _scope.set(folder)
    try:
        yield folder
    finally:
        _scope.reset(token)
        remove(spark, folder)


def stage(df: DataFrame, label: str, path: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the written table.

    Used where a result feeds several jobs: it is computed once, survives the loss of executors
    and cuts the lineage. Its real size is known afterwards, so that adaptive execution can tell a
    side to broadcast from one to shuffle. Tables with text are packed closer.
    """
    path = path or scratch_path(df.sparkSession, label)
    writer = df.write
    if any(isinstance(f.dataType, T.StringType) for f in df.schema):
        writer = writer.option("compression", "zstd")
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _at(spark: SparkSession, path: str):
    """A path and the file system that holds it."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system holds it; nothing happens if it is gone already."""
    where, files = _at(spark, path)
    files.delete(where, True)


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names of what a folder holds, sorted; a folder that is not there holds nothing."""
    where, files = _at(spark, folder)
    return sorted(f.getPath().getName() for f in files.listStatus(where)) if files.exists(where) else []


def size_of(spark: SparkSession, folder: str) -> int:
    """Bytes of all files below a folder."""
    where, files = _at(spark, folder)
    return files.getContentSummary(where).getLength()


def read_note(spark: SparkSession, path: str) -> str:
    """A small text file, read by the driver."""
    where, files = _at(spark, path)
    stream = files.open(where)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_note(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text file; it appears whole under its name. A file that is there already is an error."""
    where, files = _at(spark, path)
    draft, _ = _at(spark, f"{path}.{uuid.uuid4().hex}.draft")
    stream = files.create(draft, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if files.exists(where) or not files.rename(draft, where):
        files.delete(draft, False)
        raise FileExistsError(path)

"""Landed payloads byte for byte: a store of files by their SHA-256, and the paths that had them.

The text layer keeps a document per line and turns line breaks into blanks; here nothing is changed. A payload that lands
again, under whatever path, is stored once. A run's paths are replaced whole when the run is stored again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from advertlake.operators.windows import keep_first
from advertlake.schema import PARTITIONS
from advertlake.session import stage
from advertlake.sources.layers import write_partitions
from advertlake.sources.store import table_exists

# First two hexadecimal digits of the address: the folder a payload is in.
SHELF = "shelf"
BLOB_SCHEMA = T.StructType(
    [T.StructField("sha256", T.StringType()), T.StructField("content", T.BinaryType()), T.StructField(SHELF, T.StringType())]
)


def _path_schema(partitions: Sequence[str]) -> T.StructType:
    fields = [T.StructField("path", T.StringType()), T.StructField("length", T.LongType()), T.StructField("sha256", T.StringType())]
    return T.StructType(fields + [T.StructField(c, T.StringType()) for c in partitions])


def landed_files(spark: SparkSession, landing: str, partitions: Sequence[str] = PARTITIONS) -> DataFrame:
    """``path, length, content`` and the folder columns of every file below ``landing``; a file is one row.

    Files without a byte are no payloads: the reader passes over them.
    """
    files = spark.read.format("binaryFile").load(landing)
    return files.select("path", "length", "content", *[F.col(c).cast("string").alias(c) for c in partitions])


def store_payloads(
    spark: SparkSession, landing: str, root: str, *, partitions: Sequence[str] = PARTITIONS
) -> int:
    """Store all files below ``landing``; returns how many payloads were new.

    Only the addresses are matched with what is stored, and only new payloads are moved. The paths are written after the
    payloads: a run that is lost in between is repeated, which changes nothing.
    """
    files = landed_files(spark, landing, partitions).withColumn("sha256", F.sha2("content", 256))
    paths = stage(files.select("path", "length", "sha256", *partitions), "payload-paths")
    wanted = paths.select("sha256").distinct()
    if table_exists(spark, f"{root}/blobs"):
        wanted = wanted.join(spark.read.schema(BLOB_SCHEMA).parquet(f"{root}/blobs").select("sha256"), "sha256", "left_anti")
    wanted = stage(wanted, "payload-new")
    n = wanted.count()
    if n:
        new = keep_first(files.select("sha256", "content").join(wanted, "sha256", "left_semi"), ["sha256"], ["sha256"])
        new.withColumn(SHELF, F.substring("sha256", 1, 2)).write.mode("append").partitionBy(SHELF).parquet(f"{root}/blobs")
    write_partitions(paths, f"{root}/paths", partitions=partitions)
    return n


def stored_payloads(spark: SparkSession, root: str, *, partitions: Sequence[str] = PARTITIONS) -> DataFrame:
    """``path, length, sha256, content`` and the folder columns of every stored path.

    A payload that a lost run has left twice counts once.
    """
    paths = spark.read.schema(_path_schema(partitions)).parquet(f"{root}/paths")
    blobs = keep_first(spark.read.schema(BLOB_SCHEMA).parquet(f"{root}/blobs").select("sha256", "content"), ["sha256"], ["sha256"])
    return paths.join(blobs, "sha256").select("path", "length", "sha256", "content", *partitions)


def altered(payloads: DataFrame) -> DataFrame:
    """Stored payloads whose bytes do not have the digest or the length they were stored under: none, unless files broke."""
    return payloads.filter((F.sha2("content", 256) != F.col("sha256")) | (F.octet_length("content") != F.col("length")))

"""Tables in equal key buckets, which are joined on their key without a shuffle.

Every bucket of a folder is one sorted file, and the rows of a key stand in buckets of the same number in all tables that
were written with the same key and number of buckets. The catalog entry of a table, which the planner takes the layout
from, is made again from a note beside the files, so any session can open it.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from advertlake.schema import SNAPSHOT_KEY
from advertlake.session import names_in, read_note, write_note
from advertlake.sources.store import folder_columns, with_folders

NOTE = "layout.json"


def _name(path: str) -> str:
    return f"bucketed_{hashlib.sha256(path.encode()).hexdigest()[:24]}"


def _register(spark: SparkSession, path: str, note: dict) -> str:
    """A catalog entry for the files below ``path``; one that is there already is made anew, with the folders of now."""
    schema, names = T.StructType.fromJson(note["schema"]), folder_columns(note["partitions"])
    columns = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in schema] + [f"`{c}` string" for c in names])
    key = ", ".join(f"`{c}`" for c in note["key"])
    parts = f"PARTITIONED BY ({', '.join(f'`{c}`' for c in names)}) " if names else ""
    spark.sql(f"DROP TABLE IF EXISTS {_name(path)}")
    spark.sql(
        f"CREATE TABLE {_name(path)} ({columns}) USING parquet {parts}"
        f"CLUSTERED BY ({key}) SORTED BY ({key}) INTO {note['buckets']} BUCKETS LOCATION '{path}/data'"
    )
    if names and names_in(spark, f"{path}/data"):
        spark.sql(f"ALTER TABLE {_name(path)} RECOVER PARTITIONS")
    return _name(path)


def save_buckets(
    df: DataFrame,
    path: str,
    *,
    buckets: int,
    key: Sequence[str] = SNAPSHOT_KEY,
    partitions: Sequence[str] = ("ingest_date",),
) -> None:
    """Put ``df`` into the bucketed table at ``path`` in place of the folders that it has rows of.

    The layout is that of the first load. Rows of a bucket meet in one task of the shuffle in front of the writer, so a
    folder gets one file per bucket; ``buckets`` should make that some hundred megabytes. Keys should be unique, so that
    no bucket outgrows the others.
    """
    spark = df.sparkSession
    note = {"schema": json.loads(df.schema.json()), "key": list(key), "partitions": list(partitions), "buckets": buckets}
    if NOTE in names_in(spark, path):
        known = json.loads(read_note(spark, f"{path}/{NOTE}"))
        if {k: known[k] for k in ("key", "partitions", "buckets")} != {k: note[k] for k in ("key", "partitions", "buckets")}:
            raise ValueError(f"{path} has another layout: {known['key']}, {known['buckets']} buckets")
        note = known
    else:
        write_note(spark, f"{path}/{NOTE}", json.dumps(note))
    name = _register(spark, path, note)
    rows = with_folders(df.select(*[f["name"] for f in note["schema"]["fields"]]), partitions)
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        rows.repartition(buckets, *key).write.insertInto(name, overwrite=True)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)


def read_buckets(spark: SparkSession, path: str) -> DataFrame:
    """The table at ``path`` with its layout, as the latest load left it."""
    note = json.loads(read_note(spark, f"{path}/{NOTE}"))
    names = [f["name"] for f in note["schema"]["fields"]]
    return spark.table(_register(spark, path, note)).select(*names)


def join_buckets(left: DataFrame, right: DataFrame, key: Sequence[str] = SNAPSHOT_KEY) -> DataFrame:
    """Inner join on the key of two bucketed tables. The hint keeps the planner from broadcasting a side, which would
    need it whole in every executor; with equal layouts neither side moves."""
    return left.hint("merge").join(right, list(key), "inner")


def shuffles_below_join(df: DataFrame) -> int:
    """Number of exchanges in the plan of ``df`` that stand below a join."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    count, inside = 0, None
    for line in plan.splitlines():
        depth = len(line) - len(line.lstrip(" :+-*()0123456789"))
        if inside is not None and depth <= inside:
            inside = None
        if inside is None and "Join" in line:
            inside = depth
        elif inside is not None and "Exchange" in line:
            count += 1
    return count

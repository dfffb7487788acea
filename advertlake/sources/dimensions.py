"""Stored type-2 dimensions: closed versions in folders by their last day, open ones in hash buckets.

A load reads the open versions of the buckets its keys are in. It writes the buckets whose open versions changed, and
one folder with the versions that ended. All other files stay as they are, so a load costs what changed that day,
however long the history is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from advertlake.operators.history import Dimension, build_dimension, daily_states, versions
from advertlake.session import stage
from advertlake.sources import store

SEGMENT = "segment"
BUCKETS = 64


def _open_segment(key: Sequence[str], buckets: int) -> Column:
    return F.concat(F.lit("open-"), F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("string"))


def _with_segment(rows: DataFrame, key: Sequence[str], buckets: int) -> DataFrame:
    closed = F.concat(F.lit("closed-"), F.col("valid_to").cast("string"))
    return rows.withColumn(SEGMENT, F.when(F.col("valid_to").isNull(), _open_segment(key, buckets)).otherwise(closed))


def stored_schema(delta: DataFrame, dimension: Dimension, at: str = "ingest_date") -> T.StructType:
    return build_dimension(delta.limit(0), dimension, at=at).schema


def read_dimension(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All versions, as the latest complete load left them."""
    return store.read_keyed(spark, path, schema, (SEGMENT,))


def load_snapshots(
    spark: SparkSession,
    path: str,
    delta: DataFrame,
    dimension: Dimension,
    *,
    snapshots: DataFrame | None = None,
    buckets: int = BUCKETS,
    retain: int = 0,
    at: str = "ingest_date",
    last_by: Sequence[str] = ("job_id",),
) -> list[str]:
    """Bring the stored dimension at ``path`` up to a batch of snapshots; returns the segments that were written.

    Afterwards it equals the dimension built from all snapshots. A batch of the last loaded day or of later ones needs
    the stored versions alone: open ones, and those that ended on one of its days, when that day is sent again. An
    earlier day is refused without ``snapshots``, all rows stored so far: with them the versions of the touched keys are
    built again. States of the batch replace those of the same day. A batch without dated, keyed rows changes nothing.
    ``buckets`` is set by the first load.
    """
    key, spec = list(dimension.key), {"key": dimension.key, "tracked": dimension.tracked, "at": at}
    schema = stored_schema(delta, dimension, at)
    before = store.current(spark, path)
    buckets = int(before.about.get("buckets", buckets))
    fresh = stage(daily_states(delta, last_by=last_by, **spec).withColumn(SEGMENT, _open_segment(key, buckets)), f"{dimension.name}-states")
    # one row: the days, and as many buckets as there are
    met = fresh.agg(F.min(at).alias("first"), F.max(at).alias("last"), F.collect_set(SEGMENT).alias("open")).first()
    if met["first"] is None:
        return []
    first, last, until = str(met["first"]), str(met["last"]), before.about.get("until")
    late = until is not None and first < until
    if late and snapshots is None:
        raise ValueError(f"a snapshot lies before {until}: pass the stored snapshots")
    fresh = fresh.drop(SEGMENT)
    touched = fresh.groupBy(*key).agg(F.min(at).alias("_from"))

    ended = {f for f in before.folders if f[0].startswith("closed-") and (late or f[0].removeprefix("closed-") >= first)}
    known = {f: v for f, v in before.folders.items() if f in ended or f[0] in met["open"]}
    stored = _with_segment(store.read_folders(spark, path, schema, known, (SEGMENT,)), key, buckets)
    old = stored.join(touched, key)
    if late:
        past = daily_states(snapshots.join(touched.select(*key), key, "left_semi"), last_by=last_by, **spec)
    else:
        old = old.filter(F.col("valid_to").isNull() | (F.col("valid_to") >= F.col("_from")))
        past = old.select(*key, F.col("valid_from").alias(at), *dimension.tracked)
    states = past.join(fresh.select(*key, at), [*key, at], "left_anti").unionByName(fresh)
    new = _with_segment(versions(states, **spec), key, buckets)

    # versions that stay as they are cancel out
    columns = [*schema.names, SEGMENT]
    both = old.select(*columns, F.lit(-1).alias("_sign")).unionByName(new.select(*columns, F.lit(1).alias("_sign")))
    changes = both.groupBy(*columns).agg(F.sum("_sign").alias("_sign")).filter("_sign <> 0")
    changes = stage(changes, f"{dimension.name}-changes")
    about = {"until": max(last, until or last), "buckets": str(buckets)}
    # as many segments as there are buckets and days
    segments = {(r[SEGMENT],) for r in changes.select(SEGMENT).distinct().collect()}
    there = {f: v for f, v in before.folders.items() if f in segments}
    kept = _with_segment(store.read_folders(spark, path, schema, there, (SEGMENT,)), key, buckets)
    kept = kept.join(changes.filter("_sign < 0").select("version_id", SEGMENT), ["version_id", SEGMENT], "left_anti")
    rows = kept.select(*columns).unionByName(changes.filter("_sign > 0").select(*columns))
    full = {(r[SEGMENT],) for r in rows.select(SEGMENT).distinct().collect()}
    store.write_folders(
        spark, path, rows, full, before, partitions=(SEGMENT,), sort=("valid_from", *key), retain=retain,
        emptied=segments - full, about=about,
    )
    return sorted(f[0] for f in segments)

"""Reports from partial states: a load aggregates its own folders, reading combines what all loads left.

A state is a row per stored folder, week and role class with counts, sums and a quantile sketch, all of which can be
merged. The states of a folder are replaced when the folder is loaded again, so that the reports stay equal to a full
computation, while old folders are never read for them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from advertlake.functions.scalars import period_start
from advertlake.functions.taxonomy import GROUP_COLUMNS
from advertlake.operators.share import GROUP
from advertlake.schema import PARTITIONS
from advertlake.sources import store

COUNTERS = tuple(GROUP_COLUMNS.values())
MEASURES = ("salary_min", "salary_max")
SKETCH_K = 800  # accuracy of the sketches, and what it means: ranks are right within this part of the values
RANK_ERROR = 0.005

STATE_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in (*PARTITIONS, "role_class")]
    + [T.StructField("week", T.DateType())]
    + [T.StructField(c, T.LongType()) for c in ("ads", "ai_ads", *COUNTERS)]
    + [T.StructField(f"{m}_sketch", T.BinaryType()) for m in MEASURES]
)


def partial_states(rows: DataFrame) -> DataFrame:
    """States of enriched rows: one per folder, week and role class, combined before the shuffle."""
    by = list(dict.fromkeys([*PARTITIONS, *GROUP]))
    return rows.groupBy(*by, period_start(F.col("created_at"), "week").cast("date").alias("week")).agg(
        F.count(F.lit(1)).alias("ads"),
        F.count_if(F.col("ai_mentioned")).alias("ai_ads"),
        *[F.sum(c).cast("bigint").alias(c) for c in COUNTERS],
        *[F.kll_sketch_agg_double(F.col(m).cast("double"), F.lit(SKETCH_K)).alias(f"{m}_sketch") for m in MEASURES],
    ).select(*STATE_SCHEMA.names)


def refresh(
    spark: SparkSession, path: str, rows: DataFrame, *, folders: Sequence[tuple[str, str]] = (), retain: int = 0
) -> int:
    """Replace the states of every folder that ``rows`` have rows of; returns the number of folders.

    ``rows`` hold all enriched rows of these folders, as a load leaves them. ``folders`` (date, country) names further
    ones that have no rows any more.
    """
    states = partial_states(rows)
    names = store.folder_columns(PARTITIONS)
    there = store.with_folders(rows.select(*PARTITIONS).distinct(), PARTITIONS)
    full = {tuple(r) for r in there.select(*names).collect()}  # folders, not rows
    emptied = {tuple(f) for f in folders} - full
    before = store.current(spark, path)
    if full or emptied:
        store.write_folders(spark, path, states, full, before, partitions=PARTITIONS, sort=("week",), retain=retain, emptied=emptied)
    return len(full)


def read_states(spark: SparkSession, path: str) -> DataFrame:
    return store.read_keyed(spark, path, STATE_SCHEMA, PARTITIONS)


def weekly_share(states: DataFrame, by: Sequence[str] = GROUP, digits: int = 4) -> DataFrame:
    """``week, *by, total_ads, ai_ads, ai_share`` from the states; undated rows form a null week."""
    counts = states.groupBy("week", *by).agg(F.sum("ads").alias("total_ads"), F.sum("ai_ads").alias("ai_ads"))
    return counts.withColumn("ai_share", F.round(F.col("ai_ads") / F.col("total_ads"), digits))


def group_counts(states: DataFrame, by: Sequence[str] = GROUP) -> DataFrame:
    """Summed counters and the number of adverts per group."""
    sums = [F.sum(column).alias(f"{group}_mentions") for group, column in GROUP_COLUMNS.items()]
    return states.groupBy(*by).agg(*sums, F.sum("ads").alias("ads"))


def quantiles(states: DataFrame, shares: Sequence[float], by: Sequence[str] = GROUP) -> DataFrame:
    """``*by, measure, share, n, value``: quantiles from the merged sketches, ranks right within ``RANK_ERROR``.

    ``n`` is the number of values; a measure without any has no row.
    """
    merged = states.groupBy(*by).agg(*[F.kll_merge_agg_double(f"{m}_sketch", F.lit(SKETCH_K)).alias(m) for m in MEASURES])
    each = [F.struct(F.lit(m).alias("measure"), F.col(m).alias("sketch")) for m in MEASURES]
    long = merged.select(*by, F.inline(F.array(*each))).withColumn("n", F.kll_sketch_get_n_double("sketch")).filter("n > 0")
    asked = [
        F.struct(F.lit(float(x)).alias("share"), F.kll_sketch_get_quantile_double("sketch", F.lit(float(x))).alias("value")) for x in shares
    ]
    return long.select(*by, "measure", "n", F.inline(F.array(*asked))).select(*by, "measure", "share", "n", "value")

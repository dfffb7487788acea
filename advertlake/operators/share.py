"""Mention shares per period and counters per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from advertlake.functions.scalars import period_start, week_label
from advertlake.functions.taxonomy import GROUP_COLUMNS
from advertlake.session import stage

GROUP = ("country", "role_class")


def _require(df: DataFrame, columns: Sequence[str]) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"analysis frame is missing {missing}: run enrich_ads first")


def period_share(
    df: DataFrame,
    *,
    ts: str = "created_at",
    flag: str = "ai_mentioned",
    by: Sequence[str] = GROUP,
    period: str = "week",
    digits: int | None = 4,
    counted: str | None = None,
) -> DataFrame:
    """``(period, *by, total_ads, ai_ads, ai_share)``; undated rows form a null period.

    ``counted`` names a column whose non-null values make the denominator (all rows by default);
    ``digits=None`` leaves the share unrounded. Groups are combined before the shuffle, so large
    groups cost no more than small ones.
    """
    _require(df, [*by, flag, ts])
    share = F.avg(F.coalesce(F.col(flag), F.lit(False)).cast("double"))
    total = F.count(F.lit(1) if counted is None else F.col(counted))
    out = df.groupBy(period_start(F.col(ts), period).alias(period), *by).agg(
        total.alias("total_ads"),
        F.count_if(F.col(flag)).alias("ai_ads"),
        share.alias("ai_share"),
    )
    if counted is not None:
        ratio = F.when(F.col("total_ads") > 0, F.col("ai_ads") / F.col("total_ads"))
        out = out.withColumn("ai_share", ratio)
    return out if digits is None else out.withColumn("ai_share", F.round("ai_share", digits))


def weekly_share(df: DataFrame) -> DataFrame:
    """Unrounded weekly shares over non-null ids, complete groups only, labelled ``Monday/Sunday``."""
    share = period_share(df, digits=None, counted="job_id").dropna(subset=["week", *GROUP])
    return share.withColumn("week", week_label(F.col("week"))).orderBy("week", *GROUP)


def latest_period(share: DataFrame, period: str = "week") -> DataFrame:
    """Rows of the most recent period; a null period is never the latest.

    The series is written once; its largest period is one row, which meets the series in an equi-join,
    so no task gets more of the series than any other.
    """
    series = stage(share, "series")
    latest = series.agg(F.max(period).alias("_latest"))
    return series.join(F.broadcast(latest), F.col(period) == F.col("_latest")).drop("_latest")


def latest_share(df: DataFrame, **options) -> DataFrame:
    return latest_period(period_share(df, **options), options.get("period", "week"))


def group_counts(
    df: DataFrame,
    *,
    by: Sequence[str] = GROUP,
    counters: dict[str, str] | None = None,
) -> DataFrame:
    """Summed counters (``column -> output name``) and the number of adverts per group."""
    named = counters or {c: f"{g}_mentions" for g, c in GROUP_COLUMNS.items()}
    sums = [F.sum(column).alias(output) for column, output in named.items()]
    return df.groupBy(*by).agg(*sums, F.count(F.lit(1)).alias("ads"))


def skill_counts(df: DataFrame) -> DataFrame:
    """Counter sums per complete group under their column names, by country and falling adverts."""
    out = group_counts(df.dropna(subset=list(GROUP)), counters={c: c for c in GROUP_COLUMNS.values()})
    return out.orderBy("country", F.desc("ads"), "role_class")


def flag_rate(df: DataFrame, flag: str = "ai_mentioned") -> DataFrame:
    return df.agg(
        F.count_if(F.col(flag)).alias("flagged"),
        F.count(F.lit(1)).alias("total"),
        F.avg(F.coalesce(F.col(flag), F.lit(False)).cast("double")).alias("rate"),
    )


def window_share(share: DataFrame, by: Sequence[str] = GROUP) -> DataFrame:
    """Share over the whole window (weighted by adverts) and the plain mean of the period shares."""
    return share.groupBy(*by).agg(
        (F.sum("ai_ads") / F.sum("total_ads")).alias("weighted_share"),
        F.avg("ai_share").alias("mean_share"),
        F.sum("total_ads").alias("total_ads"),
    )


def class_gap(
    share: DataFrame,
    *,
    by: Sequence[str] = ("week", "country"),
    pivot: str = "role_class",
    high: str = "technical",
    low: str = "non-technical",
    value: str = "ai_share",
) -> DataFrame:
    """Difference of two classes per period and country, one column per class and ``gap``."""
    wide = share.groupBy(*by).agg(
        F.max(F.when(F.col(pivot) == high, F.col(value))).alias("high_share"),
        F.max(F.when(F.col(pivot) == low, F.col(value))).alias("low_share"),
    )
    return wide.withColumn("gap", F.col("high_share") - F.col("low_share"))


def edge_means(
    share: DataFrame, *, by: Sequence[str] = GROUP, period: str = "week", value: str = "ai_share", k: int = 4
) -> DataFrame:
    """Mean share of the first and the last ``k`` periods of each series."""
    series = share.filter(F.col(period).isNotNull())
    first = F.row_number().over(Window.partitionBy(*by).orderBy(period))
    last = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc(period)))
    return (
        series.withColumns({"_first": first, "_last": last})
        .groupBy(*by)
        .agg(
            F.avg(F.when(F.col("_first") <= k, F.col(value))).alias("early_mean"),
            F.avg(F.when(F.col("_last") <= k, F.col(value))).alias("late_mean"),
        )
        .withColumn("rise", F.col("late_mean") - F.col("early_mean"))
    )

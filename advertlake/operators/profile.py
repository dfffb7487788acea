"""Profiling reports over the clean table: the data behind the exploratory charts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from advertlake.operators.windows import seeded_sample, top_k
from advertlake.schema import SNAPSHOT_KEY
from advertlake.session import stage

ACCURACY = 10000  # of approximate ranks: one in so many
QUARTILES = (0.25, 0.5, 0.75)


def snapshots_per_ad(df: DataFrame, key: Sequence[str] = ("job_id", "country")) -> DataFrame:
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("snapshots"))


def repeated_ads(df: DataFrame, key: Sequence[str] = ("job_id", "country")) -> DataFrame:
    """Adverts seen more than once."""
    return snapshots_per_ad(df, key).filter("snapshots > 1")


def value_counts(df: DataFrame, columns: Sequence[str], k: int | dict[str, int] | None = None) -> DataFrame:
    """``(column, value, n)`` for several columns in one scan, nulls included.

    Every row becomes one short pair per column; pairs combine before the shuffle and the top-k cut
    is applied in each task before the ranking, so a dominant value costs nothing extra.
    """
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    pairs = texts.unpivot([], list(columns), "column", "value")
    counts = pairs.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    if k is None:
        return counts
    order = [F.desc("n"), F.asc_nulls_last("value")]
    if isinstance(k, int):
        return top_k(counts, k, order, by=["column"])
    ranked = top_k(counts, max(k.values()), order, by=["column"])
    rank = F.row_number().over(Window.partitionBy("column").orderBy(*order))
    limits = F.create_map(*[F.lit(x) for pair in k.items() for x in pair])
    return ranked.withColumn("_rank", rank).filter(F.col("_rank") <= limits[F.col("column")]).drop("_rank")


def top_values(df: DataFrame, column: str, k: int) -> DataFrame:
    return value_counts(df, [column], k).select(F.col("value").alias(column), "n")


def rows_of_top_values(df: DataFrame, column: str, k: int) -> DataFrame:
    """Rows whose value is among the ``k`` most frequent; the broadcast side has ``k`` rows."""
    top = top_values(df.filter(F.col(column).isNotNull()), column, k).select(column)
    return df.join(F.broadcast(top), column, "left_semi")


def unpivot_numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, value)`` with missing values left out."""
    numbers = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    pairs = numbers.unpivot([], list(columns), "column", "value")
    return pairs.filter("value is not null and not isnan(value)")


def quantiles(
    df: DataFrame,
    *,
    by: Sequence[str],
    value: str,
    probabilities: Sequence[float] = QUARTILES,
    approximate: bool = False,
    accuracy: int = ACCURACY,
) -> DataFrame:
    """``(*by, q0, q1, …)``: linearly interpolated quantiles per group.

    The exact form sorts instead of collecting a group: equal values are combined, the distinct ones
    are range-partitioned on group and value, and each partition learns from the partition totals
    where its ranks start. A group may own every row; it is still spread over all tasks. The range
    partitions are written once so that both uses see the same boundaries.
    """
    if approximate:
        present = df.filter(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
        found = F.percentile_approx(F.col(value).cast("double"), list(probabilities), accuracy)
        out = present.groupBy(*by).agg(found.alias("_q"))
        return out.select(*by, *[F.col("_q")[i].alias(f"q{i}") for i in range(len(probabilities))])

    return _quantiles_of(counted_ranges(df, by=by, value=value), by, probabilities)


def counted_ranges(df: DataFrame, *, by: Sequence[str], value: str) -> DataFrame:
    """``(*by, _v, _n, _part)``: distinct values with their numbers, in written range partitions."""
    present = df.filter(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    counts = present.groupBy(*by, F.col(value).cast("double").alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    return stage(
        counts.repartitionByRange(*by, "_v").withColumn("_part", F.spark_partition_id()), "quantile-ranges"
    )


def _quantiles_of(ranges: DataFrame, by: Sequence[str], probabilities: Sequence[float]) -> DataFrame:
    in_group = Window.partitionBy(*by)
    parts = (
        ranges.groupBy(*by, "_part")
        .agg(F.sum("_n").alias("_rows"))
        .withColumns(
            {
                "_start": F.sum("_rows").over(in_group.orderBy("_part")) - F.col("_rows"),
                "_total": F.sum("_rows").over(in_group),
            }
        )
    )
    places = [(F.col("_total") - 1) * F.lit(float(p)) for p in probabilities]
    ranks = [rank for place in places for rank in (F.floor(place), F.ceil(place))]
    holds = [(F.col("_start") <= rank) & (rank < F.col("_start") + F.col("_rows")) for rank in ranks]
    # Only the few parts that hold a wanted rank are read on; the others end here.
    wanted = parts.filter(reduce(or_, holds))
    # Null-safe so that a null group keeps its quantiles.
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"p.{c}")) for c in (*by, "_part")]
    placed = ranges.alias("r").join(wanted.alias("p"), same).select("r.*", "p._start", "p._total")
    upto = F.sum("_n").over(Window.partitionBy(*by, "_part").orderBy("_v"))
    ranked = placed.withColumn("_end", F.col("_start") + upto)

    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("_end") - F.col("_n") <= rank) & (rank < F.col("_end")), F.col("_v")))

    ends = {}
    for i, place in enumerate(places):
        ends[f"_lo{i}"] = at(F.floor(place))
        ends[f"_hi{i}"] = at(F.ceil(place))
        ends[f"_at{i}"] = F.max(place - F.floor(place))
    found = ranked.groupBy(*by).agg(*[expr.alias(name) for name, expr in ends.items()])
    between = [
        (F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * F.col(f"_at{i}")).alias(f"q{i}")
        for i in range(len(probabilities))
    ]
    return found.select(*by, *between)


def describe(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """Count, mean, deviation, extremes and quartiles per column, over the non-missing values."""
    values = unpivot_numbers(df, columns)
    moments = values.groupBy("column").agg(
        F.count("value").alias("n"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    found = quantiles(values, by=["column"], value="value", approximate=approximate)
    quartile = found.select(
        "column", F.col("q0").alias("p25"), F.col("q1").alias("p50"), F.col("q2").alias("p75")
    )
    return moments.join(quartile, "column").select(
        "column", "n", "mean", "std", "min", "p25", "p50", "p75", "max"
    )


def salary_complete(df: DataFrame) -> DataFrame:
    return df.dropna(subset=["salary_min", "salary_max"])


def geo_complete(df: DataFrame) -> DataFrame:
    return df.dropna(subset=["latitude", "longitude", "salary_max"])


def histogram(df: DataFrame, value: Column, bins: int = 40) -> DataFrame:
    """``(bin, low, high, n)`` with equal widths; the maximum belongs to the last bin, empty bins count 0."""
    values = df.select(value.cast("double").alias("v")).filter("v is not null and not isnan(v)")
    values = stage(values, "histogram-values")
    bounds = values.agg(F.min("v").alias("lo"), F.max("v").alias("hi")).first()
    lo, hi = (0.0, 1.0) if bounds.lo is None else (bounds.lo, bounds.hi)
    if lo == hi:  # a constant column gets one unit of width around its value
        lo, hi = lo - 0.5, hi + 0.5
    width = (hi - lo) / bins

    def edge(i: Column) -> Column:
        return lo + i * width

    # The quotient may round across an edge; comparing with the edges settles it.
    near = F.least(F.floor((F.col("v") - lo) / (hi - lo) * bins), F.lit(bins - 1))
    at = (
        F.when(F.col("v") < edge(F.col("near")), F.col("near") - 1)
        .when((F.col("v") >= edge(F.col("near") + 1)) & (F.col("near") < bins - 1), F.col("near") + 1)
        .otherwise(F.col("near"))
    )
    counts = (
        values.withColumn("near", near).groupBy((at + 1).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    )
    every = df.sparkSession.range(1, bins + 1, numPartitions=1).select(F.col("id").alias("bin"))
    return every.join(counts, "bin", "left").select(
        "bin",
        edge(F.col("bin") - 1).alias("low"),
        edge(F.col("bin")).alias("high"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def timeline(df: DataFrame, ts: str = "created_at") -> DataFrame:
    """Adverts per UTC day."""
    return (
        df.filter(F.col(ts).isNotNull())
        .groupBy(F.date_trunc("day", ts).cast("date").alias("day"))
        .agg(F.count(F.lit(1)).alias("ads"))
    )


def time_range(df: DataFrame, ts: str = "created_at") -> DataFrame:
    return df.agg(F.min(ts).alias("first"), F.max(ts).alias("last"))


def box_stats(df: DataFrame, *, by: str, value: str, reach: float = 1.5) -> DataFrame:
    """Quartiles and whiskers per group: the outermost values within ``reach`` quartile ranges.

    Both come from one table of distinct values, so the input is read once.
    """
    values = df.select(by, F.col(value).cast("double").alias("_value"))
    ranges = counted_ranges(values, by=[by], value="_value")
    quartile = _quantiles_of(ranges, [by], QUARTILES)
    spread = F.col("q2") - F.col("q0")
    inside = F.col("_v").between(F.col("q0") - reach * spread, F.col("q2") + reach * spread)
    same = F.col(f"c.{by}").eqNullSafe(F.col(f"q.{by}"))
    return (
        ranges.alias("c")
        .join(quartile.alias("q"), same)
        .groupBy(F.col(f"c.{by}").alias(by))
        .agg(
            F.sum("_n").alias("n"),
            F.max("q0").alias("q1"),
            F.max("q1").alias("median"),
            F.max("q2").alias("q3"),
            F.least(F.min(F.when(inside, F.col("_v"))), F.max("q0")).alias("whisker_low"),
            F.greatest(F.max(F.when(inside, F.col("_v"))), F.max("q2")).alias("whisker_high"),
        )
    )


def predicted_salaries(df: DataFrame) -> DataFrame:
    return df.agg(F.count_if("salary_is_predicted").alias("predicted"))


def inverted_salaries(df: DataFrame) -> DataFrame:
    return df.agg(F.count_if(F.col("salary_min") > F.col("salary_max")).alias("inverted"))


def daily_total(history: DataFrame) -> DataFrame:
    """History counts per day over all countries."""
    return history.groupBy("day").agg(F.sum("count").alias("total"))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct().orderBy(column)


def table_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))


def sample_flagged(
    flags: DataFrame, *, n: int = 5, seed: int = 1, snippet: int = 180, flag: str = "ai_mentioned"
) -> DataFrame:
    """A repeatable sample of flagged adverts for review, with the start of their text."""
    picked = seeded_sample(flags.filter(F.col(flag)), n, SNAPSHOT_KEY, seed)
    return picked.select(
        *SNAPSHOT_KEY, "role_class", "title", F.substring("description", 1, snippet).alias("snippet")
    )

"""Linear trend of a share series per group, with interval, p-value and verdict."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from advertlake.functions.stats import two_sided_p

# Weeks per month, normal quantile of the interval, significance level.
WEEKS_PER_MONTH = 4.33
INTERVAL_Z = 1.96
SIGNIFICANCE = 0.05
FLAT_VARIATION = 1e-20


def series_index(series: DataFrame, by: Sequence[str], t: str, output: str = "x") -> DataFrame:
    """Position 0, 1, 2 … of each row along ``t`` within its series; gaps in ``t`` are closed up.

    A series has one row per period, so a group never outgrows the calendar.
    """
    return series.withColumn(output, F.row_number().over(Window.partitionBy(*by).orderBy(t)) - 1)


def verdict(slope: Column, p_value: Column, significance: float = SIGNIFICANCE) -> Column:
    return (
        F.when(p_value > significance, "stable").when(slope > 0, "increasing").otherwise("decreasing")
    )


def linear_trend(
    series: DataFrame,
    *,
    by: Sequence[str] = ("country", "role_class"),
    t: str = "week",
    y: str = "ai_share",
    min_points: int = 3,
    scale: float = WEEKS_PER_MONTH * 100.0,
    significance: float = SIGNIFICANCE,
    calendar_days: int | None = None,
) -> DataFrame:
    """Least-squares line through each series from built-in regression sums; no Python in the tasks.

    ``x`` counts the rows of a series; with ``calendar_days`` (the length of a period) it counts
    periods on the calendar, so gaps stay gaps. Rows without a period, group or value are left out.
    """
    points = series.dropna(subset=[t, y, *by])
    indexed = series_index(points, by, t)
    if calendar_days:
        first = F.min(t).over(Window.partitionBy(*by))
        indexed = indexed.withColumn("x", F.datediff(F.col(t), first) / F.lit(float(calendar_days)))
    value = F.col(y).cast("double")
    sums = indexed.groupBy(*by).agg(
        F.count(F.lit(1)).alias("weeks"),
        F.min(t).alias("first_week"),
        F.max(t).alias("last_week"),
        F.min_by(value, t).alias("_y0"),
        F.max_by(value, t).alias("_yn"),
        F.regr_sxx(value, F.col("x").cast("double")).alias("_sxx"),
        F.regr_syy(value, F.col("x").cast("double")).alias("_syy"),
        F.regr_sxy(value, F.col("x").cast("double")).alias("_sxy"),
    )
    enough = (F.col("weeks") >= min_points) & (F.col("weeks") >= 2)
    flat = F.col("_syy") < FLAT_VARIATION
    residual = F.greatest(F.col("_syy") - F.col("_sxy") * F.col("_sxy") / F.col("_sxx"), F.lit(0.0))
    freedom = F.col("weeks") - 2
    fitted = sums.withColumns(
        {
            "_slope": F.when(enough, F.when(flat, 0.0).otherwise(F.col("_sxy") / F.col("_sxx"))),
            "_se": F.when(
                enough,
                F.when(flat | (freedom == 0), 0.0).otherwise(F.sqrt(residual / (freedom * F.col("_sxx")))),
            ),
        }
    )
    p_value = (
        F.when(flat, 1.0)
        .when(F.col("_se") == 0, 0.0)
        .otherwise(two_sided_p(F.abs(F.col("_slope")) / F.nullif(F.col("_se"), F.lit(0.0)), freedom))
    )
    tested = fitted.withColumns(
        {
            "_p": F.when(enough, p_value),
            "_slope": F.col("_slope") * scale,
            "_se": F.col("_se") * scale,
        }
    )
    margin = F.col("_se") * INTERVAL_Z
    return tested.select(
        *by,
        "weeks",
        "first_week",
        "last_week",
        F.round("_y0", 4).alias("week0_share"),
        F.round("_yn", 4).alias("weekN_share"),
        F.round("_slope", 3).alias("slope_pp_per_month"),
        F.round("_se", 3).alias("se_pp_per_month"),
        F.round("_p", 4).alias("p_value"),
        F.round(F.col("_slope") - margin, 3).alias("ci_low_pp_per_month"),
        F.round(F.col("_slope") + margin, 3).alias("ci_high_pp_per_month"),
        F.when(enough, verdict(F.col("_slope"), F.col("_p"), significance))
        .otherwise("insufficient_data")
        .alias("verdict"),
    )


trend_series = linear_trend


def verdict_tally(trend: DataFrame) -> DataFrame:
    return trend.groupBy("verdict").agg(F.count(F.lit(1)).alias("series"))

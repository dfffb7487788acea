import math
import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from advertlake.functions.stats import two_sided_p
from advertlake.operators import share as A
from advertlake.operators.trend import linear_trend, verdict_tally

FLAGS = "job_id string, country string, role_class string, created_at timestamp, ai_mentioned boolean"


def flags(spark, rows):
    return spark.createDataFrame(rows, FLAGS)


def series(spark, shares, country="gb", start=date(2026, 1, 5)):
    rows = [(start + timedelta(weeks=i), country, "technical", y) for i, y in enumerate(shares)]
    return spark.createDataFrame(rows, "week date, country string, role_class string, ai_share double")


def test_weekly_share_keeps_its_denominator(spark):
    df = flags(spark, [
        ("a", "gb", "technical", datetime(2026, 5, 1), True),
        ("b", "gb", "technical", datetime(2026, 5, 2), False),
        ("c", "gb", "non-technical", datetime(2026, 5, 3), True),
        (None, "gb", "technical", datetime(2026, 5, 3), False),
        ("d", "gb", None, datetime(2026, 5, 3), False),
        ("e", "gb", "technical", None, True),
    ])
    rows = {r.role_class: r for r in A.weekly_share(df).collect()}
    assert set(rows) == {"technical", "non-technical"}
    assert (rows["technical"].total_ads, rows["technical"].ai_ads, rows["technical"].ai_share) == (2, 1, 0.5)
    assert rows["technical"].week == "2026-04-27/2026-05-03"
    view = {(str(r.week), r.role_class): r for r in A.period_share(df).collect()}
    assert view[("2026-04-27", "technical")].ai_share == 0.3333
    assert view[("None", "technical")].total_ads == 1 and ("2026-04-27", None) in view


def test_share_times_total_is_the_count(spark):
    rng = random.Random(1)
    rows = [(str(i), rng.choice("ab"), "technical", datetime(2026, 1, 1) + timedelta(days=rng.randint(0, 90)), rng.random() < 0.3)
            for i in range(2000)]
    for r in A.period_share(flags(spark, rows), digits=None).collect():
        assert math.isclose(r.ai_share * r.total_ads, r.ai_ads, abs_tol=1e-9)


def test_latest_ignores_undated_rows(spark):
    df = flags(spark, [
        ("a", "gb", "technical", datetime(2026, 5, 1), True),
        ("b", "us", "technical", datetime(2026, 5, 12), True),
        ("c", "gb", "technical", datetime(2026, 5, 13), False),
        ("d", "gb", "technical", None, True),
    ])
    assert {(str(r.week), r.country) for r in A.latest_share(df).collect()} == {("2026-05-11", "us"), ("2026-05-11", "gb")}
    assert A.latest_share(df.filter("created_at is null")).count() == 0
    assert A.latest_share(df.limit(0)).count() == 0


def test_missing_columns_are_named(spark):
    with pytest.raises(ValueError, match="role_class"):
        A.period_share(spark.createDataFrame([("a",)], "country string"))


def test_skill_counts_and_rate(spark):
    cols = "country string, role_class string, ai_general_ai long, ai_machine_learning long, ai_ml_tools long, ai_generative_ai long, ai_mentioned boolean"
    df = spark.createDataFrame([("gb", "t", 1, 2, 0, 0, True), ("gb", "t", 1, 0, 0, 3, True), ("gb", None, 9, 0, 0, 0, True), ("us", "n", 0, 0, 0, 0, False)], cols)
    assert [tuple(r) for r in A.skill_counts(df).collect()] == [("gb", "t", 2, 2, 0, 3, 2), ("us", "n", 0, 0, 0, 0, 1)]
    assert A.group_counts(df).count() == 3
    assert tuple(A.flag_rate(df).first()) == (3, 4, 0.75)


def test_window_share_gap_and_edges(spark):
    cols = "week date, country string, role_class string, total_ads long, ai_ads long, ai_share double"
    weeks = [date(2026, 1, 5) + timedelta(weeks=i) for i in range(6)]
    rows = [(w, "gb", "technical", 10 * (i + 1), i, i / 10) for i, w in enumerate(weeks)]
    rows += [(weeks[0], "gb", "non-technical", 4, 1, 0.25)]
    df = spark.createDataFrame(rows, cols)
    total = {r.role_class: r for r in A.window_share(df).collect()}
    assert math.isclose(total["technical"].weighted_share, 15 / 210) and math.isclose(total["technical"].mean_share, 0.25)
    gap = {r.week: r.gap for r in A.class_gap(df).collect()}
    assert gap[weeks[0]] == -0.25 and gap[weeks[1]] is None
    edge = A.edge_means(df.filter("role_class = 'technical'"), k=2).first()
    assert math.isclose(edge.early_mean, 0.05) and math.isclose(edge.late_mean, 0.45) and math.isclose(edge.rise, 0.4)


# -- trend -------------------------------------------------------------------------------------

# Two-sided five-per-cent points of Student's t, from the standard table.
T_TABLE = {1: 12.706204736, 2: 4.302652730, 3: 3.182446305, 4: 2.776445105, 5: 2.570581836, 7: 2.364624252,
           10: 2.228138852, 38: 2.024394164, 120: 1.979930405}


def test_p_value_matches_the_table(spark):
    df = spark.createDataFrame(list(T_TABLE.items()), "nu int, t double")
    for r in df.select("nu", two_sided_p(F.col("t"), F.col("nu")).alias("p")).collect():
        assert abs(r.p - 0.05) < 1e-8, r.nu


def test_p_value_at_the_ends(spark):
    df = spark.createDataFrame([(0.0, 5), (0.0, 6), (1e9, 5), (1e9, 6)], "t double, nu int")
    p = [r.p for r in df.select(two_sided_p(F.col("t"), F.col("nu")).alias("p")).collect()]
    assert p[:2] == [1.0, 1.0] and max(p[2:]) < 1e-12


def test_rising_share_is_increasing(spark):
    out = linear_trend(series(spark, [0.10 + 0.05 * i for i in range(8)])).collect()
    assert len(out) == 1
    r = out[0]
    assert r.verdict == "increasing" and r.slope_pp_per_month == 21.65 and r.ci_low_pp_per_month > 0
    assert (r.weeks, r.week0_share, r.weekN_share, r.p_value) == (8, 0.1, 0.45, 0.0)


def naive_fit(y):
    n = len(y)
    mx, my = (n - 1) / 2, sum(y) / n
    sxx = sum((i - mx) ** 2 for i in range(n))
    slope = sum((i - mx) * (v - my) for i, v in enumerate(y)) / sxx
    residual = sum((v - my - slope * (i - mx)) ** 2 for i, v in enumerate(y))
    return slope * 433, math.sqrt(residual / (n - 2) / sxx) * 433


def test_noisy_series_agree_with_a_plain_fit(spark):
    rng = random.Random(3)
    expected, frames = {}, None
    for k in range(6):
        y = [0.3 + 0.01 * k * i + rng.gauss(0, 0.05) for i in range(4 + 5 * k)]
        expected[f"c{k}"] = naive_fit(y)
        part = series(spark, y, f"c{k}")
        frames = part if frames is None else frames.unionByName(part)
    for r in linear_trend(frames).collect():
        slope, se = expected[r.country]
        assert abs(r.slope_pp_per_month - slope) < 6e-4 and abs(r.se_pp_per_month - se) < 6e-4
        assert abs(r.ci_low_pp_per_month - (slope - 1.96 * se)) < 6e-4
        assert (r.verdict == "stable") == (r.p_value > 0.05)


def test_flat_falling_short_and_gapped_series(spark):
    flat = linear_trend(series(spark, [0.3] * 6)).first()
    assert (flat.slope_pp_per_month, flat.se_pp_per_month, flat.p_value, flat.verdict) == (0.0, 0.0, 1.0, "stable")
    falling = linear_trend(series(spark, [0.9, 0.7, 0.6, 0.3, 0.1])).first()
    assert falling.verdict == "decreasing" and falling.ci_high_pp_per_month < 0
    short = linear_trend(series(spark, [0.1, 0.2])).first()
    assert short.verdict == "insufficient_data" and short.slope_pp_per_month is None and short.weeks == 2
    two = linear_trend(series(spark, [0.1, 0.2]), min_points=2).first()
    assert (two.slope_pp_per_month, two.p_value, two.verdict) == (43.3, 0.0, "increasing")
    gapped = series(spark, [0.1, None, 0.3, 0.5])
    assert linear_trend(gapped).first().slope_pp_per_month == 86.6
    assert linear_trend(gapped, calendar_days=7).first().slope_pp_per_month < 86.6
    assert linear_trend(gapped.limit(0)).count() == 0


def test_verdict_tally(spark):
    both = series(spark, [0.1, 0.2, 0.3, 0.4]).unionByName(series(spark, [0.1], "us"))
    assert {r.verdict: r.series for r in verdict_tally(linear_trend(both)).collect()} == {"increasing": 1, "insufficient_data": 1}

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from advertlake.operators import profile as P
from advertlake.operators.windows import running_total, seeded_sample, top_k

PROBABILITIES = (0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0)


def grouped_values():
    rng = random.Random(11)
    data = {
        "hot": [rng.choice([7.0, rng.uniform(0, 1e6)]) for _ in range(3000)],  # half of it one value
        "wide": [rng.lognormvariate(0, 5) * rng.choice([-1, 1]) for _ in range(1000)],
        "one": [5.0],
        "two": [1.0, 2.0],
        None: [float(i) for i in range(10)],
    }
    return data, [(g, v) for g, values in data.items() for v in values]


def test_exact_quantiles_of_skewed_groups(spark):
    data, rows = grouped_values()
    rows += [("hot", None), ("hot", float("nan")), ("none", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    got = {r.g: list(r)[1:] for r in P.quantiles(df, by=["g"], value="v", probabilities=PROBABILITIES).collect()}
    assert set(got) == set(data)
    for g, values in data.items():
        np.testing.assert_allclose(got[g], np.quantile(values, PROBABILITIES), rtol=1e-12)


def test_approximate_quantiles_are_close(spark):
    df = spark.range(10001).select(F.lit("a").alias("g"), F.col("id").cast("double").alias("v"))
    row = P.quantiles(df, by=["g"], value="v", approximate=True).first()
    assert [abs(q - t) <= 10 for q, t in zip(list(row)[1:], (2500, 5000, 7500))] == [True] * 3


def test_describe(spark):
    rng = random.Random(2)
    rows = [(rng.gauss(50000, 9000), rng.uniform(0, 1) if i % 5 else None) for i in range(500)]
    got = {r["column"]: r for r in P.describe(spark.createDataFrame(rows, "a double, b double"), ["a", "b"]).collect()}
    for name, values in (("a", [r[0] for r in rows]), ("b", [r[1] for r in rows if r[1] is not None])):
        r = got[name]
        assert r.n == len(values) and math.isclose(r.mean, np.mean(values)) and math.isclose(r["std"], np.std(values, ddof=1))
        np.testing.assert_allclose([r["min"], r.p25, r.p50, r.p75, r["max"]], np.quantile(values, [0, 0.25, 0.5, 0.75, 1]))


NORMAL = list(np.random.default_rng(4).normal(size=800))
EDGES = [i / 40 for i in range(41)] * 3


@pytest.mark.parametrize("values", [NORMAL, EDGES, [3.0] * 7, [0.0408559] * 9, [0.0, 1.0], [1.0, 1e9, 2.0]])
def test_histogram(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double")
    rows = P.histogram(df, F.col("v"), 40).orderBy("bin").collect()
    counts, edges = np.histogram(values, bins=40)
    assert [r.n for r in rows] == list(counts)
    np.testing.assert_allclose([r.low for r in rows] + [rows[-1].high], edges, rtol=1e-9, atol=1e-9)


def test_box_stats(spark):
    data, rows = grouped_values()
    got = {r.g: r for r in P.box_stats(spark.createDataFrame(rows, "g string, v double"), by="g", value="v").collect()}
    for g, values in data.items():
        q1, median, q3 = np.quantile(values, [0.25, 0.5, 0.75])
        reach = 1.5 * (q3 - q1)
        inside = [v for v in values if q1 - reach <= v <= q3 + reach]
        r = got[g]
        assert r.n == len(values)
        np.testing.assert_allclose(
            [r.q1, r.median, r.q3, r.whisker_low, r.whisker_high],
            [q1, median, q3, min(*inside, q1), max(*inside, q3)] if len(inside) > 1 else [q1] * 5,
        )


def test_value_counts_with_nulls_and_limits(spark):
    df = spark.createDataFrame([("x", "p"), ("x", None), (None, None), ("y", "q"), ("x", None)], "a string, b string")
    got = {(r["column"], r.value): r.n for r in P.value_counts(df, ["a", "b"]).collect()}
    assert got == {("a", "x"): 3, ("a", "y"): 1, ("a", None): 1, ("b", None): 3, ("b", "p"): 1, ("b", "q"): 1}
    cut = {(r["column"], r.value) for r in P.value_counts(df, ["a", "b"], {"a": 1, "b": 2}).collect()}
    assert cut == {("a", "x"), ("b", None), ("b", "p")}
    assert [tuple(r) for r in P.top_values(df, "a", 2).collect()] == [("x", 3), ("y", 1)]
    assert P.rows_of_top_values(df, "a", 1).count() == 3


def test_small_reports(spark):
    df = spark.createDataFrame(
        [("1", "gb", "2026-01-01", 1.0, 2.0, True, 5.0, 5.0, "2026-01-01 10:00:00"),
         ("1", "gb", "2026-01-02", 3.0, 2.0, False, None, 5.0, "2026-01-01 23:59:59"),
         ("2", "us", "2026-01-02", None, 2.0, True, 1.0, 1.0, None)],
        "job_id string, country string, ingest_date string, salary_min double, salary_max double,"
        " salary_is_predicted boolean, latitude double, longitude double, created string",
    ).withColumn("created_at", F.col("created").cast("timestamp"))
    assert [tuple(r) for r in P.repeated_ads(df).collect()] == [("1", "gb", 2)]
    assert P.predicted_salaries(df).first().predicted == 2 and P.inverted_salaries(df).first().inverted == 1
    assert P.geo_complete(df).count() == 2 and P.salary_complete(df).count() == 2
    assert [(str(r.day), r.ads) for r in P.timeline(df).collect()] == [("2026-01-01", 2)]
    assert [r.ingest_date for r in P.distinct_values(df, "ingest_date").collect()] == ["2026-01-01", "2026-01-02"]
    assert P.table_count(df).first().n == 3
    history = spark.createDataFrame([("gb", "d1", 2), ("us", "d1", 3), ("us", "d2", None)], "country string, day string, count long")
    assert {r.day: r.total for r in P.daily_total(history).collect()} == {"d1": 5, "d2": None}


def test_running_total_over_blocks(spark):
    rng = random.Random(9)
    rows = [("hot" if rng.random() < 0.4 else f"k{rng.randint(0, 3)}", i, rng.randint(0, 9)) for i in range(1, 600)]
    df = spark.createDataFrame(rows, "k string, i int, n long")
    got = {(r.k, r.i): r.t for r in running_total(df, by=["k"], position="i", value="n", output="t", block=16).collect()}
    sums = {}
    for k, i, n in rows:
        sums[k] = sums.get(k, 0) + n
        assert got[(k, i)] == sums[k]


def test_samples_and_top_k_are_repeatable(spark):
    df = spark.range(100).withColumn("g", F.col("id") % 3)
    first = [r.id for r in seeded_sample(df, 5, ["id"], 1).collect()]
    assert first == [r.id for r in seeded_sample(df.repartition(7), 5, ["id"], 1).collect()] and len(first) == 5
    assert first != [r.id for r in seeded_sample(df, 5, ["id"], 2).collect()]
    assert sorted(r.id for r in top_k(df, 1, [F.desc("id")], by=["g"]).collect()) == [97, 98, 99]

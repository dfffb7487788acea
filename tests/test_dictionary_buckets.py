"""Dictionaries as tables beside the pattern, and joins of bucketed tables."""

import random

import pytest
from pyspark.sql import functions as F

from advertlake.functions import text as X
from advertlake.functions.taxonomy import SKILLS
from advertlake.operators.dictionary import dictionary_hits, prepared_dictionary, word_grams
from advertlake.sources import buckets


def test_hits_are_those_of_the_pattern(spark):
    rng = random.Random(3)
    filler = ["and", "learning", "machine", "ai", "deep", "x", "data", "model", "large", "language", "models", "of"]
    words = [t for t in SKILLS.terms] + filler
    seps = [" ", " ", " ", "-", ", ", ". ", "  ", "_", "/"]
    texts = ["".join(rng.choice(words) + rng.choice(seps) for _ in range(rng.randint(0, 60))) for _ in range(150)] + ["", None, "ai", "é ai é", "AI!" * 50]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, raw string").withColumn("norm", X.normalize_text(F.col("raw")))
    want = {r.id: r.hits for r in df.select("id", X.find_terms(F.col("norm")).alias("hits")).collect()}
    found = dictionary_hits(df, prepared_dictionary(SKILLS.table(spark)), key=["id"], text=F.col("norm"))
    got = {}
    for r in sorted(found.collect(), key=lambda r: (r.id, r.at)):
        got.setdefault(r.id, []).append(r.term)
    assert got == {i: h for i, h in want.items() if h} and sum(map(len, want.values())) > 300


def test_a_hundred_thousand_terms(spark):
    terms = spark.range(100_000).select(F.concat(F.lit("t"), F.col("id").cast("string"), F.lit(" u"), (F.col("id") % 7).cast("string")).alias("term"))
    dictionary = prepared_dictionary(terms.unionByName(spark.createDataFrame([("t5 u5 v",), ("-bad",), ("t9 u2",)], "term string")))
    assert dictionary.count() == 100_001
    texts = spark.createDataFrame([(1, "t5 u5 v t99999 u4 t1 u2 t9 u2 t5 u5"), (2, "nothing t 5"), (3, None)], "id int, norm string")
    found = dictionary_hits(texts, dictionary, key=["id"], text=F.col("norm")).orderBy("id", "at").collect()
    assert [tuple(r) for r in found] == [(1, 0, "t5 u5 v"), (1, 3, "t99999 u4"), (1, 7, "t9 u2"), (1, 9, "t5 u5")]
    empty = prepared_dictionary(terms.limit(0))
    assert dictionary_hits(texts, empty, key=["id"], text=F.col("norm")).collect() == []


def test_bucketed_tables_are_joined_without_a_shuffle(spark, folder):
    schema = "job_id string, country string, ingest_date string, n long"
    days = [spark.range(500).selectExpr("cast(id as string) AS job_id", "'gb' AS country", f"'d{k}' AS ingest_date", f"id + {k} AS n") for k in (1, 2)]
    for df in days:
        buckets.save_buckets(df, f"{folder}/left", buckets=4)
        buckets.save_buckets(df.withColumnRenamed("n", "m"), f"{folder}/right", buckets=4)
    again = days[1].withColumn("n", F.lit(-1).cast("long"))
    buckets.save_buckets(again, f"{folder}/left", buckets=4)  # a day that comes again replaces itself
    left, right = (buckets.read_buckets(spark, f"{folder}/{side}") for side in ("left", "right"))
    assert left.columns == [c.split()[0] for c in schema.split(", ")]
    joined = buckets.join_buckets(left, right)
    assert buckets.shuffles_below_join(joined) == 0
    got = joined.groupBy("ingest_date").agg(F.count("*").alias("c"), F.sum("n").alias("n"), F.sum("m").alias("m")).orderBy("ingest_date")
    assert [tuple(r) for r in got.collect()] == [("d1", 500, 125_250, 125_250), ("d2", 500, -500, 125_750)]
    plain = left.hint("merge").join(spark.createDataFrame([("1", "gb", "d1")], "job_id string, country string, ingest_date string"), ["job_id", "country", "ingest_date"])
    assert buckets.shuffles_below_join(plain) > 0
    with pytest.raises(ValueError, match="another layout"):
        buckets.save_buckets(days[0], f"{folder}/left", buckets=8)


def test_runs_begin_with_a_listed_word_and_keep_their_separators(spark):
    texts = spark.createDataFrame([(1, "deep-learning, deep learning deep"), (2, ""), (3, None), (4, "?!")], "k int, t string")
    starts = spark.createDataFrame([("deep",)], "start string")
    got = word_grams(texts, F.col("t"), [1, 2], ["k"], starts).collect()
    assert sorted(map(tuple, got)) == [
        (1, 0, 1, "deep"), (1, 0, 2, "deep-learning"), (1, 2, 1, "deep"), (1, 2, 2, "deep learning"), (1, 4, 1, "deep"),
    ]
    assert word_grams(texts, F.col("t"), [1, 2], ["k"]).count() == 9

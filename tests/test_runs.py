"""Whole runs: the batch job, the streams and the registered queries."""

import os
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from advertlake.operators import share as A
from advertlake.operators.clean import clean_ads
from advertlake.operators.enrich import enrich_ads
from advertlake.operators.quality import QualityError
from advertlake.operators.history import DIMENSIONS
from advertlake.plans import reports
from advertlake.plans.pipeline import HISTORY_MASTER, JOBS_MASTER, REPORT_STATES, run_pipeline
from advertlake.plans.warehouse import WEEKLY_VIEW, Warehouse
from advertlake.schema import CLEAN_SCHEMA, FLAGS_SCHEMA, HISTORY_SCHEMA
from advertlake.session import scratch_root
from advertlake.sources import layers, store
from advertlake.sources.dimensions import read_dimension, stored_schema
from advertlake.streaming import ingest
from checks.compare import rows_of
from tests.adverts import INGESTED_AT, advert, page, raw_frame

TODAY = datetime(2026, 9, 3, 12, tzinfo=timezone.utc)


# Adverts per four weeks, and how many of them ask for a skill: technical ones rise, the others stay.
SERIES = [
    ("2026-01-05", 10, 1, 10, 1),
    ("2026-02-02", 10, 2, 10, 0),
    ("2026-03-02", 10, 3, 10, 1),
    ("2026-03-30", 10, 5, 10, 0),
    ("2026-04-27", 10, 6, 10, 1),
    ("2026-05-25", 10, 8, 10, 1),
]


def corpus(country="gb", repeats=4):
    """The adverts of the series, one a day, and the first few of them sent again at the end."""
    ads = []
    for start, *counts in SERIES:
        for tag, total, asking in (("it-jobs", *counts[:2]), ("music-jobs", *counts[2:])):
            for i in range(total):
                day = datetime.fromisoformat(start) + timedelta(days=2 * i)
                text = "Plays in the evening." + (" Knows PyTorch and ML." if i < asking else "")
                ads.append(advert(id=f"{country}-{len(ads)}", title="Organist", description=text, category={"tag": tag, "label": tag},
                                  created=day.strftime("%Y-%m-%dT%H:%M:%SZ"), salary_min="£30,000" if i == 3 else 25000, salary_max=60000))
    return ads + [dict(ad) for ad in ads[:repeats]]


def land(folder, country, ads, size=50):
    path = f"{folder}/ingest_date=2026-09-03/country={country}"
    os.makedirs(path, exist_ok=True)
    chunks = [ads[i:i + size] for i in range(0, len(ads), size)] + [[]]
    with open(f"{path}/pages.json", "w", encoding="utf-8") as handle:
        handle.write("\n".join(page(i + 1, chunk, len(ads)) for i, chunk in enumerate(chunks)))


def land_history(folder, country):
    path = f"{folder}/ingest_date=2026-09-03/country={country}"
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/history.json", "w", encoding="utf-8") as handle:
        handle.write('{"history":{"2026-01-01":{"count":5},"2026-01-02":{"count":7}}}')


def test_full_run(spark, folder):
    for country in ("gb", "us"):
        land(f"{folder}/search", country, corpus(country))
        land_history(f"{folder}/hist", country)
    land(f"{folder}/search", "fr", corpus("fr"))  # not asked for
    spec = dict(search_path=f"{folder}/search", history_path=f"{folder}/hist", root=f"{folder}/data",
                warehouse_root=f"{folder}/dw", ingested_at=TODAY, now=TODAY)
    result = run_pipeline(spark, export=True, **spec)
    assert result.passed and result.ingest_date == "2026-09-03"
    assert result.raw_jobs == 248 and result.cleaned_rows == 240 == result.analysis_rows
    assert result.cleaning_report.duplicates_removed == 8 and result.history_rows == 4
    assert [(r.country, r.pages, r.fetched, r.complete) for r in result.extraction] == [("gb", 4, 124, True), ("us", 4, 124, True)]
    assert result.exported == ["ai_share_weekly", "ai_share_latest", "ai_skill_counts"]
    master = store.read_keyed(spark, f"{folder}/data/{JOBS_MASTER}", CLEAN_SCHEMA)
    assert master.count() == 240 and master.select("ingest_date").distinct().count() == 1
    history = store.read_keyed(spark, f"{folder}/data/{HISTORY_MASTER}", HISTORY_SCHEMA, ("country",))
    assert history.agg(F.sum("count")).first()[0] == 24
    for path in result.written:
        assert os.path.isdir(path), path
    first = sorted(map(str, master.collect()))

    staged = set(os.listdir(f"{scratch_root(spark)}"))
    category = next(d for d in DIMENSIONS if d.name == "category")
    again = run_pipeline(spark, export=True, dry_run=True, dimensions=[category], report_states=True, **spec)
    # a run leaves its two results, and here the series that its preview reads
    left = {name.split("-")[0] for name in set(os.listdir(scratch_root(spark))) - staged}
    assert left == {"checks", "nulls", "series"}
    tags = read_dimension(spark, f"{folder}/dw/dim_category", stored_schema(master, category))
    assert sorted(r.category_tag for r in tags.filter("is_current").collect()) == ["it-jobs", "music-jobs"]
    states = reports.read_states(spark, f"{folder}/dw/{REPORT_STATES}")
    weekly = Warehouse(spark, f"{folder}/dw").query(f"SELECT * FROM {WEEKLY_VIEW}").select("week", "country", "role_class", "total_ads", "ai_ads", "ai_share")
    assert sorted(map(str, reports.weekly_share(states).collect())) == sorted(map(str, weekly.collect()))
    assert sorted(map(str, store.read_keyed(spark, f"{folder}/data/{JOBS_MASTER}", CLEAN_SCHEMA).collect())) == first
    shape, head = again.previews["ai_skill_counts"]
    assert tuple(shape.first()) == ("ai_skill_counts", 4, 7) and head.count() == 4


def test_the_gate_stops_before_anything_is_loaded(spark, folder):
    land(f"{folder}/search", "gb", [advert(latitude=120)])
    spec = dict(search_path=f"{folder}/search", root=f"{folder}/data", ingested_at=TODAY, now=TODAY)
    with pytest.raises(QualityError, match="coordinates"):
        run_pipeline(spark, fail_on_validation=True, **spec)
    assert not os.path.exists(f"{folder}/data")
    loaded = run_pipeline(spark, **spec)
    assert not loaded.passed and loaded.cleaned_rows == 1
    with pytest.raises(ValueError, match="warehouse_root"):
        run_pipeline(spark, export=True, **spec)


def test_the_encoded_rise_is_recovered(spark):
    clean, _ = clean_ads(raw_frame(spark, corpus()), ingested_at=INGESTED_AT, start_date="2026-01-01")
    weekly = A.period_share(enrich_ads(clean), digits=None)
    technical = A.edge_means(weekly.filter("role_class = 'technical'")).first()
    assert technical.late_mean > technical.early_mean + 0.05
    other = A.edge_means(weekly.filter("role_class <> 'technical'")).first()
    assert other.late_mean < other.early_mean + 0.05


def test_everything_landed_is_loaded_and_losses_are_signalled(spark, folder):
    """More pages than any cap, one of them twice, one broken: all readable adverts arrive, and the checks say what did not."""
    path = f"{folder}/search/ingest_date=2026-09-03/country=gb"
    os.makedirs(path)
    lines = [page(i, [advert(id=f"{i}-{j}") for j in range(2)], 260) for i in range(1, 131)]
    lines[6] = '{"page": 7, "results": "oops"}'
    with open(f"{path}/pages.json", "w", encoding="utf-8") as handle:
        handle.write("\n".join([*lines, lines[3], "no document"]))
    spec = dict(search_path=f"{folder}/search", ingested_at=TODAY, now=TODAY)
    result = run_pipeline(spark, root=f"{folder}/data", **spec)
    assert result.raw_jobs == 258 and not result.passed
    found = {r.name: (r.status, r.detail.split()[0]) for r in result.checks.collect()}
    assert found["unreadable_pages"] == ("FAIL", "2") and found["incomplete_runs"] == ("WARN", "1")
    assert [(r.pages, r.fetched, r.complete) for r in result.extraction] == [(129, 258, False)]
    with pytest.raises(QualityError, match="unreadable_pages"):
        run_pipeline(spark, root=f"{folder}/other", fail_on_validation=True, **spec)
    capped = run_pipeline(spark, root=f"{folder}/capped", max_pages=5, **spec)
    assert capped.raw_jobs == 10


# -- streams -----------------------------------------------------------------------------------


def snapshots(spark, day, n, title):
    df = spark.range(n).select(F.col("id").cast("string").alias("job_id"), F.lit("gb").alias("country"),
                               F.lit(day).alias("ingest_date"), F.lit(title).alias("title"),
                               F.lit(f"{day} 12:00:00").cast("timestamp").alias("ingested_at"),
                               F.expr("timestampadd(DAY, cast(id % 40 as int), timestamp'2026-06-01 09:00:00')").alias("created_at"))
    from advertlake.schema import enforce_schema

    return enforce_schema(df, CLEAN_SCHEMA)


def test_deltas_stream_into_the_table(spark, folder):
    def step():
        deltas = ingest.read_deltas(spark, f"{folder}/{layers.CLEAN_JOBS}", files_per_batch=1)
        ingest.stream_into_table(deltas, f"{folder}/table", f"{folder}/ck").awaitTermination()
        return store.read_keyed(spark, f"{folder}/table", CLEAN_SCHEMA)

    layers.write_clean_delta(snapshots(spark, "2026-09-01", 5, "a"), folder)
    assert step().count() == 5
    layers.write_clean_delta(snapshots(spark, "2026-09-02", 6, "b"), folder)
    assert step().count() == 11
    layers.write_clean_delta(snapshots(spark, "2026-09-01", 5, "sent again"), folder)
    table = step()
    assert table.count() == 11 and table.filter("title = 'sent again'").count() == 5
    assert step().count() == 11  # nothing new


def test_stream_dedup_keeps_one_row_per_snapshot(spark, folder):
    day = snapshots(spark, "2026-09-01", 50, "a")
    for _ in range(3):
        day.write.mode("append").parquet(f"{folder}/in")
    arrivals = ingest.read_deltas(spark, f"{folder}/in", files_per_batch=1)
    ingest.append_rows(ingest.distinct_snapshots(arrivals), f"{folder}/out", f"{folder}/ck").awaitTermination()
    got = spark.read.schema(CLEAN_SCHEMA).parquet(f"{folder}/out")
    assert got.count() == 50 == got.select("job_id").distinct().count()


def test_streamed_weeks_equal_the_batch(spark, folder):
    clean, _ = clean_ads(raw_frame(spark, corpus()), ingested_at=INGESTED_AT)
    flags = enrich_ads(clean).cache()
    for part in flags.randomSplit([0.3, 0.3, 0.4], 5):
        part.coalesce(1).write.mode("append").parquet(f"{folder}/in")
    arrivals = ingest.read_deltas(spark, f"{folder}/in", FLAGS_SCHEMA, files_per_batch=1)
    share = ingest.weekly_share_stream(arrivals, delay="400 days")
    ingest.append_updates(share, f"{folder}/updates", f"{folder}/ck").awaitTermination()
    got = ingest.latest_updates(spark, f"{folder}/updates", share.schema, key=["week", "country", "role_class"])
    want = A.period_share(flags).select(*got.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    flags.unpersist()


# -- registered queries ------------------------------------------------------------------------

SMALL = "/root/testdata/sf0.001"
SPOT_CHECKS = [
    "clean_ads", "cleaning_report", "enriched_ads", "weekly_share", "share_trend", "quality_checks", "value_counts",
    "salary_describe", "salary_box_by_category", "search_pages", "page_cutoff", "history_normalised", "term_hits_pages",
    "dimension_category_incremental", "snapshot_fact", "jobs_master", "stream_weekly_share", "cells",
]


def test_entry_and_registry(spark):
    names = set(entry.queries())
    assert set(entry.oracle_sql()) <= names and len(names) > 100
    df = entry.entry(spark)
    assert df.columns == ["week", "country", "role_class", "total_ads", "ai_ads", "ai_share"] and df.count() > 0


@pytest.mark.parametrize("name", SPOT_CHECKS)
def test_query_equals_its_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for file in os.listdir(SMALL):
        con.execute(f"CREATE VIEW {file[:-8]} AS SELECT * FROM '{SMALL}/{file}'")
    got = entry.queries()[name](spark, SMALL).toPandas()
    want = con.execute(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows_of(got) == rows_of(want)


def test_running_counts_are_dealt_to_a_task_per_core(spark, folder):
    day = "timestamp'2026-03-0{} 10:00:00' AS created_at, 'gb' AS country, 'technical' AS role_class, true AS ai_mentioned"
    schema = spark.sql("SELECT " + day.format(1)).schema
    name, before = "spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set(name, "50")
    try:
        for n, tasks in ((1, None), (2, 3)):
            spark.sql("SELECT " + day.format(n)).write.mode("append").parquet(f"{folder}/landing")
            share = ingest.weekly_share_stream(ingest.read_deltas(spark, f"{folder}/landing", schema), delay="400 days")
            ingest.append_updates(share, f"{folder}/updates", f"{folder}/ck", tasks=tasks).awaitTermination()
            assert spark.conf.get(name) == "50"
            # a stream that goes on keeps the number it began with
            dealt = [p for p in os.listdir(f"{folder}/ck/state/0") if p.isdigit()]
            assert len(dealt) == spark.sparkContext.defaultParallelism
        ingest.append_updates(share, f"{folder}/other", f"{folder}/ck2", tasks=3).awaitTermination()
        assert len([p for p in os.listdir(f"{folder}/ck2/state/0") if p.isdigit()]) == 3
        got = ingest.latest_updates(spark, f"{folder}/updates", share.schema, key=["week", "country", "role_class"]).collect()
        assert sorted((str(r["week"]), r["total_ads"]) for r in got) == [("2026-02-23", 1), ("2026-03-02", 1)]
    finally:
        spark.conf.set(name, before)

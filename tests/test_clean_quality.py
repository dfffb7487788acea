from datetime import datetime

import pytest
from pyspark.sql import functions as F

from advertlake.operators.clean import clean_ads
from advertlake.operators.enrich import enrich_ads
from advertlake.operators.quality import QualityError, assert_quality, quality_checks, quality_passed
from advertlake.schema import CLEAN_SCHEMA, FLAGS_SCHEMA, enforce_schema
from tests.adverts import INGESTED_AT, START_DATE, advert, raw_frame


def run(spark, ads, **options):
    options = {"ingested_at": INGESTED_AT, "start_date": START_DATE, **options}
    clean, report = clean_ads(raw_frame(spark, ads, options.pop("country", "gb")), **options)
    return clean, report.first().asDict()


def test_the_first_copy_stays_and_fields_get_their_types(spark):
    ads = [
        advert(title="  Lock\u00a0Keeper "),
        advert(id="B-7", salary_max="€48,250.5", contract_time="Permanent", longitude="7.5"),
        advert(title="sent again", salary_min=1),
        advert(id=300, company=None, category={"tag": " "}, salary_is_predicted="0", contract_type=None),
        advert(title="and again"),
    ]
    clean, report = run(spark, ads)
    assert [(f.name, f.dataType) for f in clean.schema] == [(f.name, f.dataType) for f in CLEAN_SCHEMA]
    assert (report["input_rows"], report["duplicates_removed"], report["output_rows"]) == (5, 2, 3)
    rows = {r.job_id: r for r in clean.collect()}
    first, second, third = rows["A-100"], rows["B-7"], rows["300"]
    assert (first.title, first.salary_min, first.contract_type, first.salary_is_predicted) == ("Lock Keeper", 41000.0, "part_time", True)
    assert first.created_at == datetime(2026, 5, 4, 7, 15) and first.ingest_date == INGESTED_AT[:10]
    assert (second.salary_max, second.contract_time, second.longitude) == (48250.5, "permanent", 7.5)
    assert (third.company_name, third.category_tag, third.salary_is_predicted, third.contract_type) == (None, None, False, None)


def test_dedup_computes_the_rows_once_and_moves_none(spark):
    leaves = lambda df: df._jdf.queryExecution().optimizedPlan().collectLeaves().size()
    single, _ = run(spark, [advert(), advert(id="2")])
    assert "Window" not in plan_of(single) and leaves(single) == 1
    twice, _ = run(spark, [advert(), advert(id="2"), advert(title="again")])
    # the adverts, and the short list of repeated keys
    assert "Window" not in plan_of(twice) and leaves(twice) == 2
    assert {(r.job_id, r.title) for r in twice.collect()} == {("A-100", "Backend Programmer"), ("2", "Backend Programmer")}


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_nan_is_missing_to_the_checks(spark):
    clean, _ = run(spark, [advert(), advert(id="2")])
    odd = clean.withColumns({c: F.lit(float("nan")) for c in ("latitude", "longitude", "salary_min")})
    checks, nulls = quality_checks(odd, now="2026-09-03 12:00:00")
    assert {r.name: r.status for r in checks.collect()}["coordinates"] == "PASS"
    assert {r.name: r.status for r in checks.collect()}["salary_order"] == "PASS"
    assert {r["column"]: r.null_rate for r in nulls.collect()}["latitude"] == 1.0


def test_checks_read_their_table_once(spark, folder):
    clean, _ = run(spark, [advert(), advert(id="2")])
    clean.write.parquet(folder + "/t")
    checks, _ = quality_checks(spark.read.parquet(folder + "/t"), now="2026-09-03 12:00:00")
    assert plan_of(checks).count("Relation [") == 1


def test_salary_pairs(spark):
    clean, _ = run(spark, [advert(salary_min=81000, salary_max=64000), advert(id="b", salary_max=None), advert(id="c", salary_min=None)])
    rows = {r.job_id: (r.salary_min, r.salary_max) for r in clean.collect()}
    assert rows == {"A-100": (64000.0, 81000.0), "b": (41000.0, 41000.0), "c": (52000.0, 52000.0)}


def test_window_and_missing_ids(spark):
    ads = [advert(), advert(id="old", created="2025-12-31T23:00:00Z"), advert(id="undated", created=None),
           advert(id=None), advert(id="  "), advert(id="edge", created="2026-01-01T00:00:00Z")]
    clean, report = run(spark, ads)
    assert report == {
        "input_rows": 6, "missing_job_id_removed": 2, "duplicates_removed": 0,
        "outside_date_window_removed": 1, "output_rows": 3,
    }
    assert {r.job_id for r in clean.collect()} == {"A-100", "undated", "edge"}
    _, unlimited = run(spark, ads, start_date=None)
    assert unlimited["outside_date_window_removed"] == 0 and unlimited["output_rows"] == 4


def test_dedup_precedes_the_window(spark):
    # The first copy is outside the window, so both copies go: one as a duplicate, one by date.
    clean, report = run(spark, [advert(created="2025-01-01T00:00:00Z"), advert()])
    assert clean.count() == 0
    assert (report["duplicates_removed"], report["outside_date_window_removed"]) == (1, 1)


def test_empty_input(spark):
    raw = raw_frame(spark, [advert()]).limit(0)
    clean, report = clean_ads(raw, ingested_at=INGESTED_AT, start_date=START_DATE)
    assert clean.count() == 0 and clean.columns == CLEAN_SCHEMA.names
    assert report.first().asDict() == {
        "input_rows": 0, "missing_job_id_removed": 0, "duplicates_removed": 0,
        "outside_date_window_removed": 0, "output_rows": 0,
    }


def test_sparse_and_odd_feeds(spark):
    raw = spark.createDataFrame([("1", "us", 1, 0)], "id string, country string, page int, pos int")
    row = clean_ads(raw, ingested_at=INGESTED_AT, source="feed")[0].first()
    assert (row.job_id, row.salary_currency, row.title, row.source) == ("1", "GBP", None, "feed")
    clean, _ = run(spark, [advert(location={"area": ["UK", "Yorkshire"]}, category=None, salary_is_predicted=True)], country="fr")
    row = clean.first()
    assert (row.location_area_1, row.location_area_2, row.category_tag) == ("Yorkshire", None, None)
    assert row.salary_currency == "EUR" and row.salary_is_predicted is True


def test_a_hot_key_is_cut_before_the_shuffle(spark):
    hot = spark.range(0, 3000, 1, 4).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("id"),
        F.lit("gb").alias("country"), F.col("id").cast("int").alias("page"), F.lit(0).alias("pos"),
        F.col("id").cast("string").alias("title"),
    )
    clean, report = clean_ads(hot, ingested_at=INGESTED_AT)
    plan = clean._jdf.queryExecution().executedPlan().toString()
    # the rows stay where they are: one list of repeated keys meets them
    assert "Window" not in plan and "BroadcastHashJoin" in plan and plan.count("Exchange") == plan.count("BroadcastExchange")
    assert clean.filter("job_id = 'hot'").first().title == "0"
    assert report.first().duplicates_removed == 999 and report.first().output_rows == 2001


# -- quality -----------------------------------------------------------------------------------


def battery(df, **options):
    checks, nulls = quality_checks(df, now="2026-09-03 12:00:00", start_date=START_DATE, **options)
    return checks, {r.name: (r.status, r.detail) for r in checks.collect()}, nulls


def test_a_clean_batch_passes(spark):
    clean, _ = run(spark, [advert(), advert(id="2")])
    checks, status, nulls = battery(clean)
    assert {s for s, _ in status.values()} == {"PASS"} and len(status) == 9
    assert status["schema_columns"][1] == "25 columns; missing=none"
    assert quality_passed(checks).first().passed
    assert_quality(checks)
    rates = {r["column"]: r.null_rate for r in nulls.collect()}
    assert len(rates) == 25 and rates["title"] == 0.0 and rates["job_id"] == 0.0


def test_every_status_can_be_provoked(spark):
    clean, _ = run(spark, [advert(), advert(id="2")])
    base = clean.filter("job_id = '2'")
    broken = clean.unionByName(base).unionByName(
        base.withColumns({
            "job_id": F.lit(None).cast("string"), "title": F.lit(None).cast("string"),
            "created_at": F.lit("2027-01-01").cast("timestamp"), "salary_min": F.lit(9e9),
            "latitude": F.lit(91.0), "longitude": F.lit(-181.0),
        })
    ).unionByName(base.withColumns({"job_id": F.lit("3"), "created_at": F.lit("2025-01-01").cast("timestamp")}))
    checks, status, _ = battery(broken.drop("adref"))
    assert status["schema_columns"] == ("FAIL", "24 columns; missing=['adref']")
    assert status["duplicate_snapshots"] == ("FAIL", "1 duplicate (job_id, country, ingest_date) rows")
    assert status["missing_job_id"] == ("FAIL", "1 rows without a job_id")
    assert status["created_window"] == ("WARN", "1 rows created before 2026-01-01")
    assert status["future_dates"] == ("WARN", "1 rows created in the future")
    assert status["salary_order"] == ("WARN", "1 rows where salary_min > salary_max")
    assert status["coordinates"] == ("FAIL", "1 bad latitudes, 1 bad longitudes")
    assert status["null_title"] == ("WARN", "null rate 20.0%")
    assert status["null_created_at"] == ("PASS", "null rate 0.0%")
    assert not quality_passed(checks).first().passed
    with pytest.raises(QualityError, match="coordinates"):
        assert_quality(checks)


def test_an_empty_batch_does_not_pass(spark):
    clean, _ = run(spark, [advert()])
    checks, status, nulls = battery(clean.limit(0))
    assert list(status) == ["schema_columns", "row_count"] and status["row_count"][0] == "WARN"
    assert not quality_passed(checks).first().passed
    assert nulls.count() == 0
    with pytest.raises(QualityError):
        assert_quality(checks)


def test_without_a_start_date_there_is_no_window_check(spark):
    clean, _ = run(spark, [advert()])
    checks, _ = quality_checks(clean, now="2026-09-03")
    assert "created_window" not in {r.name for r in checks.collect()}


def test_enrich_and_enforce(spark):
    clean, _ = run(spark, [advert(description="Deep learning, AI and PyTorch"), advert(id="2", title=None, description=None)])
    flags = enrich_ads(clean)
    assert flags.columns == FLAGS_SCHEMA.names
    assert [f.dataType for f in flags.schema] == [f.dataType for f in FLAGS_SCHEMA]
    rows = {r.job_id: r for r in flags.collect()}
    row = rows["A-100"]
    assert (row.ai_total_mentions, row.ai_general_ai, row.ai_machine_learning, row.ai_ml_tools, row.ai_generative_ai) == (3, 1, 1, 1, 0)
    assert (row.role_class, row.taxonomy_version, row.role_classifier_version) == ("technical", "1.0", "1.0")
    assert not rows["2"].ai_mentioned
    shaped = enforce_schema(spark.createDataFrame([("7", "x")], "job_id string, salary_min string"), CLEAN_SCHEMA)
    assert shaped.columns == CLEAN_SCHEMA.names and shaped.first().salary_min is None

import json
import os

import pytest
from pyspark.sql import functions as F

from advertlake.operators.clean import clean_ads
from advertlake.schema import CLEAN_SCHEMA, FLAGS_SCHEMA
from advertlake.sources import layers, pages
from tests.adverts import INGESTED_AT, advert, page, raw_frame


def landing(spark, folder, documents, country="gb", name="pages.json"):
    path = f"{folder}/ingest_date=2026-09-03/country={country}"
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/{name}", "w", encoding="utf-8") as handle:
        handle.write("\n".join(documents))
    return pages.read_payloads(spark, folder)


def sized(number, n, count):
    return page(number, [advert(id=f"{number}-{i}") for i in range(n)], count)


def test_pages_keep_order_and_country(spark, folder):
    ads = [advert(id=1, country="zz"), advert(id="2", salary_is_predicted=False, salary_min=1.5)]
    payloads = landing(spark, folder, [page(2, [advert(id="3")]), page(1, ads)])
    rows = pages.explode_ads(pages.parse_pages(payloads)).orderBy("page", "pos").collect()
    assert [(r.id, r.page, r.pos, r.country, r.ingest_date) for r in rows] == [
        ("1", 1, 0, "gb", "2026-09-03"), ("2", 1, 1, "gb", "2026-09-03"), ("3", 2, 0, "gb", "2026-09-03"),
    ]
    assert (rows[1].salary_is_predicted, rows[1].salary_min, rows[0].salary_min) == ("false", "1.5", "41000")


def test_archives_wrap_pages(spark, folder):
    whole = json.dumps({"responses": [json.loads(page(1, [advert()])), json.loads(page(2, [advert(id="b"), advert(id="c")]))]}, indent=2)
    lines = pages.read_documents(landing(spark, folder, [whole]))
    assert lines.filter("reason is null").count() == 0 and lines.count() > 10
    payloads = pages.read_payloads(spark, folder, whole_files=True)
    rows = pages.explode_ads(pages.parse_pages(payloads)).orderBy("page", "pos").collect()
    assert [(r.id, r.page) for r in rows] == [("A-100", 1), ("b", 2), ("c", 2)]
    # written to the raw layer, the indented document is one line and the same
    layers.write_payloads(payloads, f"{folder}-raw")
    back = pages.explode_ads(pages.parse_pages(pages.read_payloads(spark, f"{folder}-raw")))
    assert sorted(r.id for r in back.collect()) == ["A-100", "b", "c"]


def test_what_is_no_page_is_told_apart(spark, folder):
    good = json.loads(page(1, [advert()]))
    archive = {"responses": [good, {"page": 2, "results": "oops"}, {"results": [advert(id="c")]}, {"error": "late"}]}
    lines = [json.dumps(archive), '{"error": "none"}', "{broken", '{"results": []}', '{"responses": []}', '{"responses": "x"}']
    found = pages.read_documents(landing(spark, folder, lines)).collect()
    kept = [(r.page, len(r.results)) for r in found if r.reason is None]
    assert sorted(kept) == [(1, 1), (3, 1)]
    lost = sorted((r.reason, r["at"]) for r in found if r.reason)
    assert len(lost) == 6 and ("no results", 1) in lost and ("no results", 3) in lost
    counted = {r.reason: r.n for r in pages.reject_counts(pages.rejects(pages.read_documents(landing(spark, folder, lines)))).collect()}
    assert counted["no page number"] == 1 and sum(counted.values()) == 6


def test_page_numbers_come_from_a_stated_column(spark, folder):
    bodies = [json.dumps({"count": 4, "results": [advert(id=str(i))]}) for i in range(8)]
    payloads = landing(spark, folder, bodies)
    assert pages.parse_pages(payloads).count() == 0  # without a number nothing says where a page belongs
    numbered = payloads.withColumn("file_no", F.regexp_extract("value", '"id": "([0-9])"', 1).cast("int") + 1)
    kept = pages.cut_pages(pages.parse_pages(numbered, page_number="file_no"))
    assert sorted(r.page for r in kept.collect()) == [1, 2, 3, 4]


def test_a_page_that_landed_twice_counts_once(spark, folder):
    lines = [sized(1, 2, 6), sized(1, 2, 6), sized(2, 2, 6), sized(3, 1, 6), sized(3, 2, 6)]
    parsed = pages.parse_pages(landing(spark, folder, lines))
    kept = pages.cut_pages(parsed)
    assert sorted((r.page, len(r.results)) for r in kept.collect()) == [(1, 2), (2, 2), (3, 2)]
    audit = pages.page_audit(parsed).first()
    assert (audit.pages, audit.fetched, audit.advertised, audit.complete) == (3, 6, 6, True)
    counters = pages.extraction_counters(parsed).first()
    assert (counters.pages, counters.ads) == (3, 6)


def test_odd_histories_are_rejected(spark):
    texts = ['{"history":{"2026-01-01":{"count":5}}}', "{cut", '{"mean":1}', '{"history":[["2026-01-02",3],7,[null,1]]}', '{"history":{}}']
    payloads = spark.createDataFrame([(t, "gb") for t in texts], "value string, country string")
    assert sorted((r.day, r["count"]) for r in pages.normalise_history(payloads).collect()) == [("2026-01-01", 5), ("2026-01-02", 3)]
    assert sorted(r.reason for r in pages.history_rejects(payloads).collect()) == ["no day", "no day", "no history", "not a document"]


def test_csv_keeps_blanks_and_empty_texts(spark, folder):
    rows = [("1", "  both  "), ("2", ""), ("3", None), ("4", 'a "b", c\nd')]
    df = spark.createDataFrame(rows, "job_id string, title string")
    layers.write_csv(df, f"{folder}/csv")
    assert sorted(map(tuple, layers.read_csv(spark, f"{folder}/csv", df.schema).collect())) == rows


def test_a_field_of_the_wrong_type_does_not_lose_its_page(spark, folder):
    odd = [advert(), advert(id="2", company="Acme", salary_min={"from": 1}), advert(id="3")]
    rows = pages.explode_ads(pages.parse_pages(landing(spark, folder, [page(1, odd)]))).collect()
    assert {r.id for r in rows} == {"A-100", "2", "3"}


@pytest.mark.parametrize(
    ("sizes", "count", "cap", "kept", "fetched", "complete"),
    [
        ([3, 3, 2, 0, 5], 8, None, 3, 8, True),  # advertised number reached
        ([3, 3, 0, 5], 0, None, 3, 6, True),  # nothing advertised: stops at the empty page
        ([3, 0, 5], 9, None, 2, 3, False),  # runs dry before the number
        ([3, 3, 3], 9, 2, 2, 6, False),  # page cap
        ([3, 3], 99, None, 2, 6, False),  # landing ends
        ([0], 5, None, 1, 0, False),
    ],
)
def test_page_cutoff(spark, folder, sizes, count, cap, kept, fetched, complete):
    payloads = landing(spark, folder, [sized(i + 1, n, count) for i, n in enumerate(sizes)])
    parsed = pages.parse_pages(payloads)
    assert sorted(r.page for r in pages.cut_pages(parsed, max_pages=cap).collect()) == list(range(1, kept + 1))
    audit = pages.page_audit(parsed, max_pages=cap).first()
    assert (audit.pages, audit.fetched, audit.advertised, audit.complete) == (kept, fetched, count, complete)


def test_countries_stop_on_their_own(spark, folder):
    landing(spark, folder, [sized(1, 2, 2), sized(2, 2, 2)], "gb")
    payloads = landing(spark, folder, [sized(1, 2, 4), sized(2, 2, 4)], "us")
    kept = pages.cut_pages(pages.parse_pages(payloads))
    assert {(r.country, r.page) for r in kept.collect()} == {("gb", 1), ("us", 1), ("us", 2)}
    counters = {r.country: (r.pages, r.ads) for r in pages.extraction_counters(kept).collect()}
    assert counters == {"gb": (1, 2), "us": (2, 4)}


@pytest.mark.parametrize(
    ("payload", "rows"),
    [
        ({"history": {"2026-01-01": {"count": 5, "x": None}, "2026-01-02": {"count": 6}}},
         [("2026-01-01", 5, {"count": 5, "x": None}), ("2026-01-02", 6, {"count": 6})]),
        ({"history": [["2026-01-01", {"count": 5}], ["2026-01-02", 7]]}, [("2026-01-01", 5, {"count": 5}), ("2026-01-02", 7, None)]),
        ({"history": {"2026-01-01": 9, "2026-01-02": None}}, [("2026-01-01", 9, None), ("2026-01-02", None, None)]),
        ({"history": {}}, []),
        ({"history": []}, []),
        ({"count": 3}, []),
        ({"history": {"2026-01-01": {"mean": 2}}}, [("2026-01-01", None, {"mean": 2})]),
    ],
)
def test_history_shapes(spark, payload, rows):
    df = spark.createDataFrame([(json.dumps(payload), "gb")], "value string, country string")
    got = pages.normalise_history(df).orderBy("day").collect()
    assert [(r.day, r["count"], r.details_json and json.loads(r.details_json)) for r in got] == rows
    assert all(r.country == "gb" for r in got)


def test_flatten_keeps_nested_values_as_json(spark):
    flat = pages.flatten_nested_to_json(raw_frame(spark, [advert(company={"display_name": None}, title="ä")]))
    row = flat.first()
    assert json.loads(row.location) == {"area": ["FR", "Grand Est", "Colmar"], "display_name": "Colmar"}
    assert json.loads(row.company) == {"display_name": None} and row.title == "ä" and row.salary_min == "41000"


def test_csv_round_trip_keeps_types_and_texts(spark, folder):
    texts = ['a "quoted", text', "two\nlines", "back\\slash", None]
    ads = [advert(id=f"0{i}", title=t) for i, t in enumerate(texts)]
    clean, _ = clean_ads(raw_frame(spark, ads), ingested_at=INGESTED_AT)
    clean = clean.withColumn("description", F.lit('line one\nline "two", end'))
    layers.write_csv(clean, f"{folder}/master")
    back = layers.read_csv(spark, f"{folder}/master")
    assert back.schema == CLEAN_SCHEMA
    assert sorted(back.collect(), key=str) == sorted(clean.collect(), key=str)


def test_clean_delta_is_replaced_per_folder(spark, folder):
    gb, _ = clean_ads(raw_frame(spark, [advert(), advert(id="2")]), ingested_at=INGESTED_AT)
    us, _ = clean_ads(raw_frame(spark, [advert(id="3")], "us"), ingested_at=INGESTED_AT)
    layers.write_clean_delta(gb.unionByName(us), folder)
    layers.write_clean_delta(gb.filter("job_id = '2'"), folder)
    back = layers.read_clean_delta(spark, folder)
    assert sorted((r.job_id, r.country) for r in back.collect()) == [("2", "gb"), ("3", "us")]
    assert back.schema["ingest_date"].dataType.simpleString() == "string"
    assert layers.read_clean_delta(spark, folder, "us").count() == 1


def test_a_country_filter_prunes_folders(spark, folder):
    gb, _ = clean_ads(raw_frame(spark, [advert()]), ingested_at=INGESTED_AT)
    layers.write_clean_delta(gb, folder)
    plan = layers.read_clean_delta(spark, folder, "gb").select("job_id")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(country" in plan and "description" not in plan


def test_export_cells_replace_and_append(spark, folder):
    frame = spark.createDataFrame([("gb", 0.2, None), ("us", 2.0, 3)], "country string, ai_share double, n long").coalesce(1)
    path = f"{folder}/view"
    layers.export_table(frame, path)
    layers.export_table(frame, path)
    lines = [r.value for r in spark.read.text(path).collect()]
    assert lines == ["country,ai_share,n", "gb,0.2,", "us,2,3"]
    layers.export_table(frame.filter("country = 'us'"), path, replace=False)
    assert sorted(r.value for r in spark.read.text(path).collect()) == sorted([*lines, "us,2,3"])
    layers.export_table(frame.limit(0), f"{folder}/empty")
    assert [r.value for r in spark.read.text(f"{folder}/empty").collect()] == ["country,ai_share,n"]


def test_preview_shows_shape_and_first_rows(spark):
    shape, head = layers.preview({"v": spark.range(25).orderBy("id")})["v"]
    assert tuple(shape.first()) == ("v", 25, 1) and [r.id for r in head.collect()] == list(range(10))


def test_analysis_files(spark, folder):
    flags = spark.createDataFrame([], FLAGS_SCHEMA)
    counts = spark.createDataFrame([("gb", 2)], "country string, ads long")
    written = layers.write_analysis(flags, {"ai_skill_counts": counts}, folder, "20260903")
    assert [os.path.basename(p) for p in written] == ["ai_job_flags_20260903", "ai_skill_counts"]
    assert [r.value for r in spark.read.text(written[1]).collect()] == ["country,ads", "gb,2"]

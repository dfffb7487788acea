"""Loads that read what they change alone: stored dimensions, report states, first arrivals, folded updates, manifests."""

import glob
import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from advertlake.functions.taxonomy import GROUP_COLUMNS
from advertlake.operators import history as H
from advertlake.operators.interval import with_versions
from advertlake.operators.windows import keep_first, keep_first_sparse
from advertlake.plans import reports
from advertlake.plans.warehouse import FACT_TABLE, WEEKLY_VIEW, Warehouse
from advertlake.schema import CLEAN_SCHEMA, enforce_schema
from advertlake.sources import dimensions, store
from advertlake.streaming import ingest
from tests.test_store_history import DIM, SNAP, as_rows, naive_versions, random_snapshots


def clean_rows(spark, *values):
    """Clean rows from (job_id, country, ingest_date, title, salary_max)."""
    schema = "job_id string, country string, ingest_date string, title string, salary_max double"
    return enforce_schema(spark.createDataFrame(values, schema), CLEAN_SCHEMA)


# -- facts and versions


def test_a_sweep_over_many_ranges_equals_a_lookup(spark):
    snaps = random_snapshots(600, seed=3)
    dim = H.build_dimension(spark.createDataFrame(snaps, SNAP), DIM)
    days = [(date(2025, 12, 28) + timedelta(days=i)).isoformat() for i in range(20)]
    rng = random.Random(4)
    facts = [(i, "hot" if i % 2 else rng.choice(["k1", "k2", "absent", None]), rng.choice(days)) for i in range(900)] + [(-1, "hot", None)]
    frame = spark.createDataFrame(facts, "id long, k string, day string")
    by_key = {}
    for r in dim.collect():
        by_key.setdefault(r.k, []).append((r.valid_from, r.valid_to, r.version_id))
    want = {}
    for i, k, day in facts:
        found = [v for f, t, v in by_key.get(k, []) if day is not None and f <= day and (t is None or day < t)]
        want[i] = found[0] if found else None
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # ranges as small as they can be
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        got = with_versions(frame, {"a": dim, "b": dim}, {"a": ("k",), "b": ("k",)}, at="day").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert {r.id: r.a_version for r in got} == want == {r.id: r.b_version for r in got} and len(got) == len(facts)


def test_facts_are_read_once_for_all_dimensions(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(frames):
        for frame in frames:
            seen.add(len(frame))
            yield frame

    facts = spark.createDataFrame([("a", "d1"), ("b", "d2")], "k string, day string").mapInPandas(count, "k string, day string")
    dim = spark.createDataFrame([("v", "a", "d0", None)], "version_id string, k string, valid_from string, valid_to string")
    tables = {name: dim for name in "pqrs"}
    got = with_versions(facts, tables, {name: ("k",) for name in "pqrs"}, at="day")
    assert [tuple(r) for r in got.orderBy("k").collect()] == [("a", "d1", "v", "v", "v", "v"), ("b", "d2", None, None, None, None)]
    assert seen.value == 2


# -- stored dimensions


def versions_of(path):
    """Files by segment."""
    out = {}
    for f in glob.glob(f"{path}/data/**/*.parquet", recursive=True):
        out.setdefault(f.split("_f_segment=")[1].split("/")[0], set()).add(f)
    return out


def test_stored_dimension_equals_a_full_build_and_leaves_other_files(spark, folder):
    snaps = random_snapshots(500, seed=21)
    days = sorted({s[1] for s in snaps})
    frame = lambda values: spark.createDataFrame(values, SNAP)
    schema = dimensions.stored_schema(frame(snaps[:1]), DIM)
    late, last = days[4], days[-1]
    loads = [[s for s in snaps if s[1] in days[:3]], [s for s in snaps if s[1] in days[3:-1] and s[1] != late]]
    loads += [[(*s[:3], "odd", 9.0) if s[0] == "hot" else s for s in snaps if s[1] == last], [s for s in snaps if s[1] == last]]
    done = []
    for load in loads:
        before = versions_of(folder)
        written = dimensions.load_snapshots(spark, folder, frame(load), DIM, buckets=8)
        after = versions_of(folder)
        assert all(after.get(segment) == files for segment, files in before.items() if segment not in written)
        done = [s for s in done if s[1] not in {x[1] for x in load}] + load
        assert as_rows(dimensions.read_dimension(spark, folder, schema)) == naive_versions(done)
    # sent again as it is, a day changes nothing
    assert dimensions.load_snapshots(spark, folder, frame(loads[-1]), DIM) == []
    held = [s for s in snaps if s[1] == late]
    with pytest.raises(ValueError, match="pass the stored snapshots"):
        dimensions.load_snapshots(spark, folder, frame(held), DIM)
    dimensions.load_snapshots(spark, folder, frame(held), DIM, snapshots=frame(done))
    assert as_rows(dimensions.read_dimension(spark, folder, schema)) == naive_versions(snaps)


def test_a_day_of_one_key_touches_its_segments_only(spark, folder):
    rows = [(f"k{i}", "d1", "1", "x", 1.0) for i in range(40)]
    dimensions.load_snapshots(spark, folder, spark.createDataFrame(rows, SNAP), DIM, buckets=16)
    before = versions_of(folder)
    again = [("k3", "d2", "1", "y", 1.0)] + [(f"k{i}", "d2", "1", "x", 1.0) for i in range(40) if i != 3]
    written = dimensions.load_snapshots(spark, folder, spark.createDataFrame(again, SNAP), DIM)
    # of forty keys one has changed: its bucket, and the folder of what ended that day
    assert len(written) == 2 and "closed-d2" in written
    after = versions_of(folder)
    assert {s for s in before if after.get(s) != before[s]} == set(written) - {"closed-d2"}
    assert dimensions.load_snapshots(spark, folder, spark.createDataFrame([], SNAP), DIM) == []


# -- manifests


def test_manifests_are_folded_and_lost_loads_removed(spark, folder):
    path = f"{folder}/table"
    for k in range(35):
        if k == 3:
            clean_rows(spark, ("9", "gb", "d9", "lost", 1.0)).write.parquet(f"{path}/data/_v=lost/_f_ingest_date=d9/_f_country=gb")
        store.save_replaced(spark, path, clean_rows(spark, (str(k), "gb", f"d{k % 3}", "t", 1.0)), schema=CLEAN_SCHEMA)
    assert store.read_keyed(spark, path, CLEAN_SCHEMA).count() == 35
    now = store.current(spark, path)
    assert now.load == 35 and len(now.folders) == 3 and len(now.files) <= 2 * store.FOLD
    assert not glob.glob(f"{path}/data/_v=lost") and len(glob.glob(f"{path}/data/**/*.parquet", recursive=True)) == 3


def test_two_writers_cannot_publish_the_same_load(spark, folder):
    path = f"{folder}/table"
    store.save_replaced(spark, path, clean_rows(spark, ("1", "gb", "d1", "a", 1.0)), schema=CLEAN_SCHEMA)
    stale = store.current(spark, path)
    store.save_replaced(spark, path, clean_rows(spark, ("2", "gb", "d1", "b", 1.0)), schema=CLEAN_SCHEMA)
    with pytest.raises(FileExistsError):
        store.write_folders(spark, path, clean_rows(spark, ("3", "gb", "d1", "c", 1.0)), [("d1", "gb")], stale, partitions=("ingest_date", "country"))
    assert store.read_keyed(spark, path, CLEAN_SCHEMA).count() == 2


def test_an_older_frame_reads_for_as_many_loads_as_are_retained(spark, folder):
    path = f"{folder}/table"
    put = lambda title: store.save_replaced(spark, path, clean_rows(spark, ("1", "gb", "d1", title, 1.0)), schema=CLEAN_SCHEMA, retain=2)
    put("a")
    frame = store.read_keyed(spark, path, CLEAN_SCHEMA)
    for title in ("b", "c"):
        put(title)
        assert [r.title for r in frame.collect()] == ["a"]
    put("d")
    with pytest.raises(Exception, match="(?i)file|path"):
        frame.collect()
    assert [r.title for r in store.read_keyed(spark, path, CLEAN_SCHEMA).collect()] == ["d"]


def test_a_table_of_many_folders(spark, folder):
    days = spark.range(300).selectExpr("cast(id as string) AS job_id", "'gb' AS country", "concat('d', id) AS ingest_date", "'t' AS title", "1.0D AS salary_max")
    days = enforce_schema(days, CLEAN_SCHEMA)
    assert store.save_replaced(spark, folder, days, schema=CLEAN_SCHEMA) == 300
    store.save_replaced(spark, folder, clean_rows(spark, ("7", "gb", "d7", "new", 1.0)), schema=CLEAN_SCHEMA)
    got = store.read_keyed(spark, folder, CLEAN_SCHEMA)
    assert got.count() == 300 and [r.title for r in got.filter("ingest_date = 'd7'").collect()] == ["new"]


# -- the warehouse in another session


def test_stored_views_and_later_loads_are_seen_elsewhere(spark, folder):
    first = Warehouse(spark, folder)
    first.upsert_jobs(clean_rows(spark, ("1", "gb", "d1", "a", 1.0)))
    first.create_view("jobs_by_country", f"SELECT country, count(*) AS n FROM {FACT_TABLE} GROUP BY 1")
    first.create_view("largest", "SELECT max(n) AS n FROM jobs_by_country")
    other = Warehouse(spark.newSession(), folder)
    assert other.query("SELECT n FROM largest").first().n == 1
    first.upsert_jobs(clean_rows(spark, ("2", "gb", "d1", "b", 1.0), ("3", "us", "d1", "c", 1.0)))
    assert other.query("SELECT n FROM largest").first().n == 2 and other.query(f"SELECT * FROM {WEEKLY_VIEW}").count() == 0
    first.create_view("largest", "SELECT min(n) AS n FROM jobs_by_country")
    assert other.query("SELECT n FROM largest").first().n == 1
    with pytest.raises(Exception, match="(?i)not_there"):
        first.create_view("broken", "SELECT * FROM not_there")


# -- report states


def enriched(spark, values):
    """Rows of (id, country, day, role, created, flag, salary)."""
    base = spark.createDataFrame(values, "job_id string, country string, ingest_date string, role_class string, created string, ai_mentioned boolean, salary_min double")
    counters = {c: F.col("ai_mentioned").cast("bigint") for c in GROUP_COLUMNS.values()}
    return base.withColumn("created_at", F.to_timestamp("created")).withColumns(counters).withColumn("salary_max", F.lit(None).cast("double"))


def test_states_of_loads_add_up_to_a_full_report(spark, folder):
    rng = random.Random(5)
    rows = [(str(i), rng.choice(["gb", "us"]), rng.choice(["d1", "d2", "d3"]), rng.choice(["technical", "other", None]),
             rng.choice([None, "2026-01-05", "2026-01-13"]), rng.random() < 0.4, rng.choice([None, float(i)])) for i in range(400)]
    whole = enriched(spark, rows)
    for day in ("d1", "d2", "d3"):
        reports.refresh(spark, folder, whole.filter(F.col("ingest_date") == day).withColumn("ai_mentioned", ~F.col("ai_mentioned") if day == "d2" else F.col("ai_mentioned")))
    files = set(glob.glob(f"{folder}/data/**/*_f_ingest_date=d1/**/*.parquet", recursive=True))
    assert reports.refresh(spark, folder, whole.filter("ingest_date = 'd2'")) == 2
    assert files and files == set(glob.glob(f"{folder}/data/**/*_f_ingest_date=d1/**/*.parquet", recursive=True))
    states = reports.read_states(spark, folder)
    want = {}
    for _, country, _, role, created, flag, _ in rows:
        week = {None: None, "2026-01-05": "2026-01-05", "2026-01-13": "2026-01-12"}[created]
        n, ai = want.get((week, country, role), (0, 0))
        want[week, country, role] = (n + 1, ai + flag)
    got = {(r.week and str(r.week), r.country, r.role_class): (r.total_ads, r.ai_ads) for r in reports.weekly_share(states).collect()}
    assert got == want
    counts = reports.group_counts(states, by=["country"]).collect()
    assert {r.country: r.ads for r in counts} == {c: sum(x[1] == c for x in rows) for c in ("gb", "us")}
    quantiles = reports.quantiles(states, [0.5], by=["country"]).collect()
    for r in quantiles:
        values = sorted(x[6] for x in rows if x[1] == r.country and x[6] is not None)
        assert r.n == len(values) and r.measure == "salary_min" and abs(values.index(r.value) / len(values) - 0.5) < 0.02
    # a folder that lost its rows
    reports.refresh(spark, folder, whole.filter("false"), folders=[("d1", "gb"), ("d1", "us")])
    assert reports.weekly_share(reports.read_states(spark, folder)).agg(F.sum("total_ads")).first()[0] == sum(x[2] != "d1" for x in rows)


# -- streams


def test_updates_are_folded(spark, folder):
    schema = "week string, country string, total_ads long, ai_ads long"
    frame = lambda *rows: spark.createDataFrame(rows, schema)
    last = {}
    for n in range(40):
        rows = [(f"w{n % 7}", "gb", n + 1, n // 2), (f"w{n}", "us", 2, 1)]
        last.update({(r[0], r[1]): r[2:] for r in rows})
        ingest.save_update(spark, folder, frame(*rows), frame().schema, n, key=["week", "country"], fold=5)
        if n == 22:  # a batch that is repeated after a failure
            ingest.save_update(spark, folder, frame(*rows), frame().schema, n, key=["week", "country"], fold=5)
    base, after = ingest._layers(spark, folder)
    assert base is not None and len(after) < 5 and len(glob.glob(f"{folder}/batch=*")) <= 10 and len(glob.glob(f"{folder}/base=*")) <= 2
    got = ingest.latest_updates(spark, folder, frame().schema, key=["week", "country"]).collect()
    assert {(r.week, r.country): (r.total_ads, r.ai_ads) for r in got} == last


def test_first_arrivals_stay_whatever_comes_later(spark, folder):
    table = ingest.FirstArrivals(spark, folder, first_by=("salary_max",), bits=1 << 16, fold=3)
    rng = random.Random(9)
    first = {}
    for n in range(8):
        rows = [(f"{rng.randint(0, 60)}", rng.choice(["gb", "", None]), rng.choice(["d1", "d2"]), f"batch {n}", float(i)) for i in range(30)]
        for r in rows:
            first.setdefault(r[:3], r)
        for _ in range(2 if n in (4, 6) else 1):  # repeated after a failure
            table.add(clean_rows(spark, *rows), n)
    got = table.table().collect()
    assert {(r.job_id, r.country, r.ingest_date): (r.title, r.salary_max) for r in got} == {k: r[3:] for k, r in first.items()}
    assert len(got) == len(first)
    again = ingest.FirstArrivals(spark, folder, first_by=("salary_max",), bits=1 << 16, fold=3)
    again.add(clean_rows(spark, *[(*k, "late", -1.0) for k in first]), 8)
    assert again.table().count() == len(first)


# -- keep first


@pytest.mark.parametrize("tied", [False, True])
def test_sparse_keep_first_equals_the_plain_one(spark, tied):
    rng = random.Random(11)
    rows = [(rng.choice(["a", "b", None, f"u{i}"]), i % 3 if tied else i, f"t{i}") for i in range(200)]
    df = spark.createDataFrame(rows, "k string, o int, t string")
    got = keep_first_sparse(df, ["k"], ["o"])
    plain = keep_first(df, ["k"], ["o"])
    assert sorted((r.k or "", r.o) for r in got.collect()) == sorted((r.k or "", r.o) for r in plain.collect())
    assert got.columns == df.columns
    if not tied:
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr)


# -- payloads byte for byte


def test_payloads_come_back_byte_for_byte(spark, folder):
    import hashlib
    import os

    from advertlake.sources import payloads

    contents = {"gb/a.json": b'{\n  "results": [\r\n  ]\n}\n', "gb/b.json": b" ", "us/c.json": b"\xff\x00no text\n", "us/d.json": b'{\n  "results": [\r\n  ]\n}\n'}
    for name, raw in contents.items():
        country, file = name.split("/")
        os.makedirs(f"{folder}/landing/ingest_date=2026-09-03/country={country}", exist_ok=True)
        with open(f"{folder}/landing/ingest_date=2026-09-03/country={country}/{file}", "wb") as handle:
            handle.write(raw)
    assert payloads.store_payloads(spark, f"{folder}/landing", f"{folder}/store") == 3  # two files are equal
    assert payloads.store_payloads(spark, f"{folder}/landing", f"{folder}/store") == 0
    stored = payloads.stored_payloads(spark, f"{folder}/store")
    got = {f"{r.country}/{r.path.split('/')[-1]}": (bytes(r.content), r.sha256) for r in stored.collect()}
    assert got == {name: (raw, hashlib.sha256(raw).hexdigest()) for name, raw in contents.items()}
    assert payloads.altered(stored).count() == 0
    assert payloads.altered(stored.withColumn("content", F.lit("x").cast("binary"))).count() == 4


def test_files_hold_ranges_of_the_date(spark, folder):
    days = spark.range(4000).selectExpr(
        "cast(id as string) AS job_id", "'gb' AS country", "'d1' AS ingest_date", "timestampadd(HOUR, cast(id * 7919 % 4000 as int), timestamp'2026-01-01') AS created_at"
    )
    store.save_replaced(spark, folder, enforce_schema(days, CLEAN_SCHEMA), schema=CLEAN_SCHEMA, file_rows=200)
    master = store.read_keyed(spark, folder, CLEAN_SCHEMA)
    assert len(master.inputFiles()) >= 15
    week = master.filter("created_at >= timestamp'2026-02-02' AND created_at < timestamp'2026-02-09'")
    assert week.count() == 168 and week.select(F.input_file_name()).distinct().count() <= 3

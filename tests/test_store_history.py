import glob
import hashlib
import json
import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from advertlake.operators import history as H
from advertlake.operators import merge as M
from advertlake.operators.clean import clean_ads
from advertlake.operators.enrich import enrich_ads
from advertlake.plans.warehouse import FACT_TABLE, FLAGS_TABLE, WEEKLY_VIEW, Warehouse
from advertlake.schema import CLEAN_SCHEMA, HISTORY_KEY, HISTORY_SCHEMA, enforce_schema
from advertlake.sources import store
from tests.adverts import INGESTED_AT, advert, raw_frame


def rows(spark, *values):
    """Clean rows from (job_id, country, ingest_date, title)."""
    return enforce_schema(spark.createDataFrame(values, "job_id string, country string, ingest_date string, title string"), CLEAN_SCHEMA)


def titles(df):
    return sorted((r.job_id, r.country, r.ingest_date, r.title) for r in df.collect())


def test_merges_replace_by_key_and_repeat_without_effect(spark):
    old = rows(spark, ("1", "gb", "d1", "a"), ("2", "gb", "d1", "b"), ("1", "us", "d1", "c"))
    new = rows(spark, ("2", "gb", "d1", "B"), ("2", "gb", "d2", "n"))
    expected = [("1", "gb", "d1", "a"), ("1", "us", "d1", "c"), ("2", "gb", "d1", "B"), ("2", "gb", "d2", "n")]
    for merge in (M.merge_keep_last, M.replace_by_key):
        once = merge(old, new)
        assert once.schema.names == CLEAN_SCHEMA.names
        assert titles(once) == expected and titles(merge(once, new)) == expected
        assert titles(merge(old, new.limit(0))) == titles(old)


def test_master_order_puts_missing_dates_last(spark):
    df = spark.createDataFrame([("b", "d1", None), ("a", "d1", "2026-01-01"), ("c", "d0", None)], "job_id string, ingest_date string, created_at string")
    assert [r.job_id for r in M.master_sorted(df).collect()] == ["c", "a", "b"]


def stored(spark, path):
    return store.read_keyed(spark, path, CLEAN_SCHEMA)


def files(path, part=""):
    return {f for f in glob.glob(f"{path}/data/**/*.parquet", recursive=True) if part in f}


def test_stored_table_touches_only_its_folders(spark, folder):
    path = f"{folder}/master"
    store.save_replaced(spark, path, rows(spark, ("1", "gb", "d1", "a"), ("2", "us", "d1", "b")), schema=CLEAN_SCHEMA)
    before = files(path, "_f_country=us")
    batch = rows(spark, ("1", "gb", "d1", "A"), ("3", "gb", "d1", "c"), ("4", "gb", "d2", "d"))
    for _ in range(2):
        store.save_replaced(spark, path, batch, schema=CLEAN_SCHEMA)
    table = stored(spark, path)
    assert titles(table) == [("1", "gb", "d1", "A"), ("2", "us", "d1", "b"), ("3", "gb", "d1", "c"), ("4", "gb", "d2", "d")]
    assert before == files(path, "_f_country=us") and table.schema == CLEAN_SCHEMA
    # of what was replaced nothing is left: three folders of one small file
    assert len(before) == 1 and len(files(path)) == 3


def test_a_key_is_stored_once_and_never_null(spark, folder):
    path = f"{folder}/master"
    twice = rows(spark, ("1", "gb", "d1", "a"), ("1", "gb", "d1", "b"), ("2", "gb", "d1", "c"))
    for _ in range(2):
        store.save_replaced(spark, path, twice, schema=CLEAN_SCHEMA, keep_last_of=("title",))
        assert titles(stored(spark, path)) == [("1", "gb", "d1", "b"), ("2", "gb", "d1", "c")]
    with pytest.raises(Exception, match="a key column is null"):
        store.save_replaced(spark, path, rows(spark, ("9", None, "d1", "x")), schema=CLEAN_SCHEMA)
    assert titles(stored(spark, path)) == [("1", "gb", "d1", "b"), ("2", "gb", "d1", "c")]


def test_blank_keys_and_odd_names_keep_their_rows(spark, folder):
    path = f"{folder}/master"
    batches = [("1", "", "d1", "a"), ("2", "", "d1", "b"), ("3", "", "", "c"), ("4", "", "", "d"), ("5", "a/b=c d%", "d:1", "e"), ("6", "a/b=c d%", "d:1", "f")]
    for row in batches:
        store.save_replaced(spark, path, rows(spark, row), schema=CLEAN_SCHEMA)
    assert titles(stored(spark, path)) == sorted(batches)
    assert len(files(path)) == 3  # of what was replaced nothing is left


def test_a_load_lost_before_its_switch_changes_nothing(spark, folder, monkeypatch):
    path = f"{folder}/master"
    store.save_replaced(spark, path, rows(spark, ("1", "gb", "d1", "a"), ("2", "us", "d1", "b")), schema=CLEAN_SCHEMA)
    batch = rows(spark, ("1", "gb", "d1", "A"), ("3", "gb", "d2", "n"))

    def lost(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patched:
        patched.setattr(store, "_publish", lost)
        with pytest.raises(KeyboardInterrupt):
            store.save_replaced(spark, path, batch, schema=CLEAN_SCHEMA)
    assert titles(stored(spark, path)) == [("1", "gb", "d1", "a"), ("2", "us", "d1", "b")]
    with monkeypatch.context() as patched:  # lost after it: only the old folders stay behind
        patched.setattr(store, "remove", lost)
        with pytest.raises(KeyboardInterrupt):
            store.save_replaced(spark, path, batch, schema=CLEAN_SCHEMA)
    want = [("1", "gb", "d1", "A"), ("2", "us", "d1", "b"), ("3", "gb", "d2", "n")]
    assert titles(stored(spark, path)) == want
    store.save_replaced(spark, path, batch, schema=CLEAN_SCHEMA)
    assert titles(stored(spark, path)) == want


def test_thousands_of_folders_can_be_asked_for(spark):
    names = spark.range(4000).select(F.concat(F.lit("d"), F.col("id").cast("string")).alias("ingest_date"), F.lit("gb").alias("country"))
    names = names.unionByName(spark.createDataFrame([(None, "gb")], "ingest_date string, country string"))
    table = rows(spark, ("1", "gb", "d1", "a"), ("2", "gb", "d3999", "b"), ("3", "us", "d1", "c"), ("4", "gb", None, "d"), ("5", None, "d1", "e"))
    assert [t[0] for t in titles(store.rows_of_folders(table, names, ["ingest_date", "country"]).na.fill("-"))] == ["1", "2", "4"]


def test_history_master(spark, folder):
    path = f"{folder}/history"
    batch = lambda *values: spark.createDataFrame(values, HISTORY_SCHEMA)
    spec = {"schema": HISTORY_SCHEMA, "key": HISTORY_KEY, "partitions": ("country",), "sort": ("day",), "keep_last_of": ("count", "details_json")}
    store.save_replaced(spark, path, batch(("gb", "d1", 1, None), ("us", "d1", 2, None)), **spec)
    store.save_replaced(spark, path, batch(("gb", "d1", 5, "{}"), ("gb", "d1", 4, None), ("gb", "d2", 6, None)), **spec)
    got = sorted(tuple(r)[:3] for r in store.read_keyed(spark, path, HISTORY_SCHEMA, ("country",)).collect())
    assert got == [("gb", "d1", 5), ("gb", "d2", 6), ("us", "d1", 2)]


def test_partitions_are_loaded_once(spark, folder):
    deltas = rows(spark, ("1", "gb", "d1", "a"), ("2", "us", "d1", "b"))
    spec = (f"{folder}/table", f"{folder}/ledger")
    assert store.load_pending(spark, deltas, *spec, schema=CLEAN_SCHEMA) == 2
    assert store.load_pending(spark, deltas, *spec, schema=CLEAN_SCHEMA) == 0
    more = deltas.unionByName(rows(spark, ("3", "gb", "d2", "c")))
    assert store.load_pending(spark, more, *spec, schema=CLEAN_SCHEMA) == 1
    assert len(titles(stored(spark, spec[0]))) == 3


def test_warehouse_loads_are_idempotent(spark, folder):
    ads = [advert(id="j1", description="ML jobs with PyTorch and LLMs."), advert(id="j2", description="PyTorch")]
    clean, _ = clean_ads(raw_frame(spark, ads), ingested_at=INGESTED_AT)
    warehouse = Warehouse(spark, folder)
    assert warehouse.table_count(FACT_TABLE) == 0 and warehouse.upsert_jobs(clean.limit(0)) == 0
    for _ in range(2):
        assert warehouse.upsert_jobs(clean) == 2 and warehouse.upsert_analysis(enrich_ads(clean)) == 2
    assert warehouse.table_count(FACT_TABLE) == 2 and warehouse.table_count(FLAGS_TABLE) == 2
    frames = warehouse.export_frames()
    assert set(frames) == {"ai_share_weekly", "ai_share_latest", "ai_skill_counts"}
    weekly = frames["ai_share_weekly"].collect()
    assert [(r.role_class, r.ai_share, r.total_ads) for r in weekly] == [("technical", 1.0, 2)]
    assert warehouse.query(f"SELECT max(total_ads) AS n FROM {WEEKLY_VIEW}").first().n == 2
    again = Warehouse(spark, folder)
    assert again.table_count(FACT_TABLE) == 2
    assert frames["ai_skill_counts"].first().generative_ai_mentions == 1


# -- dimensions --------------------------------------------------------------------------------

DIM = H.Dimension("thing", ("k",), ("a", "b"))


def naive_versions(snapshots):
    by_key = {}
    for k, day, order, a, b in sorted(snapshots, key=lambda s: (s[0], s[1], s[2])):
        by_key.setdefault(k, {})[day] = (a, b)
    out = []
    for k, days in by_key.items():
        runs = []
        for day in sorted(days):
            if not runs or runs[-1][1] != days[day]:
                runs.append((day, days[day]))
        for i, (day, state) in enumerate(runs):
            end = runs[i + 1][0] if i + 1 < len(runs) else None
            out.append((k, *state, day, end, end is None))
    return sorted(out, key=str)


def random_snapshots(n=900, seed=6):
    rng = random.Random(seed)
    days = [(date(2026, 1, 1) + timedelta(days=i)).isoformat() for i in range(12)]
    # A third of all rows belong to one key.
    return [("hot" if rng.random() < 0.34 else f"k{rng.randint(0, 25)}", rng.choice(days), f"{i:04d}",
             rng.choice(["x", None]), rng.choice([1.0, 2.0])) for i in range(n)]


SNAP = "k string, ingest_date string, job_id string, a string, b double"


def as_rows(df):
    return sorted(((r.k, r.a, r.b, r.valid_from, r.valid_to, r.is_current) for r in df.collect()), key=str)


def test_versions_agree_with_a_naive_build(spark):
    snaps = random_snapshots()
    dim = H.build_dimension(spark.createDataFrame(snaps, SNAP), DIM)
    assert as_rows(dim) == naive_versions(snaps)
    assert dim.select("version_id").distinct().count() == dim.count()


def test_daily_extension_equals_a_full_build(spark):
    snaps = random_snapshots(seed=8)
    df = spark.createDataFrame(snaps, SNAP)
    whole = sorted(H.build_dimension(df, DIM).collect(), key=str)
    days = sorted({s[1] for s in snaps})
    cut = days[len(days) // 2]
    dim = H.build_dimension(df.filter(F.col("ingest_date") <= cut), DIM)
    rest = df.filter(F.col("ingest_date") > cut)
    assert sorted(H.extend_dimension(dim, rest, DIM, loaded_until=cut).collect(), key=str) == whole
    # Sending the last known day again changes nothing.
    again = H.extend_dimension(H.build_dimension(df, DIM), df.filter(F.col("ingest_date") == days[-1]), DIM, loaded_until=days[-1])
    assert sorted(again.collect(), key=str) == whole


def test_a_last_day_sent_again_and_a_late_day_equal_a_full_build(spark):
    snaps = random_snapshots(seed=12)
    days = sorted({s[1] for s in snaps})
    last, late = days[-1], days[5]
    frame = lambda values: spark.createDataFrame(values, SNAP)
    wrong = [(*s[:3], "odd", 9.0) if s[1] == last else s for s in snaps]
    built = H.build_dimension(frame(wrong), DIM)
    fixed = H.extend_dimension(built, frame([s for s in snaps if s[1] == last]), DIM, loaded_until=last)
    assert as_rows(fixed) == naive_versions(snaps)
    without, held = [s for s in snaps if s[1] != late], [s for s in snaps if s[1] == late]
    early = H.build_dimension(frame(without), DIM)
    with pytest.raises(ValueError, match="pass the stored snapshots"):
        H.extend_dimension(early, frame(held), DIM, loaded_until=last)
    with pytest.raises(ValueError, match="loaded_until"):
        H.extend_dimension(early, frame(held), DIM)
    whole = H.extend_dimension(early, frame(held), DIM, snapshots=frame(without))
    assert as_rows(whole) == naive_versions(snaps)
    assert whole.groupBy("k").agg(F.count_if("is_current").alias("n")).filter("n <> 1").count() == 0


def test_facts_meet_the_version_of_their_day(spark):
    snaps = random_snapshots(300, seed=10)
    df = spark.createDataFrame(snaps, SNAP)
    dim = H.build_dimension(df, DIM)
    fact = H.with_version(df, dim, DIM)
    assert fact.count() == len(snaps)
    joined = fact.join(dim.select("version_id", F.col("valid_from").alias("f"), F.col("valid_to").alias("t")),
                       F.col("thing_version") == F.col("version_id"))
    assert joined.filter("f <= ingest_date and (t is null or ingest_date < t)").count() == len(snaps)


def test_snapshot_fact_and_dates(spark):
    base, _ = clean_ads(raw_frame(spark, [advert(), advert(id="2", company=None)]), ingested_at=INGESTED_AT)
    later = base.withColumn("ingest_date", F.lit("2026-09-05")).withColumn("category_label", F.lit("IT"))
    snaps = base.unionByName(later)
    tables = {d.name: H.build_dimension(snaps, d) for d in H.DIMENSIONS}
    assert {n: t.count() for n, t in tables.items()} == {"company": 1, "location": 1, "category": 2, "job": 2}
    fact = H.snapshot_fact(snaps, tables)
    got = fact.collect()
    assert len(got) == 4 and {r.date_id for r in got} == {20260903, 20260905}
    assert len({r.category_version for r in got}) == 2
    assert [r.company_version is None for r in sorted(got, key=lambda r: r.job_id)] == [True, True, False, False]
    days = H.date_dimension(snaps).orderBy("day").collect()
    assert [str(r.day) for r in days] == ["2026-09-03", "2026-09-04", "2026-09-05"] and days[0].iso_weekday == 4


def test_scratch_folder_is_the_one_the_cluster_names(spark):
    from advertlake import session

    assert session.checkpoint_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    staged = session.stage(spark.range(3), "probe")
    assert staged.count() == 3 and staged.inputFiles()[0].split("://")[-1].lstrip("/").startswith(
        spark.conf.get("spark.checkpoint.dir").lstrip("/")
    )


def test_a_session_without_a_shared_folder_is_refused():
    from advertlake import session

    class Nothing:
        conf = type("Conf", (), {"get": staticmethod(lambda key, default=None: default)})
        sparkContext = type("Context", (), {"getCheckpointDir": staticmethod(lambda: None)})

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_folder(Nothing())


def test_fixed_values_are_as_they_were():
    """The SQL twins are made from the library's constants, so a change there must show here."""
    from advertlake.functions import scalars, taxonomy

    text = json.dumps([{g: list(t) for g, t in taxonomy.SKILLS.groups.items()}, scalars.CURRENCY_BY_COUNTRY], sort_keys=True)
    assert hashlib.sha256(text.encode()).hexdigest() == "50c4dcf5580c027af4ad0f4095e7aa67c04441e52fcc2ec737cb3a2682ba4c09"


def test_a_load_leaves_versions_without_its_keys_alone(spark, folder, monkeypatch):
    path = f"{folder}/master"
    monkeypatch.setattr(store, "APART", 0)
    put = lambda *values: store.save_replaced(spark, path, rows(spark, *values), schema=CLEAN_SCHEMA)
    put(("1", "a/b=c d%", "2026-09-01", "a"), ("2", "", "2026-09-01", "b"))
    first = files(path)
    put(("3", "a/b=c d%", "2026-09-01", "c"), ("4", "", "2026-09-01", "d"))
    assert first < files(path)
    both = files(path)
    put(("3", "a/b=c d%", "2026-09-01", "C"))
    assert first < files(path) and len(both - files(path)) == 1
    assert titles(stored(spark, path)) == sorted([
        ("1", "a/b=c d%", "2026-09-01", "a"), ("2", "", "2026-09-01", "b"), ("3", "a/b=c d%", "2026-09-01", "C"), ("4", "", "2026-09-01", "d"),
    ])
    for _ in range(store.FOLD):  # the files that name all folders name all versions of each
        put(("4", "", "2026-09-01", "D"))
    assert len(titles(stored(spark, path))) == 4 and len(files(path)) == 4


def test_loads_move_no_texts(spark, folder, monkeypatch):
    # a large batch that repeats keys, and replaces others, is written as its tasks hold it
    path = f"{folder}/master"
    monkeypatch.setattr("advertlake.sources.layers.DEALT_ROWS", 1)
    moved = []
    monkeypatch.setattr(store, "spread_for_write", lambda df, names: moved.append(df) or df)
    batch = [(str(k), "gb", "d1", f"t{k}") for k in range(40)]
    store.save_replaced(spark, path, rows(spark, *batch), schema=CLEAN_SCHEMA)
    again = [(str(k), "gb", "d1", t) for k in range(20, 60) for t in ("A", "B")]
    store.save_replaced(spark, path, rows(spark, *again), schema=CLEAN_SCHEMA, keep_last_of=("title",))
    assert titles(stored(spark, path)) == sorted([*batch[:20], *[r for r in again if r[3] == "B"]]) and not moved

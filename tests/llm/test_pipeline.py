"""Every stage of the pipeline on its own input, and the whole run."""

import random

import pytest

import corpus_pipeline
from advertlake.llm import decontaminate, mixing, ngram_join, quality
from advertlake.llm.queries import ORACLES, QUERIES, prepared
from advertlake.session import stage

from tests.llm.test_operators import plain_components, prose


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    prepared(spark)
    folder = str(tmp_path_factory.mktemp("tables"))
    rnd = random.Random(6)
    items = [t for t in prose(60, 10) if len(t.split()) >= 20]
    texts = [t for t in prose(61, 90) if len(t.split()) >= 30]
    texts += [t + " end" for t in texts[:8]] + [f"{a} {b}" for a, b in zip(texts[8:12], items)]
    bad = [" ".join(f"{w.upper()}!!" for w in t.split()) for t in prose(62, 60)]
    rows = [(i, t, rnd.choice(["en", "fr"]), f"src{i % 6}", len(t)) for i, t in enumerate(texts + bad + ["", "tiny"])]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{folder}/documents.parquet")
    labels = [(i, int(i < len(texts)), 0) for i in range(len(texts) + len(bad))]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def test_stages_are_the_named_ones():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "ngram_jaccard_join", "benchmark_decontamination", "target_mix", "token_files"
    ]
    assert {f"op{n}_" for n in range(1, 14)} == {q.split("_")[0] + "_" for q in QUERIES}
    assert set(ORACLES) <= set(QUERIES)


def test_every_stage_on_its_input(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    benchmark = spark.read.parquet(f"{tables}/benchmark.parquet")
    given = docs
    for name, apply in corpus_pipeline.STAGES:
        out = stage(apply(spark, given, tables), name)
        ids = sorted(r["doc_id"] for r in out.collect())
        before = {r["doc_id"]: r["text"] for r in given.collect()}
        if name != "token_files":
            assert out.columns == docs.columns
        if name == "quality_rules":
            judged = quality.judge_quality(given, quality.fit_quality(given, spark.read.parquet(f"{tables}/labels.parquet")))
            assert ids == sorted(r["doc_id"] for r in judged.filter("kept").collect()) and 80 < len(ids) < len(before) - 30
        elif name == "ngram_jaccard_join":
            assert ids == sorted(d for d, _, c in plain_components(list(before.items())) if d == c) and len(ids) < len(before)
        elif name == "benchmark_decontamination":
            hit = {r["doc_id"] for r in decontaminate.contaminated(given, benchmark).collect()}
            assert ids == sorted(set(before) - hit) and len(hit) == 4
        elif name == "target_mix":
            raked = mixing.raked_cells(given)
            rated = mixing.rated(given, raked).filter(mixing.uniform(mixing.F.col("row.doc_id"), mixing.SEED) < mixing.F.col("probability"))
            assert ids == sorted(r["doc_id"] for r in rated.select("row.doc_id").collect())
        else:
            assert ids == sorted(before) and out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
        given = out
    assert sorted(map(tuple, corpus_pipeline.run(spark, tables).collect())) == sorted(map(tuple, given.collect()))


def test_the_quality_stage_rejects_nearly_all_that_is_bad(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    kept, n = corpus_pipeline.quality_rules(spark, docs, tables).count(), docs.count()
    assert 80 < kept < n - 50


def test_an_empty_table_passes_through(spark, tables, folder):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{tables}/{name}.parquet").limit(0).write.parquet(f"{folder}/{name}.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0


def test_odd_documents_pass_through_every_stage(spark, tables, folder):
    # null texts and ids, repeated rows, a very long text, ties, and columns with names that operators use themselves
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    good = docs.filter("doc_id = 0").first()["text"]
    long = " ".join(prose(77, 1500))
    odd = [(900, None), (901, ""), (None, None), (902, long), (903, good + " once more"), (903, good + " once more"), (None, good.upper())]
    more = spark.createDataFrame([(i, t, None, None, None) for i, t in odd], docs.schema)
    clash = {"row": 1, "cell": "c", "k": 2, "n": 3, "root": 4, "probability": 0.5, "d": "d", "kept": True}
    given = docs.unionByName(more)
    for name, value in clash.items():
        given = given.withColumn(name, mixing.F.lit(value))
    given.write.parquet(f"{folder}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{tables}/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    given = spark.read.parquet(f"{folder}/documents.parquet")
    columns = given.columns
    for name, apply in corpus_pipeline.STAGES:
        out = stage(apply(spark, given, folder), name)
        rows = out.collect()
        if name == "quality_rules":
            ids = [r["doc_id"] for r in rows]
            assert not {900, 901} & set(ids) and all(r["text"] for r in rows) and 902 in ids and ids.count(903) == 2
        elif name == "ngram_jaccard_join":
            # the copies of document 0 are near copies of it: one row of them stays
            alike = [r for r in rows if r["text"].lower().startswith(good.lower())]
            assert [r["doc_id"] for r in alike] == [0] and 902 in [r["doc_id"] for r in rows]
        if name != "token_files":
            assert out.columns == columns and len(rows) > 20
        else:
            assert len(rows) == given.count()
        given = out

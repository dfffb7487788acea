"""The operators of this package as queries over the given tables, with SQL twins where SQL can express them."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from advertlake.llm import (
    attention,
    decontaminate,
    lengths,
    mixing,
    ngram_join,
    packing,
    quality,
    run_index,
    secrets,
    tokenfiles,
    trie,
    urls,
    whitening,
)
from advertlake.session import configure, scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(prepared(spark), sf_dir)

        QUERIES[build.__name__] = run
        if sql is not None:
            ORACLES[build.__name__] = sql.strip()
        return build

    return register


ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def prepared(spark: SparkSession) -> SparkSession:
    """Batches of a few megabytes of text, and workers that find this package where it is not installed."""
    configure(spark)
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([p for p in paths if p] + [ROOT])
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Positions from the lengths of the parts between matches and of the matches before. The letters stand in classes
# because this engine's folding of case goes beyond a-z.
_SECRETS_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
raw AS (
  SELECT doc_id, t, 0 AS rank, 'assign' AS kind, 6 AS least, {assign} AS p, 2 AS g FROM d
  UNION ALL SELECT doc_id, t, 1, 'access', 20, 'AKIA[A-Z0-9]+', 0 FROM d
  UNION ALL SELECT doc_id, t, 2, 'hex', 24, '[0-9a-f]+', 0 FROM d
  UNION ALL SELECT doc_id, t, 3, 'pem', 1, '-----BEGIN [A-Z ]{{0,32}}PRIVATE KEY-----', 0 FROM d),
cut AS (
  SELECT doc_id, rank, kind, least, regexp_extract_all(t, {assign}, 0) AS hits,
         regexp_extract_all(t, {assign}, 2) AS counted, string_split_regex(t, {assign}) AS parts FROM raw WHERE rank = 0
  UNION ALL
  SELECT doc_id, rank, kind, least, regexp_extract_all(t, 'AKIA[A-Z0-9]+'), regexp_extract_all(t, 'AKIA[A-Z0-9]+'),
         string_split_regex(t, 'AKIA[A-Z0-9]+') FROM raw WHERE rank = 1
  UNION ALL
  SELECT doc_id, rank, kind, least, regexp_extract_all(t, '[0-9a-f]+'), regexp_extract_all(t, '[0-9a-f]+'),
         string_split_regex(t, '[0-9a-f]+') FROM raw WHERE rank = 2
  UNION ALL
  SELECT doc_id, rank, kind, least, regexp_extract_all(t, '-----BEGIN [A-Z ]{{0,32}}PRIVATE KEY-----'),
         regexp_extract_all(t, '-----BEGIN [A-Z ]{{0,32}}PRIVATE KEY-----'),
         string_split_regex(t, '-----BEGIN [A-Z ]{{0,32}}PRIVATE KEY-----') FROM raw WHERE rank = 3),
hit AS (SELECT doc_id, rank, kind, least, unnest(hits) AS hit, unnest(counted) AS c, unnest(parts[1:len(hits)]) AS gap,
               generate_subscripts(hits, 1) AS i FROM cut WHERE len(hits) > 0),
placed AS (SELECT *, sum(length(gap) + length(hit)) OVER (PARTITION BY doc_id, rank ORDER BY i) AS e FROM hit),
span AS (SELECT doc_id, rank, kind, CAST(e - length(hit) AS BIGINT) AS s, CAST(e AS BIGINT) AS e FROM placed WHERE length(c) >= least),
per AS (
  SELECT doc_id, count(*) FILTER (rank = 0) AS n_assign, count(*) FILTER (rank = 1) AS n_access,
         count(*) FILTER (rank = 2) AS n_hex,
         string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) FILTER (rank < 3) AS base,
         string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) AS spans
  FROM span GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN per USING (doc_id)
""".format(
    assign="'([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
    "|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"'']?\\x20*[:=]\\x20*[\"'']?([A-Za-z0-9+/_.=-]+)'"
)


@query(_SECRETS_SQL)
def op1_secret_scans(spark, sf_dir):
    # two loads of the table: the second finds every blob in the ledger and scans nothing
    ledger = secrets.BlobLedger(spark, scratch_path(spark, "secret-ledger"))
    documents = table(spark, sf_dir, "documents")
    ledger.record(documents)
    return secrets.secret_digest(documents, ledger)


_JACCARD_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '[^\x20\x09-\x0D]+') AS x FROM documents),
g AS (SELECT DISTINCT doc_id, CASE WHEN len(x) < 5 THEN array_to_string(x, ' ') ELSE array_to_string(x[i : i + 4], ' ') END AS s
      FROM (SELECT doc_id, x, unnest(range(1, greatest(len(x) - 3, 2))) AS i FROM w WHERE len(x) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM g a JOIN g b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
e AS MATERIALIZED (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(v, root) AS (SELECT a, a FROM e UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.v WHERE r.root < e.b),
c AS (SELECT v, min(root) AS root FROM r GROUP BY v)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, least(w.doc_id, coalesce(c.root, w.doc_id)) AS component_id
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN c ON c.v = w.doc_id
""".format(upper=urls.UPPER, lower=urls.LOWER)


@query(_JACCARD_SQL)
def op2_ngram_join(spark, sf_dir):
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"))


@query()
def op3_token_files(spark, sf_dir):
    path = scratch_path(spark, "token-files")
    tokenfiles.write_token_files(table(spark, sf_dir, "documents"), path)
    return tokenfiles.read_digests(spark, path)


@query()
def op4_repeated_spans(spark, sf_dir):
    return run_index.remove_repeats(table(spark, sf_dir, "documents"))


@query()
def op5_quality_rules(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return quality.judge_quality(documents, quality.fit_quality(documents, table(spark, sf_dir, "labels")))


@query(mixing.sample_sql())
def op6_mixed_sample(spark, sf_dir):
    # the share of the SQL twin, whether it can meet the targets or not
    sampled = mixing.sample_to_targets(table(spark, sf_dir, "documents"), share=mixing.SHARE)
    return sampled.select("row.doc_id", "cell.*", "n_tokens", F.round("probability", 9).alias("probability"))


@query()
def op7_decontamination(spark, sf_dir):
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), short_items=True)


@query()
def op8_token_counts(spark, sf_dir):
    return lengths.length_histogram(table(spark, sf_dir, "documents"))


_RULES_SQL = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in urls.RULES)


@query(
    rf"""
WITH rules(rh, rp, rv) AS (VALUES {_RULES_SQL}),
u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
p AS (SELECT page_id, translate(regexp_extract(r, '^[^/?#]*'), '{urls.UPPER}', '{urls.LOWER}') AS host,
             regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
f AS (SELECT page_id, rh || rp AS rule, rv,
             row_number() OVER (PARTITION BY page_id ORDER BY length(rh || rp) DESC, rh || rp DESC) AS k
      FROM p JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp))
SELECT p.page_id, host, path, rule, coalesce(rv, 'allow') AS verdict
FROM p LEFT JOIN f ON p.page_id = f.page_id AND k = 1
"""
)
def op9_url_filters(spark, sf_dir):
    rules = spark.createDataFrame(urls.RULES, urls.RULE_SCHEMA)
    return urls.judge_urls(table(spark, sf_dir, "pages"), rules)


@query()
def op10_quality_classifier(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    model = attention.fit_passage_classifier(documents, table(spark, sf_dir, "labels"))
    return attention.score_documents(documents, model)


@query()
def op12_best_fit_packing(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents"))


@query()
def op11_embedding_whitening(spark, sf_dir):
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


# Prefixes as lists of digests. The checksum of the id's digits goes bit by bit, as this engine has no such function.
_TRIE_SQL = r"""
WITH RECURSIVE t AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS i
  FROM conversations WHERE conv_id IS NOT NULL),
d AS (SELECT c, i, md5(length(role) || ':' || role || text) AS x, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS w FROM t),
crc(c, k, v) AS (
  SELECT DISTINCT c, 0, 4294967295 FROM d
  UNION ALL
  SELECT c, k + 1,
         CASE WHEN u & 1 = 1 THEN xor(u >> 1, 3988292384) ELSE u >> 1 END
  FROM (SELECT c, k, CASE WHEN k % 8 = 0 THEN xor(v, ascii(substr(CAST(c AS VARCHAR), k // 8 + 1, 1))) ELSE v END AS u
        FROM crc WHERE k < 8 * length(CAST(c AS VARCHAR)))),
h AS (SELECT c, xor(arg_max(v, k), 4294967295) % 4 AS h FROM crc GROUP BY c),
r AS (
  SELECT h.c, d.i AS pos, d.x, d.w FROM h JOIN d ON d.c = h.c - h.c % 20 AND d.i < h.h
  UNION ALL SELECT h.c, d.i + 1000000, d.x, d.w FROM h JOIN d ON d.c = h.c AND d.i >= h.h),
p AS (SELECT h.c, coalesce(list(x ORDER BY pos) FILTER (x IS NOT NULL), []) AS x, coalesce(list(w ORDER BY pos) FILTER (x IS NOT NULL), []) AS w
      FROM h LEFT JOIN r ON r.c = h.c GROUP BY h.c),
m AS (SELECT c, unnest(range(0, len(x) + 1)) AS d, x, w FROM p),
n AS (SELECT x[1 : d] AS node, d, min(c) AS conv, count(*) AS n, max(w[d]) AS w, count(*) FILTER (len(x) = d) AS e,
             string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (len(x) = d) AS ends
      FROM m GROUP BY x[1 : d], d),
k AS (SELECT node[1 : d - 1] AS node, d - 1 AS d, count(*) AS children FROM n WHERE d > 0 GROUP BY ALL),
f AS (SELECT n.*, coalesce(k.children, 0) AS children, (n.n - 1) * coalesce(n.w, 0) AS saved FROM n LEFT JOIN k USING (node, d)),
s AS (SELECT node[1 : u] AS node, u AS d, count(*) FILTER (children = 0) AS leaves, CAST(sum(saved) AS BIGINT) AS saved
      FROM (SELECT *, unnest(range(0, d + 1)) AS u FROM f) GROUP BY ALL)
SELECT f.conv AS conv_id, f.d AS depth, up.conv AS parent_conv_id, f.n AS n_convs, f.children AS n_children,
       s.leaves AS n_leaves, s.saved AS saved_tokens, sha256(coalesce(f.ends, '')) AS ends_sha256
FROM f JOIN s USING (node, d) LEFT JOIN n up ON up.d = f.d - 1 AND up.node = f.node[1 : f.d - 1]
"""


@query(_TRIE_SQL)
def op13_prefix_trie(spark, sf_dir):
    return trie.prefix_trie(table(spark, sf_dir, "conversations"))

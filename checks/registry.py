"""Every operator as a query over the given tables, with its SQL twin where one exists."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from advertlake.functions import text as X
from advertlake.functions.taxonomy import SKILLS, Taxonomy
from advertlake.operators import clean as C
from advertlake.operators import dictionary as D
from advertlake.operators import enrich as E
from advertlake.operators import history as H
from advertlake.operators import merge as M
from advertlake.operators import profile as P
from advertlake.operators import quality as Q
from advertlake.operators import share as A
from advertlake.operators import trend as R
from advertlake.operators.windows import keep_first, top_k
from advertlake.plans import pipeline, reports, warehouse
from advertlake.schema import CLEAN_SCHEMA, FLAGS_SCHEMA, HISTORY_KEY, HISTORY_SCHEMA
from advertlake.session import configure, scratch_path, stage
from advertlake.sources import buckets, dimensions, layers, pages, payloads, store
from advertlake.streaming import ingest
from checks import ads_view as V
from checks import sql as S

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def portable(df: DataFrame) -> DataFrame:
    """Dates and times as text, which every client renders alike."""
    as_text = {c: F.col(c).cast("string") for c, t in df.dtypes if t in ("date", "timestamp", "timestamp_ntz")}
    return df.withColumns(as_text) if as_text else df


def query(sql: str | None = None, name: str | None = None):
    def register(build: Query) -> Query:
        key = name or build.__name__

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return portable(build(configure(spark), sf_dir))

        QUERIES[key] = run
        if sql is not None:
            ORACLES[key] = sql.strip()
        return build

    return register


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = V.raw_ads(spark, sf_dir)
    return C.clean_ads(raw, ingested_at=V.INGESTED_AT, start_date=V.START_DATE)[0]


def flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.enrich_ads(cleaned(spark, sf_dir))


def weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.period_share(flagged(spark, sf_dir))


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    spread = cleaned(spark, sf_dir).withColumn(
        "snap", F.explode(F.expr("sequence(0, cast(cast(job_id as bigint) % 3 as int))"))
    )
    return spread.selectExpr(*[f"{S.SNAPSHOT_CHANGES.get(c, c)} AS {c}" for c in CLEAN_SCHEMA.names])


TEXT_COLUMNS = {"created_at", "ingested_at"}


def columns(names, source: str = "") -> str:
    return ", ".join(f"CAST({source}{c} AS VARCHAR) AS {c}" if c in TEXT_COLUMNS else f"{source}{c}" for c in names)


CLEAN_COLUMNS = columns(CLEAN_SCHEMA.names)
FLAG_COLUMNS = columns(FLAGS_SCHEMA.names)
WEEK_COLUMNS = "CAST(week AS VARCHAR) AS week, country, role_class, total_ads, ai_ads, ai_share"


def ctes(*parts: str) -> str:
    return "WITH " + ", ".join(parts) + "\n"


# -- cleaning ----------------------------------------------------------------------------------


@query(ctes(S.CLEAN) + f"SELECT {CLEAN_COLUMNS} FROM clean")
def clean_ads(spark, sf_dir):
    return cleaned(spark, sf_dir)


@query(ctes(S.CLEAN) + f"""
SELECT (SELECT count(*) FROM flat) AS input_rows,
  (SELECT count(*) FROM flat WHERE job_id IS NULL) AS missing_job_id_removed,
  (SELECT count(*) FROM ranked WHERE rn > 1) AS duplicates_removed,
  (SELECT count(*) FROM ranked WHERE rn = 1 AND created_at < TIMESTAMP '{V.START_DATE} 00:00:00') AS outside_date_window_removed,
  (SELECT count(*) FROM clean) AS output_rows""")
def cleaning_report(spark, sf_dir):
    raw = V.raw_ads(spark, sf_dir)
    return C.clean_ads(raw, ingested_at=V.INGESTED_AT, start_date=V.START_DATE)[1]


@query(ctes(S.CLEAN) + f"SELECT {columns(S.FLAT)} FROM flat")
def flatten_ads(spark, sf_dir):
    return C.flatten_ads(V.raw_ads(spark, sf_dir), ingested_at=V.INGESTED_AT)


@query(ctes(S.CLEAN) + f"SELECT {columns(S.FLAT)} FROM ranked WHERE rn = 1")
def deduplicated_ads(spark, sf_dir):
    raw = V.raw_ads(spark, sf_dir)
    return C.clean_ads(raw, ingested_at=V.INGESTED_AT)[0]


@query(ctes(S.CLEAN) + f"SELECT {CLEAN_COLUMNS} FROM clean WHERE country = 'gb'")
def country_subset(spark, sf_dir):
    return cleaned(spark, sf_dir).filter("country = 'gb'")


@query(ctes(S.CLEAN) + """
SELECT job_id, latitude, longitude, salary_max FROM clean
WHERE latitude IS NOT NULL AND longitude IS NOT NULL AND salary_max IS NOT NULL""")
def geo_complete_rows(spark, sf_dir):
    return P.geo_complete(cleaned(spark, sf_dir)).select("job_id", "latitude", "longitude", "salary_max")


@query(ctes(S.CLEAN) + """
SELECT job_id, salary_min, salary_max, salary_currency FROM clean
WHERE salary_min IS NOT NULL AND salary_max IS NOT NULL""")
def salary_complete_rows(spark, sf_dir):
    return P.salary_complete(cleaned(spark, sf_dir)).select(
        "job_id", "salary_min", "salary_max", "salary_currency"
    )


# -- sources -----------------------------------------------------------------------------------


def landed(spark: SparkSession, sf_dir: str, compression: str = "none") -> str:
    """Write the page payloads as a landing folder, one page per line, and return its path."""
    path = scratch_path(spark, "landing")
    layers.write_payloads(V.landed_pages(spark, sf_dir), path, compression=compression)
    return path


def parsed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.parse_pages(pages.read_payloads(spark, landed(spark, sf_dir)))


RAW_OUT = {
    **{c: c for c in ("id", "adref", "title", "description", "created", "salary_min", "salary_max",
                      "salary_is_predicted", "latitude", "contract_type", "country", "page")},
    "pos": "row_number() OVER (PARTITION BY country, page ORDER BY pos) - 1",
    "company_name": "company_name",
    "area_1": "CASE WHEN levels > 1 THEN area_1 END",
    "tag": "category_tag",
}


@query(ctes(S.RAW) + f"SELECT {S.select_list(RAW_OUT)} FROM raw")
def search_pages(spark, sf_dir):
    ads = pages.explode_ads(parsed_pages(spark, sf_dir))
    plain = [c for c in RAW_OUT if c not in ("company_name", "area_1", "tag")]
    return ads.select(
        *plain,
        F.col("company.display_name").alias("company_name"),
        F.get("location.area", F.lit(1)).alias("area_1"),
        F.col("category.tag").alias("tag"),
    )


@query(ctes(S.RAW) + """
SELECT country, page, row_number() OVER (PARTITION BY country, page ORDER BY pos) - 1 AS pos, id, title FROM raw""")
def archived_pages(spark, sf_dir):
    # The archive form wraps pages in one document; here each document wraps ten pages of a country.
    page = V.landed_pages(spark, sf_dir).withColumn("no", F.get_json_object("value", "$.page").cast("int"))
    wrapped = page.groupBy("ingest_date", "country", F.floor(F.col("no") / 10).alias("part")).agg(
        F.concat(
            F.lit('{"responses":['),
            F.concat_ws(",", F.transform(F.sort_array(F.collect_list(F.struct("no", "value"))), lambda x: x["value"])),
            F.lit("]}"),
        ).alias("value")
    )
    path = scratch_path(spark, "archive")
    layers.write_payloads(wrapped, path)
    ads = pages.explode_ads(pages.parse_pages(pages.read_payloads(spark, path)))
    return ads.select("country", "page", "pos", "id", "title")


# Every page number that leaves the rest 1 or 2 by 7 arrives broken: its list of results is a text, or its body no
# document. A country's empty last page counts too.
@query(ctes(S.RAW) + """
SELECT country, CASE WHEN page % 2 = 0 THEN 'no results' ELSE 'not a document' END AS reason, count(*) AS n
FROM (SELECT country, page FROM raw UNION SELECT country, max(page) + 1 FROM raw GROUP BY 1)
WHERE page % 7 IN (1, 2) GROUP BY 1, 2""")
def archived_pages_rejects(spark, sf_dir):
    page = V.landed_pages(spark, sf_dir).withColumn("no", F.get_json_object("value", "$.page").cast("int"))
    full = page.filter(F.get_json_object("value", "$.results").isNotNull())
    broken = (F.col("no") % 7).isin(1, 2)
    body = F.when(broken & (F.col("no") % 2 == 0), F.concat(F.lit('{"page":'), F.col("no").cast("string"), F.lit(',"results":"oops"}')))
    single = full.filter(broken & (F.col("no") % 2 == 1)).withColumn("value", F.concat(F.lit('{"page": broken '), F.substring("value", 1, 200)))
    wrapped = (
        full.filter(~(broken & (F.col("no") % 2 == 1)))
        .withColumn("value", F.coalesce(body, "value"))
        .groupBy("ingest_date", "country", F.floor(F.col("no") / 10).alias("part"))
        .agg(F.concat(F.lit('{"responses":['), F.concat_ws(",", F.collect_list("value")), F.lit("]}")).alias("value"))
    )
    path = scratch_path(spark, "archive")
    layers.write_payloads(wrapped.drop("part").unionByName(single.select("ingest_date", "country", "value")), path)
    found = pages.read_documents(pages.read_payloads(spark, path))
    return pages.reject_counts(pages.rejects(found), ["country"])


PAGE_SIZES = """, adverts AS (
  SELECT country, page, count(*) AS n FROM raw GROUP BY 1, 2
), sizes AS (
  SELECT country, page, n FROM adverts UNION ALL SELECT country, max(page) + 1, 0 FROM adverts GROUP BY 1
), totals AS (
  SELECT *, sum(n) OVER (PARTITION BY country ORDER BY page) AS fetched,
    (sum(n) OVER (PARTITION BY country)) // 2 AS advertised FROM sizes
), stops AS (
  SELECT country, coalesce(min(page) FILTER (n = 0 OR (advertised > 0 AND fetched >= advertised)), max(page)) AS last_page
  FROM totals GROUP BY 1
)"""


@query("WITH " + S.RAW + PAGE_SIZES + """
SELECT country, page, n, CAST(fetched AS BIGINT) AS fetched FROM totals JOIN stops USING (country) WHERE page <= last_page""")
def page_cutoff(spark, sf_dir):
    # Half of the adverts are advertised, so reading stops in the middle.
    half = parsed_pages(spark, sf_dir).withColumn("count", F.expr("count div 2"))
    return read_sizes(pages.cut_pages(half))


def read_sizes(kept: DataFrame) -> DataFrame:
    sizes = kept.select("country", "page", F.greatest(F.size("results"), F.lit(0)).cast("long").alias("n"))
    return pages.running_total(sizes, by=["country"], position="page", value="n", output="fetched")


@query("WITH " + S.RAW + PAGE_SIZES + """
SELECT country, page, n, CAST(fetched AS BIGINT) AS fetched FROM totals JOIN stops USING (country) WHERE page <= last_page""")
def page_cutoff_retried(spark, sf_dir):
    # Every third page landed twice, as after a retry: nothing may change.
    payloads = pages.read_payloads(spark, landed(spark, sf_dir))
    retried = payloads.unionByName(payloads.filter(F.get_json_object("value", "$.page").cast("int") % 3 == 1))
    half = pages.parse_pages(retried).withColumn("count", F.expr("count div 2"))
    return read_sizes(pages.cut_pages(half))


@query("WITH " + S.RAW + PAGE_SIZES + """
SELECT country, count(*) AS pages, CAST(sum(n) AS BIGINT) AS fetched, CAST(max(advertised) AS BIGINT) AS advertised,
  sum(n) >= max(advertised) AS complete
FROM totals JOIN stops USING (country) WHERE page <= last_page GROUP BY country""")
def page_audit(spark, sf_dir):
    half = parsed_pages(spark, sf_dir).withColumn("count", F.expr("count div 2"))
    return pages.page_audit(half).drop("ingest_date")


@query("WITH " + S.RAW + PAGE_SIZES + """
SELECT country, count(*) AS pages, CAST(sum(n) AS BIGINT) AS ads FROM sizes GROUP BY country""")
def extraction_counters(spark, sf_dir):
    return pages.extraction_counters(parsed_pages(spark, sf_dir)).drop("ingest_date")


def history_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One payload per event type, in the three shapes a history comes in; a payload has one entry per day."""
    per_day = (
        V.table(spark, sf_dir, "events")
        .groupBy("event_type", F.date_format("ts", "yyyy-MM-dd").alias("day"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    entry = (
        F.when(F.col("event_type") == "click", F.format_string('"%s":{"count":%d}', "day", "n"))
        .when(F.col("event_type") == "view", F.format_string('"%s":%d', "day", "n"))
        .otherwise(F.format_string('["%s",{"count":%d}]', "day", "n"))
    )
    body = F.concat_ws(",", F.sort_array(F.collect_list(entry)))
    is_map = F.col("event_type").isin("click", "view")
    text = F.when(is_map, F.concat(F.lit('{"history":{'), body, F.lit("}}"))).otherwise(
        F.concat(F.lit('{"history":['), body, F.lit("]}"))
    )
    return per_day.groupBy("event_type").agg(text.alias("value")).withColumnRenamed("event_type", "country")


HISTORY_SQL = """SELECT event_type AS country, strftime(ts, '%Y-%m-%d') AS day, count(*) AS count,
  CASE WHEN event_type = 'view' THEN NULL ELSE concat('{"count":', count(*), '}') END AS details_json
FROM events GROUP BY 1, 2"""


@query(HISTORY_SQL)
def history_normalised(spark, sf_dir):
    return pages.normalise_history(history_payloads(spark, sf_dir))


@query("""SELECT event_type AS country, CASE event_type WHEN 'click' THEN 'not a document' WHEN 'view' THEN 'no history' ELSE 'no day' END AS reason,
  CASE WHEN event_type IN ('click', 'view') THEN 1 ELSE count(DISTINCT strftime(ts, '%Y-%m-%d')) END AS n FROM events GROUP BY event_type""")
def history_rejects(spark, sf_dir):
    # The same payloads, damaged: cut off, without their history, or with numbers in place of the pairs.
    good = history_payloads(spark, sf_dir)
    bad = good.withColumn(
        "value",
        F.when(F.col("country") == "click", F.substring("value", 1, 30))
        .when(F.col("country") == "view", F.regexp_replace("value", '^."history"', '{"other"'))
        .otherwise(F.regexp_replace("value", r'\["[0-9-]+",(.*?)\}\]', "7")),
    )
    return pages.history_rejects(bad).groupBy("country", "reason").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH h AS ({HISTORY_SQL}) SELECT day, CAST(sum(count) AS BIGINT) AS total FROM h GROUP BY day")
def history_daily_total(spark, sf_dir):
    return P.daily_total(pages.normalise_history(history_payloads(spark, sf_dir)))


@query(ctes(S.RAW) + """
SELECT id, concat('{"display_name":', coalesce('"' || company_name || '"', 'null'), '}') AS company,
  CASE levels WHEN 3 THEN concat('{"area":["', area_0, '","', area_1, '","', area_2, '"],"display_name":"', area_2, '"}')
              WHEN 2 THEN concat('{"area":["', area_0, '","', area_1, '"],"display_name":"', area_2, '"}') END AS location,
  salary_min, country, page FROM raw""")
def raw_rows_flat(spark, sf_dir):
    flat = pages.flatten_nested_to_json(V.raw_ads(spark, sf_dir))
    return flat.select("id", "company", "location", "salary_min", "country", "page")


@query(ctes(S.CLEAN) + f"SELECT {CLEAN_COLUMNS} FROM clean")
def master_csv_round_trip(spark, sf_dir):
    path = scratch_path(spark, "master-csv")
    layers.write_csv(cleaned(spark, sf_dir), path)
    return layers.read_csv(spark, path)


# -- text and roles ----------------------------------------------------------------------------

# A dictionary of phrases that are frequent in the given texts, with terms that contain others.
CORPUS = Taxonomy(
    {
        "phrases": ["of the", "and the", "the of the", "for the"],
        "words": ["the", "of", "and", "for"],
        "romance": ["de la", "de", "la", "por el", "ai"],
        "german": ["der die", "der", "die", "ich"],
    },
    {"phrases": "n_phrases", "words": "n_words", "romance": "n_romance", "german": "n_german"},
    "corpus-1",
)


def _normal_query(table: str, key: list[str], column: str) -> None:
    keys = ", ".join(key)
    norm = S.normalized(column)

    @query(f"WITH n AS (SELECT {keys}, {norm} AS norm FROM {table}) "
           f"SELECT {keys}, length(norm) AS chars, md5(norm) AS digest FROM n", f"normalized_{table}")
    def normal(spark, sf_dir):
        text = V.table(spark, sf_dir, table).select(*key, X.normalize_text(F.col(column)).alias("norm"))
        return text.select(*key, F.length("norm").cast("long").alias("chars"), F.md5("norm").alias("digest"))

    groups = ", ".join(f"{S.in_group('hits', CORPUS.groups[g])} AS {c}" for g, c in CORPUS.columns.items())

    @query(f"WITH n AS (SELECT {keys}, {norm} AS norm FROM {table}), h AS (SELECT *, {S.hits('norm', CORPUS)} AS hits FROM n) "
           f"SELECT {keys}, len(hits) > 0 AS mentioned, CAST(len(hits) AS BIGINT) AS total, {groups} FROM h",
           f"term_hits_{table}")
    def matched(spark, sf_dir):
        scanned = E.with_hits(V.table(spark, sf_dir, table), F.col(column), CORPUS)
        hits = F.col("hits")
        return scanned.select(
            *key,
            X.mentioned(hits).alias("mentioned"),
            X.total_mentions(hits).alias("total"),
            *[X.group_mentions(hits, g, CORPUS).alias(c) for g, c in CORPUS.columns.items()],
        )

    @query(f"WITH n AS (SELECT {norm} AS norm FROM {table}), h AS (SELECT unnest({S.hits('norm', CORPUS)}) AS term FROM n) "
           "SELECT term, count(*) AS mentions FROM h GROUP BY term", f"term_counts_{table}")
    def counted(spark, sf_dir):
        return E.term_counts(V.table(spark, sf_dir, table), text=F.col(column), taxonomy=CORPUS)


_normal_query("documents", ["doc_id"], "text")
_normal_query("pages", ["page_id"], "html")
_normal_query("conversations", ["conv_id", "turn"], "text")


@query(ctes(S.FLAGS) + f"SELECT {FLAG_COLUMNS} FROM flags")
def enriched_ads(spark, sf_dir):
    return flagged(spark, sf_dir)


@query(ctes(S.FLAGS) + "SELECT job_id, country, category_tag, title, role_class FROM flags")
def role_classes(spark, sf_dir):
    return E.add_role_class(cleaned(spark, sf_dir)).select(
        "job_id", "country", "category_tag", "title", "role_class"
    )


@query(ctes(S.FLAGS) + """, terms AS (SELECT job_id, country, unnest(hits) AS term FROM flags)
SELECT job_id, country, term, count(*) AS n FROM terms GROUP BY 1, 2, 3""")
def skill_matches(spark, sf_dir):
    scanned = E.with_hits(cleaned(spark, sf_dir), E.advert_text())
    match = scanned.select("job_id", "country", X.skill_match(F.col("hits")).alias("m"))
    return match.select("job_id", "country", F.explode_outer("m.terms").alias("term", "n")).filter("term is not null")


@query(ctes(S.FLAGS) + "SELECT job_id, country, ai_total_mentions, created_at::VARCHAR AS created_at FROM flags WHERE ai_mentioned")
def flagged_ads(spark, sf_dir):
    # The stored flags are filtered: a filter on the scan itself would be pushed below it and scan every text twice.
    counted = flagged(spark, sf_dir).select("job_id", "country", "ai_mentioned", "ai_total_mentions", "created_at")
    return stage(counted, "flags").filter("ai_mentioned").drop("ai_mentioned")


TERMS = ctes(S.FLAGS) + ", terms AS (SELECT country, unnest(hits) AS term FROM flags)\n"


@query(TERMS + "SELECT term, count(*) AS mentions FROM terms GROUP BY term")
def term_counts(spark, sf_dir):
    return E.term_counts(cleaned(spark, sf_dir))


@query(TERMS + "SELECT term, count(*) AS mentions FROM terms GROUP BY term")
def dictionary_term_counts(spark, sf_dir):
    # The same hits by way of word n-grams that meet the dictionary as a table.
    dictionary = D.prepared_dictionary(SKILLS.table(spark))
    ads = cleaned(spark, sf_dir).select("job_id", "country", X.normalize_text(E.advert_text()).alias("norm"))
    hits = D.dictionary_hits(ads, dictionary, key=["job_id", "country"], text=F.col("norm"))
    return hits.groupBy("term").agg(F.count(F.lit(1)).alias("mentions"))


_GROUP_OF = " ".join(f"WHEN '{t}' THEN '{g}'" for g, ts in SKILLS.groups.items() for t in ts)


@query(TERMS + f"SELECT term, count(*) AS mentions, CASE term {_GROUP_OF} END AS term_group FROM terms GROUP BY term")
def term_counts_with_group(spark, sf_dir):
    return E.with_group(E.term_counts(cleaned(spark, sf_dir)))


@query(TERMS + """, counted AS (SELECT country, term, count(*) AS mentions FROM terms GROUP BY 1, 2)
SELECT country, term, mentions FROM counted
QUALIFY row_number() OVER (PARTITION BY country ORDER BY mentions DESC, term) <= 10""")
def top_terms_by_country(spark, sf_dir):
    counted = E.term_counts(cleaned(spark, sf_dir), by=["country"])
    return top_k(counted, 10, [F.desc("mentions"), "term"], by=["country"])


@query(ctes(S.FLAGS) + f""", texts AS (SELECT {S.normalized("description")} AS norm FROM flags WHERE ai_mentioned),
terms AS (SELECT unnest({S.hits("norm")}) AS term FROM texts)
SELECT term, count(*) AS mentions FROM terms GROUP BY term ORDER BY mentions DESC, term LIMIT 15""")
def top_terms_of_flagged(spark, sf_dir):
    flags = stage(flagged(spark, sf_dir).select("description", "ai_mentioned"), "flags")
    counts = E.term_counts(flags.filter("ai_mentioned"), text=F.col("description"))
    return top_k(counts, 15, [F.desc("mentions"), "term"])


# -- shares ------------------------------------------------------------------------------------


@query(ctes(S.WEEKLY) + f"SELECT {WEEK_COLUMNS} FROM weekly")
def weekly_share(spark, sf_dir):
    return weekly(spark, sf_dir)


@query(ctes(S.WEEKLY) + f"SELECT {WEEK_COLUMNS} FROM weekly")
def weekly_share_joined(spark, sf_dir):
    clean = stage(cleaned(spark, sf_dir), "clean")
    return warehouse.share_weekly(clean, stage(E.enrich_ads(clean), "flags"))


@query(ctes(S.WEEKLY) + f"SELECT {WEEK_COLUMNS}, 0 AS shuffles FROM weekly")
def weekly_share_bucketed(spark, sf_dir):
    # Facts and flags in equal buckets of the snapshot key; the flags come twice, first all false.
    fact_path, flags_path = scratch_path(spark, "fact-buckets"), scratch_path(spark, "flag-buckets")
    flags = stage(flagged(spark, sf_dir), "flags")
    facts = flags.select("job_id", "country", "ingest_date", "created_at")
    flags = flags.select("job_id", "country", "ingest_date", "role_class", "ai_mentioned")
    buckets.save_buckets(facts, fact_path, buckets=8)
    for batch in (flags.withColumn("ai_mentioned", F.lit(False)), flags):
        buckets.save_buckets(batch, flags_path, buckets=8)
    joined = buckets.join_buckets(buckets.read_buckets(spark, fact_path), buckets.read_buckets(spark, flags_path))
    return A.period_share(joined).withColumn("shuffles", F.lit(buckets.shuffles_below_join(joined)))


@query(ctes(S.FLAGS) + """
SELECT concat(CAST(date_trunc('week', created_at) AS DATE), '/', CAST(date_trunc('week', created_at) AS DATE) + 6) AS week,
  country, role_class, count(job_id) AS total_ads, count(*) FILTER (ai_mentioned) AS ai_ads,
  count(*) FILTER (ai_mentioned) / count(job_id)::DOUBLE AS ai_share
FROM flags WHERE created_at IS NOT NULL GROUP BY 1, 2, 3""")
def weekly_share_labelled(spark, sf_dir):
    return A.weekly_share(flagged(spark, sf_dir))


@query(ctes(S.WEEKLY) + f"SELECT {WEEK_COLUMNS} FROM weekly WHERE week = (SELECT max(week) FROM weekly)")
def latest_share(spark, sf_dir):
    return A.latest_share(flagged(spark, sf_dir))


SKILL_COUNTS = """SELECT country, role_class, CAST(sum(ai_general_ai) AS BIGINT) AS {a}, CAST(sum(ai_machine_learning) AS BIGINT) AS {b},
  CAST(sum(ai_ml_tools) AS BIGINT) AS {c}, CAST(sum(ai_generative_ai) AS BIGINT) AS {d}, count(*) AS ads
FROM flags GROUP BY country, role_class"""


@query(ctes(S.FLAGS) + SKILL_COUNTS.format(a="general_ai_mentions", b="machine_learning_mentions",
                                           c="ml_tools_mentions", d="generative_ai_mentions"))
def skill_counts_view(spark, sf_dir):
    return A.group_counts(flagged(spark, sf_dir))


@query(ctes(S.FLAGS) + SKILL_COUNTS.format(a="ai_general_ai", b="ai_machine_learning", c="ai_ml_tools", d="ai_generative_ai"))
def skill_counts(spark, sf_dir):
    return A.skill_counts(flagged(spark, sf_dir))


@query(ctes(S.FLAGS) + """
SELECT count(*) FILTER (ai_mentioned) AS flagged, count(*) AS total,
  round(avg(CASE WHEN ai_mentioned THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 9) AS rate FROM flags""")
def flag_rate(spark, sf_dir):
    return A.flag_rate(flagged(spark, sf_dir)).withColumn("rate", F.round("rate", 9))


@query(ctes(S.WEEKLY) + """
SELECT country, role_class, round(sum(ai_ads) / sum(total_ads)::DOUBLE, 9) AS weighted_share,
  round(avg(ai_share), 9) AS mean_share, CAST(sum(total_ads) AS BIGINT) AS total_ads FROM weekly GROUP BY 1, 2""")
def window_share(spark, sf_dir):
    out = A.window_share(weekly(spark, sf_dir))
    return out.withColumns({c: F.round(c, 9) for c in ("weighted_share", "mean_share")})


GAP = """SELECT CAST(week AS VARCHAR) AS week, country, max(ai_share) FILTER (role_class = 'technical') AS high_share,
  max(ai_share) FILTER (role_class = 'non-technical') AS low_share,
  round(max(ai_share) FILTER (role_class = 'technical') - max(ai_share) FILTER (role_class = 'non-technical'), 9) AS gap
FROM weekly GROUP BY 1, 2"""


@query(ctes(S.WEEKLY) + GAP)
def technical_gap(spark, sf_dir):
    return A.class_gap(weekly(spark, sf_dir)).withColumn("gap", F.round("gap", 9))


@query(ctes(S.WEEKLY) + """, placed AS (
  SELECT *, row_number() OVER (PARTITION BY country, role_class ORDER BY week) AS a,
    row_number() OVER (PARTITION BY country, role_class ORDER BY week DESC) AS z FROM weekly WHERE week IS NOT NULL
)
SELECT country, role_class, round(avg(ai_share) FILTER (a <= 4), 9) AS early_mean, round(avg(ai_share) FILTER (z <= 4), 9) AS late_mean,
  round(avg(ai_share) FILTER (z <= 4) - avg(ai_share) FILTER (a <= 4), 9) AS rise FROM placed GROUP BY 1, 2""")
def edge_means(spark, sf_dir):
    out = A.edge_means(weekly(spark, sf_dir))
    return out.withColumns({c: F.round(c, 9) for c in ("early_mean", "late_mean", "rise")})


@query("""SELECT CAST(date_trunc('day', ts) AS DATE)::VARCHAR AS day, user_id, count(*) AS total_ads,
  count(*) FILTER (event_type = 'error') AS ai_ads,
  round(avg(CASE WHEN event_type = 'error' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 4) AS ai_share
FROM events GROUP BY 1, 2""")
def event_share_by_day(spark, sf_dir):
    events = V.table(spark, sf_dir, "events").withColumn("is_error", F.col("event_type") == "error")
    return A.period_share(events, ts="ts", flag="is_error", by=["user_id"], period="day")


# Every document that carries a label, by language: the label is the flag.
LABEL_SQL = """SELECT d.lang, d.source, count(*) AS docs, count(*) FILTER (l.toxic = 1) AS flagged
FROM documents d JOIN labels l USING (doc_id) GROUP BY 1, 2"""


@query(LABEL_SQL)
def labelled_flags(spark, sf_dir):
    docs = V.table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    labels = V.table(spark, sf_dir, "labels").withColumn("flag", F.col("toxic") == 1)
    joined = E.join_flags(docs, labels, columns=["flag"], key=["doc_id"])
    return joined.groupBy("lang", "source").agg(
        F.count(F.lit(1)).alias("docs"), F.count_if("flag").alias("flagged")
    )


@query(ctes(S.WEEKLY) + f"SELECT {WEEK_COLUMNS} FROM weekly WHERE week IS NOT NULL ORDER BY week DESC, country DESC, role_class DESC LIMIT 8")
def last_weekly_rows(spark, sf_dir):
    dated = weekly(spark, sf_dir).filter("week is not null")
    return top_k(dated, 8, [F.desc("week"), F.desc("country"), F.desc("role_class")])


# -- trend -------------------------------------------------------------------------------------


@query(ctes(S.WEEKLY, S.trend("weekly", "country, role_class", "week", "ai_share")) + "SELECT * FROM trend")
def share_trend(spark, sf_dir):
    return R.linear_trend(weekly(spark, sf_dir))


@query(ctes(S.WEEKLY, S.trend("weekly", "country, role_class", "week", "ai_share", 36)) + "SELECT * FROM trend")
def share_trend_too_short(spark, sf_dir):
    return R.linear_trend(weekly(spark, sf_dir), min_points=36)


@query(ctes(S.WEEKLY, S.trend("weekly", "country, role_class", "week", "ai_share"))
       + "SELECT verdict, count(*) AS series FROM trend GROUP BY verdict")
def verdict_tally(spark, sf_dir):
    return R.verdict_tally(R.linear_trend(weekly(spark, sf_dir)))


ORDER_SHARE = """shares AS (
  SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, o_orderpriority,
    round(avg(CASE WHEN o_orderstatus = 'F' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 4) AS ai_share
  FROM orders GROUP BY 1, 2
)"""


@query(ctes(ORDER_SHARE, S.trend("shares", "o_orderpriority", "month", "ai_share")) + "SELECT * FROM trend")
def order_trend(spark, sf_dir):
    orders = V.table(spark, sf_dir, "orders").withColumn("is_f", F.col("o_orderstatus") == "F")
    share = A.period_share(orders, ts="o_orderdate", flag="is_f", by=["o_orderpriority"], period="month")
    return R.linear_trend(share, by=["o_orderpriority"], t="month")


@query(ctes(S.WEEKLY) + """SELECT CAST(week AS VARCHAR) AS week, country, role_class, ai_share,
  row_number() OVER (PARTITION BY country, role_class ORDER BY week) - 1 AS x FROM weekly WHERE week IS NOT NULL""")
def series_index(spark, sf_dir):
    series = weekly(spark, sf_dir).filter("week is not null").drop("total_ads", "ai_ads")
    return R.series_index(series, ["country", "role_class"], "week").withColumn("x", F.col("x").cast("long"))


# -- quality -----------------------------------------------------------------------------------

# The battery looks at the clean table and at the flattened rows before de-duplication, where it fails.


def _quality_sql(source: str) -> str:
    return ctes(S.CLEAN) + f""", s AS (
  SELECT count(*) AS n, (SELECT coalesce(sum(k - 1), 0) FROM (SELECT count(*) AS k FROM {source} GROUP BY job_id, country, ingest_date)) AS dupes,
    count(*) FILTER (job_id IS NULL) AS no_id, count(*) FILTER (created_at < TIMESTAMP '{V.START_DATE} 00:00:00') AS early,
    count(*) FILTER (created_at > TIMESTAMP '{V.NOW}') AS future, count(*) FILTER (salary_min > salary_max) AS inverted,
    count(*) FILTER (abs(latitude) > 90) AS lat, count(*) FILTER (abs(longitude) > 180) AS lon,
    count(*) FILTER (title IS NULL) AS no_title, count(*) FILTER (created_at IS NULL) AS no_created
  FROM {source}
)
SELECT 1 AS position, 'schema_columns' AS name, 'PASS' AS status, '25 columns; missing=none' AS detail
UNION ALL SELECT 3, 'duplicate_snapshots', if(dupes > 0, 'FAIL', 'PASS'), concat(dupes, ' duplicate (job_id, country, ingest_date) rows') FROM s
UNION ALL SELECT 4, 'missing_job_id', if(no_id > 0, 'FAIL', 'PASS'), concat(no_id, ' rows without a job_id') FROM s
UNION ALL SELECT 5, 'created_window', if(early > 0, 'WARN', 'PASS'), concat(early, ' rows created before {V.START_DATE}') FROM s
UNION ALL SELECT 6, 'future_dates', if(future > 0, 'WARN', 'PASS'), concat(future, ' rows created in the future') FROM s
UNION ALL SELECT 7, 'salary_order', if(inverted > 0, 'WARN', 'PASS'), concat(inverted, ' rows where salary_min > salary_max') FROM s
UNION ALL SELECT 8, 'coordinates', if(lat + lon > 0, 'FAIL', 'PASS'), concat(lat, ' bad latitudes, ', lon, ' bad longitudes') FROM s
UNION ALL SELECT 9, 'null_title', if(no_title > 0, 'WARN', 'PASS'), printf('null rate %.1f%%', no_title * 100.0 / n) FROM s
UNION ALL SELECT 10, 'null_created_at', if(no_created > 0, 'WARN', 'PASS'), printf('null rate %.1f%%', no_created * 100.0 / n) FROM s"""


@query(_quality_sql("clean"))
def quality_checks(spark, sf_dir):
    return Q.quality_checks(cleaned(spark, sf_dir), now=V.NOW, start_date=V.START_DATE)[0]


@query(ctes(S.CLEAN) + """SELECT 1 AS position, 'schema_columns' AS name, 'FAIL' AS status, '25 columns; missing=[''title'']' AS detail
FROM clean LIMIT 1""")
def quality_missing_column(spark, sf_dir):
    renamed = cleaned(spark, sf_dir).withColumnRenamed("title", "headline")
    checks, _ = Q.quality_checks(renamed, now=V.NOW, start_date=V.START_DATE)
    return checks.filter("position = 1")


@query("""SELECT CAST(position AS INT) AS position, name, status, detail FROM (VALUES (1, 'schema_columns', 'PASS', '25 columns; missing=none'),
  (2, 'row_count', 'WARN', 'dataset is empty; nothing to validate')) v(position, name, status, detail), (SELECT count(*) AS n FROM documents) WHERE n > 0""")
def quality_empty_table(spark, sf_dir):
    nothing = cleaned(spark, sf_dir).filter("job_id = 'none such'")
    return Q.quality_checks(nothing, now=V.NOW, start_date=V.START_DATE)[0]


@query(ctes(S.CLEAN) + """SELECT count(*) FILTER (abs(latitude) > 90 OR abs(longitude) > 180) > 0 AS stopped,
  count(*) FILTER (abs(latitude) <= 90) > 0 AS loaded FROM clean""")
def quality_gate(spark, sf_dir):
    clean = stage(cleaned(spark, sf_dir), "clean")

    def stops(rows: DataFrame) -> bool:
        try:
            Q.assert_quality(Q.quality_checks(rows, now=V.NOW, start_date=V.START_DATE)[0])
        except Q.QualityError:
            return True
        return False

    sound = clean.filter("abs(latitude) <= 90")
    return spark.createDataFrame([(stops(clean), not stops(sound))], "stopped boolean, loaded boolean")


@query(_quality_sql("flat"))
def quality_checks_unclean(spark, sf_dir):
    flat = C.flatten_ads(V.raw_ads(spark, sf_dir), ingested_at=V.INGESTED_AT)
    return Q.quality_checks(flat, now=V.NOW, start_date=V.START_DATE)[0]


@query(ctes(S.CLEAN) + """SELECT count(*) > 0 AND count(*) FILTER (abs(latitude) > 90 OR abs(longitude) > 180) = 0 AS passed FROM clean""")
def quality_passed(spark, sf_dir):
    checks, _ = Q.quality_checks(cleaned(spark, sf_dir), now=V.NOW, start_date=V.START_DATE)
    return Q.quality_passed(checks)


_NULLS = "\nUNION ALL ".join(
    f"SELECT '{c}' AS \"column\", round(avg(CASE WHEN {c} IS NULL THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 9) AS null_rate FROM clean"
    for c in CLEAN_SCHEMA.names
)


@query(ctes(S.CLEAN) + _NULLS)
def null_summary(spark, sf_dir):
    return Q.null_rates(cleaned(spark, sf_dir)).withColumn("null_rate", F.round("null_rate", 9))


# -- profiling ---------------------------------------------------------------------------------


@query(ctes(S.SNAPSHOTS) + "SELECT job_id, country, count(*) AS snapshots FROM snapshots GROUP BY 1, 2 HAVING count(*) > 1")
def repeated_ads(spark, sf_dir):
    return P.repeated_ads(snapshots(spark, sf_dir))


COUNTED = {"category_label": 12, "contract_time": 12, "contract_type": 12, "company_name": 15, "location_display_name": 15}
_COUNTS = "\nUNION ALL ".join(
    f"""(SELECT '{c}' AS "column", {c} AS value, count(*) AS n FROM clean GROUP BY {c} ORDER BY n DESC, {c} ASC NULLS LAST LIMIT {k})"""
    for c, k in COUNTED.items()
)


@query(ctes(S.CLEAN) + _COUNTS)
def value_counts(spark, sf_dir):
    return P.value_counts(cleaned(spark, sf_dir), list(COUNTED), COUNTED)


def _describe_sql(source: str, names: list[str], where: str = "true") -> str:
    return "\nUNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS n, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, min({c}) AS min,
  round(quantile_cont({c}, 0.25), 4) AS p25, round(quantile_cont({c}, 0.5), 4) AS p50, round(quantile_cont({c}, 0.75), 4) AS p75,
  max({c}) AS max FROM {source} WHERE {where}"""
        for c in names
    )


def _rounded(df: DataFrame, names: list[str], digits: int = 4) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in names})


DESCRIBED = ["mean", "std", "p25", "p50", "p75"]


@query(ctes(S.CLEAN) + _describe_sql("clean", ["salary_min", "salary_max"], "salary_min IS NOT NULL AND salary_max IS NOT NULL"))
def salary_describe(spark, sf_dir):
    salaries = P.salary_complete(cleaned(spark, sf_dir).select("salary_min", "salary_max"))
    return _rounded(P.describe(salaries, ["salary_min", "salary_max"]), DESCRIBED)


@query(_describe_sql("lineitem", ["l_quantity", "l_extendedprice", "l_discount"]))
def lineitem_describe(spark, sf_dir):
    return _rounded(P.describe(V.table(spark, sf_dir, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"]), DESCRIBED)


@query("""SELECT c AS "column", q AS quartile, true AS within FROM (VALUES ('l_quantity'), ('l_extendedprice')) a(c),
  (VALUES ('p25'), ('p50'), ('p75')) b(q)""")
def lineitem_describe_approximate(spark, sf_dir):
    # Approximate quartiles depend on the engine; that their ranks lie within the stated accuracy does not.
    names = ["l_quantity", "l_extendedprice"]
    items = V.table(spark, sf_dir, "lineitem").select(*names)
    found = P.describe(items, names, approximate=True).select("column", "p25", "p50", "p75")
    wanted = stage(found.unpivot(["column"], ["p25", "p50", "p75"], "quartile", "estimate"), "estimates")
    values = P.unpivot_numbers(items, names)
    ranks = values.join(F.broadcast(wanted), "column").groupBy("column", "quartile").agg(  # six rows
        F.count_if(F.col("value") < F.col("estimate")).alias("below"),
        F.count_if(F.col("value") <= F.col("estimate")).alias("upto"),
        F.count(F.lit(1)).alias("n"),
    )
    share = F.substring("quartile", 2, 2).cast("int") / 100
    slack = F.col("n") / P.ACCURACY + 1
    return ranks.select("column", "quartile", (
        (F.col("below") <= share * F.col("n") + slack) & (F.col("upto") >= share * F.col("n") - slack)
    ).alias("within"))


def _histogram_sql(source: str, value: str) -> str:
    return f"""v AS (SELECT {value} AS v FROM {source} WHERE {value} IS NOT NULL),
b AS (SELECT min(v) AS lo, max(v) AS hi, (max(v) - min(v)) / 40 AS w FROM v),
near AS (SELECT v, lo, w, least(floor((v - lo) / (hi - lo) * 40), 39) AS i FROM v, b),
placed AS (SELECT CASE WHEN v < lo + i * w THEN i - 1 WHEN v >= lo + (i + 1) * w AND i < 39 THEN i + 1 ELSE i END AS i FROM near),
k AS (SELECT CAST(i + 1 AS BIGINT) AS bin, count(*) AS n FROM placed GROUP BY 1)
SELECT i AS bin, round(lo + (i - 1) * w, 6) AS low, round(lo + i * w, 6) AS high, coalesce(k.n, 0) AS n
FROM (SELECT unnest(range(1, 41)) AS i) e CROSS JOIN b LEFT JOIN k ON k.bin = i"""


@query(ctes(S.CLEAN, "sal AS (SELECT * FROM clean WHERE salary_min IS NOT NULL AND salary_max IS NOT NULL)",
            _histogram_sql("sal", "salary_min")))
def salary_histogram(spark, sf_dir):
    salaries = P.salary_complete(cleaned(spark, sf_dir).select("salary_min", "salary_max"))
    return _rounded(P.histogram(salaries, F.col("salary_min")), ["low", "high"], 6)


@query(ctes(S.CLEAN, "sal AS (SELECT * FROM clean WHERE salary_min IS NOT NULL AND salary_max IS NOT NULL)",
            _histogram_sql("sal", "ln(1 + salary_max)")))
def salary_log_histogram(spark, sf_dir):
    salaries = P.salary_complete(cleaned(spark, sf_dir).select("salary_min", "salary_max"))
    return _rounded(P.histogram(salaries, F.log1p("salary_max")), ["low", "high"], 6)


@query(ctes(_histogram_sql("lineitem", "l_extendedprice")))
def price_histogram(spark, sf_dir):
    return _rounded(P.histogram(V.table(spark, sf_dir, "lineitem"), F.col("l_extendedprice")), ["low", "high"], 6)


@query(ctes(S.CLEAN) + """SELECT CAST(CAST(created_at AS DATE) AS VARCHAR) AS day, count(*) AS ads FROM clean
WHERE created_at IS NOT NULL GROUP BY 1""")
def daily_timeline(spark, sf_dir):
    return P.timeline(cleaned(spark, sf_dir))


@query(ctes(S.CLEAN) + """SELECT CAST(min(created_at) AS VARCHAR) AS first, CAST(max(created_at) AS VARCHAR) AS last FROM clean""")
def created_range(spark, sf_dir):
    return P.time_range(cleaned(spark, sf_dir))


def _box_sql(source: str, by: str, value: str) -> str:
    return f"""q AS (SELECT {by}, count(*) AS n, quantile_cont({value}, 0.25) AS q1, quantile_cont({value}, 0.5) AS median,
  quantile_cont({value}, 0.75) AS q3 FROM {source} WHERE {value} IS NOT NULL GROUP BY 1)
SELECT q.{by}, any_value(n) AS n, round(any_value(q1), 4) AS q1, round(any_value(median), 4) AS median, round(any_value(q3), 4) AS q3,
  round(least(min({value}), any_value(q1)), 4) AS whisker_low, round(greatest(max({value}), any_value(q3)), 4) AS whisker_high
FROM q JOIN {source} s ON s.{by} IS NOT DISTINCT FROM q.{by}
  AND s.{value} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)
GROUP BY q.{by}"""


BOXED = ["q1", "median", "q3", "whisker_low", "whisker_high"]


@query(ctes(S.CLEAN, """top AS (SELECT category_label FROM clean WHERE category_label IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 8),
sub AS (SELECT * FROM clean WHERE category_label IN (SELECT category_label FROM top))""", _box_sql("sub", "category_label", "salary_max")))
def salary_box_by_category(spark, sf_dir):
    clean = stage(cleaned(spark, sf_dir).select("category_label", "salary_max"), "box")
    sub = P.rows_of_top_values(clean, "category_label", 8)
    return _rounded(P.box_stats(sub, by="category_label", value="salary_max"), BOXED)


@query(ctes(S.CLEAN, _box_sql("clean", "contract_time", "salary_max")))
def salary_box_by_contract(spark, sf_dir):
    clean = cleaned(spark, sf_dir).select("contract_time", "salary_max")
    return _rounded(P.box_stats(clean, by="contract_time", value="salary_max"), BOXED)


@query(ctes(_box_sql("lineitem", "l_returnflag", "l_extendedprice")))
def price_box_by_flag(spark, sf_dir):
    return _rounded(P.box_stats(V.table(spark, sf_dir, "lineitem"), by="l_returnflag", value="l_extendedprice"), BOXED)


@query(ctes(S.CLEAN, """top AS (SELECT category_label FROM clean WHERE category_label IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 8)""")
       + "SELECT job_id, country, category_label FROM clean WHERE category_label IN (SELECT category_label FROM top)")
def rows_of_top_categories(spark, sf_dir):
    clean = cleaned(spark, sf_dir).select("job_id", "country", "category_label")
    return P.rows_of_top_values(clean, "category_label", 8)


@query(ctes(S.CLEAN) + "SELECT count(*) FILTER (salary_is_predicted) AS predicted FROM clean")
def predicted_salaries(spark, sf_dir):
    return P.predicted_salaries(cleaned(spark, sf_dir))


@query(ctes(S.SNAPSHOTS) + "SELECT count(*) FILTER (salary_min > salary_max) AS inverted FROM snapshots")
def inverted_salaries(spark, sf_dir):
    return P.inverted_salaries(snapshots(spark, sf_dir))


@query(ctes(S.SNAPSHOTS) + "SELECT DISTINCT ingest_date FROM snapshots")
def ingest_dates(spark, sf_dir):
    return P.distinct_values(snapshots(spark, sf_dir), "ingest_date")


@query(ctes(S.SNAPSHOTS) + "SELECT count(*) AS n FROM snapshots")
def snapshot_count(spark, sf_dir):
    return P.table_count(snapshots(spark, sf_dir))


@query(ctes(S.FLAGS) + """SELECT job_id, country, ingest_date, role_class, title, substr(description, 1, 180) AS snippet FROM flags
WHERE ai_mentioned ORDER BY md5(concat_ws(chr(31), job_id, country, ingest_date, '1')), job_id, country LIMIT 5""")
def flagged_sample(spark, sf_dir):
    return P.sample_flagged(flagged(spark, sf_dir))


# -- exports -----------------------------------------------------------------------------------


def frames(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    clean = stage(cleaned(spark, sf_dir), "clean")
    return warehouse.export_frames(clean, stage(E.enrich_ads(clean), "flags"))


@query(ctes(S.WEEKLY) + f"SELECT {WEEK_COLUMNS} FROM weekly ORDER BY week, country, role_class")
def export_share_weekly(spark, sf_dir):
    return frames(spark, sf_dir)["ai_share_weekly"]


@query(ctes(S.WEEKLY) + f"SELECT {WEEK_COLUMNS} FROM weekly WHERE week = (SELECT max(week) FROM weekly) ORDER BY ai_share DESC")
def export_share_latest(spark, sf_dir):
    return frames(spark, sf_dir)["ai_share_latest"]


@query(ctes(S.FLAGS) + SKILL_COUNTS.format(a="general_ai_mentions", b="machine_learning_mentions",
                                           c="ml_tools_mentions", d="generative_ai_mentions") + " ORDER BY ads DESC")
def export_skill_counts(spark, sf_dir):
    return frames(spark, sf_dir)["ai_skill_counts"]


def _cell(c: str) -> str:
    """A double as cell text: whole numbers without a fraction."""
    return f"coalesce(CASE WHEN {c} = floor({c}) THEN CAST(CAST({c} AS BIGINT) AS VARCHAR) ELSE CAST({c} AS VARCHAR) END, '')"


@query(ctes(S.CLEAN) + f"""SELECT job_id, coalesce(title, '') AS title, {_cell("salary_min")} AS salary_min, {_cell("salary_max")} AS salary_max,
  {_cell("latitude")} AS latitude, coalesce(company_name, '') AS company_name,
  CASE WHEN salary_is_predicted THEN 'True' ELSE 'False' END AS salary_is_predicted FROM clean""")
def cells(spark, sf_dir):
    picked = cleaned(spark, sf_dir).select(
        "job_id", "title", "salary_min", "salary_max", "latitude", "company_name", "salary_is_predicted"
    )
    return layers.to_cells(picked)


@query(ctes(S.WEEKLY) + f"""SELECT coalesce(CAST(week AS VARCHAR), '') AS week, country, role_class, CAST(total_ads AS VARCHAR) AS total_ads,
  CAST(ai_ads AS VARCHAR) AS ai_ads, {_cell("ai_share")} AS ai_share FROM weekly""")
def exported_table(spark, sf_dir):
    path = scratch_path(spark, "export")
    share = stage(weekly(spark, sf_dir), "weekly")
    layers.export_table(share.limit(0), path)
    layers.export_table(share, path)
    text = T.StructType([T.StructField(c, T.StringType()) for c in share.columns])
    back = spark.read.schema(text).option("header", "true").csv(path)
    return back.select([F.coalesce(F.col(c), F.lit("")).alias(c) for c in back.columns])


@query(ctes(S.WEEKLY) + f"""SELECT coalesce(CAST(week AS VARCHAR), '') AS week, country, role_class, CAST(total_ads AS VARCHAR) AS total_ads,
  CAST(ai_ads AS VARCHAR) AS ai_ads, {_cell("ai_share")} AS ai_share FROM weekly""")
def exported_table_appended(spark, sf_dir):
    # Replaced with the rows of one country, then appended with the other's; the appended file has no header.
    path = scratch_path(spark, "export")
    share = stage(weekly(spark, sf_dir), "weekly")
    layers.export_table(share.filter("country = 'gb'"), path)
    layers.export_table(share.filter("country <> 'gb'"), path, replace=False)
    text = T.StructType([T.StructField(c, T.StringType()) for c in share.columns])
    lines = spark.read.schema(text).csv(path).filter("country <> 'country'")
    return lines.select([F.coalesce(F.col(c), F.lit("")).alias(c) for c in lines.columns])


@query(ctes(S.WEEKLY) + f"""SELECT {WEEK_COLUMNS} FROM weekly ORDER BY week NULLS FIRST, country, role_class LIMIT 10""")
def export_preview_rows(spark, sf_dir):
    return layers.preview(frames(spark, sf_dir))["ai_share_weekly"][1]


@query(ctes(S.WEEKLY) + """, c AS (SELECT country, role_class, count(*) AS n FROM flags GROUP BY 1, 2)
SELECT 'ai_share_weekly' AS name, (SELECT count(*) FROM weekly) AS rows, 6 AS columns
UNION ALL SELECT 'ai_share_latest', (SELECT count(*) FROM weekly WHERE week = (SELECT max(week) FROM weekly)), 6
UNION ALL SELECT 'ai_skill_counts', (SELECT count(*) FROM c), 7""")
def export_preview(spark, sf_dir):
    shapes = None
    for shape, _ in layers.preview(frames(spark, sf_dir)).values():
        shapes = shape if shapes is None else shapes.unionByName(shape)
    return shapes


@query(ctes(S.FLAGS) + f"SELECT {FLAG_COLUMNS} FROM flags")
def analysis_files(spark, sf_dir):
    flags = stage(flagged(spark, sf_dir), "flags")
    root = scratch_path(spark, "analysis")
    written = layers.write_analysis(flags, {"ai_skill_counts": A.group_counts(flags)}, root, "20260903")
    return layers.read_csv(spark, written[0], FLAGS_SCHEMA)


# -- stored layers and merges ------------------------------------------------------------------


@query(ctes(S.CLEAN) + f"SELECT {CLEAN_COLUMNS} FROM clean")
def clean_delta_layer(spark, sf_dir):
    root = scratch_path(spark, "layers")
    clean = stage(cleaned(spark, sf_dir), "clean")
    layers.write_clean_delta(clean, root)
    layers.write_clean_delta(clean.filter("country = 'gb'"), root)  # a rerun of one country
    return layers.read_clean_delta(spark, root)


@query(ctes(S.RAW) + """SELECT country, page, row_number() OVER (PARTITION BY country, page ORDER BY pos) - 1 AS pos, id, title,
  md5(description) AS digest FROM raw""")
def raw_payload_layer(spark, sf_dir):
    payloads = pages.read_payloads(spark, landed(spark, sf_dir))
    path = scratch_path(spark, "raw")
    # landed indented: breaks between the parts of a document must not split it
    layers.write_payloads(payloads.withColumn("value", F.regexp_replace("value", '^[{]"count"', '{\n  "count"')), path)
    ads = pages.explode_ads(pages.parse_pages(pages.read_payloads(spark, path)))
    return ads.select("country", "page", "pos", "id", "title", F.md5("description").alias("digest"))


@query(HISTORY_SQL)
def history_delta_layer(spark, sf_dir):
    root = scratch_path(spark, "history-layer")
    history = stage(pages.normalise_history(history_payloads(spark, sf_dir)), "history")
    for _ in range(2):  # a rerun replaces the folders of its day
        layers.write_history_delta(history, root, V.INGEST_DATE)
    back = layers.read_table(spark, f"{root}/{layers.CLEAN_HISTORY}", T.StructType([*HISTORY_SCHEMA, T.StructField("ingest_date", T.StringType())]))
    return back.filter(F.col("ingest_date") == V.INGEST_DATE).drop("ingest_date")


@query(ctes(S.RAW) + """
SELECT country, CAST(count(DISTINCT page) + 1 AS BIGINT) AS pages, 0 AS new_again, true AS unaltered FROM raw GROUP BY 1""")
def payload_store(spark, sf_dir):
    # Landed files go to the store of payloads twice; the pages are read back from its bytes.
    landing, root = landed(spark, sf_dir), scratch_path(spark, "payloads")
    first = payloads.store_payloads(spark, landing, root)
    again = payloads.store_payloads(spark, landing, root)
    stored = payloads.stored_payloads(spark, root)
    lines = stored.select("country", F.explode(F.split(F.col("content").cast("string"), "\n")).alias("line")).filter("line <> ''")
    unaltered = first > 0 and payloads.altered(stored).isEmpty()
    counts = lines.groupBy("country").agg(F.count_if(F.get_json_object("line", "$.results").isNotNull()).alias("pages"))
    return counts.withColumns({"new_again": F.lit(again), "unaltered": F.lit(unaltered)})


@query(ctes(S.SNAPSHOTS) + f"""
SELECT {columns(["job_id", "country", "ingest_date", "created_at"])}, true AS few_files FROM snapshots
WHERE created_at >= TIMESTAMP '2026-03-02' AND created_at < TIMESTAMP '2026-03-09'""")
def master_week(spark, sf_dir):
    # One week of a master whose files hold ranges of the date: the rows stand in a part of the files.
    path = scratch_path(spark, "clustered")
    days = stage(snapshots(spark, sf_dir), "days")
    n = store.save_replaced(spark, path, days, schema=CLEAN_SCHEMA, file_rows=max(1, days.count() // 96))
    master = store.read_keyed(spark, path, CLEAN_SCHEMA)
    week = master.filter("created_at >= TIMESTAMP '2026-03-02' AND created_at < TIMESTAMP '2026-03-09'")
    read = week.select(F.input_file_name().alias("f")).distinct().count()
    few = n > 0 and 4 * read <= len(master.inputFiles())
    return week.select("job_id", "country", "ingest_date", "created_at").withColumn("few_files", F.lit(few))


MASTER_SQL = ctes(S.SNAPSHOTS) + f"SELECT {CLEAN_COLUMNS} FROM snapshots"


@query(MASTER_SQL)
def jobs_master(spark, sf_dir):
    path = scratch_path(spark, "master")
    days = stage(snapshots(spark, sf_dir), "days")
    for day in ("2026-09-01", "2026-09-02", "2026-09-03", "2026-09-02"):  # one day comes twice
        store.save_replaced(spark, path, days.filter(F.col("ingest_date") == day), schema=CLEAN_SCHEMA)
    return store.read_keyed(spark, path, CLEAN_SCHEMA)


@query(ctes(S.SNAPSHOTS) + "SELECT job_id, CASE WHEN country = 'us' THEN '' ELSE country END AS country, ingest_date, title FROM snapshots")
def master_blank_country(spark, sf_dir):
    # Adverts without a country arrive in two batches of one day, each batch twice.
    path = scratch_path(spark, "blank-master")
    days = snapshots(spark, sf_dir).withColumn("country", F.when(F.col("country") == "us", "").otherwise(F.col("country")))
    days = stage(days, "days")
    odd = F.col("job_id").cast("bigint") % 2 == 1
    for batch in (days.filter(odd), days.filter(~odd), days.filter(odd), days.filter(~odd)):
        store.save_replaced(spark, path, batch, schema=CLEAN_SCHEMA)
    return store.read_keyed(spark, path, CLEAN_SCHEMA).select("job_id", "country", "ingest_date", "title")


VERSION_COLUMNS = columns(["job_id", "country", "ingest_date", "created_at", "salary_max"])


@query(ctes(S.SNAPSHOTS) + f"""
SELECT 'before' AS reader, {VERSION_COLUMNS} FROM snapshots WHERE ingest_date <= '2026-09-02'
UNION ALL SELECT 'after', {VERSION_COLUMNS.replace("salary_max", "CASE WHEN ingest_date = '2026-09-02' THEN salary_max + 1000 ELSE salary_max END AS salary_max")}
FROM snapshots WHERE ingest_date <= '2026-09-02'""")
def published_versions(spark, sf_dir):
    # Two loads, one that is lost before its switch, and a correction: a frame made before it still reads what it saw,
    # a later one the corrected rows, and neither the lost load.
    path = scratch_path(spark, "published")
    days = stage(snapshots(spark, sf_dir), "days")
    spec = {"schema": CLEAN_SCHEMA, "retain": 1}
    for day in ("2026-09-01", "2026-09-02"):
        store.save_replaced(spark, path, days.filter(F.col("ingest_date") == day), **spec)
    lost = store.with_folders(days.filter("ingest_date = '2026-09-03'"), ["ingest_date", "country"])
    lost.write.partitionBy("_f_ingest_date", "_f_country").parquet(f"{path}/data/{store.VERSION}=lost")
    before = store.read_keyed(spark, path, CLEAN_SCHEMA)
    store.save_replaced(spark, path, correction(days), **spec)
    after = store.read_keyed(spark, path, CLEAN_SCHEMA)
    both = before.withColumn("reader", F.lit("before")).unionByName(after.withColumn("reader", F.lit("after")))
    return both.select("reader", "job_id", "country", "ingest_date", "created_at", "salary_max")


@query(HISTORY_SQL)
def history_master(spark, sf_dir):
    path = scratch_path(spark, "history")
    history = stage(pages.normalise_history(history_payloads(spark, sf_dir)), "history")
    stale = history.withColumn("count", F.col("count") - 1)
    for batch in (stale, history, history):
        store.save_replaced(
            spark, path, batch, schema=HISTORY_SCHEMA, key=HISTORY_KEY, partitions=("country",),
            sort=("day",), keep_last_of=("count", "details_json"),
        )
    return store.read_keyed(spark, path, HISTORY_SCHEMA, ("country",))


# A later batch sends the second day again with raised salaries.
CORRECTED = ctes(S.SNAPSHOTS) + f"""SELECT {CLEAN_COLUMNS.replace("salary_max,", "CASE WHEN ingest_date = '2026-09-02' THEN salary_max + 1000 ELSE salary_max END AS salary_max,")} FROM snapshots"""


def correction(days: DataFrame) -> DataFrame:
    return days.filter("ingest_date = '2026-09-02'").withColumn("salary_max", F.col("salary_max") + 1000)


@query(CORRECTED)
def merge_keep_last(spark, sf_dir):
    days = stage(snapshots(spark, sf_dir), "days")
    return M.merge_keep_last(days, correction(days))


@query(CORRECTED)
def replace_by_key(spark, sf_dir):
    days = stage(snapshots(spark, sf_dir), "days")
    return M.replace_by_key(days, correction(days))


@query(ctes(S.SNAPSHOTS) + """SELECT job_id, country, max(ingest_date) AS ingest_date, arg_max(title, ingest_date) AS title
FROM (SELECT job_id, country, ingest_date, coalesce(title, '') AS title FROM snapshots) GROUP BY 1, 2""")
def keep_last_snapshot(spark, sf_dir):
    days = snapshots(spark, sf_dir).select("job_id", "country", "ingest_date", F.coalesce("title", F.lit("")).alias("title"))
    return keep_first(days, ["job_id", "country"], [F.desc("ingest_date")])


@query(ctes(S.SNAPSHOTS) + """SELECT job_id, country, ingest_date, CAST(created_at AS VARCHAR) AS created_at FROM snapshots
ORDER BY ingest_date, created_at ASC NULLS LAST, job_id""")
def master_order(spark, sf_dir):
    days = snapshots(spark, sf_dir).select("job_id", "country", "ingest_date", "created_at")
    return M.master_sorted(days)


@query(ctes(S.SNAPSHOTS) + """SELECT DISTINCT ingest_date, country FROM snapshots WHERE ingest_date > '2026-09-02'""")
def pending_partitions(spark, sf_dir):
    folders = snapshots(spark, sf_dir).select("ingest_date", "country").distinct()
    loaded = folders.filter("ingest_date <= '2026-09-02'")
    return M.not_loaded(folders, loaded)


@query(MASTER_SQL)
def incremental_load(spark, sf_dir):
    root = scratch_path(spark, "incremental")
    days = stage(snapshots(spark, sf_dir), "days")
    spec = (f"{root}/table", f"{root}/ledger")
    for known in ("2026-09-01", "2026-09-03", "2026-09-03"):
        deltas = days.filter(F.col("ingest_date") <= known)
        store.load_pending(spark, deltas, *spec, schema=CLEAN_SCHEMA)
    return store.read_keyed(spark, spec[0], CLEAN_SCHEMA)


def loaded_warehouse(spark: SparkSession, sf_dir: str) -> warehouse.Warehouse:
    clean = stage(cleaned(spark, sf_dir), "clean")
    flags = stage(E.enrich_ads(clean), "flags")
    store_ = warehouse.Warehouse(spark, scratch_path(spark, "warehouse"))
    for _ in range(2):  # loading twice equals loading once
        store_.upsert_jobs(clean)
        store_.upsert_analysis(flags)
    return store_


@query(ctes(S.WEEKLY) + f"SELECT {WEEK_COLUMNS} FROM weekly")
def warehouse_duplicate_batch(spark, sf_dir):
    # Each batch holds every key twice; the copy loaded later has the true title.
    clean = stage(cleaned(spark, sf_dir), "clean")
    older = clean.withColumns({"ingested_at": F.col("ingested_at") - F.expr("INTERVAL 1 DAY"), "title": F.lit("Data Scientist")})
    store_ = warehouse.Warehouse(spark, scratch_path(spark, "warehouse"))
    flags = stage(E.enrich_ads(clean), "flags")
    for _ in range(2):
        store_.upsert_jobs(older.unionByName(clean))
        store_.upsert_analysis(flags.unionByName(flags))
    return store_.query(f"SELECT * FROM {warehouse.WEEKLY_VIEW}")


@query(ctes(S.WEEKLY) + f"SELECT {WEEK_COLUMNS} FROM weekly")
def warehouse_weekly_view(spark, sf_dir):
    return loaded_warehouse(spark, sf_dir).query(f"SELECT * FROM {warehouse.WEEKLY_VIEW}")


@query(ctes(S.FLAGS) + f"SELECT {FLAG_COLUMNS} FROM flags")
def warehouse_flags_table(spark, sf_dir):
    return loaded_warehouse(spark, sf_dir).table(warehouse.FLAGS_TABLE)


@query(ctes(S.FLAGS) + """SELECT country, role_class, count(*) AS ads, round(avg(salary_max), 4) AS mean_salary
FROM clean JOIN flags USING (job_id, country, ingest_date) GROUP BY 1, 2""")
def warehouse_sql(spark, sf_dir):
    return loaded_warehouse(spark, sf_dir).query(
        f"SELECT country, role_class, count(*) AS ads, round(avg(salary_max), 4) AS mean_salary"
        f" FROM {warehouse.FACT_TABLE} JOIN {warehouse.FLAGS_TABLE} USING (job_id, country, ingest_date) GROUP BY 1, 2"
    )


# Every snapshot with the flags of its advert.
FLAGGED_DAYS = S.FLAGS + ", " + S.SNAPSHOTS[len(S.CLEAN) + 2 :] + """, days AS (
  SELECT s.country, s.ingest_date, s.salary_min, s.salary_max, CAST(date_trunc('week', f.created_at) AS DATE) AS week, f.* EXCLUDE (country, ingest_date)
  FROM snapshots s JOIN flags f ON s.job_id = f.job_id AND s.country = f.country
)"""


def flagged_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = snapshots(spark, sf_dir).select("job_id", "country", "ingest_date", "salary_min", "salary_max")
    flags = flagged(spark, sf_dir).drop("ingest_date", "title", "description", "category_tag", "category_label")
    return stage(days.join(flags, ["job_id", "country"]), "flagged-days")


def loaded_reports(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """States of three days that were loaded one by one, the second first with wrong flags; and the rows themselves."""
    days, path = flagged_days(spark, sf_dir), scratch_path(spark, "report-states")
    of = lambda day: days.filter(F.col("ingest_date") == day)
    wrong = of("2026-09-02").withColumns({"ai_mentioned": ~F.col("ai_mentioned"), "salary_max": F.col("salary_max") * 3})
    for batch in (of("2026-09-01"), wrong, of("2026-09-03"), of("2026-09-02")):
        reports.refresh(spark, path, batch)
    return reports.read_states(spark, path), days


@query("WITH " + FLAGGED_DAYS + """
SELECT CAST(week AS VARCHAR) AS week, country, role_class, count(*) AS total_ads, count(*) FILTER (ai_mentioned) AS ai_ads,
  round(count(*) FILTER (ai_mentioned) / count(*)::DOUBLE, 4) AS ai_share FROM days GROUP BY 1, 2, 3""")
def incremental_weekly_share(spark, sf_dir):
    return reports.weekly_share(loaded_reports(spark, sf_dir)[0])


@query("WITH " + FLAGGED_DAYS + f"""
SELECT country, role_class, {", ".join(f"CAST(sum({c}) AS BIGINT) AS {g}_mentions" for g, c in SKILLS.columns.items())}, count(*) AS ads
FROM days GROUP BY 1, 2""")
def incremental_group_counts(spark, sf_dir):
    return reports.group_counts(loaded_reports(spark, sf_dir)[0])


@query("WITH " + FLAGGED_DAYS + """
SELECT country, role_class, measure, share, count(*) AS n, true AS within
FROM (SELECT country, role_class, unnest(['salary_min', 'salary_max']) AS measure, unnest([salary_min, salary_max]) AS value FROM days),
     (SELECT unnest([0.25, 0.5, 0.75]::DOUBLE[]) AS share)
WHERE value IS NOT NULL GROUP BY ALL""")
def incremental_salary_quantiles(spark, sf_dir):
    # The merged sketches' values, and whether their ranks among all values are as close as promised.
    states, days = loaded_reports(spark, sf_dir)
    got = reports.quantiles(states, [0.25, 0.5, 0.75])
    each = F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).alias("v")) for m in reports.MEASURES])
    values = days.select("country", "role_class", F.inline(each)).filter("v IS NOT NULL")
    met = values.join(got, ["country", "role_class", "measure"])
    ranks = met.groupBy("country", "role_class", "measure", "share", "n").agg(
        F.count_if(F.col("v") < F.col("value")).alias("below"), F.count_if(F.col("v") <= F.col("value")).alias("upto")
    )
    slack = F.lit(reports.RANK_ERROR) * F.col("n") + 1
    within = (F.col("below") - slack <= F.col("share") * F.col("n")) & (F.col("share") * F.col("n") <= F.col("upto") + slack)
    return ranks.select("country", "role_class", "measure", "share", "n", within.alias("within"))


@query(ctes(S.WEEKLY) + f"SELECT {WEEK_COLUMNS} FROM weekly")
def full_run(spark, sf_dir):
    root = scratch_path(spark, "run")
    pipeline.run_pipeline(
        spark,
        search_path=landed(spark, sf_dir, "snappy"),
        root=root,
        ingested_at=datetime(2026, 9, 3, 12, tzinfo=timezone.utc),
        warehouse_root=f"{root}/warehouse",
        start_date=V.START_DATE,
        now=datetime(2026, 7, 1, tzinfo=timezone.utc),
    )
    return warehouse.Warehouse(spark, f"{root}/warehouse").query(f"SELECT * FROM {warehouse.WEEKLY_VIEW}")


# -- history dimensions ------------------------------------------------------------------------


def _versions_sql(dimension: H.Dimension) -> str:
    keys = ", ".join(dimension.key)
    tracked = "".join(f", {c}" for c in dimension.tracked)
    state = "row(" + (", ".join(dimension.tracked) or "0") + ")"
    present = " AND ".join(f"{k} IS NOT NULL" for k in dimension.key)
    digest = ", ".join(f"CAST({k} AS VARCHAR)" for k in (*dimension.key, "valid_from"))
    return f"""states AS (
  SELECT {keys}, ingest_date{tracked} FROM snapshots WHERE {present}
  QUALIFY row_number() OVER (PARTITION BY {keys}, ingest_date ORDER BY job_id DESC) = 1
), marked AS (
  SELECT *, lag({state}) OVER w AS prior, row_number() OVER w AS k FROM states WINDOW w AS (PARTITION BY {keys} ORDER BY ingest_date)
), starts AS (
  SELECT *, ingest_date AS valid_from FROM marked WHERE k = 1 OR prior IS DISTINCT FROM {state}
), versions AS (
  SELECT {keys}{tracked}, valid_from, lead(valid_from) OVER (PARTITION BY {keys} ORDER BY valid_from) AS valid_to FROM starts
), {dimension.name} AS (
  SELECT sha256(concat_ws(chr(31), {digest})) AS version_id, *, valid_to IS NULL AS is_current FROM versions
)"""


def _register_dimension(dimension: H.Dimension) -> None:
    sql = ctes(S.SNAPSHOTS, _versions_sql(dimension)) + f"SELECT * FROM {dimension.name}"

    @query(sql, f"dimension_{dimension.name}")
    def whole(spark, sf_dir):
        return H.build_dimension(snapshots(spark, sf_dir), dimension)

    kept = ctes(S.SNAPSHOTS, _versions_sql(dimension)) + f"SELECT *, true AS others_kept FROM {dimension.name}"

    @query(kept, f"dimension_{dimension.name}_stored")
    def stored(spark, sf_dir):
        # Three days, one by one, and the last of them again. Files of segments that a load does not name must stay.
        path, others_kept = scratch_path(spark, "dimension"), True
        days = stage(snapshots(spark, sf_dir), "days")
        for day in ("2026-09-01", "2026-09-02", "2026-09-03", "2026-09-03"):
            before = store.current(spark, path).folders
            written = dimensions.load_snapshots(spark, path, days.filter(F.col("ingest_date") == day), dimension)
            after = store.current(spark, path).folders
            others_kept &= all(after.get(f) == v for f, v in before.items() if f[0] not in written)
            others_kept &= day != "2026-09-03" or before != after or not written
        table = dimensions.read_dimension(spark, path, dimensions.stored_schema(days, dimension))
        return table.withColumn("others_kept", F.lit(others_kept))

    @query(sql, f"dimension_{dimension.name}_incremental")
    def stepwise(spark, sf_dir):
        days = stage(snapshots(spark, sf_dir), "days")
        dim = H.build_dimension(days.filter("ingest_date = '2026-09-01'"), dimension)
        for last, day in (("2026-09-01", "2026-09-02"), ("2026-09-02", "2026-09-03")):
            fresh = days.filter(F.col("ingest_date") == day)
            dim = H.extend_dimension(stage(dim, "dim"), fresh, dimension, loaded_until=last)
        return dim


for _dimension in H.DIMENSIONS:
    _register_dimension(_dimension)


@query(ctes(S.SNAPSHOTS) + """, span AS (SELECT min(ingest_date)::DATE AS lo, max(ingest_date)::DATE AS hi FROM snapshots),
days AS (SELECT unnest(generate_series(lo, hi, INTERVAL 1 DAY))::DATE AS d FROM span)
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_id, CAST(d AS VARCHAR) AS day, CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
  CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day_of_month, CAST(isodow(d) AS INTEGER) AS iso_weekday,
  CAST(CAST(date_trunc('week', d) AS DATE) AS VARCHAR) AS week FROM days""")
def dimension_date(spark, sf_dir):
    return H.date_dimension(snapshots(spark, sf_dir))


def _dimension_sql(name: str) -> str:
    dimension = next(d for d in H.DIMENSIONS if d.name == name)
    return ctes(S.SNAPSHOTS, _versions_sql(dimension)) + f"SELECT * FROM {name}"


@query(_dimension_sql("job"))
def dimension_job_late_day(spark, sf_dir):
    # The days arrive as first, third, second: the second lies before versions that are open already.
    days = stage(snapshots(spark, sf_dir), "days")
    of = lambda day: days.filter(F.col("ingest_date") == day)
    job = next(d for d in H.DIMENSIONS if d.name == "job")
    path = scratch_path(spark, "dimension")
    for day in ("2026-09-01", "2026-09-03"):
        dimensions.load_snapshots(spark, path, of(day), job)
    dimensions.load_snapshots(spark, path, of("2026-09-02"), job, snapshots=days.filter("ingest_date <> '2026-09-02'"))
    return dimensions.read_dimension(spark, path, dimensions.stored_schema(days, job))


@query(_dimension_sql("category"))
def dimension_category_rerun(spark, sf_dir):
    # The last day is first loaded with other labels, then sent again as it should be.
    days = stage(snapshots(spark, sf_dir), "days")
    category = next(d for d in H.DIMENSIONS if d.name == "category")
    last = days.filter("ingest_date = '2026-09-03'")
    wrong = last.withColumn("category_label", F.concat("category_label", F.lit("?")))
    path = scratch_path(spark, "dimension")
    for batch in (days.filter("ingest_date < '2026-09-03'"), wrong, last):
        dimensions.load_snapshots(spark, path, batch, category)
    return dimensions.read_dimension(spark, path, dimensions.stored_schema(days, category))


_FACT_DIMENSIONS = list(H.DIMENSIONS)
_JOINED = "\n".join(
    f"LEFT JOIN {d.name} ON " + " AND ".join(f"s.{k} = {d.name}.{k}" for k in d.key)
    + f" AND {d.name}.valid_from <= s.ingest_date AND ({d.name}.valid_to IS NULL OR s.ingest_date < {d.name}.valid_to)"
    for d in _FACT_DIMENSIONS
)


def _prefixed(dimension: H.Dimension) -> str:
    text = _versions_sql(dimension)
    for part in ("states", "marked", "starts", "versions"):
        text = text.replace(f"{part} AS (", f"{part}_{dimension.name} AS (").replace(f"FROM {part}", f"FROM {part}_{dimension.name}")
    return text


@query(ctes(S.SNAPSHOTS, *[_prefixed(d) for d in _FACT_DIMENSIONS]) + f"""
SELECT s.job_id, s.country, s.ingest_date, CAST(replace(s.ingest_date, '-', '') AS INTEGER) AS date_id,
  {", ".join(f"{d.name}.version_id AS {d.name}_version" for d in _FACT_DIMENSIONS)}, s.salary_min, s.salary_max
FROM snapshots s {_JOINED}""")
def snapshot_fact(spark, sf_dir):
    days = stage(snapshots(spark, sf_dir), "days")
    tables = {d.name: H.build_dimension(days, d) for d in _FACT_DIMENSIONS}
    return H.snapshot_fact(days, tables)


# -- streams -----------------------------------------------------------------------------------


def delta_folder(spark: SparkSession, sf_dir: str) -> str:
    root = scratch_path(spark, "deltas")
    layers.write_clean_delta(snapshots(spark, sf_dir), root)
    return f"{root}/{layers.CLEAN_JOBS}"


@query(MASTER_SQL)
def stream_ingest(spark, sf_dir):
    root = scratch_path(spark, "stream")
    deltas = ingest.read_deltas(spark, delta_folder(spark, sf_dir), files_per_batch=8)
    ingest.stream_into_table(deltas, f"{root}/table", f"{root}/checkpoint").awaitTermination()
    return store.read_keyed(spark, f"{root}/table", CLEAN_SCHEMA)


@query(ctes(S.CLEAN) + "SELECT DISTINCT trim(id) AS job_id, country, true AS arrived FROM raw WHERE trim(id) <> ''")
def stream_distinct(spark, sf_dir):
    # The rows before de-duplication, so adverts that were sent twice arrive twice.
    landing = scratch_path(spark, "arrivals")
    flat = C.flatten_ads(V.raw_ads(spark, sf_dir), ingested_at=V.INGESTED_AT).filter(C.has_id())
    flat.write.parquet(landing)
    root = scratch_path(spark, "distinct")
    arrivals = ingest.read_deltas(spark, landing)
    rows = ingest.distinct_snapshots(arrivals).select(*CLEAN_SCHEMA.names)
    ingest.append_rows(rows, f"{root}/rows", f"{root}/checkpoint").awaitTermination()
    kept = spark.read.schema(CLEAN_SCHEMA).parquet(f"{root}/rows")
    # Which copy comes first is not stated, but it must be one that arrived, whole.
    sent = spark.read.schema(CLEAN_SCHEMA).parquet(landing).select("job_id", "country", F.xxhash64(*CLEAN_SCHEMA.names).alias("h"))
    known = kept.select("job_id", "country", F.xxhash64(*CLEAN_SCHEMA.names).alias("h")).join(
        sent.distinct().withColumn("there", F.lit(True)), ["job_id", "country", "h"], "left"
    )
    return known.select("job_id", "country", F.coalesce("there", F.lit(False)).alias("arrived"))


@query(ctes(S.WEEKLY) + f"SELECT {WEEK_COLUMNS} FROM weekly WHERE week IS NOT NULL")
def stream_weekly_share(spark, sf_dir):
    landing, root = scratch_path(spark, "flags-landing"), scratch_path(spark, "weekly-stream")
    flagged(spark, sf_dir).drop("description").write.parquet(landing)
    arrivals = ingest.read_deltas(spark, landing, T.StructType([f for f in FLAGS_SCHEMA if f.name != "description"]))
    share = ingest.weekly_share_stream(arrivals, delay="400 days")
    key = ["week", "country", "role_class"]
    ingest.append_updates(share, f"{root}/updates", f"{root}/checkpoint", key=key).awaitTermination()
    return ingest.latest_updates(spark, f"{root}/updates", share.schema, key=key)


@query("""SELECT CAST(CAST(date_trunc('week', ts) AS DATE) AS VARCHAR) AS week, event_type, count(*) AS total_ads,
  count(*) FILTER (value > 10) AS ai_ads, round(count(*) FILTER (value > 10) / count(*)::DOUBLE, 4) AS ai_share
FROM events GROUP BY 1, 2""")
def stream_event_share(spark, sf_dir):
    root = scratch_path(spark, "event-stream")
    events = V.table(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("ts"), "event_type", "value")
    events.write.parquet(f"{root}/landing")
    arrivals = ingest.read_deltas(spark, f"{root}/landing", events.schema).withColumn("high", F.col("value") > 10)
    share = ingest.weekly_share_stream(arrivals, ts="ts", flag="high", by=["event_type"], delay="60 days")
    ingest.append_updates(share, f"{root}/updates", f"{root}/checkpoint").awaitTermination()
    return ingest.latest_updates(spark, f"{root}/updates", share.schema, key=["week", "event_type"])


@query(ctes(S.WEEKLY) + f"SELECT {WEEK_COLUMNS}, true AS bounded FROM weekly WHERE week IS NOT NULL")
def stream_weekly_share_folded(spark, sf_dir):
    # Twelve batches, folded by four: a reader opens a base and at most four batches.
    landing, root = scratch_path(spark, "flags-landing"), scratch_path(spark, "weekly-stream")
    key, columns_ = ["week", "country", "role_class"], ["created_at", "ai_mentioned", "country", "role_class"]
    flagged(spark, sf_dir).select(columns_).repartition(12).write.parquet(landing)
    arrivals = ingest.read_deltas(spark, landing, T.StructType([f for f in FLAGS_SCHEMA if f.name in columns_]), files_per_batch=1)
    share = ingest.weekly_share_stream(arrivals, delay="400 days")
    ingest.append_updates(share, f"{root}/updates", f"{root}/checkpoint", key=key, fold=4).awaitTermination()
    base, after = ingest._layers(spark, f"{root}/updates")
    table = ingest.latest_updates(spark, f"{root}/updates", share.schema, key=key)
    return table.withColumn("bounded", F.lit(base is not None and len(after) < 4))


@query(MASTER_SQL)
def stream_first_arrivals(spark, sf_dir):
    # The days arrive in order, then the first one again with other salaries, after a restart and long after any watermark.
    root = scratch_path(spark, "arrivals")
    days = stage(snapshots(spark, sf_dir), "days")
    late = days.filter("ingest_date = '2026-09-01'").withColumns(
        {"salary_max": F.col("salary_max") + 1, "ingested_at": F.col("ingested_at") + F.expr("INTERVAL 40 DAYS")}
    )
    for part in (days.filter("ingest_date < '2026-09-03'"), late.unionByName(days.filter("ingest_date = '2026-09-03'"))):
        part.write.mode("append").parquet(f"{root}/landing")
        arrivals = ingest.FirstArrivals(spark, f"{root}/table")
        arrivals.stream(ingest.read_deltas(spark, f"{root}/landing"), f"{root}/checkpoint").awaitTermination()
    return arrivals.table()

"""A view of the ``documents`` table as job adverts.

The given tables hold no adverts, so every document becomes one: its text is the description, and
the other fields follow from ``doc_id`` by a rule. The rules are written once as SQL that both Spark
and the comparison engine understand; only integer division and date arithmetic are spelled per engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from advertlake.functions.taxonomy import SKILLS

INGESTED_AT = "2026-09-03 12:00:00"
INGEST_DATE = "2026-09-03"
START_DATE = "2026-01-01"
NOW = "2026-07-01 00:00:00"

# Made up for this view; only the two technical tags must be those of the role rules.
TITLES = [
    "Backend Programmer", "Night Porter", "Bee Keeper", "Lead Statistician", "Tram Conductor", "Cloud Engineer",
    "Piano Tuner", "Payroll Clerk", "Ferry Captain", "Test Automation Developer", "Florist", "Museum Guide",
    "Data Steward", "Glass Blower", "Radio Host", "Network Architect",
]
CATEGORIES = [
    ("it-jobs", "Computing"), ("garden-jobs", "Gardens & Parks"), ("harbour-jobs", "Harbours & Ships"),
    ("museum-jobs", "Museums"), ("music-jobs", "Music"), ("engineering-jobs", "Machines"),
    ("kitchen-jobs", "Kitchens"), ("archive-jobs", "Archives"), ("rail-jobs", "Railways"), ("radio-jobs", "Radio"),
]
# every third term of the dictionary, so that each of its groups is met
PHRASES = sorted(term for terms in SKILLS.groups.values() for term in terms)[::3]


def _case(expr: str, values: list[str], otherwise: str = "NULL") -> str:
    whens = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"(CASE {expr} {whens} ELSE {otherwise} END)"


# Two engines, one set of rules: {div} is integer division, {day_date} the text of the creation day.
SPELLINGS = {
    "spark": {"div": "div", "day_date": "cast(date_add(date'2026-01-01', cast((doc_id*37) % 240 as int)) as string)"},
    "sql": {"div": "//", "day_date": "cast(date '2026-01-01' + cast((doc_id*37) % 240 as int) as string)"},
}

_TITLE = _case("(doc_id*5 + doc_id {div} 16) % 16", TITLES)
_PCT = (
    "(CASE WHEN doc_id % 11 IN (0, 5) THEN 8 + 40*((doc_id*37) % 240)/240.0"
    " ELSE 3 + 9*((doc_id*37) % 240)/240.0 END)"
)

# One expression per raw field, over documents with ``copy`` 0, or 0 and 1 for adverts sent twice.
RAW_FIELDS = {
    "doc_id": "doc_id",
    "id": "CASE WHEN doc_id % 101 = 100 THEN NULL WHEN doc_id % 103 = 102 THEN '   '"
    " ELSE concat(' ', cast(doc_id as string)) END",
    "adref": "concat('ref-', cast(doc_id as string))",
    "title": f"CASE WHEN doc_id % 97 = 96 THEN NULL WHEN doc_id % 9 = 4"
    f" THEN concat('  ', replace({_TITLE}, ' ', concat(' ', chr(160))), ' ') ELSE {_TITLE} END",
    "description": "concat(CASE WHEN copy = 1 THEN '(sent again) ' ELSE '' END, text,"
    f" CASE WHEN (doc_id*7919 + 13) % 100 < {_PCT}"
    f" THEN concat(' We also use ', {_case(f'doc_id % {len(PHRASES)}', PHRASES)}, '.') ELSE '' END)",
    "company_name": "CASE WHEN doc_id % 20 = 19 THEN NULL WHEN doc_id % 20 = 18 THEN ''"
    " WHEN doc_id % 3 = 0 THEN 'Agency One' ELSE concat('Company ', cast((doc_id*7) % 41 as string)) END",
    "levels": "CASE WHEN doc_id % 50 = 49 THEN 0 WHEN doc_id % 8 = 5 THEN 2 ELSE 3 END",
    "area_0": "CASE WHEN (doc_id {div} 7) % 2 = 0 THEN 'UK' ELSE 'US' END",
    "area_1": "concat('Region ', cast(doc_id % 9 as string))",
    "area_2": "concat('Town ', cast(doc_id % 27 as string))",
    "category_tag": _case("doc_id % 11", [t for t, _ in CATEGORIES]),
    "category_label": _case("doc_id % 11", [label for _, label in CATEGORIES]),
    "salary_min": "CASE doc_id % 12 WHEN 0 THEN NULL WHEN 1 THEN '£32,500' WHEN 2 THEN cast(90000 + doc_id % 50 as string)"
    " WHEN 3 THEN '12d' WHEN 4 THEN 'n/a' WHEN 5 THEN ' €1,234.5 ' ELSE cast(20000 + (doc_id*131) % 60000 as string) END",
    "salary_max": "CASE WHEN doc_id % 12 = 2 THEN '70000' WHEN doc_id % 12 = 6 OR doc_id % 24 = 0 THEN NULL"
    " ELSE cast(30000 + (doc_id*977) % 90000 as string) END",
    "salary_currency": "CASE WHEN doc_id % 17 = 3 THEN ' USD' ELSE NULL END",
    "salary_is_predicted": "CASE doc_id % 7 WHEN 0 THEN '1' WHEN 1 THEN '0' WHEN 2 THEN NULL WHEN 3 THEN 'true'"
    " WHEN 4 THEN 'x' WHEN 5 THEN '2' ELSE '0.5' END",
    "latitude": "CASE WHEN doc_id % 40 = 39 THEN NULL WHEN doc_id % 499 = 498 THEN '123.4'"
    " ELSE concat(cast(doc_id % 179 - 89 as string), '.5') END",
    "longitude": "concat(cast(doc_id % 359 - 179 as string), '.25')",
    "contract_type": "CASE doc_id % 4 WHEN 0 THEN 'Full_Time ' WHEN 1 THEN 'part time' WHEN 2 THEN 'FULL-TIME' ELSE NULL END",
    "contract_time": "CASE doc_id % 3 WHEN 0 THEN 'permanent' WHEN 1 THEN 'Contract' ELSE '' END",
    "created": "CASE WHEN doc_id % 59 = 58 THEN NULL WHEN doc_id % 61 = 60 THEN 'n/a'"
    " WHEN doc_id % 67 = 66 THEN '2025-12-31T23:00:00Z'"
    " WHEN doc_id % 53 = 52 THEN concat({day_date}, 'T00:30:00+02:00') ELSE concat({day_date}, 'T09:00:00Z') END",
    "redirect_url": "concat('https://example.com/ad/', cast(doc_id as string))",
    "country": "CASE WHEN (doc_id {div} 7) % 2 = 0 THEN 'gb' ELSE 'us' END",
    # Place in the reading order of a country: blocks of seven documents alternate between two.
    "page": "cast(((doc_id {div} 14)*7 + doc_id % 7) {div} 50 + 1 as int)",
    "pos": "cast((((doc_id {div} 14)*7 + doc_id % 7) % 50)*2 + copy as int)",
}


def raw_fields(engine: str) -> dict[str, str]:
    return {name: sql.format(**SPELLINGS[engine]) for name, sql in RAW_FIELDS.items()}


TEXT_TABLES = ("documents", "pages", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    # The small test tables are one file with one row group, which a single core would scan alone.
    return df.repartition(cores) if name in TEXT_TABLES and len(df.inputFiles()) < cores else df


def raw_ads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested raw adverts with their place in the reading order."""
    copies = table(spark, sf_dir, "documents").selectExpr(
        "doc_id", "text", "explode(sequence(0, IF(doc_id % 33 = 0, 1, 0))) AS copy"
    )
    flat = copies.selectExpr(*[f"{sql} AS {name}" for name, sql in raw_fields("spark").items()])
    area = F.array("area_0", "area_1", "area_2")
    location = F.struct(F.slice(area, F.lit(1), F.col("levels")).alias("area"), F.col("area_2").alias("display_name"))
    return flat.select(
        "id", "adref", "title", "description", "redirect_url", "created", "salary_min", "salary_max",
        "salary_currency", "salary_is_predicted", "latitude", "longitude", "contract_type", "contract_time",
        F.struct(F.col("company_name").alias("display_name")).alias("company"),
        F.when(F.col("levels") > 0, location).alias("location"),
        F.struct(F.col("category_tag").alias("tag"), F.col("category_label").alias("label")).alias("category"),
        "country", "page", "pos",
    )


def landed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search pages as payload texts ``(value, ingest_date, country)``, one page per row.

    A page holds at most a hundred adverts. Each country also has the empty page after its last one,
    and ``count`` advertises the number of adverts of the country.
    """
    ads = raw_ads(spark, sf_dir)
    fields = [c for c in ads.columns if c not in ("country", "page", "pos")]
    full = ads.groupBy("country", "page").agg(
        F.sort_array(F.collect_list(F.struct("pos", F.struct(*fields).alias("ad")))).alias("r"),
    )
    sizes = ads.groupBy("country").agg(F.count(F.lit(1)).alias("count"), F.max("page").alias("last"))
    empty = sizes.select("country", (F.col("last") + 1).alias("page"), F.lit(None).cast(full.schema["r"].dataType).alias("r"))
    pages = full.unionByName(empty).join(F.broadcast(sizes.select("country", "count")), "country")  # two countries
    results = F.coalesce(F.transform("r", lambda x: x["ad"]), F.array())
    payload = F.to_json(F.struct("count", "page", results.alias("results")))
    return pages.select(payload.alias("value"), F.lit(INGEST_DATE).alias("ingest_date"), "country")

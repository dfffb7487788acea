"""SQL of the comparison engine for the advert view and its clean, flags and snapshot forms."""

from __future__ import annotations

import unicodedata

from advertlake.functions.scalars import CURRENCY_BY_COUNTRY, DEFAULT_CURRENCY
from advertlake.functions.taxonomy import SKILLS, TECHNICAL_TAGS, TECHNICAL_TITLE_WORDS, Taxonomy
from checks.ads_view import INGEST_DATE, INGESTED_AT, START_DATE, raw_fields


def select_list(columns: dict[str, str]) -> str:
    return ",\n  ".join(f"{sql} AS {name}" for name, sql in columns.items())


def clean_string(x: str) -> str:
    spaces = r"[\t-\r\x1c-\x1f\x{85}\p{Z}]+"
    return f"nullif(trim(regexp_replace({x}, '{spaces}', ' ', 'g')), '')"


def number(x: str, symbols: str = "") -> str:
    bare = f"translate({x}, '{symbols}', '')" if symbols else x
    bare = rf"regexp_replace({bare}, '^\s+|\s+$', '', 'g')"
    form = "[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?"
    return f"(CASE WHEN regexp_full_match({bare}, '{form}') THEN try_cast({bare} AS DOUBLE) END)"


def _quoted(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


_CURRENCY = " ".join(f"WHEN '{c}' THEN '{v}'" for c, v in CURRENCY_BY_COUNTRY.items())
_LOW, _HIGH = number("salary_min", ",£€"), number("salary_max", ",£€")

FLAT = {
    "job_id": clean_string("id"),
    "adref": clean_string("adref"),
    "title": clean_string("title"),
    "description": clean_string("description"),
    "company_name": clean_string("company_name"),
    "salary_min": f"least({_LOW}, {_HIGH})",
    "salary_max": f"greatest({_LOW}, {_HIGH})",
    "salary_currency": f"coalesce({clean_string('salary_currency')}, CASE country {_CURRENCY} ELSE '{DEFAULT_CURRENCY}' END)",
    "salary_is_predicted": "coalesce(abs(coalesce(" + number("salary_is_predicted")
    + ", CASE WHEN lower(salary_is_predicted) = 'true' THEN 1.0 ELSE 0.0 END)) >= 1, false)",
    "location_display_name": "CASE WHEN levels > 0 THEN area_2 END",
    "location_area_0": "CASE WHEN levels > 0 THEN area_0 END",
    "location_area_1": "CASE WHEN levels > 1 THEN area_1 END",
    "location_area_2": "CASE WHEN levels > 2 THEN area_2 END",
    "latitude": number("latitude", ",£€"),
    "longitude": number("longitude", ",£€"),
    "category_tag": clean_string("category_tag"),
    "category_label": clean_string("category_label"),
    "contract_type": f"replace(lower({clean_string('contract_type')}), ' ', '_')",
    "contract_time": f"replace(lower({clean_string('contract_time')}), ' ', '_')",
    "created_at": "CASE WHEN created LIKE '%+02:00' THEN try_cast(left(created, 19) AS TIMESTAMP) - INTERVAL 2 HOUR"
    " ELSE try_cast(rtrim(created, 'Z') AS TIMESTAMP) END",
    "redirect_url": clean_string("redirect_url"),
    "source": "'job-board'",
    "country": "country",
    "ingested_at": f"TIMESTAMP '{INGESTED_AT}'",
    "ingest_date": f"'{INGEST_DATE}'",
}

RAW = f"""copies AS (
  SELECT doc_id, text, unnest(CASE WHEN doc_id % 33 = 0 THEN [0, 1] ELSE [0] END) AS copy FROM documents
), raw AS (
  SELECT {select_list(raw_fields("sql"))} FROM copies
)"""

CLEAN = RAW + f""", flat AS (
  SELECT {select_list(FLAT)}, page, pos FROM raw
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY job_id, country, ingest_date ORDER BY page, pos) AS rn
  FROM flat WHERE job_id IS NOT NULL
), clean AS (
  SELECT {", ".join(FLAT)} FROM ranked
  WHERE rn = 1 AND (created_at IS NULL OR created_at >= TIMESTAMP '{START_DATE} 00:00:00')
)"""


def normalized(x: str) -> str:
    """NFKD of the Latin letters as replacements, then markup, control characters, spaces, case."""
    out = f"coalesce({x}, '')"
    for code in range(0xC0, 0x180):
        parts = unicodedata.normalize("NFKD", chr(code))
        if parts != chr(code):
            out = f"replace({out}, '{chr(code)}', '{parts}')"
    out = f"regexp_replace({out}, '<[^>]+>', ' ', 'g')"
    out = rf"regexp_replace({out}, '&nbsp;|[\x00-\x1f\x7f\x{{a0}}]', ' ', 'g')"
    return rf"lower(trim(regexp_replace({out}, '[\s\p{{Z}}]+', ' ', 'g')))"


def hits(norm: str, taxonomy: Taxonomy = SKILLS) -> str:
    """All matches; the engine's word boundary is ASCII, so letters without a decomposition are spelled out."""
    terms = sorted(taxonomy.terms, key=len, reverse=True)
    word = rf"\b(?:{'|'.join(terms)})\b"
    spelled = norm
    for letter in "ßæœøđłıħŋ":
        spelled = f"replace({spelled}, '{letter}', 'ss')"
    return f"regexp_extract_all({spelled}, '{word}')"


def role_class(tag: str, title: str) -> str:
    words = "|".join(w.replace("*", r"\w*") for w in TECHNICAL_TITLE_WORDS)
    t, n = f"lower(trim(coalesce({tag}, '')))", f"lower(trim(coalesce({title}, '')))"
    return (
        f"CASE WHEN {t} IN ({_quoted(TECHNICAL_TAGS)}) THEN 'technical'"
        rf" WHEN regexp_matches({n}, '\b(?:{words})\b') THEN 'technical'"
        f" WHEN {t} <> '' OR {n} <> '' THEN 'non-technical' ELSE 'unknown' END"
    )


def in_group(hits_column: str, terms) -> str:
    return f"CAST(len(list_filter({hits_column}, lambda h: h IN ({_quoted(terms)}))) AS BIGINT)"


FLAGS = CLEAN + f""", normed AS (
  SELECT *, {normalized("concat(coalesce(title, ''), '. ', coalesce(description, ''))")} AS norm FROM clean
), scanned AS (
  SELECT *, {hits("norm")} AS hits FROM normed
), flags AS (
  SELECT job_id, country, ingest_date, created_at, title, description, category_tag, category_label,
  {role_class("category_tag", "title")} AS role_class,
  len(hits) > 0 AS ai_mentioned, CAST(len(hits) AS BIGINT) AS ai_total_mentions,
  {", ".join(f"{in_group('hits', SKILLS.groups[g])} AS {c}" for g, c in SKILLS.columns.items())},
  '1.0' AS taxonomy_version, '1.0' AS role_classifier_version, hits
  FROM scanned
)"""

WEEKLY = FLAGS + """, weekly AS (
  SELECT CAST(date_trunc('week', created_at) AS DATE) AS week, country, role_class,
    count(*) AS total_ads, count(*) FILTER (ai_mentioned) AS ai_ads,
    round(avg(CASE WHEN ai_mentioned THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 4) AS ai_share
  FROM flags GROUP BY 1, 2, 3
)"""

# Each advert is seen on one to three days, with some attributes changing from day to day.
SNAPSHOT_CHANGES = {
    "title": "CASE WHEN snap = 2 THEN title || ' (revised)' ELSE title END",
    "salary_max": "salary_max + 500 * snap * (cast(job_id as bigint) % 2)",
    "longitude": "CASE WHEN location_display_name = 'Town 3' THEN longitude + snap ELSE longitude END",
    "category_label": "CASE WHEN snap = 1 AND category_tag = 'it-jobs' THEN 'IT and Data Jobs' ELSE category_label END",
    "ingest_date": "concat('2026-09-0', cast(1 + snap as string))",
}

SNAPSHOTS = CLEAN + f""", spread AS (
  SELECT *, unnest(range(0, cast(job_id as bigint) % 3 + 1)) AS snap FROM clean
), snapshots AS (
  SELECT {", ".join(f"{SNAPSHOT_CHANGES.get(c, c)} AS {c}" for c in FLAT)} FROM spread
)"""


def trend(series: str, by: str, t: str, y: str, min_points: int = 3) -> str:
    """The regression table over ``series``; the p-value uses closed-form series coefficients."""
    return f"""pts AS (
  SELECT {by}, {t} AS t, CAST({y} AS DOUBLE) AS y,
    row_number() OVER (PARTITION BY {by} ORDER BY {t}) - 1 AS x
  FROM {series} WHERE {t} IS NOT NULL AND {y} IS NOT NULL
), sums AS (
  SELECT {by}, count(*) AS n, min(t) AS first_week, max(t) AS last_week,
    arg_min(y, t) AS y0, arg_max(y, t) AS yn, regr_sxx(y, x) AS sxx, regr_syy(y, x) AS syy, regr_sxy(y, x) AS sxy
  FROM pts GROUP BY {by}
), fit AS (
  SELECT *, CASE WHEN syy < 1e-20 THEN 0.0 ELSE sxy / sxx END AS slope,
    CASE WHEN syy < 1e-20 OR n = 2 THEN 0.0
         ELSE sqrt(greatest(syy - sxy * sxy / sxx, 0.0) / ((n - 2) * sxx)) END AS se
  FROM sums
), angle AS (
  SELECT *, n - 2 AS nu, atan(abs(slope) / nullif(se, 0) / sqrt(greatest(n - 2, 1))) AS theta FROM fit
), folded AS (
  SELECT {by}, sum(CASE WHEN nu % 2 = 1 AND j <= (nu - 3) / 2.0
      THEN exp(2 * j * ln(2) + 2 * lgamma(j + 1) - lgamma(2 * j + 2)) * pow(cos(theta), 2 * j + 1)
      WHEN nu % 2 = 0 AND j <= (nu - 2) / 2.0
      THEN exp(lgamma(2 * j + 1) - 2 * j * ln(2) - 2 * lgamma(j + 1)) * pow(cos(theta), 2 * j) ELSE 0 END) AS s
  FROM angle, (SELECT unnest(range(0, (SELECT max(n) FROM sums))) AS j) GROUP BY {by}
), tested AS (
  SELECT a.*, CASE WHEN syy < 1e-20 THEN 1.0 WHEN se = 0 THEN 0.0
    WHEN nu % 2 = 1 THEN greatest(1 - 2 / pi() * (theta + sin(theta) * s), 0)
    ELSE greatest(1 - sin(theta) * s, 0) END AS p
  FROM angle a JOIN folded f USING ({by})
), trend AS (
  SELECT {by}, n AS weeks, CAST(first_week AS VARCHAR) AS first_week, CAST(last_week AS VARCHAR) AS last_week,
    round(y0, 4) AS week0_share, round(yn, 4) AS "weekN_share",
    CASE WHEN n >= {min_points} THEN round(slope * 433.0, 3) END AS slope_pp_per_month,
    CASE WHEN n >= {min_points} THEN round(se * 433.0, 3) END AS se_pp_per_month,
    CASE WHEN n >= {min_points} THEN round(p, 4) END AS p_value,
    CASE WHEN n >= {min_points} THEN round((slope - 1.96 * se) * 433.0, 3) END AS ci_low_pp_per_month,
    CASE WHEN n >= {min_points} THEN round((slope + 1.96 * se) * 433.0, 3) END AS ci_high_pp_per_month,
    CASE WHEN n < {min_points} THEN 'insufficient_data' WHEN p > 0.05 THEN 'stable'
         WHEN slope > 0 THEN 'increasing' ELSE 'decreasing' END AS verdict
  FROM tested
)"""

"""Raw adverts to the clean snapshot table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from advertlake.functions import scalars as S
from advertlake.operators.windows import keep_first_sparse
from advertlake.schema import CLEAN_SCHEMA, RAW_AD, SNAPSHOT_KEY, enforce_schema

READING_ORDER = ("country", "page", "pos")


def _instant(value: datetime | str | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(value).cast("timestamp")


def _with_raw_fields(raw: DataFrame) -> DataFrame:
    """Add the raw fields a feed leaves out, as typed nulls, so that every path resolves."""
    present = set(raw.columns)
    absent = {f.name: F.lit(None).cast(f.dataType) for f in RAW_AD if f.name not in present}
    if "country" not in present:
        absent["country"] = F.lit(None).cast("string")
    return raw.withColumns(absent) if absent else raw


def _nested(raw: DataFrame, path: str) -> Column:
    parent, field = path.split(".")
    dtype = raw.schema[parent].dataType
    if isinstance(dtype, T.StructType) and field in dtype.names:
        return F.col(path)
    return F.lit(None).cast(RAW_AD[parent].dataType[field].dataType)


def flatten_ads(
    raw: DataFrame,
    *,
    ingested_at: datetime | str | Column,
    source: str = "job-board",
    currencies: Mapping[str, str] = S.CURRENCY_BY_COUNTRY,
    default_currency: str = S.DEFAULT_CURRENCY,
    money_symbols: str = S.MONEY_SYMBOLS,
    keep: Sequence[str] = (),
) -> DataFrame:
    """One nested advert to one row of the clean schema, row by row; ``keep`` columns pass through."""
    raw = _with_raw_fields(raw)
    area = _nested(raw, "location.area")
    low, high = S.balanced_pair(
        S.money(F.col("salary_min"), money_symbols), S.money(F.col("salary_max"), money_symbols)
    )
    country = F.coalesce(S.clean_string(F.col("country")), F.lit(""))
    instant = _instant(ingested_at)
    columns = {
        "job_id": S.clean_string(F.col("id").cast("string")),
        "adref": S.clean_string(F.col("adref")),
        "title": S.clean_string(F.col("title")),
        "description": S.clean_string(F.col("description")),
        "company_name": S.clean_string(_nested(raw, "company.display_name")),
        "salary_min": low,
        "salary_max": high,
        "salary_currency": S.currency_or_default(
            F.col("salary_currency"), country, currencies, default_currency
        ),
        "salary_is_predicted": F.coalesce(S.truthy_number(F.col("salary_is_predicted")), F.lit(False)),
        "location_display_name": S.clean_string(_nested(raw, "location.display_name")),
        "location_area_0": S.clean_string(F.get(area, F.lit(0))),
        "location_area_1": S.clean_string(F.get(area, F.lit(1))),
        "location_area_2": S.clean_string(F.get(area, F.lit(2))),
        "latitude": S.money(F.col("latitude"), money_symbols),
        "longitude": S.money(F.col("longitude"), money_symbols),
        "category_tag": S.clean_string(_nested(raw, "category.tag")),
        "category_label": S.clean_string(_nested(raw, "category.label")),
        "contract_type": S.contract_label(F.col("contract_type")),
        "contract_time": S.contract_label(F.col("contract_time")),
        "created_at": S.parse_utc(F.col("created")),
        "redirect_url": S.clean_string(F.col("redirect_url")),
        "source": F.lit(source),
        "country": country,
        "ingested_at": instant,
        "ingest_date": S.utc_date_text(instant),
    }
    flat = [expr.cast(CLEAN_SCHEMA[name].dataType).alias(name) for name, expr in columns.items()]
    # Order columns travel under a prefix: a raw 'country' must not shadow the cleaned one.
    return raw.select(*flat, *[F.col(c).alias(f"_{c}") for c in keep])


def has_id() -> Column:
    return F.col("job_id").isNotNull()


def in_window(created: Column, start_date: str | None) -> Column:
    """Undated adverts stay; dated ones must not lie before midnight UTC of ``start_date``."""
    if not start_date:
        return F.lit(True)
    return created.isNull() | (created >= F.lit(start_date).cast("timestamp"))


def clean_ads(
    raw: DataFrame,
    *,
    ingested_at: datetime | str | Column,
    start_date: str | None = None,
    order_by: Sequence[str] = READING_ORDER,
    **flatten_options,
) -> tuple[DataFrame, DataFrame]:
    """Clean snapshot rows and a one-row report of what was removed.

    Rows without an id go first, then repeated snapshots (the first in reading order stays), then
    rows before the window. The report reads only the id, the date and the order columns. Repeats are
    found from the key columns alone; rows of other keys, with their texts, are not shuffled.
    """
    flat = flatten_ads(raw, ingested_at=ingested_at, keep=order_by, **flatten_options)
    order = [f"_{c}" for c in order_by]
    kept = keep_first_sparse(flat.filter(has_id()), SNAPSHOT_KEY, order, "repeated-ads")
    clean = enforce_schema(kept.filter(in_window(F.col("created_at"), start_date)), CLEAN_SCHEMA)
    return clean, _report(flat, order, start_date)


def _report(flat: DataFrame, order: Sequence[str], start_date: str | None) -> DataFrame:
    # Grouping combines on the map side, so repeated keys and the rows without an id (one group)
    # leave every task as a single row.
    per_key = flat.groupBy(*SNAPSHOT_KEY).agg(
        F.count(F.lit(1)).alias("n"),
        F.min_by("created_at", F.struct(*order)).alias("first_created"),
    )
    outside = has_id() & ~in_window(F.col("first_created"), start_date)
    total = lambda amount: F.coalesce(F.sum(amount), F.lit(0)).cast("long")
    return per_key.agg(
        total(F.col("n")).alias("input_rows"),
        total(F.when(~has_id(), F.col("n"))).alias("missing_job_id_removed"),
        total(F.when(has_id(), F.col("n") - 1)).alias("duplicates_removed"),
        F.count_if(outside).alias("outside_date_window_removed"),
        F.count_if(has_id() & ~outside).alias("output_rows"),
    )

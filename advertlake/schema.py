"""Fixed schemas of the tables this package reads and writes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SNAPSHOT_KEY = ("job_id", "country", "ingest_date")
HISTORY_KEY = ("country", "day")
PARTITIONS = ("ingest_date", "country")


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields.items()])


_S, _D, _L, _B, _TS = T.StringType(), T.DoubleType(), T.LongType(), T.BooleanType(), T.TimestampType()

# Column order and types of the clean snapshot table.
CLEAN_SCHEMA = _struct(
    job_id=_S,
    adref=_S,
    title=_S,
    description=_S,
    company_name=_S,
    salary_min=_D,
    salary_max=_D,
    salary_currency=_S,
    salary_is_predicted=_B,
    location_display_name=_S,
    location_area_0=_S,
    location_area_1=_S,
    location_area_2=_S,
    latitude=_D,
    longitude=_D,
    category_tag=_S,
    category_label=_S,
    contract_type=_S,
    contract_time=_S,
    created_at=_TS,
    redirect_url=_S,
    source=_S,
    country=_S,
    ingested_at=_TS,
    ingest_date=_S,
)

# The daily history aggregate.
HISTORY_SCHEMA = _struct(country=_S, day=_S, count=_L, details_json=_S)

# The flags derived from one snapshot row.
FLAGS_SCHEMA = _struct(
    job_id=_S,
    country=_S,
    ingest_date=_S,
    created_at=_TS,
    title=_S,
    description=_S,
    category_tag=_S,
    category_label=_S,
    role_class=_S,
    ai_mentioned=_B,
    ai_total_mentions=_L,
    ai_general_ai=_L,
    ai_machine_learning=_L,
    ai_ml_tools=_L,
    ai_generative_ai=_L,
    taxonomy_version=_S,
    role_classifier_version=_S,
)

# One advert as it arrives. Scalars that come as number, text or boolean are read as text and
# typed by the cleaning expressions, so one odd advert never nulls a whole page.
RAW_AD = _struct(
    id=_S,
    adref=_S,
    title=_S,
    description=_S,
    redirect_url=_S,
    created=_S,
    salary_min=_S,
    salary_max=_S,
    salary_currency=_S,
    salary_is_predicted=_S,
    latitude=_S,
    longitude=_S,
    contract_type=_S,
    contract_time=_S,
    company=_struct(display_name=_S),
    location=_struct(area=T.ArrayType(_S), display_name=_S),
    category=_struct(tag=_S, label=_S),
)

PAGE_SCHEMA = _struct(count=_L, page=T.IntegerType(), results=T.ArrayType(RAW_AD))


def enforce_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project to exactly ``schema``: fixed order, missing columns as null, types cast."""
    present = set(df.columns)

    def column(field: T.StructField) -> Column:
        if field.name not in present:
            return F.lit(None).cast(field.dataType).alias(field.name)
        if df.schema[field.name].dataType == field.dataType:
            return F.col(field.name)
        return F.col(field.name).try_cast(field.dataType).alias(field.name)

    return df.select([column(field) for field in schema])


def missing_columns(df: DataFrame, schema: T.StructType) -> list[str]:
    present = set(df.columns)
    return [name for name in schema.names if name not in present]

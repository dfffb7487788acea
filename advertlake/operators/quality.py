"""Data-quality battery over the clean table, its null summary and the load gate."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from advertlake.schema import CLEAN_SCHEMA, SNAPSHOT_KEY, missing_columns

CHECK_COLUMNS = ("position", "name", "status", "detail")


class QualityError(RuntimeError):
    """Raised by the gate when a batch must not be loaded."""


def _is_missing(df: DataFrame, name: str) -> Column:
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return F.col(name).isNull() | F.isnan(name)
    return F.col(name).isNull()


def null_rates(df: DataFrame) -> DataFrame:
    """Share of missing values per column in one pass, highest first."""
    rates = df.agg(*[F.avg(_is_missing(df, c).cast("double")).alias(c) for c in df.columns])
    return (
        rates.unpivot([], list(df.columns), "column", "null_rate")
        .filter("null_rate is not null")
        .orderBy(F.desc("null_rate"), "column")
    )


def quality_checks(
    df: DataFrame,
    *,
    now: datetime | str | Column,
    start_date: str | None = None,
    schema: T.StructType = CLEAN_SCHEMA,
    key: Sequence[str] = SNAPSHOT_KEY,
) -> tuple[DataFrame, DataFrame]:
    """``(checks, null_summary)``; the checks carry position, name, status and detail.

    One pass: every counter is summed per key and then over the keys, whose surplus rows are the
    duplicates. Only counters and key columns are shuffled. A NaN is a missing value.
    """
    missing = missing_columns(df, schema)
    present = set(df.columns)

    def count_where(condition: Column, *needs: str) -> Column:
        return F.count_if(condition) if present.issuperset(needs) else F.sum(F.lit(0).cast("long"))

    def number(name: str) -> Column:
        return F.nanvl(F.col(name).cast("double"), F.lit(None).cast("double"))

    moment = now if isinstance(now, Column) else F.lit(now).cast("timestamp")
    created, lat, lon = F.col("created_at"), number("latitude"), number("longitude")
    low, high = number("salary_min"), number("salary_max")
    start = F.lit(start_date).cast("timestamp")
    counted = {
        "n": F.count(F.lit(1)),
        "no_id": count_where(F.col("job_id").isNull(), "job_id"),
        "early": count_where(created < start, "created_at"),
        "future": count_where(created > moment, "created_at"),
        "inverted": count_where(low > high, "salary_min", "salary_max"),
        "bad_lat": count_where(F.abs(lat) > 90, "latitude"),
        "bad_lon": count_where(F.abs(lon) > 180, "longitude"),
        "no_title": count_where(F.col("title").isNull(), "title"),
        "no_created": count_where(created.isNull(), "created_at"),
    }
    # without its key columns the table is one group, which combines before the shuffle
    keys = list(key) if present.issuperset(key) else []
    per_key = df.groupBy(*keys).agg(*[expr.alias(name) for name, expr in counted.items()])
    repeats = F.col("n") - 1 if keys else F.lit(0)
    sums = {**{name: F.col(name) for name in counted}, "dupes": repeats}
    counters = per_key.agg(*[F.coalesce(F.sum(v), F.lit(0)).cast("long").alias(name) for name, v in sums.items()])

    return counters.select(F.inline(_check_rows(df, missing, key, start_date))), null_rates(df)


def _check_rows(df: DataFrame, missing: list[str], key: Sequence[str], start_date: str | None) -> Column:
    def check(position: int, name: str, bad: Column, severity: str, detail: Column) -> Column:
        status = F.when(bad, severity).otherwise("PASS")
        values = (F.lit(position), F.lit(name), status, detail)
        return F.struct(*[value.alias(label) for label, value in zip(CHECK_COLUMNS, values)])

    def rate(count: str) -> Column:
        return F.format_string("null rate %.1f%%", F.col(count) * 100.0 / F.col("n"))

    def counted(count: str, words: str) -> Column:
        return F.concat(F.col(count).cast("string"), F.lit(f" {words}"))

    found = F.lit(f"{len(df.columns)} columns; missing={missing or 'none'}")
    coordinates = F.concat(
        F.col("bad_lat").cast("string"), F.lit(" bad latitudes, "),
        F.col("bad_lon").cast("string"), F.lit(" bad longitudes"),
    )
    key_words = f"duplicate ({', '.join(key)}) rows"
    schema_row = check(1, "schema_columns", F.lit(bool(missing)), "FAIL", found)
    empty_row = check(2, "row_count", F.lit(True), "WARN", F.lit("dataset is empty; nothing to validate"))
    rows = [
        schema_row,
        check(3, "duplicate_snapshots", F.col("dupes") > 0, "FAIL", counted("dupes", key_words)),
        check(4, "missing_job_id", F.col("no_id") > 0, "FAIL", counted("no_id", "rows without a job_id")),
        check(6, "future_dates", F.col("future") > 0, "WARN", counted("future", "rows created in the future")),
        check(7, "salary_order", F.col("inverted") > 0, "WARN",
              counted("inverted", "rows where salary_min > salary_max")),
        check(8, "coordinates", F.col("bad_lat") + F.col("bad_lon") > 0, "FAIL", coordinates),
        check(9, "null_title", F.col("no_title") > 0, "WARN", rate("no_title")),
        check(10, "null_created_at", F.col("no_created") > 0, "WARN", rate("no_created")),
    ]
    if start_date:
        rows.insert(3, check(5, "created_window", F.col("early") > 0, "WARN",
                             counted("early", f"rows created before {start_date}")))
    return F.when(F.col("n") == 0, F.array(schema_row, empty_row)).otherwise(F.array(*rows))


def extraction_checks(audit: DataFrame, rejected: DataFrame, lost_history: DataFrame | None = None) -> DataFrame:
    """Check rows on what was read: unreadable pages and history entries, and runs short of their total."""
    bad = rejected.agg(F.count(F.lit(1)).alias("pages"))
    lost = F.lit(0).cast("long").alias("entries")
    entries = bad.select(lost) if lost_history is None else lost_history.agg(F.count(F.lit(1)).alias("entries"))
    short = audit.agg(F.count_if(~F.col("complete")).alias("short"), F.count(F.lit(1)).alias("runs"))
    counted = bad.join(F.broadcast(entries)).join(F.broadcast(short))  # one row each

    def check(position: int, name: str, count: str, severity: str, words: str) -> Column:
        detail = F.concat(F.col(count).cast("string"), F.lit(f" {words}"))
        values = (F.lit(position), F.lit(name), F.when(F.col(count) > 0, severity).otherwise("PASS"), detail)
        return F.struct(*[value.alias(label) for label, value in zip(CHECK_COLUMNS, values)])

    rows = [
        check(11, "unreadable_pages", "pages", "FAIL", "pages left out as unreadable"),
        check(12, "unreadable_history", "entries", "FAIL", "history payloads or entries left out as unreadable"),
        check(13, "incomplete_runs", "short", "WARN", "runs with fewer adverts than advertised"),
    ]
    return counted.select(F.inline(F.array(*rows)))


def quality_passed(checks: DataFrame) -> DataFrame:
    """One row ``passed``: nothing failed and the table was not empty."""
    blocking = (F.col("status") == "FAIL") | (F.col("name") == "row_count")
    return checks.agg((F.count_if(blocking) == 0).alias("passed"))


def assert_quality(checks: DataFrame) -> None:
    """The gate: raise before anything is loaded. Reads at most one row per check."""
    rows = checks.collect()
    if any(row.status == "FAIL" or row.name == "row_count" for row in rows):
        listed = "; ".join(f"[{row.status}] {row.name}: {row.detail}" for row in rows if row.status != "PASS")
        raise QualityError(f"validation failed, nothing was loaded: {listed}")

"""The stored layers: raw payloads, raw rows, clean deltas, accumulated masters, export files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from advertlake.functions.scalars import cell_text
from advertlake.schema import CLEAN_SCHEMA, HISTORY_SCHEMA, PARTITIONS, enforce_schema
from advertlake.sources.pages import flatten_nested_to_json

# Folders of the layers below the data root.
RAW_SEARCH = "raw/search"
RAW_SEARCH_FLAT = "raw/search_flat"
RAW_HISTORY = "raw/history"
RAW_HISTORY_FLAT = "raw/history_flat"
CLEAN_JOBS = "processed/jobs"
CLEAN_HISTORY = "processed/history"
ANALYSIS = "analysis"

# Blanks at the edges stay, and an empty text is told from a missing one by its quotes.
CSV_OPTIONS = {
    "header": "true", "quote": '"', "escape": '"', "timestampFormat": "yyyy-MM-dd HH:mm:ssXXX",
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "nullValue": "",
}
WRITTEN_EMPTY = {"emptyValue": '""'}
# The reader would turn an empty text into a null, were it not read as something else first.
EMPTY = "\u0001empty\u0001"


# A batch of few folders with many rows each is written as its tasks hold it.
DEALT_FOLDERS, DEALT_ROWS = 8, 50_000


def is_dealt(rows: int, folders: int) -> bool:
    """Whether tasks can write their rows as they hold them, without small files for many folders."""
    return folders <= DEALT_FOLDERS and rows >= DEALT_ROWS * folders


def spread_for_write(df: DataFrame, partitions: Sequence[str]) -> DataFrame:
    """Bring rows of a folder together, but split folders that are large.

    A rebalance lets adaptive execution cut an oversized folder into several tasks and files by its
    real size, so a country with a third of all rows is not written by one task.
    """
    return df.hint("rebalance", *[F.col(c) for c in partitions])


def write_partitions(
    df: DataFrame, path: str, *, partitions: Sequence[str] = PARTITIONS, sort: Sequence[str] = (), dealt: bool = False
) -> None:
    """Replace exactly the folders present in ``df``; the output committer publishes them at the end.

    Rows that are ``dealt`` already are written by the tasks that hold them.
    """
    out = df if dealt else spread_for_write(df, partitions)
    if sort:
        out = out.sortWithinPartitions(*partitions, *[F.asc_nulls_last(c) for c in sort])
    (
        out.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .partitionBy(*partitions)
        .parquet(path)
    )


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read with the declared schema, so that folder names such as dates stay text."""
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def write_payloads(
    payloads: DataFrame, path: str, *, partitions: Sequence[str] = PARTITIONS, compression: str = "none"
) -> None:
    """Payloads one per line under their run's folder, so that they split over tasks when read again; packed files by file.

    A text without line breaks is written as it is. In an indented document the breaks stand between
    its parts, for JSON has none inside a string, and become blanks: the document stays the same.
    """
    (
        payloads.select(F.translate("value", "\r\n", "  ").alias("value"), *partitions)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", compression)
        .partitionBy(*partitions)
        .text(path)
    )


def write_raw_rows(ads: DataFrame, path: str, *, dealt: bool = False) -> None:
    write_partitions(flatten_nested_to_json(ads), path, dealt=dealt)


def write_clean_delta(clean: DataFrame, root: str, *, dealt: bool = False) -> None:
    """The clean rows of a run; a rerun replaces the run's folders whole."""
    write_partitions(clean, f"{root}/{CLEAN_JOBS}", sort=("created_at", "job_id"), dealt=dealt)


def read_clean_delta(spark: SparkSession, root: str, country: str | None = None) -> DataFrame:
    table = read_table(spark, f"{root}/{CLEAN_JOBS}", CLEAN_SCHEMA)
    return table if country is None else table.filter(F.col("country") == country)


def write_history_delta(history: DataFrame, root: str, ingest_date: str) -> None:
    rows = enforce_schema(history, HISTORY_SCHEMA).withColumn("ingest_date", F.lit(ingest_date))
    write_partitions(rows, f"{root}/{CLEAN_HISTORY}", sort=("day",))


def write_layers(
    *,
    root: str,
    ingest_date: str,
    payloads: DataFrame,
    ads: DataFrame,
    clean: DataFrame,
    history_payloads: DataFrame | None = None,
    history: DataFrame | None = None,
) -> list[str]:
    """Raw and clean layers of one run; returns the folders written. Raw payloads are packed with gzip."""
    # folders, not rows; the raw rows are some more
    sizes = [r["count"] for r in clean.groupBy(*PARTITIONS).count().collect()]
    dealt = is_dealt(sum(sizes), len(sizes))
    write_payloads(payloads, f"{root}/{RAW_SEARCH}", compression="gzip")
    write_raw_rows(ads, f"{root}/{RAW_SEARCH_FLAT}", dealt=dealt)
    write_clean_delta(clean, root, dealt=dealt)
    written = [RAW_SEARCH, RAW_SEARCH_FLAT, CLEAN_JOBS]
    if history is not None:
        if history_payloads is not None:
            write_payloads(history_payloads, f"{root}/{RAW_HISTORY}", compression="gzip")
            written.append(RAW_HISTORY)
        dated = history.withColumn("ingest_date", F.lit(ingest_date))
        write_partitions(dated, f"{root}/{RAW_HISTORY_FLAT}")
        write_history_delta(history, root, ingest_date)
        written += [RAW_HISTORY_FLAT, CLEAN_HISTORY]
    return [f"{root}/{folder}" for folder in written]


# -- text files --------------------------------------------------------------------------------


def write_csv(
    df: DataFrame, path: str, *, one_file: bool = False, mode: str = "overwrite", compression: str = "none"
) -> None:
    """CSV with a header; ``one_file`` is for aggregated views only.

    The view is brought into one task when it is made; making it stays spread.
    """
    out = df.repartition(1) if one_file else df
    out.write.mode(mode).options(**CSV_OPTIONS, **WRITTEN_EMPTY, compression=compression).csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType = CLEAN_SCHEMA) -> DataFrame:
    """CSV back with the declared types; texts may span lines."""
    rows = spark.read.schema(schema).options(**CSV_OPTIONS, emptyValue=EMPTY).option("multiLine", "true").csv(path)
    texts = {f.name: F.when(F.col(f.name) == EMPTY, "").otherwise(F.col(f.name)) for f in schema if f.dataType == T.StringType()}
    return rows.withColumns(texts)


def to_cells(df: DataFrame) -> DataFrame:
    """Every column as the text of a spreadsheet cell, under its own name."""
    return df.select([cell_text(F.col(name), dtype).alias(name) for name, dtype in df.dtypes])


def export_table(df: DataFrame, path: str, *, replace: bool = True) -> None:
    """Cells of one aggregated view as CSV: replaced with a header, or appended without one.

    For a sheet, that is views of a bounded size; the sorted view is brought into one task when it is made.
    """
    cells = to_cells(df).repartition(1)
    cells.write.mode("overwrite" if replace else "append").option("header", replace).options(
        emptyValue="", ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false"
    ).csv(path)


def export_all(frames: Mapping[str, DataFrame], root: str) -> list[str]:
    for name, frame in frames.items():
        export_table(frame, f"{root}/{name}")
    return list(frames)


def preview(frames: Mapping[str, DataFrame], n: int = 10) -> dict[str, tuple[DataFrame, DataFrame]]:
    """Per view its shape ``(name, rows, columns)`` and its first ``n`` rows; nothing is written."""
    shapes = {}
    for name, frame in frames.items():
        shape = frame.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("name"), "rows", F.lit(len(frame.columns)).alias("columns")
        )
        shapes[name] = (shape, frame.limit(n))
    return shapes


def write_analysis(flags: DataFrame, frames: Mapping[str, DataFrame], root: str, stamp: str) -> list[str]:
    """Flags of the run under a date stamp, packed with gzip, and one file per view."""
    written = [f"{root}/{ANALYSIS}/ai_job_flags_{stamp}"]
    write_csv(flags, written[0], compression="gzip")
    for name, frame in frames.items():
        path = f"{root}/{ANALYSIS}/{name}"
        write_csv(frame, path, one_file=True)
        written.append(path)
    return written

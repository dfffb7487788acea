"""Landed search pages and history payloads to rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from advertlake.operators.windows import keep_first_sparse, running_total
from advertlake.schema import PAGE_SCHEMA, PARTITIONS
from advertlake.session import stage

# A file holds a page per line or an archive that wraps the pages of one run.
UNREADABLE = "_unreadable"
ENVELOPE = T.StructType(
    [
        *PAGE_SCHEMA.fields,
        T.StructField("responses", T.ArrayType(PAGE_SCHEMA)),
        T.StructField(UNREADABLE, T.StringType()),
    ]
)

# Why a payload or a part of it is no page or no history.
NO_JSON, NO_RESULTS, NO_NUMBER = "not a document", "no results", "no page number"
NO_HISTORY, NO_DAY = "no history", "no day"


def read_payloads(
    spark: SparkSession, path: str, *, whole_files: bool = False, partitions: Sequence[str] = PARTITIONS
) -> DataFrame:
    """Payload texts as landed under ``ingest_date=…/country=…``; the folders give those columns.

    One payload per line splits over tasks and is the form for large landings; ``whole_files`` reads
    indented documents, one per file and task. A landing written by ``write_payloads`` is read whichever
    form it was landed in.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("value", *partitions)])
    payloads = spark.read.schema(schema).text(path, wholetext=whole_files)
    return payloads.filter(F.length(F.btrim("value")) > 0)


def read_documents(
    payloads: DataFrame, value: str = "value", page_number: str | None = None
) -> DataFrame:
    """Every page found in the payloads, good or not: ``count, page, results, at, reason, sample``.

    An archive document yields all pages it wraps, each judged by itself. A page's number is the one in
    its body, else the integer column ``page_number`` (from a file or folder name), else its place in
    the archive. ``reason`` is null for a good page: one with a number and a list of results, be it
    empty. A field of the wrong type becomes null.
    """
    others = [c for c in payloads.columns if c not in (value, page_number)]
    stated = F.col(page_number).cast("int") if page_number else F.lit(None).cast("int")
    doc = F.from_json(value, ENVELOPE, {"columnNameOfCorruptRecord": UNREADABLE})
    parsed = payloads.select(*others, stated.alias("_stated"), F.substring(value, 1, 80).alias("sample"), doc.alias("doc"))
    single = F.array(F.struct(*[F.col(f"doc.{name}").alias(name) for name in PAGE_SCHEMA.names]))
    # The outer form, because a plain explode is preceded by a filter that parses the text again.
    exploded = parsed.select(
        *others, "_stated", "sample",
        F.col("doc.responses").isNotNull().alias("_wrapped"),
        F.col(f"doc.{UNREADABLE}").isNotNull().alias("_odd"),
        F.posexplode_outer(F.coalesce("doc.responses", single)).alias("at", "p"),
    )
    place = F.when(F.col("_wrapped"), F.col("at") + 1)
    page = F.coalesce("p.page", "_stated", place)
    reason = (
        F.when(F.col("p").isNull() & F.col("_wrapped") & F.col("at").isNull(), None)  # an archive of no pages
        .when(F.col("p.results").isNull(), F.when(F.col("_odd") & ~F.col("_wrapped"), NO_JSON).otherwise(NO_RESULTS))
        .when(page.isNull(), NO_NUMBER)
    )
    found = exploded.filter(~(F.col("_wrapped") & F.col("at").isNull()))
    return found.select(
        *others, F.col("p.count").alias("count"), page.alias("page"), F.col("p.results").alias("results"),
        F.coalesce("at", F.lit(0)).alias("at"), reason.alias("reason"), "sample",
    )


def good_pages(documents: DataFrame) -> DataFrame:
    return documents.filter("reason is null").drop("at", "reason", "sample")


def rejects(documents: DataFrame, run: Sequence[str] = PARTITIONS) -> DataFrame:
    """What was no page, with the reason, the place in its document and the start of the text."""
    return documents.filter("reason is not null").select(*run, "at", "reason", "sample")


def reject_counts(rejected: DataFrame, run: Sequence[str] = PARTITIONS) -> DataFrame:
    return rejected.groupBy(*run, "reason").agg(F.count(F.lit(1)).alias("n"))


def parse_pages(payloads: DataFrame, value: str = "value", page_number: str | None = None) -> DataFrame:
    """The good pages of the payloads; ``read_documents`` says what was left out and why."""
    return good_pages(read_documents(payloads, value, page_number))


def one_per_page(pages: DataFrame, run: Sequence[str] = PARTITIONS) -> DataFrame:
    """One row per run and page: of a page landed several times the fullest copy, then by content."""
    order = [-F.size("results"), F.xxhash64("count", "results")]
    return keep_first_sparse(pages, [*run, "page"], order, "repeated-pages")


def page_totals(pages: DataFrame, run: Sequence[str] = PARTITIONS) -> DataFrame:
    """Per page its rows, the running total and the number page 1 advertised; no advert is carried.

    Copies of a page count once. The page sizes are written once: they cost a pass over the payloads,
    and everything after works on that narrow table.
    """
    size = F.greatest(F.size("results"), F.lit(0)).cast("long").alias("n")
    copies = pages.select(*run, "page", "count", size, F.xxhash64("count", "results").alias("_h"))
    # the copy that one_per_page keeps
    best = F.min_by(F.struct("count", "n"), F.struct(-F.col("n"), "_h")).alias("_best")
    sizes = stage(copies.groupBy(*run, "page").agg(best).select(*run, "page", "_best.*"), "page-sizes")
    totals = running_total(sizes.select(*run, "page", "n"), by=run, position="page", value="n", output="fetched")
    first = F.max(F.when(F.col("page") == 1, F.col("count")))
    advertised = sizes.groupBy(*run).agg(F.coalesce(first, F.lit(0)).alias("advertised"))
    return totals.join(advertised, list(run))


def _last_page(totals: DataFrame, max_pages: int | None, run: Sequence[str]) -> DataFrame:
    reached = (F.col("advertised") > 0) & (F.col("fetched") >= F.col("advertised"))
    stop = F.min(F.when((F.col("n") == 0) | reached, F.col("page")))
    last = F.coalesce(stop, F.max("page"))
    if max_pages is not None:
        last = F.least(last, F.lit(max_pages))
    return totals.groupBy(*run).agg(last.alias("last_page"))


def last_pages(pages: DataFrame, *, max_pages: int | None = None, run: Sequence[str] = PARTITIONS) -> DataFrame:
    """Last page to read per run: the cap, the first empty page, or the page that reaches the total."""
    return _last_page(page_totals(pages, run), max_pages, run)


def cut_pages(
    pages: DataFrame,
    *,
    max_pages: int | None = None,
    run: Sequence[str] = PARTITIONS,
    totals: DataFrame | None = None,
) -> DataFrame:
    """The pages a sequential reader would have read before it stopped, each once."""
    totals = page_totals(pages, run) if totals is None else totals
    last = stage(_last_page(totals, max_pages, run), "last-pages")
    read = one_per_page(pages, run).join(last, list(run))
    return read.filter(F.col("page") <= F.col("last_page")).drop("last_page")


def page_audit(
    pages: DataFrame,
    *,
    max_pages: int | None = None,
    run: Sequence[str] = PARTITIONS,
    totals: DataFrame | None = None,
    cut: bool = True,
) -> DataFrame:
    """``(run, pages, fetched, advertised, complete)`` over the pages kept by the cut-off, or over all."""
    totals = page_totals(pages, run) if totals is None else totals
    if cut:
        last = _last_page(totals, max_pages, run)
        totals = totals.join(last, list(run)).filter(F.col("page") <= F.col("last_page"))
    return (
        totals.groupBy(*run)
        .agg(
            F.count(F.lit(1)).alias("pages"),
            F.sum("n").alias("fetched"),
            F.max("advertised").alias("advertised"),
        )
        .withColumn("complete", F.col("fetched") >= F.col("advertised"))
    )


def explode_ads(pages: DataFrame, run: Sequence[str] = PARTITIONS) -> DataFrame:
    """One row per advert, stamped with its run and its place ``(page, pos)``."""
    ads = pages.select(*run, "page", F.posexplode("results").alias("pos", "ad"))
    fields = pages.schema["results"].dataType.elementType.names
    return ads.select(*[F.col(f"ad.{f}").alias(f) for f in fields if f not in run], *run, "page", "pos")


def extraction_counters(pages: DataFrame, run: Sequence[str] = PARTITIONS) -> DataFrame:
    """Pages and adverts per run; a page that landed twice counts once."""
    totals = page_totals(pages, run)
    return totals.groupBy(*run).agg(F.count(F.lit(1)).alias("pages"), F.sum("n").cast("long").alias("ads"))


def flatten_nested_to_json(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text, scalars as they are; driven by the schema alone."""

    def column(field: T.StructField) -> Column:
        if isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType)):
            return F.to_json(field.name, {"ignoreNullFields": "false"}).alias(field.name)
        return F.col(field.name)

    return df.select([column(field) for field in df.schema])


def read_history(payloads: DataFrame, value: str = "value", country: str = "country") -> DataFrame:
    """Every entry of the history payloads, good or not: ``(country, day, count, details_json, reason, sample)``.

    ``history`` may be a map ``day -> {count: n, …}``, a map ``day -> n`` or a list of such pairs;
    what is not an object is the count itself and has no details. ``reason`` says why a payload or an
    entry of it is left out: no document, no history, or an entry without a day.
    """
    document = F.try_parse_json(value)
    history = F.try_variant_get(document, "$.history", "variant")
    as_map = F.try_variant_get("history", "$", "map<string,variant>")
    pairs = F.try_variant_get("history", "$", "array<variant>")
    as_pairs = F.transform(
        pairs,
        lambda pair: F.struct(
            F.try_variant_get(pair, "$[0]", "string").alias("key"),
            F.try_variant_get(pair, "$[1]", "variant").alias("value"),
        ),
    )
    entries = payloads.select(
        country, document.isNotNull().alias("_read"), F.substring(value, 1, 80).alias("sample"), history.alias("history")
    )
    entries = entries.withColumn("_all", F.coalesce(F.map_entries(as_map), as_pairs))
    exploded = entries.select(country, "_read", "sample", F.col("_all").isNotNull().alias("_found"), F.explode_outer("_all").alias("entry"))
    days = exploded.select(
        country, "sample", "_read", "_found", F.col("entry").isNotNull().alias("_any"),
        F.col("entry.key").alias("day"), F.col("entry.value").alias("v"),
    )
    is_object = F.schema_of_variant("v").startswith("OBJECT")
    reason = (
        F.when(~F.col("_read"), NO_JSON).when(~F.col("_found"), NO_HISTORY).when(F.col("_any") & F.col("day").isNull(), NO_DAY)
    )
    return days.filter("not _found or _any").select(
        F.col(country).alias("country"),
        "day",
        F.when(is_object, F.try_variant_get("v", "$.count", "long"))
        .otherwise(F.try_variant_get("v", "$", "long"))
        .alias("count"),
        F.when(is_object, F.to_json("v")).alias("details_json"),
        reason.alias("reason"),
        "sample",
    )


def normalise_history(payloads: DataFrame, value: str = "value", country: str = "country") -> DataFrame:
    """The good entries of the history payloads as ``(country, day, count, details_json)``."""
    return read_history(payloads, value, country).filter("reason is null").drop("reason", "sample")


def history_rejects(payloads: DataFrame, value: str = "value", country: str = "country") -> DataFrame:
    """``(country, reason, sample)`` of payloads and entries that ``normalise_history`` leaves out."""
    return read_history(payloads, value, country).filter("reason is not null").select("country", "reason", "sample")

"""The full run: landed payloads to layers, masters, warehouse and reports."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from advertlake.functions.taxonomy import SKILLS, Taxonomy
from advertlake.operators.clean import clean_ads
from advertlake.operators.enrich import enrich_ads
from advertlake.operators.quality import assert_quality, quality_checks, quality_passed
from advertlake.operators.history import Dimension
from advertlake.operators.quality import extraction_checks
from advertlake.plans import reports
from advertlake.plans.warehouse import FACT_TABLE, FLAGS_TABLE, Warehouse
from advertlake.schema import CLEAN_SCHEMA, HISTORY_KEY, HISTORY_SCHEMA, SNAPSHOT_KEY
from advertlake.session import configure, scratch_path, scratch_scope, stage
from advertlake.sources import layers, pages, store
from advertlake.sources.dimensions import load_snapshots

REPORT_STATES = "report_states"
JOBS_MASTER = "processed/jobs_master"
HISTORY_MASTER = "processed/history_master"

# Defaults of a run.
DEFAULT_COUNTRIES = ("gb", "us")
DEFAULT_START_DATE = "2026-01-01"


@dataclass
class RunResult:
    """Counters of a run and its frames; the counters are a handful of rows."""

    ingest_date: str
    raw_jobs: int
    history_rows: int
    cleaned_rows: int
    extraction: list[Row]
    cleaning_report: Row
    passed: bool
    checks: DataFrame
    null_summary: DataFrame
    written: list[str] = field(default_factory=list)
    analysis_rows: int = 0
    exported: list[str] | None = None
    previews: dict[str, tuple[DataFrame, DataFrame]] | None = None


def run_pipeline(
    spark: SparkSession,
    *,
    search_path: str,
    root: str,
    ingested_at: datetime,
    history_path: str | None = None,
    countries: Sequence[str] = DEFAULT_COUNTRIES,
    start_date: str | None = DEFAULT_START_DATE,
    cut: bool = False,
    max_pages: int | None = None,
    page_number: str | None = None,
    warehouse_root: str | None = None,
    export: bool = False,
    dry_run: bool = False,
    fail_on_validation: bool = False,
    whole_files: bool = False,
    now: datetime | None = None,
    taxonomy: Taxonomy = SKILLS,
    source: str = "job-board",
    dimensions: Sequence[Dimension] = (),
    report_states: bool = False,
) -> RunResult:
    """Extract, clean, check, load, analyse and export the payloads landed for one ingest date.

    The batch is parsed once and cleaned once: pages and clean rows are written to the shared scratch
    folder, which is freed at the end, and quality checks, layers and analysis read those tables.
    Everything landed is loaded, each page once, unless ``cut`` asks for what a sequential reader
    would have read, or ``max_pages`` for no more than that. Pages that cannot be read, and runs that
    hold fewer adverts than were advertised, are checks of their own. Quality is judged before anything
    is loaded. Loading replaces by folder and by key, so a lost run can simply be repeated.

    The warehouse also keeps the versions of ``dimensions``, each brought up to the run's day, and with ``report_states``
    the partial states that reports are combined from; both read and write what the day touches.
    """
    if export and not warehouse_root:
        raise ValueError("export needs a warehouse_root")
    configure(spark)
    instant = ingested_at if ingested_at.tzinfo else ingested_at.replace(tzinfo=timezone.utc)
    ingest_date = instant.astimezone(timezone.utc).date().isoformat()
    of_run = (F.col("ingest_date") == ingest_date) & F.col("country").isin(list(countries))

    # the two results that outlive the run's scratch
    lasting = {label: scratch_path(spark, label) for label in ("checks", "nulls")}
    with scratch_scope(spark, "run"):
        result = _loaded(
            spark, search_path=search_path, history_path=history_path, root=root, warehouse_root=warehouse_root, instant=instant,
            ingest_date=ingest_date, of_run=of_run, start_date=start_date, cut=cut, max_pages=max_pages, page_number=page_number,
            fail_on_validation=fail_on_validation, whole_files=whole_files, now=now, taxonomy=taxonomy, source=source, lasting=lasting,
            dimensions=dimensions, report_states=report_states,
        )
        if export and not dry_run:
            result.exported = layers.export_all(Warehouse(spark, warehouse_root).export_frames(), f"{root}/export")
    if export and dry_run:
        frames = Warehouse(spark, warehouse_root).export_frames()
        result.previews = layers.preview(frames)
        result.exported = list(frames)
    return result


def _loaded(
    spark: SparkSession,
    *,
    search_path: str,
    history_path: str | None,
    root: str,
    warehouse_root: str | None,
    instant: datetime,
    ingest_date: str,
    of_run: Column,
    start_date: str | None,
    cut: bool,
    max_pages: int | None,
    page_number: str | None,
    fail_on_validation: bool,
    whole_files: bool,
    now: datetime | None,
    taxonomy: Taxonomy,
    source: str,
    lasting: dict[str, str],
    dimensions: Sequence[Dimension],
    report_states: bool,
) -> RunResult:
    """The run up to its reports; what it stages belongs to the scope around it, but for the ``lasting`` tables."""

    def kept(df: DataFrame, label: str) -> DataFrame:
        return stage(df, label)

    payloads = pages.read_payloads(spark, search_path, whole_files=whole_files).filter(of_run)
    documents = kept(pages.read_documents(payloads, page_number=page_number), "documents")
    parsed, rejected = pages.good_pages(documents), pages.rejects(documents)
    cut = cut or max_pages is not None
    totals = pages.page_totals(parsed)
    read = pages.cut_pages(parsed, max_pages=max_pages, totals=totals) if cut else pages.one_per_page(parsed)
    ads = pages.explode_ads(read)
    audit = kept(pages.page_audit(parsed, max_pages=max_pages, totals=totals, cut=cut), "audit")
    extraction = audit.orderBy("country").collect()

    clean, report = clean_ads(ads, ingested_at=instant, start_date=start_date, source=source)
    clean = kept(clean, "clean")
    checks, nulls = quality_checks(clean, now=now or datetime.now(timezone.utc), start_date=start_date)
    history_payloads = history = lost = None
    if history_path:
        history_payloads = pages.read_payloads(spark, history_path, whole_files=whole_files).filter(of_run)
        entries = kept(pages.read_history(history_payloads), "history")
        history = entries.filter("reason is null").drop("reason", "sample")
        lost = entries.filter("reason is not null")
    found = extraction_checks(audit, rejected, lost)
    checks = checks.unionByName(found)
    checks = stage(checks, "checks", lasting["checks"])
    nulls = stage(nulls, "nulls", lasting["nulls"]).orderBy(F.desc("null_rate"), "column")
    if fail_on_validation:
        assert_quality(checks)

    written = layers.write_layers(
        root=root,
        ingest_date=ingest_date,
        payloads=payloads,
        ads=ads,
        clean=clean,
        history_payloads=history_payloads,
        history=history,
    )
    master = f"{root}/{JOBS_MASTER}"
    store.save_replaced(spark, master, clean, schema=CLEAN_SCHEMA)
    written.append(master)
    if history is not None:
        history_master = f"{root}/{HISTORY_MASTER}"
        store.save_replaced(
            spark, history_master, history, schema=HISTORY_SCHEMA, key=HISTORY_KEY,
            partitions=("country",), sort=("day",), keep_last_of=("count", "details_json"),
        )
        written.append(history_master)

    summary = report.first()
    result = RunResult(
        ingest_date=ingest_date,
        raw_jobs=summary.input_rows,
        history_rows=history.count() if history is not None else 0,
        cleaned_rows=summary.output_rows,
        extraction=extraction,
        cleaning_report=summary,
        passed=quality_passed(checks).first().passed,
        checks=checks,
        null_summary=nulls,
        written=written,
        analysis_rows=summary.output_rows,  # one flags row per clean row
    )

    if warehouse_root:
        flags = kept(enrich_ads(clean, taxonomy=taxonomy), "flags")
        warehouse = Warehouse(spark, warehouse_root)
        warehouse.upsert_jobs(clean)
        warehouse.upsert_analysis(flags)
        frames = warehouse.export_frames()
        written.append(warehouse_root)
        written += layers.write_analysis(flags, frames, root, ingest_date.replace("-", ""))
        for dimension in dimensions:
            # a day before the last loaded one is built from the stored facts, others do not read them
            load_snapshots(spark, f"{warehouse_root}/dim_{dimension.name}", clean, dimension, snapshots=warehouse.table(FACT_TABLE))
        if report_states:
            # the folders as the loads left them: a run may send a part of a day again
            of_day = (F.col("ingest_date") == ingest_date) & F.col("country").isin(sorted({r["country"] for r in extraction}))
            salaries = warehouse.table(FACT_TABLE).filter(of_day).select(*SNAPSHOT_KEY, *reports.MEASURES)
            stored = warehouse.table(FLAGS_TABLE).filter(of_day).join(salaries, list(SNAPSHOT_KEY))
            reports.refresh(spark, f"{warehouse_root}/{REPORT_STATES}", stage(stored, "report-rows"))
    return result

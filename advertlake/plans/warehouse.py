"""Tables over the stored layers, the reporting views and the export frames."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from advertlake.operators.enrich import join_flags
from advertlake.operators.share import group_counts, latest_period, period_share
from advertlake.schema import CLEAN_SCHEMA, FLAGS_SCHEMA
from advertlake.session import names_in, read_note, write_note
from advertlake.sources.store import current, read_keyed, save_replaced

FACT_TABLE = "fact_job_snapshot"
FLAGS_TABLE = "analysis_job_ai_flags"
TABLES: dict[str, T.StructType] = {FACT_TABLE: CLEAN_SCHEMA, FLAGS_TABLE: FLAGS_SCHEMA}
WEEKLY_VIEW = "v_ai_share_weekly"
LATEST_VIEW = "v_ai_share_latest"
COUNTS_VIEW = "v_ai_skill_counts"


def share_weekly(fact: DataFrame, flags: DataFrame) -> DataFrame:
    """Weekly shares over facts joined with their flags; only the columns of the report are read."""
    joined = join_flags(fact.select("job_id", "country", "ingest_date", "created_at"), flags,
                        columns=["role_class", "ai_mentioned"])
    return period_share(joined)


def export_frames(fact: DataFrame, flags: DataFrame) -> dict[str, DataFrame]:
    """The three report frames in their export order, ties settled by the group columns."""
    weekly = share_weekly(fact, flags)
    return {
        "ai_share_weekly": weekly.orderBy("week", "country", "role_class"),
        "ai_share_latest": latest_period(weekly).orderBy(F.desc("ai_share"), "country", "role_class"),
        "ai_skill_counts": group_counts(flags).orderBy(F.desc("ads"), "country", "role_class"),
    }


class Warehouse:
    """The two keyed tables below one root folder, queryable by name, with views that are stored beside them.

    Whoever opens the folder finds the same names, in this session or another one: tables and standard views follow from
    the code, further views are kept as SQL below ``views``. The session catalog holds views over the files, so no shared
    metastore is needed; ``query`` looks first whether another writer has loaded something since. What a load replaces
    stays readable for ``retain`` further loads, for frames that were made before.
    """

    def __init__(self, spark: SparkSession, root: str, *, retain: int = 1) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self.retain = retain
        self.seen: tuple | None = None
        self.ensure_schema()

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def table(self, name: str) -> DataFrame:
        return read_keyed(self.spark, self.path(name), TABLES[name])

    def _state(self) -> tuple:
        """Numbers of the last loads and the names of the stored views; a few folder listings."""
        loads = [current(self.spark, self.path(name)).load for name in TABLES]
        return (*loads, *names_in(self.spark, f"{self.root}/views"))

    def ensure_schema(self) -> None:
        """Point the names at the current files; a table without loads is empty. Safe to repeat."""
        self.seen = self._state()
        for name in TABLES:
            self.table(name).createOrReplaceTempView(name)
        fact, flags = self.table(FACT_TABLE), self.table(FLAGS_TABLE)
        share_weekly(fact, flags).createOrReplaceTempView(WEEKLY_VIEW)
        # lazily: a view must not compute anything when it is made
        self.spark.sql(
            f"SELECT * FROM {WEEKLY_VIEW} WHERE week = (SELECT max(week) FROM {WEEKLY_VIEW})"
        ).createOrReplaceTempView(LATEST_VIEW)
        group_counts(flags).createOrReplaceTempView(COUNTS_VIEW)
        for name, sql in self._stored_views().items():
            self.spark.sql(sql).createOrReplaceTempView(name)

    def _stored_views(self) -> dict[str, str]:
        """SQL of the stored views, in the order in which they were first made: a view may use those before it.

        Every change is a file of its own, ``<number>-<name>.json``; the last one of a name counts.
        """
        out = {}
        for f in names_in(self.spark, f"{self.root}/views"):
            if f.endswith(".json"):
                note = json.loads(read_note(self.spark, f"{self.root}/views/{f}"))
                out[note["name"]] = note["sql"]
        return out

    def create_view(self, name: str, sql: str) -> None:
        """Keep a view with the tables: everyone who opens the warehouse finds it. Its SQL is tried before it is kept."""
        if not name.isidentifier():
            raise ValueError(f"not a view name: {name}")
        self.query(sql).schema  # noqa: B018
        numbers = [int(f[:6]) for f in names_in(self.spark, f"{self.root}/views") if f.endswith(".json")]
        note = json.dumps({"name": name, "sql": sql})
        write_note(self.spark, f"{self.root}/views/{1 + max(numbers, default=0):06d}-{name}.json", note)
        self.ensure_schema()

    def _upsert(self, table: str, batch: DataFrame) -> int:
        n = save_replaced(self.spark, self.path(table), batch, schema=TABLES[table], retain=self.retain)
        if n:
            self.ensure_schema()
        return n

    def upsert_jobs(self, clean: DataFrame) -> int:
        """Put clean snapshot rows in by key; returns the size of the batch, 0 changes nothing.

        A key the batch repeats is stored once; a null key stops the load.
        """
        return self._upsert(FACT_TABLE, clean)

    def upsert_analysis(self, flags: DataFrame) -> int:
        return self._upsert(FLAGS_TABLE, flags)

    def query(self, sql: str) -> DataFrame:
        if self.seen != self._state():
            self.ensure_schema()
        return self.spark.sql(sql)

    def table_count(self, name: str) -> int:
        return self.query(f"SELECT * FROM {name}").count()

    def export_frames(self) -> dict[str, DataFrame]:
        return export_frames(self.table(FACT_TABLE), self.table(FLAGS_TABLE))

"""Keyed merges of a batch into an accumulated table, as plain table-to-table operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from advertlake.operators.windows import keep_first
from advertlake.schema import HISTORY_KEY, SNAPSHOT_KEY, enforce_schema

MASTER_ORDER = ("ingest_date", "created_at", "job_id")
HISTORY_ORDER = ("day",)


def concat_batches(*batches: DataFrame, sequence: str = "_batch") -> DataFrame:
    """Batches one below the other on the schema of the first, numbered in order of arrival."""
    schema = batches[0].schema
    out = None
    for number, batch in enumerate(batches):
        part = enforce_schema(batch, schema).withColumn(sequence, F.lit(number))
        out = part if out is None else out.unionByName(part)
    return out


def keep_last(
    df: DataFrame, key: Sequence[str], sequence: str = "_batch", order_by: Sequence[str] = ()
) -> DataFrame:
    """The last row of every key: latest batch first, then the stated order within a batch."""
    order = [F.desc(sequence), *[F.desc_nulls_last(c) for c in order_by]]
    return keep_first(df, key, order).drop(sequence)


def merge_keep_last(
    previous: DataFrame, new: DataFrame, *, key: Sequence[str] = SNAPSHOT_KEY, order_by: Sequence[str] = ()
) -> DataFrame:
    """Accumulated master after a batch. An empty batch changes nothing.

    ``order_by`` settles keys repeated within one batch; clean batches hold a key once.
    """
    return keep_last(concat_batches(previous, new), key, order_by=order_by)


def replace_by_key(target: DataFrame, batch: DataFrame, *, key: Sequence[str] = SNAPSHOT_KEY) -> DataFrame:
    """Target with the rows of the batch put in place of equal keys.

    The batch must hold each key once. The anti-join keeps whole target rows in place and needs the
    key columns of the batch only; no window or sort over the text columns.
    """
    kept = target.join(batch.select(*key), list(key), "left_anti").select(*target.columns)
    return kept.unionByName(enforce_schema(batch, target.schema))


def merge_history(previous: DataFrame, new: DataFrame) -> DataFrame:
    return merge_keep_last(previous, new, key=HISTORY_KEY, order_by=("count", "details_json"))


def not_loaded(partitions: DataFrame, ledger: DataFrame, key: Sequence[str] = ("ingest_date", "country")) -> DataFrame:
    """Partitions that the load ledger does not list yet."""
    return partitions.join(ledger.select(*key).distinct(), list(key), "left_anti")


def master_sorted(df: DataFrame, order: Sequence[str] = MASTER_ORDER) -> DataFrame:
    """The total order of a one-file export, missing values last."""
    return df.orderBy(*[F.asc_nulls_last(c) for c in order])


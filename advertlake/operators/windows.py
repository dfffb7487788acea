"""Window forms that hold up when one key owns a large part of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from advertlake.session import stage


def keep_first(df: DataFrame, key: Sequence[str], order_by: Sequence[Column | str]) -> DataFrame:
    """First row of every key in a stated total order; null keys count as equal.

    ``row_number() = 1`` lets Spark place a group limit in front of the shuffle: every task sends
    at most one row per key, so a key that owns a third of the input stays harmless.
    """
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(*order_by))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def keep_first_sparse(
    df: DataFrame, key: Sequence[str], order_by: Sequence[Column | str], label: str = "repeated-keys"
) -> DataFrame:
    """As ``keep_first`` where few keys repeat, without moving rows; ``order_by`` are values, the least one first.

    A first pass over key and order columns alone finds the keys with more than one row and the least order of each. This
    short list meets ``df`` in one left join, which adaptive execution broadcasts, and rows of a listed key stay if they
    have its least order: ``df`` is computed in full once, and its texts are not shuffled. Only where several rows of a
    key share the least order (a second narrow pass tells) are the rows of these keys ranked among themselves.
    """
    order = F.struct(*[(F.col(c) if isinstance(c, str) else c).alias(f"o{i}") for i, c in enumerate(order_by)])
    listed = [F.col(c).alias(f"_k{i}") for i, c in enumerate(key)]
    found = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"), F.min(order).alias("_least")).filter("_n > 1")
    found = stage(found.select(*listed, "_least"), label)
    if found.isEmpty():
        return df
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(key)])
    names = found.columns
    least = df.select(*key, order.alias("_order")).join(found, same & F.col("_order").eqNullSafe(F.col("_least")))
    tied = stage(least.groupBy(*names[:-1]).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n"), label)
    if not tied.isEmpty():
        whole = [*order_by, F.xxhash64(*df.columns)]
        repeated = keep_first(df.join(found, same, "left_semi"), key, whole)
        return df.join(found, same, "left_anti").unionByName(repeated)
    met = df.withColumn("_order", order).join(found, same, "left")
    return met.filter(F.col("_least").isNull() | F.col("_order").eqNullSafe(F.col("_least"))).drop("_order", *names)


def top_k(
    df: DataFrame, k: int, order_by: Sequence[Column | str], by: Sequence[str] = ()
) -> DataFrame:
    """The first ``k`` rows in order, over all rows or within every group."""
    if not by:
        return df.orderBy(*order_by).limit(k)
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order_by))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= k).drop("_rank")


def running_total(
    df: DataFrame,
    *,
    by: Sequence[str],
    position: str,
    value: str,
    output: str,
    block: int = 4096,
) -> DataFrame:
    """Inclusive running sum of ``value`` along the integer ``position`` within ``by``.

    The positions are cut into blocks: one window runs inside each block and a second one over the
    block totals, so no task sorts a whole group. ``df`` should hold only the columns needed.
    """
    blocks = df.withColumn("_block", F.floor(F.col(position) / block))
    in_block = Window.partitionBy(*by, "_block").orderBy(position)
    inside = blocks.withColumn("_inside", F.sum(value).over(in_block))
    totals = blocks.groupBy(*by, "_block").agg(F.sum(value).alias("_total"))
    before = Window.partitionBy(*by).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*by, "_block", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_before"))
    return (
        inside.join(offsets, [*by, "_block"])
        .withColumn(output, F.col("_before") + F.col("_inside"))
        .drop("_block", "_inside", "_before")
    )


def seeded_sample(df: DataFrame, n: int, key: Sequence[str], seed: int) -> DataFrame:
    """A repeatable sample of at most ``n`` rows: smallest hashes of key and seed first."""
    text = F.concat_ws("\x1f", *[F.col(c).cast("string") for c in key], F.lit(str(seed)))
    return df.orderBy(F.md5(text), *key).limit(n)

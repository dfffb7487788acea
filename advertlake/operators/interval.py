"""Lookup of the version valid at a date for many dimensions at once, as one sweep over facts and versions."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from advertlake.session import stage

ASKED, KNOWN = 1, 0


def key_text(key: Sequence[str]) -> Column:
    """A business key as one text; null if a part of it is null."""
    if len(key) == 1:
        return F.col(key[0]).cast("string")
    parts = [F.col(c).cast("string") for c in key]
    sized = [F.concat(F.length(p).cast("string"), F.lit(":"), p) for p in parts]
    return F.when(reduce(and_, [p.isNotNull() for p in parts]), F.concat(*sized))


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Walk a range in order of dimension, key and date, and give each asked row the last version before it.

    ``open`` marks rows of the range's first key that saw no version here: it may stand in a range before. The last
    record, without a row number, tells later ranges with what key and version this one ended.
    """
    part = TaskContext.get().partitionId()
    first = last = None  # (dimension, key) of the range's first row and of the last one so far
    held = (None, None)  # version and end, of the last key
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        dim, key = batch.column("dim").to_numpy(), batch.column("key").to_numpy(zero_copy_only=False)
        known = batch.column("kind").to_numpy() == KNOWN
        version, until = batch.column("version").to_pylist(), batch.column("until").to_pylist()
        begins = np.ones(n, bool)
        begins[1:] = (dim[1:] != dim[:-1]) | (key[1:] != key[:-1])
        begins[0] = (int(dim[0]), key[0]) != last
        if first is None:
            first = (int(dim[0]), key[0])
        place = np.arange(n)
        group = np.maximum.accumulate(np.where(begins, place, -1))  # -1: the key of the batch before goes on
        seen = np.maximum.accumulate(np.where(known, place, -1))
        here = (seen >= group) & (seen >= 0)
        carried = ~here & (group < 0)
        asked = np.flatnonzero(~known)
        at = batch.column("at").to_pylist()
        out_version, out_open = [], []
        in_first = [(int(dim[i]), key[i]) == first for i in asked]
        for i, leading in zip(asked.tolist(), in_first):
            v, u = (version[seen[i]], until[seen[i]]) if here[i] else held if carried[i] else (None, None)
            out_version.append(v if v is not None and (u is None or at[i] < u) else None)
            out_open.append(leading and v is None)
        took = asked.tolist()
        yield _batch(
            batch.schema.field("at").type,
            [batch.column("row")[i].as_py() for i in took],
            dim[asked].tolist(), [at[i] for i in took], out_version, [None] * len(took), out_open, part,
        )
        last = (int(dim[-1]), key[-1])
        held = (version[seen[-1]], until[seen[-1]]) if here[-1] else held if carried[-1] else (None, None)
    if first is not None:
        kind = batch.schema.field("at").type
        tail = _batch(kind, [None], [last[0]], [None], [held[0]], [held[1]], [first == last], part)
        yield pa.RecordBatch.from_arrays(
            [*tail.columns[:-2], pa.array([repr(first)]), pa.array([repr(last)])], schema=tail.schema
        )


def _batch(kind: pa.DataType, row, dim, at, version, until, open_, part: int) -> pa.RecordBatch:
    n = len(row)
    columns = [
        pa.array(row, pa.int64()), pa.array(dim, pa.int32()), pa.array(at, kind), pa.array(version, pa.string()),
        pa.array(until, kind), pa.array(open_, pa.bool_()), pa.array([part] * n, pa.int32()),
        pa.nulls(n, pa.string()), pa.nulls(n, pa.string()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["row", "dim", "at", "version", "until", "open", "part", "first", "last"])


def with_versions(
    facts: DataFrame,
    tables: Mapping[str, DataFrame],
    keys: Mapping[str, Sequence[str]],
    *,
    at: str,
) -> DataFrame:
    """``facts`` with ``<name>_version`` of every dimension's version valid at ``at``; no version gives null.

    The facts are computed once, whatever the number of dimensions. Their keys, one narrow row per fact and dimension,
    and the versions are sorted together by dimension, key and date, over ranges that may end anywhere: a key with half
    of all facts takes as many ranges as it needs. Each range is swept once, and what a range's first key needs from the
    ranges before it is carried over from their ends, one row per range. Versions of a key must not overlap.
    """
    names = list(tables)
    if not names:
        return facts
    numbered = stage(facts.withColumn("_row", F.monotonically_increasing_id()), "facts")
    fields = [
        F.struct(F.lit(i).alias("dim"), key_text(keys[name]).alias("key"), F.col(at).alias("at")) for i, name in enumerate(names)
    ]
    asked = numbered.select(F.col("_row").alias("row"), F.inline(F.array(*fields))).filter("key IS NOT NULL AND at IS NOT NULL")
    kind = facts.schema[at].dataType
    asked = asked.select("dim", "key", "at", F.lit(ASKED).alias("kind"), "row", F.lit(None).cast("string").alias("version"), F.lit(None).cast(kind).alias("until"))
    rows = asked
    for i, name in enumerate(names):
        known = tables[name].select(
            F.lit(i).alias("dim"), key_text(keys[name]).alias("key"), F.col("valid_from").cast(kind).alias("at"), F.lit(KNOWN).alias("kind"),
            F.lit(-1).cast("bigint").alias("row"), F.col("version_id").alias("version"), F.col("valid_to").cast(kind).alias("until"),
        )
        rows = rows.unionByName(known.filter("key IS NOT NULL"))
    order = ["dim", "key", "at", "kind", "row"]
    schema = T.StructType(
        [T.StructField("row", T.LongType()), T.StructField("dim", T.IntegerType()), T.StructField("at", kind)]
        + [T.StructField("version", T.StringType()), T.StructField("until", kind), T.StructField("open", T.BooleanType())]
        + [T.StructField("part", T.IntegerType()), T.StructField("first", T.StringType()), T.StructField("last", T.StringType())]
    )
    swept = stage(rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_sweep, schema), "swept")
    # one row per range
    carry, before, version, until = [], None, None, None
    for tail in swept.filter("row IS NULL").orderBy("part").collect():
        goes_on = before is not None and tail["first"] == before
        if goes_on and version is not None:
            carry.append((tail["part"], version, until))
        if not (goes_on and tail["open"] and tail["version"] is None):  # else the same key went through the whole range
            version, until = tail["version"], tail["until"]
        before = tail["last"]
    found = swept.filter("row IS NOT NULL").select("row", "dim", "at", "version", "open", "part")
    if carry:
        part = T.StructType([T.StructField("_part", T.IntegerType()), T.StructField("_version", T.StringType()), T.StructField("_until", kind)])
        ends = F.broadcast(facts.sparkSession.createDataFrame(carry, part))
        found = found.join(ends, F.col("open") & (F.col("part") == F.col("_part")), "left")
        valid = F.col("_until").isNull() | (F.col("at") < F.col("_until"))
        found = found.withColumn("version", F.coalesce("version", F.when(valid, F.col("_version"))))
    wide = found.groupBy(F.col("row").alias("_row")).agg(
        *[F.max(F.when(F.col("dim") == i, F.col("version"))).alias(f"{name}_version") for i, name in enumerate(names)]
    )
    return numbered.join(wide, "_row", "left").drop("_row")

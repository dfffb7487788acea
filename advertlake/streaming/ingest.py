"""Incremental ingest and reports over landing folders with Structured Streaming."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from advertlake.functions.scalars import bit_is_set
from advertlake.operators.windows import keep_first
from advertlake.schema import CLEAN_SCHEMA, PARTITIONS, SNAPSHOT_KEY
from advertlake.session import names_in, remove, scratch_path, stage
from advertlake.sources.layers import is_dealt, spread_for_write
from advertlake.sources.store import BLANK_FOLDER, NULL_FOLDER, by_marks, first_marks, key_marks, save_replaced


def read_deltas(
    spark: SparkSession, path: str, schema: T.StructType = CLEAN_SCHEMA, *, files_per_batch: int | None = None
) -> DataFrame:
    """A stream over the files of a delta layer; every file is read once."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def stream_into_table(
    deltas: DataFrame,
    table_path: str,
    checkpoint: str,
    *,
    schema: T.StructType = CLEAN_SCHEMA,
    key: Sequence[str] = SNAPSHOT_KEY,
    partitions: Sequence[str] = PARTITIONS,
    last_by: Sequence[str] = ("ingested_at", "created_at", "description"),
) -> StreamingQuery:
    """Put all new deltas into the stored table and stop; run it on any schedule.

    A micro-batch may hold a key more than once (a day sent again), so the last one in ``last_by``
    order is kept. Loading replaces by key: a batch repeated after a failure changes nothing.
    """

    def load(batch: DataFrame, _: int) -> None:
        spark, scratch = batch.sparkSession, scratch_path(batch.sparkSession, "micro-batch")
        written = stage(batch, "micro-batch", scratch)
        save_replaced(spark, table_path, written, schema=schema, key=key, partitions=partitions, keep_last_of=last_by)
        remove(spark, scratch)

    return (
        deltas.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def distinct_snapshots(
    deltas: DataFrame, *, key: Sequence[str] = SNAPSHOT_KEY, ts: str = "ingested_at", delay: str = "2 days"
) -> DataFrame:
    """First arrival of every snapshot; the state of a key is dropped once the watermark passes it."""
    return deltas.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(key))


def week_window(ts: Column) -> Column:
    """Tumbling weeks from Monday: the epoch was a Thursday, four days before one."""
    return F.window(ts, "7 days", "7 days", "4 days")


def weekly_share_stream(
    flags: DataFrame,
    *,
    ts: str = "created_at",
    flag: str = "ai_mentioned",
    by: Sequence[str] = ("country", "role_class"),
    delay: str = "45 days",
) -> DataFrame:
    """Running weekly counts in update mode; the share follows from the counts when reading.

    State is one row per open week and group. ``delay`` is how late an advert may arrive, by default
    the lifetime of a listing.
    """
    return (
        flags.withWatermark(ts, delay)
        .groupBy(week_window(F.col(ts)).alias("w"), *by)
        .agg(F.count(F.lit(1)).alias("total_ads"), F.count_if(F.col(flag)).alias("ai_ads"))
        .select(F.col("w.start").cast("date").alias("week"), *by, "total_ads", "ai_ads")
    )


def _finished(spark: SparkSession, folder: str) -> bool:
    return "_SUCCESS" in names_in(spark, folder)


def _layers(spark: SparkSession, path: str) -> tuple[int | None, list[int]]:
    """Number of the last whole base, if there is one, and the numbers of the batches after it, rising."""
    names = names_in(spark, path)
    bases = sorted(int(n.removeprefix("base=")) for n in names if n.startswith("base="))
    base = next((n for n in reversed(bases) if _finished(spark, f"{path}/base={n}")), None)
    batches = sorted(int(n.removeprefix("batch=")) for n in names if n.startswith("batch="))
    return base, [n for n in batches if base is None or n > base]


def _fold(spark: SparkSession, path: str, rows: DataFrame, number: int) -> None:
    """Write ``rows``, all up to batch ``number``, as the new base; what the base before it had made needless goes.

    Batches since that base stay until the next one, for readers that have listed them.
    """
    older, _ = _layers(spark, path)
    rows.write.mode("overwrite").parquet(f"{path}/base={number}")
    for name in names_in(spark, path):
        kind, _, n = name.partition("=")
        if n.isdigit() and older is not None and (int(n) <= older if kind == "batch" else int(n) < older):
            remove(spark, f"{path}/{name}")


@contextmanager
def _state_tasks(spark: SparkSession, most: int | None) -> Iterator[None]:
    """A stream started inside deals its state to a task per core, or to ``most``, and never to more than the session says.

    A stream keeps the number it was first started with in its checkpoint.
    """
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(int(before), most or spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def append_updates(
    updates: DataFrame, path: str, checkpoint: str, *, key: Sequence[str] | None = None, fold: int = 16, tasks: int | None = None
) -> StreamingQuery:
    """Write each batch of updated rows under its batch number; a repeated batch replaces itself.

    With ``key``, every ``fold`` batches are folded into a base that holds the last update of each key, so that a reader
    opens no more than ``fold`` batches and a base, however long the stream runs.

    Every batch opens and commits the state of every task, however little it holds. Running counts are few, so a new
    stream has a task per core; ``tasks`` is for groups whose state needs more.
    """
    schema = updates.schema

    def save(batch: DataFrame, number: int) -> None:
        save_update(batch.sparkSession, path, batch, schema, number, key=key, fold=fold)

    writer = updates.writeStream.outputMode("update").foreachBatch(save).option("checkpointLocation", checkpoint)
    with _state_tasks(updates.sparkSession, tasks):
        return writer.trigger(availableNow=True).start()


def save_update(
    spark: SparkSession, path: str, batch: DataFrame, schema: T.StructType, number: int, *, key: Sequence[str] | None, fold: int = 16
) -> None:
    batch.write.mode("overwrite").parquet(f"{path}/batch={number}")
    if key and len(_layers(spark, path)[1]) >= fold:
        _fold(spark, path, _last_updates(spark, path, schema, key), number)


def append_rows(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write finished rows to parquet through the exactly-once file sink and stop."""
    return (
        rows.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _last_updates(spark: SparkSession, path: str, schema: T.StructType, key: Sequence[str]) -> DataFrame:
    base, batches = _layers(spark, path)
    numbered = T.StructType([*schema.fields, T.StructField("batch", T.LongType())])
    rows = spark.createDataFrame([], numbered)
    if batches:
        rows = spark.read.schema(numbered).option("basePath", path).parquet(*[f"{path}/batch={n}" for n in batches])
    if base is not None:
        folded = spark.read.schema(schema).parquet(f"{path}/base={base}")
        rows = rows.unionByName(folded.withColumn("batch", F.lit(-1).cast("bigint")))
    return keep_first(rows, key, [F.desc("batch")]).drop("batch")


def latest_updates(
    spark: SparkSession, path: str, schema: T.StructType, *, key: Sequence[str], digits: int = 4
) -> DataFrame:
    """The current weekly share table: the last update of every group, from the base and the batches after it."""
    latest = _last_updates(spark, path, schema, key)
    return latest.withColumn("ai_share", F.round(F.col("ai_ads") / F.col("total_ads"), digits))


# ---- first arrivals, across restarts and watermarks


def _bits(keys: DataFrame, key: Sequence[str], within: Sequence[str], bits: int, hashes: int) -> DataFrame:
    """``within``, ``key``, bucket and place in it of every hash of every key."""
    place = F.explode(F.array(*[F.pmod(F.xxhash64(*key, F.lit(j)), F.lit(bits)) for j in range(hashes)]))
    columns = list(dict.fromkeys([*within, *key]))
    spread = keys.select(*columns, place.alias("_place"))
    return spread.select(*columns, F.bitmap_bucket_number("_place").alias("_bucket"), F.bitmap_bit_position("_place").alias("_bit"))


class FirstArrivals:
    """An append-only table that keeps the first arrival of every key, however late another one comes.

    The watermark of a stream forgets keys; the stored table does not. Each folder has a Bloom filter of its keys, kept as
    bitmaps. Keys of a batch that miss a bit are new, and no stored row is read for them; the others, repeats and a few
    false alarms, meet the keys of their folders in an exact join. Batches go by their numbers: one that is repeated after
    a failure looks at the batches before it alone and replaces what it wrote.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        *,
        schema: T.StructType = CLEAN_SCHEMA,
        key: Sequence[str] = SNAPSHOT_KEY,
        folders: Sequence[str] = PARTITIONS,
        first_by: Sequence[str] = ("ingested_at",),
        bits: int = 1 << 23,
        hashes: int = 4,
        fold: int = 16,
    ) -> None:
        self.spark, self.path, self.schema = spark, path, schema
        self.key, self.folders, self.first_by = list(key), list(folders), list(first_by)
        self.bits, self.hashes, self.fold = bits, hashes, fold
        names = T.StructType([f for f in schema.fields if f.name in self.folders])
        self.filter_schema = T.StructType([*names, T.StructField("_bucket", T.LongType()), T.StructField("_map", T.BinaryType())])

    def _names(self) -> list[str]:
        """Folder columns of the files; the values stay in the rows as well."""
        return [f"_f_{c}" for c in self.folders]

    def rows(self, before: int | None = None) -> DataFrame:
        """All rows, or those of the batches before one."""
        numbers = [int(n.removeprefix("batch=")) for n in names_in(self.spark, f"{self.path}/rows")]
        paths = [f"{self.path}/rows/batch={n}" for n in numbers if before is None or n < before]
        paths = [p for p in paths if _finished(self.spark, p)]
        stored = T.StructType([*self.schema.fields, *[T.StructField(c, T.StringType()) for c in self._names()]])
        if not paths:
            return self.spark.createDataFrame([], stored)
        return self.spark.read.schema(stored).option("basePath", f"{self.path}/rows").parquet(*paths)

    def table(self) -> DataFrame:
        return self.rows().select(*self.schema.names)

    def _filters(self, before: int) -> DataFrame:
        root = f"{self.path}/filters"
        base, batches = _layers(self.spark, root)
        if base is not None and base >= before:  # a batch repeated after it was folded: its own bits must not count
            base, batches = None, []
        paths = [f"{root}/batch={n}" for n in batches if n < before] + ([f"{root}/base={base}"] if base is not None else [])
        if not paths:
            return self.spark.createDataFrame([], self.filter_schema)
        parts = self.spark.read.schema(self.filter_schema).parquet(*paths)
        return parts.groupBy(*self.folders, "_bucket").agg(F.bitmap_or_agg("_map").alias("_map"))

    def _new_filters(self, rows: DataFrame) -> DataFrame:
        bits = _bits(rows, self.key, self.folders, self.bits, self.hashes)
        return bits.groupBy(*self.folders, "_bucket").agg(F.bitmap_construct_agg("_bit").alias("_map"))

    def add(self, batch: DataFrame, number: int) -> None:
        """Append the keys of a batch that no earlier batch had, each with its first row in ``first_by`` order.

        Of rows that share a key and ``first_by`` the one with the least content stays. Null keys count as equal.
        """
        spark, scratch = self.spark, scratch_path(self.spark, "first-arrivals")
        written = stage(batch.select(*self.schema.names), "batch", f"{scratch}/batch")
        kept, keys = [], written.select(*self.key, *self.folders)
        if not written.groupBy(*self.key).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").isEmpty():
            first = first_marks(written, self.key, self.first_by, [F.asc(c) for c in self.first_by])
            kept.append((stage(first, "first", f"{scratch}/first"), "left_semi"))
            keys = by_marks(written, *kept).select(*self.key, *self.folders)
        replayed = (_layers(spark, f"{self.path}/filters")[0] or -1) >= number
        bits = _bits(keys, self.key, self.folders, self.bits, self.hashes)
        known = self._filters(number).withColumnsRenamed({c: f"_w_{c}" for c in self.folders})
        same = [F.col(c).eqNullSafe(F.col(f"_w_{c}")) for c in self.folders]
        met = bits.join(known.withColumnRenamed("_bucket", "_b"), [*same, F.col("_bucket") == F.col("_b")], "left")
        hit = F.when(F.col("_map").isNotNull(), bit_is_set(F.col("_map"), F.col("_bit"))).otherwise(replayed)
        maybe = met.groupBy(*self.key).agg(F.min(hit).alias("_all")).filter("_all").drop("_all")
        maybe = stage(maybe, "maybe", f"{scratch}/maybe")
        if not maybe.isEmpty():
            # folders, not rows: as many as the batch has days and countries
            touched = maybe.select(*self.folders).distinct().collect()
            stored = self.rows(number)
            for c, name in zip(self.folders, self._names()):
                stored = stored.filter(F.col(name).isin(sorted({_folder_name(r[c]) for r in touched})))
            listed = [F.col(c).alias(f"_k{i}") for i, c in enumerate(self.key)]
            asked = maybe.select(*listed)
            equal = [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(self.key)]
            there = stored.select(*self.key).join(asked, equal, "left_semi").select(*listed).distinct()
            kept.append((stage(key_marks(written, there, equal), "there", f"{scratch}/there"), "left_anti"))
        new = by_marks(written, *kept) if kept else written
        text = [F.coalesce(F.when(F.col(c).cast("string") == "", BLANK_FOLDER).otherwise(F.col(c).cast("string")), F.lit(NULL_FOLDER)) for c in self.folders]
        out = new.withColumns(dict(zip(self._names(), text)))
        # folders, not rows
        sizes = [r["n"] for r in written.groupBy(*self.folders).agg(F.count(F.lit(1)).alias("n")).collect()]
        out = out if is_dealt(sum(sizes), len(sizes)) else spread_for_write(out, self._names())
        out.write.mode("overwrite").option("compression", "zstd").partitionBy(*self._names()).parquet(f"{self.path}/rows/batch={number}")
        added = self.spark.read.schema(self.schema).parquet(f"{self.path}/rows/batch={number}") if not new.isEmpty() else new
        self._new_filters(added).write.mode("overwrite").parquet(f"{self.path}/filters/batch={number}")
        if len(_layers(spark, f"{self.path}/filters")[1]) >= self.fold:
            _fold(spark, f"{self.path}/filters", self._filters(number + 1), number)
        remove(spark, scratch)

    def stream(self, deltas: DataFrame, checkpoint: str) -> StreamingQuery:
        """Add all new deltas and stop; run it on any schedule."""
        return (
            deltas.writeStream.foreachBatch(lambda batch, number: self.add(batch, number))
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )


def _folder_name(value: object) -> str:
    return NULL_FOLDER if value is None else BLANK_FOLDER if str(value) == "" else str(value)

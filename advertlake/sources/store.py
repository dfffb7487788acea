"""Accumulated tables: keyed replacement with an atomic publish, and the ledger of loaded partitions.

A keyed table is a folder with ``data`` and ``manifest``. A load writes the folders it changes once, below a new
``data/_v=<version>``, and then adds one small file to ``manifest`` that names the versions of each of them and what they
replace. A folder may consist of several versions, which hold different keys: a load leaves those alone that are large and
hold none of its keys. That file is the switch: readers take the latest version the manifest has for a folder, so a load that is lost
before it changes nothing and can be repeated, and one that is lost after it is complete. Loads are numbered, and two
writers that take the same number cannot both publish. Every sixteenth file names all folders, so a reader opens no
more than sixteen however many loads there were; older files go, and so do folders of loads that were lost.

Versions that were replaced are deleted ``retain`` loads later: a frame made before still reads its rows until then.
Where a table format is available, ``save_replaced`` is the function to replace by its MERGE.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import and_, or_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from advertlake.functions.scalars import bit_is_set
from advertlake.operators.merge import not_loaded
from advertlake.operators.windows import keep_first
from advertlake.schema import PARTITIONS, SNAPSHOT_KEY, enforce_schema
from advertlake.session import names_in, read_note, remove, scratch_path, size_of, stage, write_note
from advertlake.sources.layers import is_dealt, spread_for_write

VERSION = "_v"
NULL_FOLDER, BLANK_FOLDER = "(null)", "(blank)"
FOLD = 16  # loads between two manifest files that name all folders
LISTED = 256  # folders that are read by their own paths; more are found by listing the table
APART = 64 << 20  # bytes from which a version of a folder is left alone by loads that replace none of its rows

Folder = tuple[str, ...]

LEDGER_SCHEMA = T.StructType(
    [*[T.StructField(c, T.StringType()) for c in PARTITIONS], T.StructField("loaded_at", T.TimestampType())]
)


def table_exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.schema("_probe int").parquet(path)
        return True
    except AnalysisException as error:  # the analyzer reports a missing path before any job runs
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False


def folder_columns(partitions: Sequence[str]) -> list[str]:
    return [f"_f_{c}" for c in partitions]


def _folder(column: str) -> Column:
    """The folder name of a value; null and blank have names of their own, which a bare folder would not tell apart."""
    text = F.col(column).cast("string")
    return F.when(text.isNull(), NULL_FOLDER).when(text == "", BLANK_FOLDER).otherwise(text)


def with_folders(df: DataFrame, partitions: Sequence[str]) -> DataFrame:
    return df.withColumns({f: _folder(c) for f, c in zip(folder_columns(partitions), partitions)})


@dataclass
class Snapshot:
    """What a reader sees: the last load's number, the version of every folder and what loads noted about the table;
    and the manifest files behind it."""

    load: int = 0
    folders: dict[Folder, str] = field(default_factory=dict)
    files: list[str] = field(default_factory=list)
    about: dict[str, str] = field(default_factory=dict)


def current(spark: SparkSession, path: str) -> Snapshot:
    """The table as the latest complete load left it; the driver reads a few small files."""
    files = [name for name in names_in(spark, f"{path}/manifest") if name.endswith(".json")]
    out = Snapshot(files=files)
    # the last file that names all folders, and what came after it
    first = max((i for i, name in enumerate(files) if name.endswith("-all.json")), default=0)
    for name in files[first:]:
        note = json.loads(read_note(spark, f"{path}/manifest/{name}"))
        out.load, out.about = note["load"], note["about"]
        for version, *folder in note["folders"]:
            if version is None:
                out.folders.pop(tuple(folder), None)
            else:
                out.folders[tuple(folder)] = version
    return out


def versions_of(version: str) -> list[str]:
    """The versions that make up a folder, oldest first."""
    return version.split("+")


def read_folders(
    spark: SparkSession, path: str, schema: T.StructType, folders: dict[Folder, str], partitions: Sequence[str]
) -> DataFrame:
    """Rows of the given folders in their versions.

    A few folders are read by their paths, so that nothing else is listed. For many, the names prune the scan column by
    column: each column's list is as long as there are loads, days or countries, however many folders they make up.
    """
    if not folders:
        return spark.createDataFrame([], schema)
    rows = [(version, *folder) for folder, versions in folders.items() for version in versions_of(versions)]
    if len(rows) <= LISTED:
        return spark.read.schema(schema).parquet(*[_folder_path(path, v, tuple(f), partitions) for v, *f in rows])
    names = [VERSION, *folder_columns(partitions)]
    stored = T.StructType([*schema.fields, *[T.StructField(c, T.StringType()) for c in names]])
    data = spark.read.schema(stored).parquet(f"{path}/data")
    data = data.filter(reduce(and_, [F.col(c).isin(sorted({r[i] for r in rows})) for i, c in enumerate(names)]))
    listed = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in names))
    return data.join(listed, names, "left_semi").select(*schema.names)


def read_versions(
    spark: SparkSession, path: str, schema: T.StructType, folders: dict[Folder, str], partitions: Sequence[str]
) -> DataFrame:
    """As ``read_folders``, with the version and the names of the folder beside each row; the scan's metadata are there."""
    names = [VERSION, *folder_columns(partitions)]
    rows = [(version, *folder) for folder, versions in folders.items() for version in versions_of(versions)]
    stored = T.StructType([*schema.fields, *[T.StructField(c, T.StringType()) for c in names]])
    reader = spark.read.schema(stored)
    if len(rows) <= LISTED:
        paths = [_folder_path(path, v, tuple(f), partitions) for v, *f in rows]
        return reader.option("basePath", f"{path}/data").parquet(*paths)
    data = reader.parquet(f"{path}/data")
    return data.filter(reduce(and_, [F.col(c).isin(sorted({r[i] for r in rows})) for i, c in enumerate(names)]))


def read_keyed(
    spark: SparkSession, path: str, schema: T.StructType, partitions: Sequence[str] = PARTITIONS
) -> DataFrame:
    """The keyed table at ``path`` as the latest complete load left it; the driver lists its folders, no rows."""
    return read_folders(spark, path, schema, current(spark, path).folders, partitions)


def rows_of_folders(df: DataFrame, folders: DataFrame, partitions: Sequence[str]) -> DataFrame:
    """Rows of ``df`` in the listed folders, null for null; the lists prune the scan of a partitioned table."""
    values = folders.agg(*[F.collect_set(c).alias(c) for c in partitions], *[F.count_if(F.col(c).isNull()).alias(f"_n_{c}") for c in partitions]).first()
    kept = df
    for c in partitions:
        there = F.col(c).isin(values[c])
        kept = kept.filter(there | F.col(c).isNull() if values[f"_n_{c}"] else there)
    wanted = folders.select(*[F.col(c).alias(f"_w_{c}") for c in partitions]).distinct()
    same = [F.col(c).eqNullSafe(F.col(f"_w_{c}")) for c in partitions]
    return kept.join(wanted, same, "left_semi")


def _publish(
    spark: SparkSession, path: str, before: Snapshot, folders: dict[Folder, str | None], about: dict[str, str] | None = None
) -> Snapshot:
    """The switch: one file with the new version of every written folder, null for one that has no rows any more."""
    after = Snapshot(before.load + 1, before.folders | folders, about=before.about | (about or {}))
    after.folders = {f: v for f, v in after.folders.items() if v is not None}
    whole = after.load % FOLD == 0
    named = after.folders if whole else folders
    replaced = [
        [v, *f] for f, new in folders.items() if f in before.folders
        for v in versions_of(before.folders[f]) if new is None or v not in versions_of(new)
    ]
    note = {"load": after.load, "folders": [[v, *f] for f, v in named.items()], "replaced": replaced, "about": after.about}
    name = f"{after.load:012d}-{'all' if whole else 'new'}.json"
    write_note(spark, f"{path}/manifest/{name}", json.dumps(note))
    after.files = [*before.files, name]
    return after


def _vacuum(spark: SparkSession, path: str, now: Snapshot, partitions: Sequence[str], retain: int) -> None:
    """Delete what a load replaced ``retain`` loads ago, and, when all folders were named, what nothing refers to."""
    by_load = {int(name[:12]): name for name in now.files}
    due = by_load.get(now.load - retain)
    if due:
        for version, *folder in json.loads(read_note(spark, f"{path}/manifest/{due}"))["replaced"]:
            remove(spark, _folder_path(path, version, tuple(folder), partitions))
    if now.load % FOLD == 0:
        # files before the last one of their kind are read no more, unless their replaced folders still wait
        last = max((n for n, name in by_load.items() if name.endswith("-all.json") and n <= now.load - retain), default=0)
        kept = {n: name for n, name in by_load.items() if n >= last}
        for n, name in by_load.items():
            if n < last:
                remove(spark, f"{path}/manifest/{name}")
        known = {v for versions in now.folders.values() for v in versions_of(versions)}
        for name in kept.values():
            note = json.loads(read_note(spark, f"{path}/manifest/{name}"))
            known |= {v for v, *_ in note["replaced"]} | {v for vs, *_ in note["folders"] if vs for v in versions_of(vs)}
        for name in names_in(spark, f"{path}/data"):
            if name.startswith(f"{VERSION}=") and name.removeprefix(f"{VERSION}=") not in known:
                remove(spark, f"{path}/data/{name}")


def write_folders(
    spark: SparkSession,
    path: str,
    rows: DataFrame,
    folders: Iterable[Folder],
    before: Snapshot,
    *,
    partitions: Sequence[str],
    sort: Sequence[str] = (),
    retain: int = 0,
    emptied: Iterable[Folder] = (),
    about: dict[str, str] | None = None,
    ranges: int | None = None,
    staying: Mapping[Folder, Sequence[str]] | None = None,
    dealt: bool = False,
) -> Snapshot:
    """Put ``rows`` in place of all rows of the named ``folders``, which hold all of them; ``emptied`` ones lose theirs.

    ``about`` is noted with the table, in the same switch. With ``ranges`` the rows are dealt to that many tasks by folder
    and ``sort``, so that files of a folder hold ranges of it, which a filter can skip; otherwise by folder and size, or,
    if they are ``dealt`` already, not at all. Versions of a folder that are ``staying`` keep their rows beside the new ones.
    """
    names = folder_columns(partitions)
    version = uuid.uuid4().hex
    written = {f: "+".join([*(staying or {}).get(f, ()), version]) for f in folders}
    if written:
        order = [*names, *[F.asc_nulls_last(c) for c in sort]]
        out = with_folders(rows, partitions)
        if ranges:
            out = out.repartitionByRange(ranges, *order)
        elif not dealt:
            out = spread_for_write(out, names)
        out = out.sortWithinPartitions(*order)
        out.write.option("compression", "zstd").partitionBy(*names).parquet(f"{path}/data/{VERSION}={version}")
    after = _publish(spark, path, before, written | {f: None for f in emptied}, about)
    _vacuum(spark, path, after, partitions, retain)
    return after


_PLACE = ["_file", "_bucket", "_bit"]


def with_places(df: DataFrame) -> DataFrame:
    """A scan of Parquet files with the place of each row: its file, and its number in it as a bucket and a bit of it."""
    row = F.col("_metadata.row_index")
    return df.select(
        "*", F.col("_metadata.file_path").alias("_file"), F.bitmap_bucket_number(row).alias("_bucket"), F.bitmap_bit_position(row).alias("_bit")
    )


def marks(places: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows given by their places as bitmaps, one bit for each row of their files."""
    return places.groupBy(*by, "_file", "_bucket").agg(F.bitmap_construct_agg("_bit").alias("_map"))


def first_marks(written: DataFrame, key: Sequence[str], columns: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Marks of the first row of each key in ``order``, then by content; only ``columns`` and places of the rows move."""
    places = with_places(written.withColumn("_h", F.xxhash64(*written.columns)))
    narrow = places.select(*dict.fromkeys([*key, *columns]), "_h", *_PLACE)
    return marks(keep_first(narrow, key, [*order, F.col("_h")]))


def key_marks(written: DataFrame, keys: DataFrame, same: Column | Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Marks of the rows whose key is listed; only ``by`` columns, keys and places of the rows move."""
    return marks(with_places(written).join(keys, same, "left_semi"), by)


def by_marks(df: DataFrame, *marked: tuple[DataFrame, str]) -> DataFrame:
    """Rows of a scan that are marked (``left_semi``) or are not (``left_anti``). The marks, a bit a row, go to every task,
    so that no row moves."""
    rows = with_places(df)
    for bits, how in marked:
        listed = F.broadcast(bits.select(F.col("_file").alias("_f"), F.col("_bucket").alias("_b"), "_map"))
        same = (F.col("_file") == F.col("_f")) & (F.col("_bucket") == F.col("_b")) & bit_is_set(F.col("_map"), F.col("_bit"))
        rows = rows.join(listed, same, how)
    return rows.drop(*_PLACE)


def _stored_part(
    spark: SparkSession, path: str, schema: T.StructType, old: dict[Folder, str], keys: DataFrame, partitions: Sequence[str], scratch: str
) -> tuple[DataFrame | None, dict[Folder, list[str]]]:
    """What a load of ``keys`` has to write again of the folders ``old``, and the versions of them that stay as they are.

    Versions with a row that is replaced are written again without it, and so are small ones. Stored rows meet the batch by
    their keys alone.
    """
    key, names = keys.columns, [VERSION, *folder_columns(partitions)]
    stored = read_versions(spark, path, schema, old, partitions).select(*key, *names)
    replaced = stage(key_marks(stored, keys, list(key), names), "replaced", f"{scratch}/replaced")
    # versions of folders, not rows
    hit = {tuple(r) for r in replaced.select(*names).distinct().collect()}
    again: dict[Folder, list[str]] = {}
    staying: dict[Folder, list[str]] = {}
    for folder, versions in old.items():
        for v in versions_of(versions):
            small = (v, *folder) not in hit and size_of(spark, _folder_path(path, v, folder, partitions)) < APART
            (again if small or (v, *folder) in hit else staying).setdefault(folder, []).append(v)
    if not again:
        return None, staying
    rows = read_folders(spark, path, schema, {f: "+".join(vs) for f, vs in again.items()}, partitions)
    return (by_marks(rows, (replaced, "left_anti")) if hit else rows), staying


def save_replaced(
    spark: SparkSession,
    path: str,
    batch: DataFrame,
    *,
    schema: T.StructType,
    key: Sequence[str] = SNAPSHOT_KEY,
    partitions: Sequence[str] = PARTITIONS,
    sort: Sequence[str] = ("created_at", "job_id"),
    keep_last_of: Sequence[str] | None = None,
    retain: int = 0,
    file_rows: int | None = None,
) -> int:
    """Put a batch into a stored table by key and return its number of rows; loading it twice equals loading it once.

    Only folders of the batch are read, and of these only versions that are small or hold one of its keys are written anew,
    once, however large the table is. Stored rows are not shuffled, and those of a batch only where its tasks hold few of
    many folders. ``partitions`` must be part of ``key``. A key that the batch repeats is stored once, the row last in ``keep_last_of`` order, then by its
    content; a null key stops the load before anything changes. What is replaced stays readable for ``retain`` loads.
    With ``file_rows`` the files hold ranges of ``sort`` within their folder, of about so many rows of the batch, so that a
    filter on its first column reads a few of them.
    The batch is read twice, first its key columns alone, and should be a written table.
    """
    names = folder_columns(partitions)
    fresh = enforce_schema(batch, schema)
    per_key = fresh.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    missing = reduce(or_, [F.col(c).isNull() for c in key])
    # folders, not rows: as many as the batch has days and countries
    counted = with_folders(per_key, partitions).groupBy(*names).agg(
        F.sum("_n").alias("n"), F.max("_n").alias("most"), F.max(missing).alias("broken")
    )
    touched = {tuple(r[c] for c in names): r for r in counted.collect()}
    if any(r["broken"] for r in touched.values()):
        raise ValueError(f"a key column is null: {', '.join(key)}")
    if not touched:
        return 0
    n, scratch = sum(r["n"] for r in touched.values()), scratch_path(spark, "load")
    keys = fresh.select(*key)
    if any(r["most"] > 1 for r in touched.values()):
        fresh = stage(fresh, "batch", f"{scratch}/batch")
        last = keep_last_of or ()
        first = stage(first_marks(fresh, key, last, [F.desc_nulls_last(c) for c in last]), "first", f"{scratch}/first")
        fresh = by_marks(fresh, (first, "left_semi"))
        keys = fresh.select(*key)
    before = current(spark, path)
    old = {f: v for f, v in before.folders.items() if f in touched}
    kept, staying = _stored_part(spark, path, schema, old, keys, partitions, scratch) if old else (None, {})
    ranges = -(-n // file_rows) if file_rows else None
    write_folders(
        spark, path, fresh if kept is None else kept.unionByName(fresh), touched, before, partitions=partitions, sort=sort, retain=retain,
        ranges=ranges, staying=staying, dealt=is_dealt(n, len(touched)),
    )
    remove(spark, scratch)
    return n


# Characters that Spark escapes in folder names.
_ESCAPED = set("\"#%'*/:=?\\{[]^") | {chr(c) for c in (*range(1, 32), 127)}


def _escaped(name: str) -> str:
    return "".join(f"%{ord(c):02X}" if c in _ESCAPED else c for c in name)


def _folder_path(path: str, version: str, folder: Folder, partitions: Sequence[str]) -> str:
    parts = [f"{n}={_escaped(value)}" for n, value in zip(folder_columns(partitions), folder)]
    return "/".join([f"{path}/data/{VERSION}={version}", *parts])


def pending_partitions(spark: SparkSession, deltas: DataFrame, ledger_path: str) -> DataFrame:
    """Folders of the delta layer that were not loaded yet."""
    folders = deltas.select(*PARTITIONS).distinct()
    if not table_exists(spark, ledger_path):
        return folders
    return not_loaded(folders, spark.read.schema(LEDGER_SCHEMA).parquet(ledger_path))


def load_pending(
    spark: SparkSession,
    deltas: DataFrame,
    table_path: str,
    ledger_path: str,
    *,
    schema: T.StructType,
    key: Sequence[str] = SNAPSHOT_KEY,
) -> int:
    """Load every delta folder once; returns how many were new.

    The ledger is written after the table. A run lost in between loads those folders again, which
    changes nothing because the load replaces by key.
    """
    pending = stage(pending_partitions(spark, deltas, ledger_path), "pending")
    n = pending.count()
    if n == 0:
        return 0
    save_replaced(spark, table_path, rows_of_folders(deltas, pending, PARTITIONS), schema=schema, key=key)
    stamped = pending.withColumn("loaded_at", F.current_timestamp())
    enforce_schema(stamped, LEDGER_SCHEMA).repartition(1).write.mode("append").parquet(ledger_path)
    return n

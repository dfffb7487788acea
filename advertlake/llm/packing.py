"""Best-fit packing of token pieces into sequences of a fixed size, in bulk-synchronous rounds.

Every document is encoded and ended; longer ones are cut so that all pieces but the first fill a sequence. What is
shorter than a sequence is packed in three bands, long pieces first: above a half, above a third, and all others. A
round opens sequences for pieces longer than every gap, the longest first, as many as they need at least. Then it sorts
the band's pieces and the gaps of open sequences by size, in ranges over all tasks. A sweep through each range gives
every gap the longest free piece at or below it, as brackets are matched: pieces open, gaps close. What a range could
not match is matched across ranges by ranks; only counts per range come to the driver. Then the gaps are updated, and
the next round begins, until the band has no free piece.

A gap of several times the longest free piece enters a round as several slots, so that the rounds do not grow with the
number of pieces in a sequence. All rounds read and write tables of the scratch folder.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from advertlake.llm.encode import ENCODE_BYTES, default_tokenizer_path, encoder
from advertlake.llm.kernels import text_blocks
from advertlake.llm.tokenfiles import END_ID
from advertlake.session import remove, scratch_path, stage

SIZE = 1024
RANGE_ROWS = 500_000  # pieces and gaps that one task sweeps through, about 16 MB
# Fewer than this are no work for a task of their own: starting it takes longer. Late rounds have a few hundred.
LEAST_RANGE_ROWS = 20_000

PIECES = "row bigint, doc_id {id}, piece int, start bigint, length bigint, ids_crc32 bigint"
SWEPT = "kind int, id bigint, size bigint, seq bigint, range int, rank bigint"


def cut_pieces(
    documents: DataFrame, *, size: int = SIZE, tokenizer: str | None = None, keep_ids: bool = False
) -> DataFrame:
    """A row per piece of every document: ``doc_id, piece, start, length, ids_crc32`` and a unique ``row``.

    A document's ids are those of its whole text and the end id; a null or empty text has the end id alone. Only documents
    of more than ``size`` ids are cut, and only the first piece is shorter. ``keep_ids`` adds the ids as little-endian
    32-bit numbers. ``row`` depends on how rows are dealt out, so the result has to be written before it is used twice.
    Ids of documents may be null or repeat: every row is a document. Other columns are not read.
    """
    file = tokenizer or default_tokenizer_path()
    schema = PIECES.format(id=documents.schema["doc_id"].dataType.simpleString())

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(file)
        row = TaskContext.get().partitionId() << 36
        for batch in batches:
            names, texts = batch.column("doc_id"), batch.column("text")
            for block in text_blocks(texts, ENCODE_BYTES):
                rows = slice(block.first, block.first + block.rows)
                ids, counts = encode.encode(texts[rows].fill_null("").to_pylist())
                ends = np.cumsum(counts)
                of, piece, start, length, crc, kept = [], [], [], [], [], []
                for k, (a, b) in enumerate(zip((ends - counts).tolist(), ends.tolist())):
                    data = np.append(ids[a:b], END_ID).astype("<u4")
                    place, number = 0, 0
                    while place < len(data):
                        until = place + ((len(data) - place) % size or size)
                        raw = data[place:until].tobytes()
                        of.append(k)
                        piece.append(number)
                        start.append(place)
                        length.append(until - place)
                        crc.append(zlib.crc32(raw))
                        if keep_ids:
                            kept.append(raw)
                        place, number = until, number + 1
                columns = [
                    pa.array(np.arange(row, row + len(of))),
                    names[rows].take(pa.array(of, pa.int64())),
                    pa.array(piece, pa.int32()),
                    *(pa.array(x, pa.int64()) for x in (start, length, crc)),
                ]
                columns += [pa.array(kept, pa.binary())] if keep_ids else []
                row += len(of)
                heads = ["row", "doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * keep_ids
                yield pa.RecordBatch.from_arrays(columns, names=heads)

    return documents.select("doc_id", "text").mapInArrow(cut, schema + (", ids binary" if keep_ids else ""))


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Brackets of one sorted range: matched pieces with their sequence, and what is left with its rank.

    Unmatched gaps all stand before unmatched pieces, so two ranks, each from the small end, tell everything.
    """
    part = TaskContext.get().partitionId()
    got = [(b.column("kind").to_numpy(), b.column("id").to_numpy(), b.column("size").to_numpy()) for b in batches]
    if not got:
        return
    kind, ident, size = (np.concatenate(x) for x in zip(*got))
    gap = kind == 1
    running = np.cumsum(np.where(gap, -1, 1))
    level = running + gap  # a piece and the gap that closes it have the same level
    order = np.argsort(level, kind="stable")
    pair = ~gap[order[:-1]] & gap[order[1:]] & (level[order[:-1]] == level[order[1:]])
    piece, taker = order[:-1][pair], order[1:][pair]
    free = np.ones(len(kind), bool)
    free[piece] = free[taker] = False
    left_gaps, left_pieces = np.flatnonzero(free & gap), np.flatnonzero(free & ~gap)
    rank = np.concatenate((np.full(len(piece), -1), np.arange(len(left_gaps)), np.arange(len(left_pieces))))
    rows = np.concatenate((piece, left_gaps, left_pieces))
    seq = np.full(len(rows), -1, np.int64)
    seq[: len(piece)] = ident[taker]
    columns = [
        pa.array(kind[rows], pa.int32()),
        pa.array(ident[rows], pa.int64()),
        pa.array(size[rows], pa.int64()),
        pa.array(seq, mask=seq < 0),
        pa.array(np.full(len(rows), part, np.int32)),
        pa.array(rank, mask=rank < 0),
    ]
    yield pa.RecordBatch.from_arrays(columns, names=["kind", "id", "size", "seq", "range", "rank"])


def matched_ranges(left: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int, int]]:
    """``gap range, first gap rank, piece range, last piece rank, number`` of what matches across ranges.

    ``left`` has range, unmatched gaps and unmatched pieces of every range in order. Gaps take the nearest pieces
    below them: a range's smallest gap the longest free piece of the ranges before it.
    """
    free: list[list[int]] = []
    out = []
    for part, gaps, pieces in left:
        first = 0
        while first < gaps and free:
            owner, count = free[-1]
            n = min(gaps - first, count)
            out.append((part, first, owner, count - 1, n))
            first += n
            if n == count:
                free.pop()
            else:
                free[-1][1] -= n
        if pieces:
            free.append([part, pieces])
    return out


def _round(spark: SparkSession, pieces: DataFrame, slots: DataFrame, rows: int, path: str) -> DataFrame:
    """One superstep: ``id, size, seq`` of all pieces; null is the sequence of those that found no gap."""
    most = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(min(most, -(-rows // LEAST_RANGE_ROWS)), -(-rows // RANGE_ROWS))
    both = pieces.select(F.lit(0).alias("kind"), "id", "size").unionByName(slots.select(F.lit(1).alias("kind"), "id", "size"))
    keys = ["size", "kind", "id"]
    swept = stage(both.repartitionByRange(tasks, *keys).sortWithinPartitions(*keys).mapInArrow(_sweep, SWEPT), "swept", f"{path}/swept")
    # as many rows as there are ranges
    counts = (
        swept.filter("rank IS NOT NULL")
        .groupBy("range")
        .agg(F.count_if(F.col("kind") == 1).alias("gaps"), F.count_if(F.col("kind") == 0).alias("pieces"))
        .orderBy("range")
        .collect()
    )
    across = matched_ranges([tuple(r) for r in counts])
    found = swept.filter("kind = 0").select("id", "size", "seq", "range", "rank")
    if not across:
        return found.select("id", "size", "seq")
    listed = [(k, *x) for k, x in enumerate(across)]
    steps = F.broadcast(spark.createDataFrame(listed, "k int, gr int, g0 bigint, pr int, p1 bigint, n bigint"))  # two per range at most
    gaps = swept.filter("kind = 1 AND rank IS NOT NULL").join(steps, F.expr("range = gr AND rank >= g0 AND rank < g0 + n"))
    gaps = gaps.select("k", (F.col("rank") - F.col("g0")).alias("at"), F.col("id").alias("taker"))
    free = found.join(steps, F.expr("range = pr AND rank <= p1 AND rank > p1 - n"), "left")
    # pieces without a step match nothing and get keys of their own, so that they do not meet in one task
    free = free.withColumns({"k": F.coalesce("k", F.lit(-1)), "at": F.coalesce(F.col("p1") - F.col("rank"), "id")})
    return free.join(gaps, ["k", "at"], "left").select("id", "size", F.coalesce("seq", "taker").alias("seq"))


FEW = 1024  # pieces of a length that open sequences and are named one by one; of more a share is drawn


def _opening(free: dict[int, int], top: int, size: int) -> tuple[int, int]:
    """Which of the free pieces open sequences, all being counted by length: those above a length, and a number of it.

    Pieces longer than ``top``, the widest gap, can only open sequences: the longest of them, as many as they need at
    least. (size, 0) stands for none.
    """
    lone = {length: n for length, n in free.items() if length > top}
    need = max(sum(n for x, n in lone.items() if 2 * x > size), -(-sum(x * n for x, n in lone.items()) // size))
    for length in sorted(lone, reverse=True):
        if lone[length] >= need:
            return length, need
        need -= lone[length]
    return size, 0


def pack_pieces(pieces: DataFrame, *, size: int = SIZE) -> DataFrame:
    """``pieces`` (written, with a unique ``row`` and a ``length`` of 1 to ``size``) with ``sequence_id`` and ``offset``.

    The pieces of a sequence follow each other from offset 0 without gaps and have ``size`` ids at most. A sequence's
    number is the ``row`` of its first piece. No rows give no rows. The driver holds counts by length and by range.
    """
    spark = pieces.sparkSession
    root = scratch_path(spark, "packing")
    todo = pieces.filter(F.col("length") < size).select(F.col("row").alias("id"), F.col("length").alias("size"))
    counted = {r["size"]: r["n"] for r in todo.groupBy("size").agg(F.count("*").alias("n")).collect()}  # below ``size`` rows
    wait, gaps = todo, spark.createDataFrame([], "seq bigint, gap bigint")
    widths: dict[int, int] = {}
    step = 0
    for over in (size // 2, size // 3, 0):
        band = F.col("size") > over
        while sum(n for x, n in counted.items() if x > over):
            step += 1
            path = f"{root}/step={step}"
            free = {x: n for x, n in counted.items() if x > over}
            edge, some = _opening(free, max(widths, default=0), size)
            draw = F.pmod(F.xxhash64("id", F.lit(step)), F.lit(1 << 20))
            if some == free.get(edge, 0):
                drawn = F.lit(True)
            elif some <= FEW:
                named = wait.filter(F.col("size") == edge).orderBy(draw, "id").limit(some).select("id").collect()
                drawn = F.col("id").isin([r["id"] for r in named])
            else:
                # by hashes, and rather too few of them: the next round opens the rest
                drawn = draw < int((some - 2 * some**0.5) / free[edge] * (1 << 20))
            opens = (F.col("size") > edge) | ((F.col("size") == edge) & drawn)
            opened = wait.filter(band & opens).select("id", "size", F.col("id").alias("seq"))
            new = opened.select("seq", (F.lit(size) - F.col("size")).alias("gap"))
            gaps = gaps.unionByName(new)
            rest = wait.filter(band & ~opens)
            # as many as there are, or a few less where a share is drawn
            left = sum(n for x, n in free.items() if x < edge) + free.get(edge, 0) - some
            found = opened
            if left:
                top, least = max(x for x in free if x <= edge), min(free)
                takers = sum(n for g, n in widths.items() if g >= least) + sum(n for x, n in free.items() if x >= edge and size - x >= least)
                # as many slots as the pieces may need: several of the longest length, the last with the rest of the gap
                many = F.least(F.lit(-(-left // max(takers, 1))), F.greatest(F.lit(1), F.floor(F.col("gap") / top)))
                slots = (
                    gaps.filter(F.col("gap") >= least)
                    .withColumn("many", many)
                    .withColumn("slot", F.explode(F.sequence(F.lit(1), "many")))
                    .withColumn("last", F.col("gap") - (F.col("many") - 1) * top)
                    .select(F.col("seq").alias("id"), F.when(F.col("slot") < F.col("many"), top).otherwise(F.col("last")).cast("bigint").alias("size"))
                )
                found = found.unionByName(_round(spark, rest, slots, 2 * left + takers, path))
            found = stage(found, "found", f"{path}/found")
            used = found.filter("seq IS NOT NULL AND seq <> id").groupBy("seq").agg(F.sum("size").alias("used"))
            after = gaps.join(used, "seq", "left").select("seq", (F.col("gap") - F.coalesce("used", F.lit(0))).alias("gap"))
            gaps = stage(after.filter("gap > 0"), "gaps", f"{path}/gaps")
            kinds = [
                found.filter("seq IS NULL").select(F.lit(0).alias("kind"), "size"),
                gaps.select(F.lit(1).alias("kind"), F.col("gap").alias("size")),
            ]
            # two rows per length at most
            now = kinds[0].unionByName(kinds[1]).groupBy("kind", "size").agg(F.count("*").alias("n")).collect()
            widths = {r["size"]: r["n"] for r in now if r["kind"] == 1}
            counted = {x: n for x, n in counted.items() if x <= over} | {r["size"]: r["n"] for r in now if r["kind"] == 0}
            wait = found.filter("seq IS NULL").select("id", "size")
        wait = todo.filter(~band)
    full = pieces.filter(F.col("length") >= size).withColumns({"sequence_id": F.col("row"), "offset": F.lit(0).cast("bigint")})
    if not step:
        return full
    every = spark.read.schema("id bigint, size bigint, seq bigint").parquet(*[f"{root}/step={k}/found" for k in range(1, step + 1)])
    every = every.withColumn("step", F.regexp_extract(F.input_file_name(), r"/step=(\d+)/", 1).cast("int")).filter("seq IS NOT NULL")
    # the first piece of a sequence names it; a sequence has ``size`` pieces at most
    order = [F.col("seq") != F.col("id"), F.col("step"), F.col("id")]
    before = Window.partitionBy("seq").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    places = every.select(
        F.col("id").alias("row"), F.col("seq").alias("sequence_id"), F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset")
    )
    places = stage(places, "places")
    remove(spark, root)
    return full.unionByName(pieces.join(places, "row"))


def pack_documents(
    documents: DataFrame, *, size: int = SIZE, tokenizer: str | None = None, keep_ids: bool = False
) -> DataFrame:
    """All documents as pieces with their sequence and offset; see ``cut_pieces`` and ``pack_pieces``."""
    pieces = stage(cut_pieces(documents, size=size, tokenizer=tokenizer, keep_ids=keep_ids), "pieces")
    return pack_pieces(pieces, size=size).drop("row")


def packed_sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, ids, doc_ids, starts``: whole sequences from pieces that were packed with ``keep_ids``.

    ``ids`` are little-endian 32-bit numbers; ``starts`` tells where each document's piece begins, for attention masks.
    """
    parts = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids")))  # ``size`` pieces at most
    rows = packed.groupBy("sequence_id").agg(parts.alias("p"))
    joined = F.unhex(F.array_join(F.transform("p", lambda x: F.hex(x["ids"])), ""))
    return rows.select("sequence_id", joined.alias("ids"), F.col("p.doc_id").alias("doc_ids"), F.col("p.offset").alias("starts"))

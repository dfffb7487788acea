"""Token ids in files of wavelet matrices: succinct bit planes that answer access, counting and occurrence lookup.

Documents are range-partitioned by id, every task encodes its range in order and writes blocks of about a million ids
into its shard, one compressed Parquet file. A block is a row: for each bit of the ids, from the highest, the plane of
that bit over the ids in the order the planes above left them in, with the number of ones up to every 512th place; and
the documents with their numbers of ids. Files go through Spark's writer, so a lost task leaves nothing behind.
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

END_ID = 2
BLOCK_TOKENS = 1 << 20
SAMPLE = 512  # places between two counts of ones

FILE_SCHEMA = (
    "part int, seq int, n_tokens bigint, bits int, zeros array<bigint>, planes array<binary>, ones array<binary>, "
    "doc_ids array<bigint>, counts array<bigint>"
)
_FILE_ARROW = pa.schema(
    [
        ("part", pa.int32()),
        ("seq", pa.int32()),
        ("n_tokens", pa.int64()),
        ("bits", pa.int32()),
        ("zeros", pa.list_(pa.int64())),
        ("planes", pa.list_(pa.binary())),
        ("ones", pa.list_(pa.binary())),
        ("doc_ids", pa.list_(pa.int64())),
        ("counts", pa.list_(pa.int64())),
    ]
)


class WaveletMatrix:
    """Bit planes of a sequence of ids below ``2 ** bits``."""

    def __init__(self, n: int, bits: int, zeros: list[int], planes: list[np.ndarray], ones: list[np.ndarray]):
        self.n, self.bits, self.zeros, self.planes, self.ones = n, bits, zeros, planes, ones

    @classmethod
    def build(cls, ids: np.ndarray, bits: int) -> WaveletMatrix:
        ids = ids.astype(np.uint16 if bits <= 16 else np.uint32)
        zeros, planes, ones = [], [], []
        for level in range(bits):
            bit = (ids & ids.dtype.type(1 << (bits - 1 - level))).astype(bool)
            plane = np.packbits(bit, bitorder="little")
            plane = np.concatenate((plane, np.zeros(-len(plane) % (SAMPLE // 8), np.uint8)))
            per = np.bitwise_count(plane.view(np.uint64)).reshape(-1, SAMPLE // 64).sum(axis=1, dtype=np.uint32)
            planes.append(plane)
            ones.append(np.concatenate(([0], np.cumsum(per, dtype=np.uint32))).astype(np.uint32))
            # indexing by a mask costs several times as much
            ids = np.concatenate((ids.compress(~bit), ids.compress(bit)))
            zeros.append(len(ids) - int(ones[-1][-1]))
        return cls(len(ids), bits, zeros, planes, ones)

    def decode(self) -> np.ndarray:
        """All ids in order: from the lowest plane up, every plane's partition is undone."""
        kind = np.uint16 if self.bits <= 16 else np.uint32
        ids = np.zeros(self.n, kind)
        for level in reversed(range(self.bits)):
            bit = np.unpackbits(self.planes[level], count=self.n, bitorder="little").view(bool)
            before = np.empty(self.n, kind)
            before[np.flatnonzero(~bit)] = ids[: self.zeros[level]]
            before[np.flatnonzero(bit)] = ids[self.zeros[level] :] | kind(1 << (self.bits - 1 - level))
            ids = before
        return ids.astype(np.uint32)

    def _bit(self, level: int, i: int) -> int:
        return int(self.planes[level][i >> 3] >> (i & 7)) & 1

    def _rank1(self, level: int, i: int) -> int:
        """Ones among the first ``i`` places of a plane."""
        block = i // SAMPLE
        inside = np.unpackbits(self.planes[level][block * (SAMPLE // 8) : (i + 7) >> 3], bitorder="little")
        return int(self.ones[level][block]) + int(inside[: i - block * SAMPLE].sum())

    def access(self, i: int) -> int:
        """The id at place ``i``."""
        out = 0
        for level in range(self.bits):
            bit = self._bit(level, i)
            out = out << 1 | bit
            i = self.zeros[level] + self._rank1(level, i) if bit else i - self._rank1(level, i)
        return out

    def _range(self, token: int, stop: int) -> tuple[int, int]:
        """Where the ids equal to ``token`` among the first ``stop`` stand below the lowest plane."""
        if token >> self.bits:
            return 0, 0
        low, high = 0, stop
        for level in range(self.bits):
            a, b = self._rank1(level, low), self._rank1(level, high)
            if token >> (self.bits - 1 - level) & 1:
                low, high = self.zeros[level] + a, self.zeros[level] + b
            else:
                low, high = low - a, high - b
        return low, high

    def count(self, token: int, stop: int | None = None) -> int:
        """Occurrences of an id among the first ``stop`` places."""
        low, high = self._range(token, self.n if stop is None else stop)
        return high - low

    def _select(self, level: int, bit: int, k: int) -> int:
        """Place of the ``k``-th (from 0) zero or one of a plane."""
        ones = self.ones[level].astype(np.int64)
        upto = ones if bit else np.arange(len(ones)) * SAMPLE - ones
        block = int(np.searchsorted(upto, k, side="right")) - 1
        part = np.unpackbits(
            self.planes[level][block * (SAMPLE // 8) : (block + 1) * (SAMPLE // 8)], bitorder="little"
        )
        return block * SAMPLE + int(np.flatnonzero(part == bit)[k - int(upto[block])])

    def find(self, token: int, k: int) -> int:
        """Place of the ``k``-th (from 0) occurrence of an id."""
        low, high = self._range(token, self.n)
        if not 0 <= k < high - low:
            raise IndexError(f"id {token} has {high - low} occurrences")
        i = low + k
        for level in reversed(range(self.bits)):
            bit = token >> (self.bits - 1 - level) & 1
            i = self._select(level, bit, i - self.zeros[level] if bit else i)
        return i

    def row(self) -> dict:
        return {
            "n_tokens": self.n,
            "bits": self.bits,
            "zeros": self.zeros,
            "planes": [p.tobytes() for p in self.planes],
            "ones": [o.tobytes() for o in self.ones],
        }

    @classmethod
    def of_row(cls, row: dict) -> WaveletMatrix:
        return cls(
            row["n_tokens"],
            row["bits"],
            list(row["zeros"]),
            [np.frombuffer(p, np.uint8) for p in row["planes"]],
            [np.frombuffer(o, np.uint32) for o in row["ones"]],
        )


def write_token_files(
    documents: DataFrame,
    path: str,
    *,
    tokenizer: str | None = None,
    end_id: int = END_ID,
    block_tokens: int = BLOCK_TOKENS,
) -> None:
    """Encode every whole text of ``documents`` (``doc_id, text``), an end id behind each, in order of ``doc_id``.

    A null or empty text is the end id alone. Null ids come first; rows of one id stand in an order given by their
    texts. A text of more than ``block_tokens`` ids has a block of its own. Other columns are not read.
    """
    file = tokenizer or default_tokenizer_path()

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(file)
        bits = max(encode.tokenizer.get_vocab_size(with_added_tokens=True) - 1, end_id).bit_length()
        part, seq = TaskContext.get().partitionId(), 0
        held: list[np.ndarray] = []
        doc_ids: list[int | None] = []
        counts: list[int] = []
        n = 0

        def block() -> pa.RecordBatch:
            matrix = WaveletMatrix.build(np.concatenate(held), bits)
            row = {"part": part, "seq": seq, **matrix.row(), "doc_ids": doc_ids, "counts": counts}
            return pa.RecordBatch.from_pylist([row], _FILE_ARROW)

        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            texts = batch.column("text")
            for cut in text_blocks(texts, ENCODE_BYTES):
                rows = slice(cut.first, cut.first + cut.rows)
                found, sizes = encode.encode(texts[rows].fill_null("").to_pylist())
                stops = np.cumsum(sizes)
                found = np.insert(found, stops, np.uint32(end_id))
                sizes = (sizes + 1).tolist()
                at = 0
                for doc_id, size in zip(ids[rows], sizes):
                    held.append(found[at : at + size])
                    doc_ids.append(doc_id)
                    counts.append(size)
                    at += size
                    n += size
                    if n >= block_tokens:
                        yield block()
                        held, doc_ids, counts, n, seq = [], [], [], 0, seq + 1
        if doc_ids:
            yield block()

    rows = documents.select(F.col("doc_id").cast("bigint"), "text")
    # the text's hash beside the id splits an id that many rows share
    dealt = rows.withColumn("_h", F.xxhash64("text")).repartitionByRange("doc_id", "_h")
    ordered = dealt.sortWithinPartitions("doc_id", "_h", "text").select("doc_id", "text")
    ordered.mapInArrow(blocks, FILE_SCHEMA).write.option("compression", "zstd").parquet(path)


def block_starts(blocks: DataFrame) -> DataFrame:
    """``part, seq, block_start``: ids in all blocks before each."""
    sizes = blocks.select("part", "seq", "n_tokens")
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    within = sizes.select("part", "seq", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)).alias("within"))
    # one row per shard file
    over = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shards = sizes.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = shards.select("part", F.coalesce(F.sum("total").over(over), F.lit(0)).alias("before"))
    return within.join(before, "part").select("part", "seq", (F.col("before") + F.col("within")).alias("block_start"))


DIGEST_SCHEMA = "part int, seq int, doc_id bigint, inside bigint, n_tokens bigint, ids_crc32 bigint"


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files: ``doc_id, start, n_tokens, ids_crc32``, from the decoded planes."""

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
                ids = WaveletMatrix.of_row(row).decode()
                stops = np.cumsum(np.array(row["counts"], np.int64))
                starts = stops - np.array(row["counts"], np.int64)
                sums = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts.tolist(), stops.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["part"]] * len(sums), pa.int32()),
                        pa.array([row["seq"]] * len(sums), pa.int32()),
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array(starts),
                        pa.array(stops - starts),
                        pa.array(sums, pa.int64()),
                    ],
                    names=["part", "seq", "doc_id", "inside", "n_tokens", "ids_crc32"],
                )

    blocks = spark.read.schema(FILE_SCHEMA).parquet(path)
    return (
        blocks.mapInArrow(digests, DIGEST_SCHEMA)
        .join(block_starts(blocks), ["part", "seq"])
        .select("doc_id", (F.col("block_start") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")
    )


LOOKUP_SCHEMA = "part int, seq int, place bigint"


def occurrences(spark: SparkSession, path: str, token: int) -> DataFrame:
    """Places of an id in the whole sequence, ascending order not implied: ``place``."""

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
                matrix = WaveletMatrix.of_row(row)
                found = [matrix.find(token, k) for k in range(matrix.count(token))]
                yield pa.RecordBatch.from_pydict(
                    {
                        "part": pa.array([row["part"]] * len(found), pa.int32()),
                        "seq": pa.array([row["seq"]] * len(found), pa.int32()),
                        "place": pa.array(found, pa.int64()),
                    }
                )

    blocks = spark.read.schema(FILE_SCHEMA).parquet(path)
    found = blocks.drop("doc_ids", "counts").mapInArrow(places, LOOKUP_SCHEMA)
    return found.join(block_starts(blocks), ["part", "seq"]).select((F.col("block_start") + F.col("place")).alias("place"))

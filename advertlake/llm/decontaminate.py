"""Benchmark decontamination by spaced seeds.

A fixed mask over consecutive words says which of them a hash takes in and which it ignores, so a hash still meets its
partner when words at ignored places were substituted. Hashes of the benchmark's words are joined with those of the
documents; a hit aligns a document with an item, and around it the aligned words are compared: an overlap is a window
of ``WINDOW`` words of which at least four fifths are equal, or a whole shorter item but for one word at most. The masks
together hit every window with up to two substitutions, the most the share allows, and so miss none. Items shorter than
a mask are looked up by the hash of all their words, so that only a passage with the same words in order overlaps them.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from advertlake.llm.kernels import LOWER_VALUES, PLACES, U64, Block, mix, prefix_hash, span_hash, text_blocks, words_of
from advertlake.session import remove, scratch_path, stage

MASKS = ("1101111", "111010011")
WINDOW = 13
SHARE_PERCENT = 80
LEAST_WORDS = 9  # shorter items, which occur by chance, overlap only where all their words do, and only if asked for
# Benchmark text that one pass over the documents takes along; a larger benchmark takes more passes.
BLOCK_CHARS = 4_000_000
TABLE_BITS = 20

HITS = "array<struct<item_id:bigint,doc_word:bigint,item_word:bigint,n_words:bigint,n_equal:bigint>>"


def least_equal(words: int) -> int:
    """Words of a window that must be equal."""
    return -(-WINDOW * SHARE_PERCENT // 100) if words >= WINDOW else words - 1


def word_hashes(block: Block):
    words = words_of(block)
    return span_hash(prefix_hash(block.data, LOWER_VALUES), words.starts, words.ends), words


def seed_hashes(hashes: np.ndarray, rows: np.ndarray, mask: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of a mask laid at every word whose row still covers it, and those words' positions."""
    n = len(hashes) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    at = np.flatnonzero(rows[:n] == rows[len(mask) - 1 :])
    out = np.zeros(len(at), np.uint64)
    for j, taken in enumerate(mask):
        if taken == "1":
            out += hashes[at + j] * PLACES[j]
    return mix(out), at


@dataclass(frozen=True)
class SeedIndex:
    """A block of the benchmark: its words, and for every mask the sorted hashes with a bitmap before them."""

    item_ids: list[int | None]  # by row
    words: np.ndarray  # hashes
    rows: np.ndarray
    first: np.ndarray  # of a row, with a last entry behind
    seeds: list[tuple[np.ndarray, np.ndarray]]
    bitmaps: list[np.ndarray]
    short: dict[int, tuple[np.ndarray, np.ndarray]] = field(default_factory=dict)  # by words: sorted hashes, rows

    @classmethod
    def build(cls, item_ids: list[int | None], texts: list[str], short_items: bool = False) -> SeedIndex:
        hashes, rows, base = [], [], 0
        for block in text_blocks(pa.array(texts, pa.string())):
            h, w = word_hashes(block)
            hashes.append(h)
            rows.append(w.row + base)
            base += block.rows
        h = np.concatenate([np.zeros(0, np.uint64), *hashes])
        r = np.concatenate([np.zeros(0, np.int64), *rows]).astype(np.int64)
        seeds, bitmaps = [], []
        for mask in MASKS:
            s, at = seed_hashes(h, r, mask)
            order = np.argsort(s, kind="stable")
            seeds.append((s[order], at[order]))
            bitmap = np.zeros(1 << TABLE_BITS, bool)
            bitmap[(s >> U64(64 - TABLE_BITS)).astype(np.int64)] = True
            bitmaps.append(bitmap)
        first = np.searchsorted(r, np.arange(len(texts) + 1))
        short = {}
        per_row = np.diff(first)
        for k in range(1, LEAST_WORDS) if short_items else ():
            own = np.flatnonzero(per_row == k)
            if len(own):
                s, at = seed_hashes(h, r, "1" * k)
                s = s[np.searchsorted(at, first[own])]
                order = np.argsort(s, kind="stable")
                short[k] = s[order], own[order]
        return cls(item_ids, h, r, first, seeds, bitmaps, short)

    def overlaps(self, block: Block) -> list[list[tuple[int, int, int, int, int]]]:
        """For every row of a block: the best verified overlap with each item, in order of item ids, those without one last."""
        out: list[list[tuple[int, int, int, int, int]]] = [[] for _ in range(block.rows)]
        hashes, words = word_hashes(block)
        found = []
        for mask, (seeds, places), bitmap in zip(MASKS, self.seeds, self.bitmaps):
            s, at = seed_hashes(hashes, words.row, mask)
            maybe = bitmap[(s >> U64(64 - TABLE_BITS)).astype(np.int64)]
            s, at = s[maybe], at[maybe]
            low, high = np.searchsorted(seeds, s, "left"), np.searchsorted(seeds, s, "right")
            n = high - low
            here = np.repeat(at, n)
            there = places[np.repeat(low - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]
            # an item and a row stand at one shift to each other wherever they agree
            found.append(np.stack((words.row[here], self.rows[there], here - there), axis=1))
        pairs = np.unique(np.concatenate(found), axis=0)
        first_word = np.concatenate(([0], np.cumsum(words.per_row)))
        best: dict[tuple[int, int], tuple[int, int, int, int]] = {}
        for row, item, shift in pairs.tolist():
            lo = max(self.first[item], first_word[row] - shift)
            hi = min(self.first[item + 1], first_word[row + 1] - shift)
            size = min(WINDOW, int(self.first[item + 1] - self.first[item]))
            if hi - lo < size or size < LEAST_WORDS:
                continue
            equal = np.concatenate(([0], np.cumsum(self.words[lo:hi] == hashes[lo + shift : hi + shift])))
            inside = equal[size:] - equal[:-size]
            good = np.flatnonzero(inside >= least_equal(size))
            if len(good):
                a, b = int(good[0]), int(good[-1]) + size
                at = (int(equal[b] - equal[a]), b - a, int(lo + a + shift - first_word[row]), int(lo + a - self.first[item]))
                best[row, item] = max(best.get((row, item), at), at)
        for k, (seeds, items) in self.short.items():
            s, at = seed_hashes(hashes, words.row, "1" * k)
            low, high = np.searchsorted(seeds, s, "left"), np.searchsorted(seeds, s, "right")
            hit = np.flatnonzero(high > low)
            # the first place of a passage in a row
            _, once = np.unique(np.stack((words.row[at[hit]], low[hit]), axis=1), axis=0, return_index=True)
            for i in hit[once].tolist():
                row = int(words.row[at[i]])
                for item in items[low[i] : high[i]].tolist():
                    if (self.words[self.first[item] : self.first[item + 1]] == hashes[at[i] : at[i] + k]).all():
                        best[row, item] = (k, k, int(at[i] - first_word[row]), 0)
        for (row, item), (n_equal, n, doc_word, item_word) in best.items():
            out[row].append((self.item_ids[item], doc_word, item_word, n, n_equal))
        return [sorted(x, key=lambda hit: (hit[0] is None, hit[0] or 0, hit[1:])) for x in out]


def overlap_hits(text: Column, index: SeedIndex) -> Column:
    """Verified overlaps of a whole text with the items of an index; none for a null or empty text."""

    @arrow_udf(HITS)
    def hits(texts: pa.Array) -> pa.Array:
        rows: list[list[tuple]] = []
        for block in text_blocks(texts):
            rows += index.overlaps(block)
        names = ("item_id", "doc_word", "item_word", "n_words", "n_equal")
        kind = pa.list_(pa.struct([(n, pa.int64()) for n in names]))
        return pa.array([[dict(zip(names, x)) for x in r] for r in rows], kind)

    return hits.asNondeterministic()(text)


def items_of(benchmark: DataFrame) -> DataFrame:
    """``item_id, text`` once each; a null id only for texts that no row with an id has."""
    texts = benchmark.select("item_id", "text").filter("text IS NOT NULL").groupBy("text").agg(F.collect_set("item_id").alias("ids"))
    return texts.select(F.explode_outer("ids").alias("item_id"), "text")


def block_count(benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> int:
    """Blocks that the benchmark's items take."""
    chars = items_of(benchmark).agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    return max(1, -(-chars // block_chars))


def seed_indexes(benchmark: DataFrame, block_chars: int = BLOCK_CHARS, short_items: bool = False) -> Iterable[SeedIndex]:
    """Indexes over blocks of the benchmark (``item_id, text``), each collected by itself; one when it is small.

    Null texts take part in no overlap, and items of fewer than ``LEAST_WORDS`` words only with ``short_items``, where
    all their words must be found in order. Repeated rows count once. Texts that only rows without an ``item_id`` have
    are items with a null id.
    """
    items = items_of(benchmark)
    blocks = block_count(benchmark, block_chars)
    for k in range(blocks):
        part = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).orderBy("item_id", "text").collect()
        yield SeedIndex.build([r["item_id"] for r in part], [r["text"] for r in part], short_items)


def contaminated(documents: DataFrame, benchmark: DataFrame, short_items: bool = False, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per document row and item that overlap, with the place and size of the overlap in words.

    Columns: ``doc_id, item_id, doc_word, item_word, n_words, n_equal``; ``item_id`` is null for each text that only
    benchmark rows without an id have. Documents without an overlap give no row.
    The hits of one of several blocks are written before the next block is collected, so that neither
    the driver nor the plan holds all indexes.
    """
    out = None
    several = block_count(benchmark, block_chars) > 1
    for index in seed_indexes(benchmark, block_chars, short_items):
        hits = documents.select("doc_id", F.explode(overlap_hits(F.col("text"), index)).alias("hit")).select("doc_id", "hit.*")
        hits = stage(hits, "benchmark-hits") if several else hits
        out = hits if out is None else out.unionByName(hits)
    return out


def without_contaminated(documents: DataFrame, benchmark: DataFrame, short_items: bool = False, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of ``documents`` that overlap no item, with their own columns.

    With several blocks, what one leaves is written before the next is collected, and the copy before that is deleted.
    """
    several, spark, before = block_count(benchmark, block_chars) > 1, documents.sparkSession, None
    for index in seed_indexes(benchmark, block_chars, short_items):
        rated = documents.select(F.struct("*").alias("row"), F.size(overlap_hits(F.col("text"), index)).alias("hits"))
        documents = rated.filter("hits = 0").select("row.*")
        if several:
            path = scratch_path(spark, "benchmark-left")
            documents = stage(documents, "benchmark-left", path)
            if before is not None:
                remove(spark, before)
            before = path
    return documents

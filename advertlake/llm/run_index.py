"""Long repeated strings by a run-length index: a run-compressed Burrows-Wheeler transform with sampled run ends.

A byte goes if a string of ``SPAN`` bytes that covers it also starts somewhere else. No text is compared with all
others, and no index is larger than a task can hold:

1. Anchors. Every string of ``SPAN`` bytes has an anchor, the smallest hash among its short grams, which depends on the
   string alone. Equal strings have equal anchors, so only strings with one anchor need to meet. A text's strings
   with one anchor stand next to each other; the bytes they span are a piece.
2. Anchors that occur once in the corpus are dropped. The pieces of the others are grouped by anchor, equal pieces
   become one. Equal pieces repeat as a whole.
3. Different pieces with one anchor are indexed in units of about a megabyte, without the stretches whose anchors of
   longer grams are in the unit once: suffixes are sorted, the transform is cut into runs, and the places at the run ends
   are kept. How far a place's text goes on elsewhere, its matching statistic, is one less than that of the place before,
   except at run ends. So the matches at run ends, as long as they are at least ``SPAN``, cover what all places cover, and
   only these are looked at.
4. An anchor with too many different pieces for a unit (a common line that is shorter than ``SPAN``) has its pieces
   anchored again with longer grams, up to grams of ``SPAN`` bytes, where equal anchors are equal strings.

Passages of more than fifty words that stand in several texts are told besides, whatever their length in bytes. Each text
is winnowed: of every 26 runs of 26 words the least hash counts, so that two texts with a common passage of 51 words
share one of these hashes. Only around shared ones are the hashes of all runs of 51 words compared.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from advertlake.llm.kernels import CACHED, U64, Block, Words, prefix_digits, prefix_hash, span_hash, text_blocks, window_digests, words_of
from advertlake.operators.windows import keep_first
from advertlake.session import stage

SPAN = 400
GRAM_SHARES = (0.12, 0.56, 0.78, 0.89, 1.0)  # lengths of the grams of the levels, as shares of the span
UNIT_BYTES = 1 << 20
UNIT_PIECES = 1024  # different pieces of one anchor that an index takes
PASSAGE_WORDS = 51
WINNOW_WORDS = 26  # of a run that is hashed; as many runs are looked at together, so a passage has one that counts
# Places fit any text Spark can hold; of equal shortened hashes the first counts, in every copy of a string alike.
PLACE_BITS = 32


def gram_lengths(span: int) -> list[int]:
    return sorted({max(1, round(span * s)) for s in GRAM_SHARES})


def text_keys(block: Block, prefix: np.ndarray) -> np.ndarray:
    return span_hash(prefix, block.offsets[:-1], block.offsets[1:])


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of every ``width`` consecutive values, from those of runs that double in length."""
    out = np.empty(max(len(values) - width + 1, 0), values.dtype)
    for at in range(0, len(out), CACHED):
        least, size = values[at : at + CACHED + width - 1], 1
        while 2 * size <= width:
            least = np.minimum(least[:-size], least[size:])
            size *= 2
        # two runs that overlap make up the rest
        out[at : at + CACHED] = np.minimum(least[: len(least) - width + size], least[width - size :])
    return out


def anchors(block: Block, span: int, gram: int, prefix: np.ndarray) -> tuple[np.ndarray, ...]:
    """Per piece of the block: row, anchor, and where its strings first and last begin, from the start of the text."""
    none = np.zeros(0, np.int64)
    n = len(block.data)
    if n < span:
        return none, none, none, none
    # half the hash chooses the anchor, all of it tells anchors apart
    keyed = (window_digests(prefix, gram) << U64(PLACE_BITS)) | np.arange(n - gram + 1, dtype=np.uint64)
    least = (sliding_least(keyed, span - gram + 1) & U64((1 << PLACE_BITS) - 1)).astype(np.int64)
    inside = np.zeros(len(least) + 1, np.int32)
    sizes = np.diff(block.offsets)
    long = sizes >= span
    np.add.at(inside, block.offsets[:-1][long], 1)
    np.add.at(inside, block.offsets[1:][long] - span + 1, -1)
    begin = np.flatnonzero(np.cumsum(inside[:-1]) > 0)
    if not len(begin):
        return none, none, none, none
    at = least[begin]
    opens = np.append(True, (at[1:] != at[:-1]) | (begin[1:] != begin[:-1] + 1))
    closes = np.append(opens[1:], True)
    row = block.row_of(begin[opens])
    base = block.offsets[row]
    g = span_hash(prefix, at[opens], at[opens] + gram)
    return row, g.view(np.int64), begin[opens] - base, begin[closes] - base


class RunIndex:
    """Suffix order of a unit of pieces, cut into runs of its Burrows-Wheeler transform.

    ``heads`` and ``lengths`` are the runs; ``first`` and ``last`` the places sampled at their ends. Each piece ends with
    a sign of its own, so no match goes beyond a piece.
    """

    def __init__(self, pieces: list[bytes]):
        self.sizes = np.array([len(p) for p in pieces], np.int64)
        self.begins = np.concatenate(([0], np.cumsum(self.sizes + 1)))[:-1]
        n = int((self.sizes + 1).sum())
        self.data = np.frombuffer(b"\0".join(pieces) + b"\0", np.uint8)
        symbols = self.data.astype(np.int64) + len(pieces)
        ends = self.begins + self.sizes
        symbols[ends] = np.arange(len(pieces))
        self.left = np.repeat(ends, self.sizes + 1) - np.arange(n)  # bytes to the end of the piece
        order = suffix_order(symbols)
        transform = symbols[order - 1]
        opens = np.append(True, transform[1:] != transform[:-1])
        at = np.flatnonzero(opens)
        self.heads, self.lengths = transform[at], np.diff(np.append(at, n))
        self.first, self.last = order[at], order[np.append(at[1:], n) - 1]

    def long_matches(self, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Places at run ends and the lengths, ``least`` or more, of what they share with their neighbour in order."""
        a, b = self.last[:-1], self.first[1:]
        most = np.minimum(self.left[a], self.left[b])
        able = most >= least
        a, b, most = a[able], b[able], most[able]
        # equal bytes have equal hashes, so a search by them ends no earlier than the match
        prefix = prefix_hash(self.data)[:1]
        same = span_hash(prefix, a, a + least) == span_hash(prefix, b, b + least)
        a, b, most = a[same], b[same], most[same]
        low, high = np.full(len(a), least), most
        while (low < high).any():
            middle = (low + high + 1) // 2
            equal = span_hash(prefix, a, a + middle) == span_hash(prefix, b, b + middle)
            low, high = np.where(equal, middle, low), np.where(equal, high, middle - 1)
        # what is taken away rests on bytes, not on hashes
        for k, (i, j, n) in enumerate(zip(a.tolist(), b.tolist(), low.tolist())):
            one, two = self.data[i : i + n], self.data[j : j + n]
            if not np.array_equal(one, two):
                low[k] = np.flatnonzero(one != two)[0]
        a, b, low = a[low >= least], b[low >= least], low[low >= least]
        return np.concatenate((a, b)), np.concatenate((low, low))

    def covered(self, least: int) -> list[tuple[int, int, int]]:
        """``piece, start, end`` of the maximal runs of bytes that matches cover."""
        places, lengths = self.long_matches(least)
        if not len(places):
            return []
        change = np.zeros(len(self.data) + 1, np.int64)
        np.add.at(change, places, 1)
        np.add.at(change, places + lengths, -1)
        on = np.cumsum(change)[:-1] > 0
        starts = np.flatnonzero(on & ~np.append(False, on[:-1]))
        ends = np.flatnonzero(on & ~np.append(on[1:], False)) + 1
        piece = np.searchsorted(self.begins, starts, "right") - 1
        return list(zip(piece.tolist(), (starts - self.begins[piece]).tolist(), (ends - self.begins[piece]).tolist()))


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Starts of the suffixes in order, by multiplying the length compared; only suffixes still tied are sorted again.

    The first comparison is of as many symbols as a number holds, the next ones of as many ranks.
    """
    n = len(symbols)
    low = int(symbols.min(initial=0))
    bits = max(int(symbols.max(initial=0) - low + 1).bit_length(), 1)  # nothing, behind the end, is less than any symbol
    packed = max(62 // bits, 1)
    firsts = symbols - (low - 1)
    for k in range(1, packed):
        firsts <<= bits
        firsts[: max(n - k, 0)] += symbols[k:] - (low - 1)
    order = np.argsort(firsts)
    sorted_ = firsts[order]
    head = np.append(True, sorted_[1:] != sorted_[:-1])
    rank = np.empty(n + 1, np.int32 if n < 1 << 31 else np.int64)
    rank[n] = -1
    rank[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    slots = np.flatnonzero(~(head & np.append(head[1:], True)))
    active, k = order[slots], packed
    bits = n.bit_length()
    parts = max(63 // bits, 2) if bits else 2
    while len(active):
        key = rank[active].astype(np.int64)
        for j in range(1, parts):
            key <<= bits
            key += rank.take(active + j * k, mode="clip") + 1
        by = np.argsort(key)
        active, key = active[by], key[by]
        opens = np.append(True, key[1:] != key[:-1])
        # tied suffixes stand together, so the sorted ones fill the same places
        order[slots] = active
        rank[active] = np.maximum.accumulate(np.where(opens, slots, 0))
        tied = ~(opens & np.append(opens[1:], True))
        active, slots = active[tied], slots[tied]
        k *= parts
    return order


def run_hashes(word_hashes: np.ndarray, words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words and the number of the word each begins with; runs stay within a text."""
    n = len(word_hashes)
    if n < size:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    at = np.flatnonzero(words.row[: n - size + 1] == words.row[size - 1 :])
    return span_hash(prefix_digits(word_hashes), at, at + size), at


def winnowed(block: Block, prefix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of the runs of words that count: the least of every ``WINNOW_WORDS`` next to each other."""
    words = words_of(block)
    hashes = span_hash(prefix, words.starts, words.ends)
    runs, at = run_hashes(hashes, words, WINNOW_WORDS)
    if not len(runs):
        return at, runs
    row = words.row[at]
    # a window of runs begins where all of them are in one text
    whole = np.flatnonzero(row[: len(row) - WINNOW_WORDS + 1] == row[WINNOW_WORDS - 1 :]) if len(row) >= WINNOW_WORDS else at[:0]
    if not len(whole):
        return at[:0], runs[:0]
    least = sliding_least(runs, WINNOW_WORDS)[whole]
    first = np.append(True, (least[1:] != least[:-1]) | (row[whole][1:] != row[whole][:-1]))
    return row[whole][first], least[first]


ANCHOR_SCHEMA = "k bigint, g bigint, a bigint, b bigint"


def anchor_table(documents: DataFrame, span: int, gram: int) -> DataFrame:
    """``k`` (of the text), ``g``, ``a``, ``b`` of the anchors of all texts; and, without ``a`` and ``b``, ``k, g`` of the
    hashes of runs of words that count. Each different text is looked at once per task."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for block in text_blocks(batch.column("text")):
                prefix = prefix_hash(block.data)
                keys = text_keys(block, prefix).view(np.int64)
                row, g, a, b = anchors(block, span, gram, prefix)
                row_w, g_w = winnowed(block, prefix)
                fresh = np.zeros(block.rows, bool)
                for i in np.unique(np.concatenate((row, row_w))).tolist():
                    if int(keys[i]) not in seen:
                        seen.add(int(keys[i]))
                        fresh[i] = True
                take, take_w = fresh[row], fresh[row_w]
                n, m = int(take.sum()), int(take_w.sum())
                columns = [
                    pa.array(np.concatenate((keys[row[take]], keys[row_w[take_w]]))),
                    pa.array(np.concatenate((g[take].view(np.int64), g_w[take_w].view(np.int64)))),
                    pa.concat_arrays([pa.array(a[take], pa.int64()), pa.nulls(m, pa.int64())]),
                    pa.concat_arrays([pa.array(b[take], pa.int64()), pa.nulls(m, pa.int64())]),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["k", "g", "a", "b"])

    return documents.select("text").mapInArrow(found, ANCHOR_SCHEMA)


def passage_runs(candidates: DataFrame) -> DataFrame:
    """``k, h``: hashes of all runs of ``PASSAGE_WORDS`` words around the shared hashes ``passages`` of a text."""

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, lists = batch.column("k").to_numpy(), batch.column("passages")
            sizes = lists.value_lengths().fill_null(0).to_numpy()
            begins = np.concatenate(([0], np.cumsum(sizes)))
            wanted = lists.flatten().to_numpy().view(np.uint64)
            for block in text_blocks(batch.column("text")):
                words = words_of(block)
                hashes = span_hash(prefix_hash(block.data), words.starts, words.ends)
                short, at = run_hashes(hashes, words, WINNOW_WORDS)
                hit = np.zeros(len(hashes) + 1, np.int64)
                here = np.unique(wanted[begins[block.first] : begins[block.first + block.rows]])
                hit[at[np.isin(short, here)]] = 1
                before = np.concatenate(([0], np.cumsum(hit)))
                whole, start = run_hashes(hashes, words, PASSAGE_WORDS)
                around = before[start + PASSAGE_WORDS - WINNOW_WORDS + 1] > before[start]
                rows = words.row[start[around]]
                yield pa.RecordBatch.from_arrays([pa.array(keys[block.first + rows]), pa.array(whole[around].view(np.int64))], names=["k", "h"])

    return candidates.filter("passages IS NOT NULL").select("k", "text", "passages").mapInArrow(runs, "k bigint, h bigint")


def identity(text: Column) -> Column:
    """``k``, ``n`` and ``w``: key, number of bytes and number of words of a whole text."""

    @arrow_udf("struct<k:bigint,n:bigint,w:bigint>")
    def identify(texts: pa.Array) -> pa.Array:
        columns: list[list[np.ndarray]] = [[np.zeros(0, np.int64)] for _ in range(3)]
        for block in text_blocks(texts):
            found = (text_keys(block, prefix_hash(block.data)).view(np.int64), np.diff(block.offsets), words_of(block).per_row.astype(np.int64))
            for column, part in zip(columns, found):
                column.append(part)
        return pa.StructArray.from_arrays([pa.array(np.concatenate(c)) for c in columns], ["k", "n", "w"])

    return identify.asNondeterministic()(text)


PIECE_SCHEMA = "g bigint, h bigint, k bigint, at bigint, bytes binary"


def _bytes_hash(piece: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(piece, digest_size=8).digest(), "little", signed=True)


def _piece_batch(rows: list[tuple[int, int, int, int, bytes]]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
    columns = list(zip(*rows)) or [[], [], [], [], []]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["g", "h", "k", "at", "bytes"])


def first_pieces(candidates: DataFrame, span: int) -> DataFrame:
    """Pieces at the listed anchors of ``k, text, found``."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for k, text, found in zip(*[batch.column(c).to_pylist() for c in ("k", "text", "found")]):
                raw = text.encode()
                for x in found:
                    piece = raw[x["a"] : x["b"] + span]
                    rows.append((x["g"], _bytes_hash(piece), k, x["a"], piece))
                if len(rows) > 2000:
                    yield _piece_batch(rows)
                    rows = []
            yield _piece_batch(rows)

    return candidates.select("k", "text", "found").mapInArrow(cut, PIECE_SCHEMA)


def finer_pieces(pieces: DataFrame, span: int, gram: int) -> DataFrame:
    """Pieces (``k, at, bytes``) anchored again with longer grams."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ks, ats, raws = [batch.column(c).to_pylist() for c in ("k", "at", "bytes")]
            rows = []
            for i in range(0, len(raws), 256):
                part = raws[i : i + 256]
                offsets = np.concatenate(([0], np.cumsum([len(p) for p in part])))
                block = Block(i, np.frombuffer(b"".join(part), np.uint8), offsets)
                for row, g, a, b in zip(*[x.tolist() for x in anchors(block, span, gram, prefix_hash(block.data))]):
                    piece = part[row][a : b + span]
                    rows.append((g, _bytes_hash(piece), ks[i + row], ats[i + row] + a, piece))
                yield _piece_batch(rows)
                rows = []

    return pieces.select("k", "at", "bytes").mapInArrow(cut, PIECE_SCHEMA)


MARK_SCHEMA = "k bigint, s bigint, e bigint"


def met_again(pieces: list[bytes], span: int, gram: int) -> list[tuple[int, int, bytes]]:
    """``piece, start, bytes`` of the stretches of a unit whose strings of ``span`` bytes have an anchor that is there twice.

    Strings that repeat in the unit have equal anchors of every length, so all of them are within a stretch.
    """
    offsets = np.concatenate(([0], np.cumsum([len(p) for p in pieces])))
    block = Block(0, np.frombuffer(b"".join(pieces), np.uint8), offsets)
    row, g, a, b = anchors(block, span, gram, prefix_hash(block.data))
    _, back, counts = np.unique(g, return_inverse=True, return_counts=True)
    twice = counts[back] > 1
    # in the order of the text, so that a stretch ends where the next one does not begin before its end
    row, a, b = row[twice], a[twice], b[twice] + span
    opens = np.append(True, (row[1:] != row[:-1]) | (a[1:] > b[:-1]))[: len(row)]
    closes = np.append(opens[1:], True)[: len(row)]
    return [(i, s, pieces[i][s:e]) for i, s, e in zip(row[opens].tolist(), a[opens].tolist(), b[closes].tolist())]


def indexed_marks(pieces: DataFrame, span: int) -> DataFrame:
    """Marks on pieces that occur once, from indexes over all pieces of an anchor (``g, k, at, n, bytes``)."""
    longest = gram_lengths(span)[-2:][0]

    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, now = 0, None

        def index() -> pa.RecordBatch:
            parts = met_again([r[3] for r in held], span, longest)
            found = RunIndex([raw for _, _, raw in parts]).covered(span) if parts else []
            of = [(*held[i], at) for i, at, _ in parts]
            out = [(of[j][0], of[j][1] + of[j][4] + s, of[j][1] + of[j][4] + e) for j, s, e in found if of[j][2] == 1]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (list(zip(*out)) or ([], [], []))], names=["k", "s", "e"])

        for batch in batches:
            for g, *row in zip(*[batch.column(c).to_pylist() for c in ("g", "k", "at", "n", "bytes")]):
                if g != now and size >= UNIT_BYTES:
                    yield index()
                    held, size = [], 0
                now = g
                held.append(tuple(row))
                size += len(row[3])
        if held:
            yield index()

    dealt = pieces.select("g", "k", "at", "n", "bytes").repartition("g").sortWithinPartitions("g")
    return dealt.mapInArrow(marks, MARK_SCHEMA)


def repeated_marks(
    documents: DataFrame, texts: DataFrame, *, span: int = SPAN
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Marks ``k, s, e`` on texts, the texts that may have some (``k, text``), and those with a common passage (``k``).

    ``texts`` has one row ``k, text`` per different text of at least ``span`` bytes or ``PASSAGE_WORDS`` words.
    """
    grams = gram_lengths(span)
    # written, as it is read twice
    both = stage(anchor_table(documents, span, grams[0]), "repeat-anchors")
    table, counted = both.filter("a IS NOT NULL"), both.filter("a IS NULL").select("k", "g")
    place = F.xxhash64("k", "a")
    twice = table.groupBy("g").agg(F.min(place).alias("low"), F.max(place).alias("high")).filter("low <> high").select("g")
    twice = stage(twice, "repeat-grams")  # so that the join has shuffles of its own, whose large parts can be split
    # anchors of one text, each task's copy of it being equal
    listed = table.join(twice, "g").distinct().groupBy("k").agg(F.collect_list(F.struct("g", "a", "b")).alias("found"))
    common = counted.groupBy("g").agg(F.min("k").alias("low"), F.max("k").alias("high")).filter("low <> high").select("g")
    common = stage(common, "passage-grams")
    passages = counted.join(common, "g").groupBy("k").agg(F.collect_set("g").alias("passages"))
    # the texts that either asks for are moved once
    asked = stage(listed.join(passages, "k", "full"), "repeat-asked")
    candidates = stage(texts.join(asked, "k"), "repeat-candidates")

    runs = stage(passage_runs(candidates).distinct(), "passage-runs")
    twice_run = runs.groupBy("h").agg(F.min("k").alias("low"), F.max("k").alias("high")).filter("low <> high").select("h")
    with_passage = runs.join(stage(twice_run, "passage-repeats"), "h").select("k").distinct()

    all_marks = None
    pieces = first_pieces(candidates.filter("found IS NOT NULL"), span)
    for level, gram in enumerate(grams):
        different = pieces.groupBy("g", "h").agg(
            F.first("bytes").alias("bytes"), F.count("*").alias("n"), F.min(F.struct("k", "at")).alias("one")
        )
        different = stage(different.select("g", "h", "n", "one.k", "one.at", "bytes"), "repeat-pieces")
        again = different.filter("n > 1").select("g", "h")
        whole = pieces.join(again, ["g", "h"]).select("k", F.col("at").alias("s"), (F.col("at") + F.length("bytes")).alias("e"))
        marks = stage(whole, "repeat-marks")
        all_marks = marks if all_marks is None else all_marks.unionByName(marks)
        if gram == span:
            break
        groups = different.groupBy("g").agg(F.count("*").alias("m"), F.min("n").alias("least")).filter("m > 1 AND least = 1")
        groups = stage(groups.select("g", "m"), "repeat-groups")
        small = different.join(groups.filter(F.col("m") <= UNIT_PIECES), "g")
        all_marks = all_marks.unionByName(stage(indexed_marks(small, span), "repeat-marks"))
        large = groups.filter(F.col("m") > UNIT_PIECES)
        if large.isEmpty():
            break
        pieces = finer_pieces(stage(different.join(large, "g").select("k", "at", "bytes"), "repeat-large"), span, grams[level + 1])
    return all_marks, candidates, with_passage


def removal(text: Column, starts: Column, ends: Column) -> Column:
    """What is left of a text without the marked bytes: ``n_removed, n_spans, kept_sha256``."""

    @arrow_udf("struct<n_removed:bigint,n_spans:bigint,kept_sha256:string>")
    def cut(texts: pa.Array, starts: pa.Array, ends: pa.Array) -> pa.Array:
        out = []
        for text, s, e in zip(texts.to_pylist(), starts.to_pylist(), ends.to_pylist()):
            raw = text.encode()
            kept, spans, removed, at = hashlib.sha256(), 0, 0, 0
            stop = -1
            for a, b in sorted(zip(s, e)):
                if a > stop:
                    spans += 1
                if b > stop:
                    if a > at:
                        kept.update(raw[at:a])
                    removed += b - max(a, at)
                    at = stop = b
            kept.update(raw[at:])
            out.append({"n_removed": removed, "n_spans": spans, "kept_sha256": kept.hexdigest()})
        return pa.array(out, pa.struct([("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())]))

    return cut.asNondeterministic()(text, starts, ends)


def remove_repeats(documents: DataFrame, *, span: int = SPAN) -> DataFrame:
    """Per row of ``documents`` (``doc_id, text``): ``doc_id, n_bytes, n_removed, n_spans, kept_sha256, repeats``.

    ``repeats`` tells whether the text shares a passage of ``PASSAGE_WORDS`` words with another row, equal texts included.

    Texts are UTF-8 bytes, a null text none; what repeats is judged on the input. Texts shorter than ``span`` lose
    nothing; equal longer texts, repeated rows among them, lose everything. An empty table gives no rows; other columns
    are not read.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    known = documents.select("doc_id", text.alias("text")).select("doc_id", identity(F.col("text")).alias("i"), F.sha2(F.col("text").cast("binary"), 256).alias("sha"))
    rows = stage(known.select("doc_id", "i.k", "i.n", "i.w", "sha"), "repeat-rows")
    # whole texts are equal if both their keys and their digests are
    copies = rows.filter((F.col("n") >= span) | (F.col("w") >= PASSAGE_WORDS)).groupBy("k", "sha").agg(F.count("*").alias("copies")).filter("copies > 1")

    keyed = documents.filter("text IS NOT NULL").select(identity(F.col("text")).alias("i"), "text").select("i.k", "i.n", "i.w", "text")
    long = (F.col("n") >= span) | (F.col("w") >= PASSAGE_WORDS)
    texts = keep_first(keyed.filter(long).select("k", "text"), ["k"], ["k"])
    marks, candidates, with_passage = repeated_marks(documents, texts, span=span)
    per_text = marks.groupBy("k").agg(F.collect_list("s").alias("s"), F.collect_list("e").alias("e"))
    cut = candidates.select("k", "text").join(per_text, "k").select("k", removal(F.col("text"), F.col("s"), F.col("e")).alias("x"))
    changed = copies.join(cut.select("k", "x.*"), "k", "full").withColumnRenamed("sha", "sha_of_copies")
    changed = changed.join(with_passage.withColumn("passage", F.lit(True)), "k", "full")
    copied = F.coalesce(F.col("copies").isNotNull() & (F.col("sha") == F.col("sha_of_copies")), F.lit(False))
    everything = copied & (F.col("n") >= span)
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return rows.join(changed, "k", "left").select(
        "doc_id",
        F.col("n").alias("n_bytes"),
        F.when(everything, F.col("n")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("bigint").alias("n_removed"),
        F.when(everything, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("bigint").alias("n_spans"),
        F.when(everything, nothing).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
        (F.coalesce("passage", F.lit(False)) | (copied & (F.col("w") >= PASSAGE_WORDS))).alias("repeats"),
    )

"""Self-join of documents by the Jaccard similarity of their word shingles, by vertical partitioning.

Shingles have one global order, that of their hashes. The order is cut into fragments, and every document's set into
segments, one per fragment. A fragment's task meets all segments of its range, so it knows the exact number of
documents of each of its shingles, and each fragment counts for itself; sums per document or pair give the whole.

1. Fragments find the shingles that only one document has. These can be in no overlap, so a document whose repeated
   shingles, summed over the fragments, are fewer than the threshold asks for has no partner. Most end here.
2. The others keep their repeated shingles in order of rarity. Partners share one of the first few of them, more than
   that would be too many to miss. Documents with the same text set were made one class at the start.
3. Candidates' overlaps are counted segment by segment and summed per pair. In a few rounds every component, at first
   every class, tries one pair with a component that leads a list it is in, each round another one. What is left are
   pairs of a list in different components. A pair is taken where its two sets first meet: further lists that both are
   in, which near copies have by the dozen, see that the places before them agree. Of these pairs every component tries
   its most promising ones, round by round more of them, and pairs within a component go; so the links inside a large
   group of near copies are never all listed, and none that joins two components is missed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from advertlake.llm.components import connected
from advertlake.llm.kernels import LOWER_VALUES, U64, Block, mix, prefix_hash, shingle_hashes, span_hash, text_blocks, words_of
from advertlake.operators.windows import keep_first
from advertlake.session import stage

SHINGLE_WORDS = 5
PERCENT = 80
FRAGMENTS_PER_PARTITION = 4
MOST_FRAGMENTS = 1 << 16
SEGMENTS = 8  # of the repeated shingles of a document, when pairs are counted
PARITY_WORDS = 8
ROUNDS = 2  # of single tries per component before all remaining pairs are listed
BEFORE = 8  # places before one in which a pair is looked for, so that it is taken once
BUFFERED = 1 << 21  # shingles a task holds before it passes them on

KEPT_BYTES = 6  # of a shingle's hash beside its fragment
LOW = U64((1 << 48) - 1)


def shingle_sets(block: Block, size: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of every row of a block, ordered by row and hash, and the rows."""
    words = words_of(block)
    hashes = span_hash(prefix_hash(block.data, LOWER_VALUES), words.starts, words.ends)
    h, r = shingle_hashes(hashes, words, size)
    order = np.lexsort((h, r))
    h, r = h[order], r[order]
    first = np.append(True, (h[1:] != h[:-1]) | (r[1:] != r[:-1])) if len(h) else np.zeros(0, bool)
    return h[first], r[first]


def set_keys(hashes: np.ndarray, rows: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Size and key of every row's set; equal sets have equal keys."""
    sizes = np.bincount(rows, minlength=n_rows)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(hashes + U64(0x5851F42D4C957F2D)))))
    ends = np.cumsum(sizes)
    return sizes, mix(total[ends] - total[ends - sizes] + sizes.astype(np.uint64)).view(np.int64)


def described(text: Column, size: int = SHINGLE_WORDS) -> Column:
    """``n`` and ``k``: a text's number of distinct shingles and the key of their set."""

    @arrow_udf("struct<n:bigint,k:bigint>")
    def describe(texts: pa.Array) -> pa.Array:
        ns, ks = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for block in text_blocks(texts):
            n, k = set_keys(*shingle_sets(block, size), block.rows)
            ns.append(n)
            ks.append(k)
        return pa.StructArray.from_arrays([pa.array(np.concatenate(ns)), pa.array(np.concatenate(ks))], ["n", "k"])

    return describe.asNondeterministic()(text)


SEGMENT_SCHEMA = "frag int, ks binary, counts binary, ids binary"
_SEGMENT_ARROW = pa.schema([("frag", pa.int32()), ("ks", pa.binary()), ("counts", pa.binary()), ("ids", pa.binary())])


def segments(documents: DataFrame, fragments: int, size: int = SHINGLE_WORDS) -> DataFrame:
    """Segments of all sets, many documents packed into a row: fragment, keys, shingles per key, cut hashes.

    A task passes on each set once, however many of its rows have it.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        held: list[tuple[np.ndarray, np.ndarray]] = []
        n = 0

        def flush() -> pa.RecordBatch:
            h, k = (np.concatenate(x) for x in zip(*held))
            frag = (((h >> U64(48)) * U64(fragments)) >> U64(16)).astype(np.uint16)
            order = np.argsort(frag, kind="stable")
            h, k, frag = h[order], k[order], frag[order]
            opens = np.append(True, (frag[1:] != frag[:-1]) | (k[1:] != k[:-1]))
            at = np.flatnonzero(opens)
            counts = np.diff(np.append(at, len(h))).astype(np.uint32)
            keys, of = k[at], frag[at]
            ids = (h & LOW).view(np.uint8).reshape(-1, 8)[:, :KEPT_BYTES]
            present, first = np.unique(of, return_index=True)
            last = np.append(first[1:], len(of))
            low, high = at[first], np.append(at, len(h))[last]
            columns = [
                pa.array(present.astype(np.int32)),
                pa.array([keys[a:b].tobytes() for a, b in zip(first, last)], pa.binary()),
                pa.array([counts[a:b].tobytes() for a, b in zip(first, last)], pa.binary()),
                pa.array([ids[a:b].tobytes() for a, b in zip(low, high)], pa.binary()),
            ]
            return pa.RecordBatch.from_arrays(columns, schema=_SEGMENT_ARROW)

        for batch in batches:
            for block in text_blocks(batch.column("text")):
                h, r = shingle_sets(block, size)
                sizes, keys = set_keys(h, r, block.rows)
                fresh = np.zeros(block.rows, bool)
                for i in np.flatnonzero(sizes).tolist():
                    key = int(keys[i])
                    if key not in seen:
                        seen.add(key)
                        fresh[i] = True
                take = fresh[r]
                if take.any():
                    held.append((h[take], keys[r[take]]))
                    n += int(take.sum())
                if n >= BUFFERED:
                    yield flush()
                    held, n = [], 0
        if held:
            yield flush()

    return documents.select("text").mapInArrow(cut, SEGMENT_SCHEMA)


def repeated_of_fragment(frag: int, rows: list[tuple[bytes, bytes, bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Keys and values of the shingles of a fragment that two or more sets have.

    A value orders by rarity first: the logarithm of the number of sets in its highest byte, then the hash.
    """
    keys, ids = [], []
    for ks, counts, low in rows:
        keys.append(np.repeat(np.frombuffer(ks, np.int64), np.frombuffer(counts, np.uint32)))
        wide = np.zeros((len(keys[-1]), 8), np.uint8)
        wide[:, :KEPT_BYTES] = np.frombuffer(low, np.uint8).reshape(-1, KEPT_BYTES)
        ids.append(wide.view(np.uint64).ravel())
    k, v = np.concatenate(keys), np.concatenate(ids)
    order = np.lexsort((k, v))
    k, v = k[order], v[order]
    # tasks that met the same set have each passed it on
    once = np.append(True, (v[1:] != v[:-1]) | (k[1:] != k[:-1]))
    k, v = k[once], v[once]
    first = np.flatnonzero(np.append(True, v[1:] != v[:-1]))
    count = np.diff(np.append(first, len(v)))
    rarity = np.minimum(16 * np.log2(count), 255).astype(np.uint64) << U64(56)
    per = np.repeat(count, count)
    out = v | (U64(frag & 0xFF) << U64(48)) | np.repeat(rarity, count)
    return k[per > 1], (out[per > 1] ^ U64(1 << 63)).view(np.int64)  # the sign bit turned, so that longs keep the order


REPEATED_SCHEMA = "k bigint, v array<bigint>, bits array<bigint>"
PACKED_SCHEMA = "bucket int, ks binary, vs binary"


def repeated_shingles(documents: DataFrame, size: int = SHINGLE_WORDS) -> DataFrame:
    """Per set with any: the shingles it shares with others, rarest first, and their parities, ``k, v, bits``.

    What the fragments find is packed by buckets of the sets' keys, so the rows that are moved are as many as pairs of
    tasks, not as sets in fragments, and a bucket's task has each of its sets whole.
    """
    buckets = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    fragments = min(FRAGMENTS_PER_PARTITION * buckets, MOST_FRAGMENTS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        n = 0

        def flush() -> pa.RecordBatch:
            k, v = (np.concatenate(x) for x in zip(*held))
            bucket = (k.view(np.uint64) >> U64(32)) % U64(buckets)
            order = np.argsort(bucket, kind="stable")
            k, v, bucket = k[order], v[order], bucket[order]
            first = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
            ends = np.append(first[1:], len(k))
            columns = [pa.array(bucket[first].astype(np.int32))]
            columns += [pa.array([x[i:j].tobytes() for i, j in zip(first, ends)], pa.binary()) for x in (k, v)]
            return pa.RecordBatch.from_arrays(columns, names=["bucket", "ks", "vs"])

        for frag, rows in _grouped(batches, "frag", ("ks", "counts", "ids")):
            found = repeated_of_fragment(frag, rows)
            if len(found[0]):
                held.append(found)
                n += len(found[0])
            if n >= BUFFERED:
                yield flush()
                held, n = [], 0
        if held:
            yield flush()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _grouped(batches, "bucket", ("ks", "vs")):
            k, v = (np.concatenate([np.frombuffer(r[i], np.int64) for r in rows]) for i in range(2))
            order = np.lexsort((v, k))
            k, v = k[order], v[order]
            first = np.flatnonzero(np.append(True, k[1:] != k[:-1]))
            lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(k)).astype(np.int32)), pa.array(v))
            bits = parities(v.view(np.uint64), np.append(first, len(k)))
            words = pa.ListArray.from_arrays(pa.array(np.arange(len(first) + 1, dtype=np.int32) * PARITY_WORDS), pa.array(bits.ravel()))
            yield pa.RecordBatch.from_arrays([pa.array(k[first]), lists, words], names=["k", "v", "bits"])

    dealt = segments(documents, fragments, size).repartition("frag").sortWithinPartitions("frag")
    packed = dealt.mapInArrow(count, PACKED_SCHEMA).repartition("bucket").sortWithinPartitions("bucket")
    return packed.mapInArrow(merge, REPEATED_SCHEMA)


def parities(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """For each set: whether an odd number of its values falls into each of 512 places, as eight longs.

    Two sets differ in at least as many values as their parities differ in places.
    """
    places = 64 * PARITY_WORDS
    place = (mix(values) >> U64(64 - places.bit_length() + 1)).astype(np.int64)
    out = np.empty((len(bounds) - 1, PARITY_WORDS), np.int64)
    for i in range(0, len(out), 1024):
        low, high = bounds[i], bounds[min(i + 1024, len(out))]
        sets = np.repeat(np.arange(min(1024, len(out) - i)), np.diff(bounds[i : i + 1025]))
        odd = np.bincount(sets * places + place[low:high], minlength=min(1024, len(out) - i) * places) & 1
        out[i : i + 1024] = np.packbits(odd.astype(bool), bitorder="little").view(np.int64).reshape(-1, PARITY_WORDS)
    return out


def _may_reach(percent: int) -> Column:
    """Whether sets ``a`` and ``b`` (sizes n, repeated r, parities) can be alike enough, by a bound that never misses.

    Shingles that only one set has differ for certain; of the others at least as many differ as parities do.
    """
    both = F.col("na") + F.col("nb")
    return (100 + percent) * (both - _differ()) >= 2 * percent * both


def _differ() -> Column:
    """How many shingles sets ``a`` and ``b`` differ in at least."""
    odd = " + ".join(f"bit_count(bits_a[{i}] ^ bits_b[{i}])" for i in range(PARITY_WORDS))
    return F.expr(f"(na - r_a) + (nb - r_b) + {odd}")


def _grouped(batches: Iterator[pa.RecordBatch], by: str, columns: tuple[str, ...]) -> Iterator[tuple[int, list]]:
    """Rows of each value of ``by``, which they are sorted by."""
    now, rows = None, []
    for batch in batches:
        for group, *row in zip(*[batch.column(c).to_pylist() for c in (by, *columns)]):
            if rows and group != now:
                yield now, rows
                rows = []
            now = group
            rows.append(row)
    if rows:
        yield now, rows


def verified(pairs: DataFrame, parts: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs`` (``a, b, na, nb``) that reach the threshold: partial overlaps per segment, summed per pair.

    ``parts`` has ``k, part, seg``. A pair's segments meet one by one, so no row holds more than two segments.
    """
    one = parts.select(F.col("k").alias("a"), "part", F.col("seg").alias("sa"))
    two = parts.select(F.col("k").alias("b"), "part", F.col("seg").alias("sb"))
    partial = pairs.join(one, "a").join(two, ["b", "part"])
    partial = partial.select("a", "b", "na", "nb", F.size(F.array_intersect("sa", "sb")).cast("bigint").alias("shared"))
    overlap = partial.groupBy("a", "b", "na", "nb").agg(F.sum("shared").alias("shared"))
    return overlap.filter(100 * F.col("shared") >= percent * (F.col("na") + F.col("nb") - F.col("shared"))).select("a", "b")


def class_links(
    documents: DataFrame, classes: DataFrame, *, percent: int = PERCENT, size: int = SHINGLE_WORDS
) -> DataFrame | None:
    """``node, root`` of all classes that have a partner, None if none has; ``classes`` has ``k`` and ``n``."""
    shared = repeated_shingles(documents, size).withColumn("r", F.size("v").cast("bigint"))
    needed = F.ceil(F.col("n") * percent / 100).cast("bigint")
    live = shared.join(classes.select("k", "n"), "k").withColumn("first", F.col("r") - needed + 1)
    live = stage(live.filter("first > 0"), "ngram-live")

    # Shingles of one set come before all others, so a place in the whole order is behind n - r of them.
    listed = live.select("k", "n", "r", F.posexplode(F.expr("slice(v, 1, cast(first AS int))")).alias("i", "v"))
    listed = listed.withColumn("at", F.col("n") - F.col("r") + F.col("i")).drop("r")
    lists = listed.groupBy("v").agg(F.min("k").alias("low"), F.max("k").alias("high")).filter("low <> high").select("v")
    entries = stage(listed.join(lists, "v"), "ngram-lists")

    segment = F.expr(f"transform(sequence(0, {SEGMENTS - 1}), p -> struct(p AS part, filter(v, x -> pmod(x, {SEGMENTS}) = p) AS seg))")
    parts = stage(live.select("k", F.explode(segment).alias("s")).select("k", "s.part", "s.seg").filter("size(seg) > 0"), "ngram-parts")
    fits = 100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")
    parity = stage(live.select("k", "r", "bits"), "ngram-parities")
    of = lambda x: parity.select(F.col("k").alias(x), F.col("r").alias(f"r_{x}"), F.col("bits").alias(f"bits_{x}"))

    # Each round every component tries one pair with another one of its lists: as many pairs as components.
    roots = None
    rooted = entries.withColumn("root", F.col("k"))
    for turn in range(ROUNDS):
        heads = rooted.groupBy("v", "root").agg(F.min(F.struct("k", "n")).alias("head"))
        drawn = F.xxhash64("root", F.lit(turn))
        leads = heads.groupBy("v").agg(F.min(F.struct(drawn.alias("draw"), "root", "head")).alias("lead"), F.min("root").alias("low"), F.max("root").alias("high"))
        leads = leads.filter("low <> high").select("v", "lead")
        tried = heads.join(leads, "v").filter("root <> lead.root").select(
            "root", F.col("lead.head.k").alias("a"), F.col("head.k").alias("b"), F.col("lead.head.n").alias("na"), F.col("head.n").alias("nb")
        )
        often = tried.filter(fits).groupBy("root", "a", "b", "na", "nb").agg(F.count("*").alias("c"))
        able = often.join(of("a"), "a").join(of("b"), "b").filter(_may_reach(percent))
        best = able.groupBy("root").agg(F.max(F.struct("c", "a", "b", "na", "nb")).alias("best"))
        best = best.select("best.a", "best.b", "best.na", "best.nb").distinct()
        found = stage(verified(best, parts, percent), "ngram-links")
        if found.isEmpty():
            continue
        roots = _joined(found, roots)
        rooted = entries.join(roots.withColumnRenamed("node", "k"), "k", "left").withColumn("root", F.coalesce("root", "k"))

    # What is left: pairs of one list in different components. Two sets that meet at some place share at most what both
    # have listed before it, it, and what both have behind it; and their parities say how many shingles they differ in
    # at least. A pair that also meets in one of the last places before is taken there, or further up.
    open_lists = rooted.groupBy("v").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high").select("v")
    signs = live.select("k", "r", "bits", F.expr("slice(v, 1, cast(first AS int))").alias("vs"))
    rest = rooted.join(open_lists, "v").join(signs, "k")
    before = F.slice("vs", F.greatest(F.col("i") - BEFORE + 1, F.lit(1)), F.least(F.col("i"), F.lit(BEFORE)))
    rest = stage(rest.select("v", "k", "n", "r", "at", "i", "root", "bits", before.alias("before")), "ngram-open")
    one, two = (
        rest.select(
            "v", F.col("k").alias(x), F.col("n").alias(f"n{x}"), F.col("at").alias(f"p{x}"), F.col("i").alias(f"i{x}"),
            F.col("root").alias(f"root_{x}"), F.col("r").alias(f"r_{x}"), F.col("bits").alias(f"bits_{x}"), F.col("before").alias(f"before_{x}"),
        )
        for x in "ab"
    )
    behind = F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb")) - 1
    reaches = (100 + percent) * (F.least("ia", "ib") + 1 + behind) >= percent * (F.col("na") + F.col("nb"))
    apart = (one["v"] == two["v"]) & (F.col("a") < F.col("b")) & (F.col("root_a") != F.col("root_b"))
    first = ~F.arrays_overlap("before_a", "before_b")
    met = one.join(two, apart & fits & reaches & _may_reach(percent) & first)
    met = met.groupBy("a", "b", "na", "nb").agg(F.min(_differ()).alias("differ"))
    return _boruvka(stage(met, "ngram-candidates"), roots, parts, percent)


def _joined(links: DataFrame, roots: DataFrame | None) -> DataFrame:
    """Components of ``links`` together with those known already."""
    if roots is not None:
        links = links.unionByName(roots.select(F.col("node").alias("a"), F.col("root").alias("b")))
    return connected(links, "ngram-components")


def _boruvka(candidates: DataFrame, roots: DataFrame | None, parts: DataFrame, percent: int) -> DataFrame | None:
    """``node, root`` after all links among ``candidates`` (``a, b, na, nb, differ``) that join two components.

    In a round every component tries its most promising candidates with others, one at first and four times as many in
    each further round. Tried ones go, and so do those whose ends have come together. Nothing is left out: the rounds
    end when no candidate is left.
    """
    width = 1
    left = candidates
    while not left.isEmpty():
        if roots is not None:
            end = lambda x: roots.select(F.col("node").alias(x), F.col("root").alias(f"of_{x}"))
            left = left.join(end("a"), "a", "left").join(end("b"), "b", "left")
            left = left.withColumns({f"root_{x}": F.coalesce(f"of_{x}", x) for x in "ab"}).drop("of_a", "of_b")
            left = left.filter("root_a <> root_b")
        else:
            left = left.withColumns({"root_a": F.col("a"), "root_b": F.col("b")})
        left = stage(left, "ngram-candidates")
        columns = ["a", "b", "na", "nb", "differ"]
        ends = left.select(*columns, F.explode(F.array("root_a", "root_b")).alias("root"))
        # a group limit keeps ``width`` rows per component and task in front of the shuffle
        rank = F.row_number().over(Window.partitionBy("root").orderBy(F.col("differ") / (F.col("na") + F.col("nb")), "a", "b"))
        tries = ends.withColumn("rank", rank).filter(F.col("rank") <= width).select("a", "b", "na", "nb").distinct()
        tries = stage(tries, "ngram-tries")
        found = stage(verified(tries, parts, percent), "ngram-links")
        left = left.select(*columns).join(tries.select("a", "b"), ["a", "b"], "left_anti")
        if not found.isEmpty():
            roots = _joined(found, roots)
        left = stage(left, "ngram-candidates")
        width *= 4
    return roots


def rooted_classes(documents: DataFrame, rows: DataFrame, *, percent: int, size: int) -> DataFrame:
    """``k, least, root``: classes of equal sets in ``rows`` (``doc_id, n, k``), their smallest id and their component."""
    classes = rows.filter("n > 0").groupBy("k").agg(F.first("n").alias("n"), F.min("doc_id").alias("least"))
    classes = stage(classes, "ngram-classes")
    roots = class_links(documents, classes, percent=percent, size=size)
    if roots is None:
        return classes.select("k", "least", F.col("k").alias("root"))
    rooted = classes.join(roots.withColumnRenamed("node", "k"), "k", "left")
    return rooted.select("k", "least", F.coalesce("root", "k").alias("root"))


def jaccard_components(documents: DataFrame, *, percent: int = PERCENT, size: int = SHINGLE_WORDS) -> DataFrame:
    """Per row of ``documents`` (``doc_id, text``): ``doc_id, n_shingles, component_id``.

    Two documents are linked if their sets' intersection is at least ``percent`` of the union; ``component_id`` is the
    smallest id reachable by links. A text with fewer words than a shingle is one shingle of all of them; a null text
    or one without words has none and is linked with nothing. Rows of one id are documents of their own; null ids
    are never the smallest where there is another. Other columns are not read.
    """
    rows = documents.select("doc_id", described(F.col("text"), size).alias("d")).select("doc_id", "d.n", "d.k")
    rows = stage(rows, "ngram-rows")
    rooted = rooted_classes(documents, rows, percent=percent, size=size)
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    known = rooted.join(least, "root").select("k", "component_id")
    full = rows.filter("n > 0").join(known, "k").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    empty = rows.filter("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return full.unionByName(empty)


def keep_representatives(documents: DataFrame, *, percent: int = PERCENT, size: int = SHINGLE_WORDS) -> DataFrame:
    """One row of each component, one with its smallest id, and every row without words, with their own columns."""
    carried = documents.select(F.struct("*").alias("row"), "doc_id", described(F.col("text"), size).alias("d"))
    carried = carried.select("row", "doc_id", "d.n", "d.k")
    rows = stage(carried.select("doc_id", "n", "k"), "ngram-rows")
    rooted = rooted_classes(documents, rows, percent=percent, size=size)
    # nulls order first, so a class with a true id goes before one without
    chosen = rooted.groupBy("root").agg(F.min(F.struct(F.col("least").isNull(), "least", "k")).alias("first"))
    chosen = chosen.select(F.col("first.least").alias("doc_id"), F.col("first.k").alias("k"))
    same = carried["doc_id"].eqNullSafe(chosen["doc_id"]) & (carried["k"] == chosen["k"])
    kept = carried.filter("n > 0").join(chosen, same, "left_semi")
    kept = keep_first(kept, ["doc_id", "k"], ["k"])  # of repeated rows one
    return kept.select("row.*").unionByName(carried.filter("n = 0").select("row.*"))

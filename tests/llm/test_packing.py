"""Packing: every id in its place, sequences within their size, and no more of them than a plain best fit needs."""

import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from advertlake.llm import packing
from advertlake.llm.encode import default_tokenizer_path
from advertlake.llm.queries import prepared
from advertlake.session import stage

DOCS = "doc_id bigint, text string, row string, piece int, length int, seq string, size int"


@pytest.fixture(scope="module")
def llm(spark):
    return prepared(spark)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "r", 3, 4, "s", 5) for i, t in rows], DOCS).repartition(3)


def best_fit(lengths, size):
    """Sequences that best fit, longest first, opens."""
    gaps, opened = [0] * (size + 1), 0
    for n in sorted(lengths, reverse=True):
        at = next((g for g in range(n, size + 1) if gaps[g]), None)
        if at is None:
            opened, at = opened + 1, size
        else:
            gaps[at] -= 1
        gaps[at - n] += 1
    return opened


def check(rows, size):
    """Gapless offsets within the size."""
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        place = 0
        for offset, length in sorted(parts):
            assert offset == place
            place += length
        assert place <= size
    return len(by)


def test_documents_are_cut_and_packed(llm):
    rnd = random.Random(2)
    words = ["alpha", "beta", "é", "日本", "token", "\n", "x1"]
    texts = [" ".join(rnd.choice(words) for _ in range(rnd.choice([1, 5, 20, 90]))) for _ in range(60)]
    rows = [*enumerate(texts), (100, None), (101, ""), (None, "no id"), (3, "the same id"), (3, "the same id"), (200, "long text " * 4000)]
    size = 64
    packed = packing.pack_documents(frame(llm, rows), size=size, keep_ids=True)
    got = packed.collect()
    encode = Tokenizer.from_file(default_tokenizer_path())
    want, tails = [], []
    for i, t in rows:
        ids = [*encode.encode(t or "", add_special_tokens=False).ids, 2]
        cuts = [*range(len(ids) % size or size, len(ids), size), len(ids)]
        start = 0
        for k, end in enumerate(cuts):
            raw = np.array(ids[start:end], "<u4").tobytes()
            want.append((i, k, start, end - start, zlib.crc32(raw), raw))
            tails += [end - start]
            start = end
    have = [(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"], bytes(r["ids"])) for r in got]
    assert sorted(have, key=repr) == sorted(want, key=repr)
    used = check(got, size)
    assert used <= best_fit(tails, size) + 2
    whole = packing.packed_sequences(packed).collect()
    assert len(whole) == used
    parts = {(r["sequence_id"], r["offset"]): bytes(r["ids"]) for r in got}
    for r in whole:
        assert bytes(r["ids"]) == b"".join(parts[r["sequence_id"], o] for o in r["starts"])


@pytest.mark.parametrize("kind", ["mixed", "equal", "tiny", "halves"])
def test_close_to_best_fit(llm, kind):
    rng = np.random.default_rng(4)
    lengths = {
        "mixed": rng.integers(1, 1024, 1500),
        "equal": np.full(400, 342),
        "tiny": rng.integers(1, 12, 4000),
        "halves": np.concatenate([np.full(300, 512), np.full(100, 513), rng.integers(200, 520, 500)]),
    }[kind]
    rows = [(k, int(x)) for k, x in enumerate(lengths)]
    pieces = stage(llm.createDataFrame(rows, "row bigint, length bigint").repartition(5), "pieces")
    got = packing.pack_pieces(pieces).collect()
    assert sorted(r["row"] for r in got) == list(range(len(rows)))
    assert check(got, 1024) <= 1.02 * best_fit(lengths.tolist(), 1024) + 1


def test_no_document(llm):
    assert packing.pack_documents(frame(llm, [])).collect() == []


def test_ranges_match_like_one_range():
    # brackets over three ranges: gaps take the nearest pieces before them
    assert packing.matched_ranges([(0, 1, 2), (1, 1, 0), (2, 3, 1)]) == [(1, 0, 0, 1, 1), (2, 0, 0, 0, 1)]


def test_rounds_of_few_pieces_are_swept_by_few_tasks(llm, monkeypatch):
    asked = []
    dealt = type(llm.range(0)).repartitionByRange
    monkeypatch.setattr(type(llm.range(0)), "repartitionByRange", lambda df, n, *keys: asked.append(n) or dealt(df, n, *keys))
    rng = random.Random(11)
    rows = [(k, rng.randint(1, 63)) for k in range(400)]
    pieces = stage(llm.createDataFrame(rows, "row bigint, length bigint"), "pieces")
    packed = packing.pack_pieces(pieces, size=64).collect()
    assert sorted((r.row, r.length) for r in packed) == rows
    assert asked and set(asked) == {1}
    # as many tasks as there are partitions, where the rows are enough for them
    asked.clear()
    monkeypatch.setattr(packing, "LEAST_RANGE_ROWS", 10)
    again = packing.pack_pieces(pieces, size=64).collect()
    assert max(asked) == int(llm.conf.get("spark.sql.shuffle.partitions")) > 1
    assert len({r.sequence_id for r in again}) == len({r.sequence_id for r in packed})

import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from advertlake.llm import attention, decontaminate, encode, kernels, ngram_join, quality, run_index, tokenfiles

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = st.lists(st.text(alphabet="ab cé'\n\t#A1日.sSt", max_size=60), min_size=1, max_size=8)


@settings(max_examples=60, deadline=None)
@given(TEXTS, st.integers(1, 40))
def test_words_and_shingles(texts, block_bytes):
    words, sets = [], []
    for block in kernels.text_blocks(pa.array(texts), block_bytes):
        w = kernels.words_of(block)
        for row in range(block.rows):
            mine = w.row == row
            words.append([bytes(block.data[a:b]).decode() for a, b in zip(w.starts[mine], w.ends[mine])])
        h, r = ngram_join.shingle_sets(block)
        sets += [set(h[r == row].tolist()) for row in range(block.rows)]
    assert words == [WORD.findall(t) for t in texts]

    def shingles(t):
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t))
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())

    plain = [shingles(t) for t in texts]
    for a, x in zip(plain, sets):
        for b, y in zip(plain, sets):
            assert len(a & b) == len(x & y) and len(a) == len(x)


@settings(max_examples=60, deadline=None)
@given(TEXTS)
def test_base_counts_beside_a_plain_version(texts):
    got = []
    for block in kernels.text_blocks(pa.array(texts)):
        found = quality.base_counts(block, kernels.words_of(block))
        got += list(zip(*[found[n].tolist() for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]))
    want = []
    for t in texts:
        w, seen, dup = WORD.findall(t), set(), 0
        for line in t.split("\n"):
            if WORD.search(line):
                dup += line in seen
                seen.add(line)
        windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
        covered = {i + j for i, x in enumerate(windows) if windows.count(x) > 1 for j in range(5)}
        want.append((len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), dup, len(covered)))
    assert got == want


def test_null_and_empty_texts_are_rows():
    blocks = list(kernels.text_blocks(pa.array([None, "", "a b"], pa.string())))
    assert sum(b.rows for b in blocks) == 3 and kernels.words_of(blocks[0]).per_row.tolist() == [0, 0, 2]
    assert list(kernels.text_blocks(pa.array([], pa.string()))) == []


@pytest.fixture(scope="module")
def library():
    path = encode.default_tokenizer_path()
    return Tokenizer.from_file(path), encode.Encoder(path)


@settings(max_examples=150, deadline=None)
@given(texts=st.lists(st.text(alphabet=" \n\t'sSdlrevtm1é!ß日\x1c\x85\xa0", max_size=40), max_size=6))
def test_encoder_gives_the_library_ids(library, texts):
    plain, fast = library
    ids, counts = fast.encode([*texts, "x <|endoftext|> y"])
    want = [plain.encode(t, add_special_tokens=False).ids for t in [*texts, "x <|endoftext|> y"]]
    assert counts.tolist() == [len(w) for w in want]
    assert ids.tolist() == [i for w in want for i in w]


def test_encoder_forgets_and_goes_on(library, monkeypatch):
    plain, _ = library
    monkeypatch.setattr(encode, "MOST_PIECES", 3)
    fast = encode.Encoder(encode.default_tokenizer_path())
    for t in ("one two three", "four five", "one six seven eight nine"):
        assert fast.encode([t])[0].tolist() == plain.encode(t, add_special_tokens=False).ids


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 40), min_size=1, max_size=1500))
def test_wavelet_matrix(ids):
    ids = np.array(ids, np.uint32)
    w = tokenfiles.WaveletMatrix.of_row(tokenfiles.WaveletMatrix.build(ids, 6).row())
    assert w.decode().tolist() == ids.tolist()
    for i in (0, len(ids) // 2, len(ids) - 1):
        assert w.access(i) == ids[i]
        assert w.count(int(ids[i]), i) == int((ids[:i] == ids[i]).sum())
    token = int(ids[len(ids) // 2])
    places = np.flatnonzero(ids == token).tolist()
    assert [w.find(token, k) for k in range(len(places))] == places
    assert w.count(41) == 0 and w.count(1 << 9) == 0
    with pytest.raises(IndexError):
        w.find(token, len(places))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=80))
def test_suffix_order(values):
    s = np.array([*values, -1], np.int64)
    assert run_index.suffix_order(s).tolist() == sorted(range(len(s)), key=lambda i: s[i:].tolist())


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab", min_size=1, max_size=40), min_size=1, max_size=6), st.integers(2, 6))
def test_run_index_marks_what_repeats(pieces, least):
    raw = [p.encode() for p in pieces]
    index = run_index.RunIndex(raw)
    assert int(index.lengths.sum()) == sum(len(p) + 1 for p in raw)
    marked = [np.zeros(len(p), bool) for p in raw]
    for i, s, e in index.covered(least):
        marked[i][s:e] = True
    strings = [p[i : i + least] for p in raw for i in range(len(p) - least + 1)]
    for p, m in zip(raw, marked):
        want = np.zeros(len(p), bool)
        for i in range(len(p) - least + 1):
            if strings.count(p[i : i + least]) > 1:
                want[i : i + least] = True
        assert m.tolist() == want.tolist()


def test_masks_hit_every_overlap_the_threshold_allows():
    from itertools import combinations

    for words in range(decontaminate.LEAST_WORDS, decontaminate.WINDOW + 1):
        for changed in combinations(range(words), words - decontaminate.least_equal(words)):
            assert any(
                all(at + j not in changed for j, taken in enumerate(mask) if taken == "1")
                for mask in decontaminate.MASKS
                for at in range(words - len(mask) + 1)
            ), (words, changed)


def test_attention_gradients():
    rng = np.random.default_rng(1)
    x, row = rng.normal(size=(7, attention.FEATURES)), np.array([0, 0, 1, 2, 2, 2, 2])
    model = attention.fit_attention(["a b"], [1])
    weights = [w + rng.normal(0, 0.1, w.shape) for w in model.weights]
    y = np.array([1.0, 0, 1])

    def loss(ws):
        p = attention.GatedAttention(*ws).forward(x, row)["p"]
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).sum()

    m = attention.GatedAttention(*weights)
    f = m.forward(x, row)
    for k, g in enumerate(m.backward(x, row, f, f["p"] - y)):
        at = tuple(d // 2 for d in weights[k].shape)
        up, down = [w.copy() for w in weights], [w.copy() for w in weights]
        up[k][at] += 1e-5
        down[k][at] -= 1e-5
        assert abs((loss(up) - loss(down)) / 2e-5 - g[at]) < 1e-5
    assert np.allclose(np.add.reduceat(f["a"], f["begin"]), 1)


def test_calibration_is_bounded_on_separable_logits():
    z = np.concatenate((np.full(50, -3.0), np.full(50, 3.0)))
    slope, shift = quality.calibration(z, (z > 0).astype(float))
    assert 0 < slope < 10 and abs(shift) < 5
    assert quality.calibration(z, np.ones(100)) == (1.0, 0.0)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.sets(st.integers(0, 2**40), max_size=60), min_size=1, max_size=6))
def test_parities_never_show_more_than_what_differs(sets):
    flat = np.array([x for s in sets for x in sorted(s)], np.uint64)
    bits = ngram_join.parities(flat, np.concatenate(([0], np.cumsum([len(s) for s in sets]))).astype(np.int64))
    for a, x in zip(sets, bits):
        for b, y in zip(sets, bits):
            shown = int(np.bitwise_count(x.view(np.uint64) ^ y.view(np.uint64)).sum())
            assert shown <= len(a ^ b) and shown % 2 == len(a ^ b) % 2


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab", min_size=1, max_size=60), min_size=1, max_size=6), st.integers(4, 12))
def test_only_stretches_met_again_are_indexed(pieces, span):
    raw = [p.encode() for p in pieces]
    marks = lambda found: {(i, at) for i, s, e in found for at in range(s, e)}
    whole = marks(run_index.RunIndex(raw).covered(span))
    for gram in {1, span // 2, span - 1}:
        parts = run_index.met_again(raw, span, gram)
        assert all(raw[i][s : s + len(part)] == part for i, s, part in parts)
        found = run_index.RunIndex([part for _, _, part in parts]).covered(span) if parts else []
        assert marks((parts[j][0], parts[j][1] + s, parts[j][1] + e) for j, s, e in found) == whole


def test_strings_that_meet_nothing_are_not_indexed():
    rng = np.random.default_rng(5)
    own = [rng.integers(97, 123, 900, dtype=np.uint8).tobytes() for _ in range(6)]
    line = b"a line of all " * 7
    # a common line brings pieces together; one string is there twice
    pieces = [x[:450] + line + x[450:] for x in own] + [own[0][:430] + own[1][20:]]
    parts = run_index.met_again(pieces, 400, 356)
    assert {i for i, _, _ in parts} == {0, 1, 6} and 2 * sum(len(p) for _, _, p in parts) < sum(map(len, pieces))


def test_window_digests_tell_windows():
    text = b"abcabcab" * 5000 + b"x" + b"abcabcab" * 5000
    prefix = kernels.prefix_hash(np.frombuffer(text, np.uint8))
    for width in (1, 7, 300):
        got = run_index.window_digests(prefix, width).tolist()
        assert len(got) == len(text) - width + 1 and len(dict(zip((text[i : i + width] for i in range(len(got))), got))) == len(set(got))
        assert all(got[i] == got[i + 40_001] for i in range(0, 40_000 - width))
    values = np.random.default_rng(3).integers(0, 9, 40_000).astype(np.uint64)
    for width in (1, 2, 3, 7, 353):
        want = np.lib.stride_tricks.sliding_window_view(values, width).min(1)
        assert (run_index.sliding_least(values, width) == want).all()
    assert not len(run_index.sliding_least(values[:2], 3))


def test_known_pieces_are_not_sorted_again(library, monkeypatch):
    plain, _ = library
    texts = ["one two three, four", "four  three\n two", "one's " * 30]
    fresh = encode.Encoder(encode.default_tokenizer_path())
    first = fresh.encode(texts)
    monkeypatch.setattr(encode.np, "unique", None)
    again = fresh.encode(texts)
    monkeypatch.undo()
    assert again[0].tolist() == first[0].tolist() == [i for t in texts for i in plain.encode(t, add_special_tokens=False).ids]
    # all pieces in two slots
    monkeypatch.setattr(encode, "SLOT_BITS", 1)
    crowded = encode.Encoder(encode.default_tokenizer_path())
    for _ in range(2):
        assert crowded.encode(texts)[0].tolist() == first[0].tolist()


def test_new_pieces_are_asked_for_at_once(library, monkeypatch):
    plain, _ = library
    words = [f"w{i * 7919 % 10007}é{i}" for i in range(3000)]
    texts = [" ".join(words[:2000]), "\n".join(words[1000:]), "", "ÿ 's\x00 \t\r\n ŒĀ"]
    want = [i for t in texts for i in plain.encode(t, add_special_tokens=False).ids]
    fast = encode.Encoder(encode.default_tokenizer_path())
    monkeypatch.setattr(fast, "_plain", None)  # would give an answer per piece
    for t in texts:
        ids, counts = fast.encode([t])
        assert ids.tolist() == plain.encode(t, add_special_tokens=False).ids and counts.tolist() == [len(ids)]
    assert fast.encode(texts)[0].tolist() == want
    # only pieces that share a slot are kept in order, which costs with every block
    assert 0 < fast.pieces and len(fast.known) < fast.pieces / 10


def test_pieces_are_asked_for_one_by_one_where_ids_do_not_stand_for_bytes(library):
    plain, _ = library
    fast = encode.Encoder(encode.default_tokenizer_path())
    fast.bytes_of = fast.bytes_of + 1
    text = "strange pieces of a text, 1234 é\n"
    for _ in range(2):
        assert fast.encode([text])[0].tolist() == plain.encode(text, add_special_tokens=False).ids

"""Texts whose hashes would collide under a polynomial modulo a power of two, and samples of labels."""

import random
import warnings

import pytest
from tokenizers import Tokenizer

from advertlake.llm import lengths, ngram_join, quality, run_index, samples, tokenfiles
from advertlake.llm.encode import default_tokenizer_path, encoder
from advertlake.llm.kernels import text_blocks, words_of
from advertlake.llm.queries import prepared


@pytest.fixture(scope="module")
def llm(spark):
    return prepared(spark)


def twins(letters="ab"):
    """Two different texts of 2,048 letters: every other one random and shared, the others by parity and its opposite."""
    rnd = random.Random(7)
    shared = [rnd.choice("cdefgh") for _ in range(1024)]
    odd = [i.bit_count() & 1 for i in range(1024)]
    return tuple("".join(s + letters[o ^ flip] for s, o in zip(shared, odd)) for flip in (0, 1))


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(2)


def test_no_byte_goes_where_nothing_repeats(llm):
    rows = run_index.remove_repeats(frame(llm, twins())).collect()
    assert [r["n_removed"] for r in rows] == [0, 0]
    rows = run_index.remove_repeats(frame(llm, [*twins(), twins()[0]])).orderBy("doc_id").collect()
    assert [r["n_removed"] for r in rows] == [2048, 0, 2048]


def test_different_texts_are_different_sets(llm):
    rows = ngram_join.jaccard_components(frame(llm, twins())).collect()
    assert sorted(r["component_id"] for r in rows) == [0, 1]


def test_ids_are_those_of_the_library(llm, folder):
    encode = Tokenizer.from_file(default_tokenizer_path())
    texts = list(twins())
    ids, counts = encoder(default_tokenizer_path()).encode(texts)
    want = [encode.encode(t, add_special_tokens=False).ids for t in texts]
    assert want[0] != want[1] and ids.tolist() == want[0] + want[1] and counts.tolist() == [len(w) for w in want]
    tokenfiles.write_token_files(frame(llm, texts), f"{folder}/tokens")
    digests = tokenfiles.read_digests(llm, f"{folder}/tokens").collect()
    assert len({r["ids_crc32"] for r in digests}) == 2
    histogram = {r["n_tokens"]: r["n_docs"] for r in lengths.length_histogram(frame(llm, texts)).collect()}
    assert sum(k * n for k, n in histogram.items()) == sum(map(len, want))


def test_different_lines_are_not_repeated():
    import pyarrow as pa

    block = next(text_blocks(pa.array(["\n".join(twins())])))
    assert quality.base_counts(block, words_of(block))["n_dup_lines"].tolist() == [0]


def test_labels_of_other_documents_take_no_place(llm):
    docs = llm.createDataFrame([(i, "text " * (500 if i % 10 == 0 else 3)) for i in range(200)], "doc_id bigint, text string")
    labels = llm.range(20_000).selectExpr("id AS doc_id", "cast(id % 2 AS int) AS quality")
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        texts, values = samples.labelled_sample(docs, labels, "quality", rows=100, max_chars=100)
    assert len(texts) == len(values) == 100 and 0 < sum(values) < 100
    with pytest.warns(UserWarning, match="label 1"):
        samples.labelled_sample(docs, labels.filter("quality = 0"), "quality", rows=100, max_chars=100)

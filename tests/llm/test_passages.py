"""Passages of more than fifty words that stand in several texts, whatever their bytes."""

import random

import pytest

from advertlake.llm import run_index
from advertlake.llm.queries import prepared


@pytest.fixture(scope="module")
def llm(spark):
    return prepared(spark)


def test_rows_that_share_a_passage_are_told(llm):
    rnd = random.Random(17)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(1, 7)))
    prose = lambda n: [word() for _ in range(n)]
    shared, short = prose(51), prose(50)
    texts = []
    for i in range(60):
        own = prose(rnd.randint(0, 200))
        if i % 5 == 0:
            own[len(own) // 2 : len(own) // 2] = shared[: 51 if i % 10 else 50]
        if i % 7 == 0:
            own += short
        texts.append(rnd.choice([" ", "\n"]).join(own))
    tiny = " ".join(prose(60))
    texts += [None, "", "word " * 300, "word " * 300, " ".join(prose(20)), tiny, tiny, " ".join(shared) + " " + " ".join(shared), "x " * 20_000]
    seen = {}
    cut = [(t or "").split() for t in texts]
    for i, words in enumerate(cut):
        for a in range(len(words) - 50):
            seen.setdefault(tuple(words[a : a + 51]), set()).add(i)
    want = {i for rows in seen.values() if len(rows) > 1 for i in rows}
    docs = llm.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4)
    got = run_index.remove_repeats(docs).collect()
    assert {r["doc_id"] for r in got if r["repeats"]} == want and len(got) == len(texts)

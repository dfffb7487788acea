"""The prefix trie beside a plain version, over layers and shards of several sizes."""

import hashlib
import random
import re
import zlib

import pytest

from advertlake.llm import trie
from advertlake.llm.queries import prepared

CONVERSATIONS = "conv_id bigint, turn bigint, role string, text string, node string, depth int, words string, shard int"


@pytest.fixture(scope="module")
def llm(spark):
    return prepared(spark)


def frame(spark, rows):
    """Conversations with columns whose names the operator uses itself."""
    return spark.createDataFrame([(*r, "x", 1, "y", 2) for r in rows], CONVERSATIONS).repartition(3)


def plain_trie(rows):
    turns = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            turns.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    # equal turns go by the digest of role and text
    code = lambda r, t: hashlib.md5(f"{len(r)}:{r}{t}".encode()).hexdigest()
    own = {c: [(r, t) for _, _, r, t in sorted(x, key=lambda y: (*y[:2], code(*y[2:])))] for c, x in turns.items()}
    paths = {}
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        paths[c] = tuple(own.get(c - c % 20, [])[:h] + mine[h:])
    nodes = {}
    for c, p in paths.items():
        for d in range(len(p) + 1):
            nodes.setdefault(p[:d], []).append(c)
    children = {}
    for p in nodes:
        if p:
            children.setdefault(p[:-1], []).append(p)
    out = {}
    for p in sorted(nodes, key=len, reverse=True):
        members = nodes[p]
        below = children.get(p, [])
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        leaves = sum(out[q][5] for q in below) or 1
        saved = sum(out[q][6] for q in below) + (len(members) - 1) * words
        ends = ",".join(str(c) for c in sorted(c for c in members if paths[c] == p))
        above = min(nodes[p[:-1]]) if p else None
        out[p] = (min(members), len(p), above, len(members), len(below), leaves, saved, hashlib.sha256(ends.encode()).hexdigest())
    return sorted(out.values(), key=repr)


def listed(df):
    return sorted(map(tuple, df.select(*trie.COLUMNS).collect()), key=repr)


def conversations(seed, n, longest, letters):
    rnd = random.Random(seed)
    rows = []
    for c in rnd.sample(range(4 * n), n):
        for t in range(rnd.randint(1, longest)):
            rows.append((c, t, rnd.choice(["user", None]), rnd.choice(letters)))
    return rows


@pytest.mark.parametrize("layer, shards", [(256, 4), (3, 7), (1, 5), (2, 1)])
def test_trie_beside_a_plain_version(llm, layer, shards):
    rows = conversations(layer, 60, 9, ["a b", "c", "", None])
    rows += [(7_000 + c, t, "user", "same words here") for c in range(40) for t in range(7)]  # many copies of one path
    rows += [(9_020, None, "user", "null first"), (9_020, 0, "user", "x"), (9_020, 0, "user", "x"), (9_020, 0, "user", "w y")]
    rows += [(9_021, 5, "user", "only one turn"), (None, 1, "user", "of no conversation"), (-3, 0, "user", "a b")]
    got = trie.prefix_trie(frame(llm, rows), layer_turns=layer, shards=shards)
    assert listed(got) == plain_trie(rows)


def test_a_conversation_with_most_turns_is_spread(llm):
    rows = [(1, t, "user", f"turn {t}") for t in range(700)] + [(2, t, "user", f"turn {t}") for t in range(650)]
    rows += conversations(5, 20, 4, ["a", "b"])
    rows += [(300, 0, "user", "long " * 50_000)]
    got = trie.prefix_trie(frame(llm, rows), layer_turns=64, shards=6)
    assert listed(got) == plain_trie(rows)


def test_no_conversation_gives_no_node(llm):
    assert trie.prefix_trie(frame(llm, [])).collect() == []
    assert trie.prefix_trie(frame(llm, [(None, 1, "user", "x")])).collect() == []


def test_a_turnless_conversation_ends_at_the_root(llm):
    lone = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4)
    rows = [(lone, 0, "user", "replaced by nothing")]
    got = trie.prefix_trie(frame(llm, rows))
    assert listed(got) == plain_trie(rows) == [(lone, 0, None, 1, 0, 1, 0, hashlib.sha256(str(lone).encode()).hexdigest())]


def test_skeleton_holds_every_prefix_of_a_splitter():
    key = trie._key(0, trie.ROOT, b"a" * 16 + b"b" * 16)
    assert trie.skeleton_of([(key, 4)]) == {key[:20], key[:36], key}

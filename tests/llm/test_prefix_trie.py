"""The conversation trie against a plain trie, and on odd rows."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from meterlake.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def plain_conversations(rows):
    found = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            found[conv].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: tuple(x[2:] for x in sorted(v)) for c, v in found.items()}


def grafted(own):
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = own.get(c - c % 20, ())[:h] + turns[h:]
    return out


def plain_trie(convs):
    """Every row that the contract names, by listing each node's members."""
    members, children = defaultdict(list), defaultdict(int)
    for c, s in convs.items():
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
    for p in members:
        if p:
            children[p[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, m in members.items():
        words = len(p[-1][1].encode().split()) if p else 0
        for e in range(len(p) + 1):
            saved[p[:e]] += (len(m) - 1) * words
            leaves[p[:e]] += not children[p]
    out = []
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in m if convs[c] == p))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def made_up(seed, convs=90, longest=7):
    rng = random.Random(seed)
    out = []
    for c in rng.sample(range(300), convs):
        turns = [(c, t, "user" if t % 2 == 0 else "assistant", rng.choice(["yes", "no thanks", "a b c", ""]))
                 for t in range(rng.randrange(1, longest))]
        out += turns if rng.random() < 0.8 else [(c, 2 * t + 5, r, x) for c, t, r, x in turns]
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_trie_equals_a_plain_one(spark, seed):
    rows = made_up(seed)
    got = rows_of(prefix_trie.conversation_trie(spark.createDataFrame(rows, SCHEMA)))
    assert got == plain_trie(grafted(plain_conversations(rows)))


def test_given_conversations(spark, sf):
    df = spark.read.parquet(f"{sf}/conversations.parquet")
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    assert rows_of(prefix_trie.conversation_trie(df)) == plain_trie(grafted(plain_conversations(rows)))


def test_odd_rows(spark):
    long = "word " * 50_000
    rows = [(1, None, "user", "first"), (1, 0, "user", "then"), (1, 0, None, None), (None, 0, "user", "nobody's"),
            (20, 0, "user", "hello"), (20, 1, None, "x"), (21, 0, "user", "hello"), (22, 3, "user", long),
            (23, 0, "user", "same"), (23, 0, "user", "same"), (23, 0, "user", "same"), (40, None, None, None),
            (41, -7, "user", "before"), (41, 5, "user", "Été 漢字")]
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("p1", "n_convs", "depth", "words", "place", "seq", "h", "block"):
        df = df.withColumn(name, F.lit("clash"))
    assert rows_of(prefix_trie.conversation_trie(df)) == plain_trie(grafted(plain_conversations(rows)))


def test_empty_table_and_turnless_conversations(spark):
    assert prefix_trie.conversation_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    # conversation 21 lends nothing (20 is absent) and loses its first turns
    rows = [(c, 0, "user", "only turn") for c in range(21, 39)]
    got = rows_of(prefix_trie.conversation_trie(spark.createDataFrame(rows, SCHEMA)))
    assert got == plain_trie(grafted(plain_conversations(rows)))


def test_long_and_hot_conversations_are_cut(spark, monkeypatch):
    """Running totals over several chunks, end lists over several blocks."""
    monkeypatch.setattr(prefix_trie, "CHUNK_BITS", 2)
    monkeypatch.setattr(prefix_trie, "BLOCK_BITS", 3)
    rows = [(c, t, "user", f"turn {t % 3}") for c in range(60) for t in range(30)] + [(c, t, "user", f"turn {t % 3}") for c in range(60, 70) for t in range(11)]
    own = plain_conversations(rows)
    trie = prefix_trie.prefix_trie(spark.createDataFrame(rows, SCHEMA))
    digests = {(r.p1, r.p2): r.digest for r in prefix_trie.ends_digest(trie.ends).collect()}
    empty = hashlib.sha256().hexdigest()
    got = sorted(((r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens,
                   digests.get((r.p1, r.p2), empty)) for r in trie.nodes.collect()), key=str)
    assert got == plain_trie(own)


def test_nodes_have_their_texts(spark):
    rows = made_up(3, 40)
    df = spark.createDataFrame(rows, SCHEMA)
    coded = prefix_trie.code(df)
    turns, convs = prefix_trie.graft(coded)
    nodes = prefix_trie.with_texts(prefix_trie.build(turns, convs).nodes, df, coded)
    of = grafted(plain_conversations(rows))
    found = nodes.collect()
    assert len(found) == len(plain_trie(of))
    for r in found:
        if r.depth:
            assert (r.role, r.text) == of[r.conv_id][r.depth - 1]
        else:
            assert r.role is None and r.text is None

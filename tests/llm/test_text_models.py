import math
import random
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from meterlake.llm import queries, suffix_tree, toxicity


def plain_features(text):
    """Distinct buckets of a text, one n-gram at a time."""
    chars, found = [ord(c) for c in (text or "").lower()], set()
    for n in toxicity.ORDERS:
        for i in range(len(chars) - n + 1):
            gram = chars[i]
            for c in chars[i + 1:i + n]:
                gram = (gram * 0x100000001B3 + c) % (1 << 64)
            found.add((gram * 0x9E3779B97F4A7C15) % (1 << 64) >> (64 - toxicity.BITS))
    return found


def test_features_match_plain_python():
    texts = ["Hello wörld", "", None, "ab", "abc", "🙂🙂🙂🙂 x", "the the the"]
    rows, buckets = toxicity.positions(texts)
    for k, text in enumerate(texts):
        assert set(buckets[rows == k].tolist()) == plain_features(text)


def test_blocks_do_not_change_features(monkeypatch):
    rng = random.Random(1)
    texts = ["".join(rng.choice("abcde ") for _ in range(n)) for n in (500, 3, 40, 700, 0, 90)]
    whole = [x.tolist() for x in toxicity.positions(texts)]
    monkeypatch.setattr(toxicity, "BLOCK", 64)
    assert [x.tolist() for x in toxicity.positions(texts)] == whole


def toxic_corpus(spark):
    rng = random.Random(2)
    plain = ["river", "stone", "garden", "morning", "window", "paper", "yellow", "quiet"]
    rows, labels = [], []
    for i in range(400):
        words = [rng.choice(plain) for _ in range(30)]
        bad = i % 5 == 0
        if bad:
            words[rng.randrange(30)] = rng.choice(["idiotic", "idiots", "worthless"])
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(bad)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_toxic_texts_are_found(spark):
    docs, labels = toxic_corpus(spark)
    model = toxicity.train(docs, labels)
    rows = toxicity.score(docs, model).join(labels, "doc_id").withColumn("held", ~toxicity.in_training(F.col("doc_id"))).collect()
    held = [r for r in rows if r.held]
    assert {r.doc_id for r in held} == {i for i in range(400) if zlib.crc32(str(i).encode()) % 4 == 2}
    assert all(toxicity.held_out_id(r.doc_id) for r in held)
    assert len(held) > 50 and all(r.predicted == r.toxic for r in held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)


def test_score_of_odd_rows(spark, odd, odd_rows, empty):
    docs, labels = toxic_corpus(spark)
    model = toxicity.train(docs, labels)
    rows = toxicity.score(odd, model).collect()
    assert len(rows) == len(odd_rows)
    assert len({r.score for r in rows if not r.text}) == 1  # null and empty: the bias
    same = [r.score for r in rows if r.doc_id in (1, 6)]
    assert len(same) == 3 and len(set(same)) == 1
    assert toxicity.score(empty, model).count() == 0


def test_without_labels_the_score_is_the_share(spark, empty):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = toxicity.train(empty, labels)
    docs = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    assert toxicity.score(docs, model).first().score < 1e-6


def test_given_toxicity_query(spark, sf):
    rows = queries.QUERIES["op2_toxicity"](spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()


def words_of(text):
    return (text or "").encode().lower().split() + [None]


def test_base_scores_match_plain_python(spark, documents, sf):
    counts = Counter()
    for i, text in documents:
        if zlib.crc32(str(i).encode()) % 7 != 2:
            counts.update(words_of(text))
    n, v = sum(counts.values()), len(counts)
    got = {r.doc_id: r for r in queries.QUERIES["op4_lm_scoring"](spark, sf).collect()}
    assert len(got) == len(documents)
    for i, text in documents:
        words, r = words_of(text), got[i]
        assert r.held_out == (zlib.crc32(str(i).encode()) % 7 == 2) and r.train_tokens == n
        assert (r.n_tokens, r.n_known) == (len(words), sum(counts[w] > 0 for w in words))
        want = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words)
        assert math.isclose(r.base_score, want, rel_tol=1e-9)
    held = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def corpus_with_contexts(spark):
    rng = random.Random(3)
    rows = []
    for i in range(300):
        words = []
        while len(words) < 60:  # "b" follows "x a", "c" follows "y a"
            words += rng.choice([["x", "a", "b"], ["y", "a", "c"], ["z"], ["w"]])
        rows.append((i, " ".join(words)))
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_contexts_of_two_words_are_kept_where_they_tell_more(spark):
    docs = corpus_with_contexts(spark)
    model = suffix_tree.train(docs)
    tree, coder = model.tree, suffix_tree.Coder(model.tree.frequent)
    ids = dict(zip("xyzwabc", coder.codes([[c.encode() for c in "xyzwabc"]])[0].tolist()))

    def state_of(*words):
        symbols = np.array([ids[w] for w in words])
        state = [s for s in (x[-1] for x in tree.contexts(symbols, np.array([0]))) if s >= 0]
        kept = [int(s) for s in state if tree.keep[s]]
        return kept[-1] if kept else 0

    def chance(state, word):
        return 10 ** tree.log10(np.array([state]), np.array([ids[word]]), tree.base())[0]

    assert state_of("x", "a") != state_of("a") != 0
    assert chance(state_of("x", "a"), "b") > 0.95 and chance(state_of("y", "a"), "c") > 0.95
    assert 0.3 < chance(state_of("a"), "b") < 0.7
    assert state_of("w", "z") == state_of("z")  # no more to tell
    for state in np.flatnonzero(tree.keep):
        every = np.arange(len(tree.frequent))
        total = (10 ** tree.log10(np.full(len(every), state), every, tree.base())).sum()
        assert 0.99 < total <= 1.0 + 1e-9


def test_longest_state_scoring_matches_a_plain_walk(spark):
    docs = corpus_with_contexts(spark)
    model = suffix_tree.train(docs)
    tree, coder = model.tree, suffix_tree.Coder(model.tree.frequent)
    got = {r.doc_id: r.score for r in suffix_tree.score(docs, model).collect()}
    base, entries = tree.base(), dict(zip(*[x.tolist() for x in tree.entries]))
    for r in docs.limit(20).collect():
        symbols = coder.codes([suffix_tree.tokens(r.text)])[0].tolist() + [tree.end]
        total = 0.0
        for i, s in enumerate(symbols):
            past = np.array(symbols[max(0, i - suffix_tree.DEPTH):i])
            state = 0
            for found in tree.contexts(past, np.array([0])) if len(past) else []:
                if found[-1] >= 0 and tree.keep[found[-1]]:
                    state = int(found[-1])
            while state and state * len(tree.frequent) + s not in entries:
                total += tree.alpha[state]
                state = int(tree.up[state])
            total += entries[state * len(tree.frequent) + s] if state else base[s]
        assert math.isclose(got[r.doc_id], total, rel_tol=1e-9)


def test_scoring_odd_rows(spark, odd, odd_rows, empty):
    rows = suffix_tree.score(odd, suffix_tree.train(odd)).collect()
    assert sorted(r.n_tokens for r in rows) == sorted(len(words_of(t)) for _, t, *_ in odd_rows)
    assert all(r.score < 0 for r in rows)
    assert suffix_tree.score(empty, suffix_tree.train(empty)).count() == 0
    alone = suffix_tree.score(odd, suffix_tree.train(empty)).collect()
    assert len(alone) == len(odd_rows) and all(r.n_known == 0 and r.train_tokens == 0 for r in alone)


def test_a_phrase_is_learned_whatever_its_share(spark):
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choice("abcdefghij") for _ in range(1000))) for i in range(150)]
    rows += [(1000 + i, "one rare phrase") for i in range(9)]  # less than 1e-4 of the tokens
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = suffix_tree.train(docs)
    learned = sum(zlib.crc32(str(1000 + i).encode()) % 7 != 2 for i in range(9))
    assert suffix_tree.MIN_CONTEXT <= learned < 1e-4 * model.train_tokens
    got = suffix_tree.score(spark.createDataFrame([(1, "rare phrase")], "doc_id long, text string"), model).first()
    want = math.log10((learned + 1) / 10 ** model.total) + 2 * math.log10((learned - 0.5) / learned)
    assert math.isclose(got.score, want, rel_tol=1e-9) and got.score > got.base_score + 3

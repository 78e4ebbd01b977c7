import random
import re
from collections import Counter
from dataclasses import replace

import duckdb
import pytest

from pyspark.sql import functions as F

from meterlake.llm import queries
from meterlake.llm.quality_rules import FENCES, Rules, _repeat_words, quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    covered = {i + k for i in range(len(words) - 4) if windows[tuple(words[i:i + 5])] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered))


def counts(row):
    return (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words)


def test_base_counts_match_plain_python(spark, documents, sf):
    got = {r.doc_id: r for r in queries.QUERIES["op10_quality_rules"](spark, sf).collect()}
    assert len(got) == len(documents)
    for doc_id, text in documents:
        assert counts(got[doc_id]) == plain(text), doc_id
        r = got[doc_id]
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.kept and r.base_failed)


def test_matches_sql(spark, sf):
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{sf}/documents.parquet'")
    rel = con.sql(queries.ORACLE["op10_quality_rules"])
    names = sorted(rel.columns)
    want = sorted(con.sql(f"select {', '.join(names)} from ({queries.ORACLE['op10_quality_rules']})").fetchall(), key=str)
    got = sorted((tuple(r) for r in queries.QUERIES["op10_quality_rules"](spark, sf).select(*names).collect()), key=str)
    assert got == want


def test_repeated_windows_are_counted_without_a_comparator(spark):
    rng = random.Random(7)
    texts = [" ".join(rng.choice("abc") for _ in range(n)) for n in (4, 5, 6, 30, 700)]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    assert [r.n_repeat_words for r in quality(docs).orderBy("doc_id").collect()] == [plain(t)[-1] for t in texts]
    # array_sort calls a lambda for each comparison; sort_array compares the numbers
    assert "array_sort" not in str(_repeat_words(F.col("words")))


def test_odd_rows(odd, odd_rows):
    got = quality(odd).collect()
    assert len(got) == len(odd_rows)
    want = sorted(plain(r[1]) for r in odd_rows)
    assert sorted(map(counts, got)) == want
    assert all(not r.kept for r in got if not r.text)


def test_junk_diverges_and_clean_text_stays(spark):
    clean = "The quick brown fox jumps over the lazy dog and runs away from the big brown bear in the wood of the north. "
    rows = [(i, clean + f"Then number {i} walks home along the river to find {i * 7} new stones and some food for its young. " * 1, "en", "a", 0)
            for i in range(200)]
    junk = " ".join("".join(chr(35 + (i * k) % 23) for k in range(1, 9)) for i in range(1, 60))
    docs = spark.createDataFrame([*rows, (999, junk, "en", "a", 0)], "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r for r in quality(docs, Rules(min_reference_words=100, min_letters_words=10_000)).collect()}
    assert not got[999].kept and got[999].char_distance > 0.3
    assert all(got[i].kept for i in range(200))


def test_word_distance_alone_rejects_junk_and_keeps_clean_text(spark):
    rng = random.Random(4)
    common = ["".join(rng.choice("abcdefgh") for _ in range(3)) for _ in range(20)]
    rare = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(3000)]

    def text(share):
        return " ".join(rng.choice(common) if rng.random() < share else rng.choice(rare) for _ in range(150))
    rows = [(i, text(0.35), "en") for i in range(300)] + [(1000 + i, text(0.0), "en") for i in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    rules = replace(FENCES, min_chars=10**9)  # the characters say nothing
    got = {r.doc_id: r for r in quality(docs, rules).collect()}
    junk = [got[1000 + i] for i in range(8)]
    assert not any(r.kept or r.base_failed for r in junk)
    assert all(r.char_distance is None and r.word_distance < Rules().max_word_distance for r in junk)
    assert all(got[i].kept for i in range(300))


def test_empty_table(empty):
    assert quality(empty).count() == 0


@pytest.mark.parametrize("column", ["n_words", "char_distance", "kept"])
def test_columns(empty, column):
    assert column in quality(empty).columns

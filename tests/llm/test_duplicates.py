import math
import random
import re
import time
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from meterlake.llm import line_dedup, queries, simhash
from meterlake.llm import weighted_fingerprints as wf
from meterlake.llm.common import CLEANED, materialise
from meterlake.llm.graph import components
from meterlake.session import shared_dir

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def plain_simhash(text):
    words = WORD.findall((text or "").encode().lower())
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(items, linked):
    """Members of each connected component, by plain search."""
    left, out = set(range(len(items))), []
    while left:
        todo, seen = [left.pop()], []
        while todo:
            i = todo.pop()
            seen.append(i)
            near = {j for j in left if linked(items[i], items[j])}
            left -= near
            todo += near
        out.append(seen)
    return out


def test_fingerprints_match_plain_python():
    rng = random.Random(4)
    for n in (0, 1, 2, 3, 4, 5, 40, 500):
        text = " ".join(rng.choice(["The", "cat", "Été", "\x85x", "漢"]) + rng.choice(["", "\t"]) for _ in range(n))
        assert simhash.simhash(text) == plain_simhash(text)
    assert simhash.simhash(None) == 0 == simhash.simhash(" \n")


def test_every_value_has_its_anchors():
    syndrome, leads, home = simhash.covering(21, 2)
    rng = np.random.default_rng(0)
    low = (1 << simhash.CODE_BITS) - 1
    for value in rng.integers(0, 1 << 21, 200):
        s = syndrome[value & low]
        anchors = value ^ leads[s]
        assert (syndrome[anchors & low] == 0).all() and len(set(anchors.tolist())) == len(anchors)
        assert syndrome[(value ^ home[s]) & low] == 0 and bin(home[s]).count("1") <= simhash.RADIUS
        assert home[s] in leads[s]


@pytest.mark.parametrize("blocks", [2, 3])
def test_links_are_those_of_all_pairs(spark, blocks):
    rng = random.Random(6)
    fps = set()
    for _ in range(25):
        root = rng.getrandbits(64)
        for _ in range(12):
            value = root
            for _ in range(rng.randrange(7)):
                value ^= 1 << rng.randrange(64)
            fps.add(value)
    fps = sorted(fps)
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    frame = spark.createDataFrame([(x,) for x in signed], "fp long")
    got = [(r.a, r.b) for r in simhash.links(frame, 4, blocks).collect()]
    want = {(min(x, y), max(x, y)) for i, x in enumerate(signed) for j, y in enumerate(signed[:i])
            if bin(fps[i] ^ fps[j]).count("1") <= 4}
    assert len(got) == len(set(got)) and set(got) == want


def test_groups_of_the_given_documents(spark, documents, sf):
    got = {r.doc_id: r for r in queries.QUERIES["op5_simhash_near_dedup"](spark, sf).collect()}
    fps = [plain_simhash(t) for _, t in documents]
    assert all(got[i].fingerprint == f"{fp:016x}" for (i, _), fp in zip(documents, fps, strict=True))
    for members in groups(fps, lambda a, b: bin(a ^ b).count("1") <= 4):
        ids = [documents[k][0] for k in members]
        assert {got[i].component_id for i in ids} == {min(ids)}


def test_one_row_of_each_group_stays(spark, odd, empty):
    kept = simhash.keep_one(odd).collect()
    assert Counter(r.doc_id for r in kept)[1] == 1 and 6 not in {r.doc_id for r in kept}
    assert [r.doc_id for r in kept if not (r.text or "").strip()] == [2]  # null, empty, blank: one
    assert set(kept[0].asDict()) == set(odd.columns)
    assert simhash.keep_one(empty).count() == 0


def test_components_of_chains_and_stars(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(60)] + [(200, k) for k in range(201, 260)] + [(300, 300), (5, 4)] + [(900, 901)]
    rng.shuffle(edges)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{k: 200 for k in range(200, 260)}, 900: 900, 901: 900}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def changed(rng, text, edits):
    out = list(text)
    for _ in range(edits):
        k = rng.randrange(3)
        if k == 0 and out:
            out[rng.randrange(len(out))] = rng.choice("abcé🙂 ")
        elif k == 1 and out:
            del out[rng.randrange(len(out))]
        else:
            out.insert(rng.randrange(len(out) + 1), rng.choice("abcé"))
    return "".join(out) if isinstance(text, str) else out


@pytest.mark.parametrize("k", [0, 1, 2, 3])
def test_banded_distance(spark, k):
    rng = random.Random(k)
    pairs = []
    for _ in range(400):
        a = "".join(rng.choice("abcé🙂") for _ in range(rng.randrange(18)))
        pairs.append((a, changed(rng, a, rng.randrange(5))))
    for r in spark.createDataFrame(pairs, "a string, b string").withColumn("d", line_dedup.edit_distance(F.col("a"), F.col("b"), k)).collect():
        want = distance(r.a, r.b)
        assert (r.d == want) if want <= k else r.d > k


def plain_line_classes(docs, rules):
    """(doc_id, line_no) -> (class place, different lines), by all pairs of distinct lines."""
    places = defaultdict(list)
    for doc_id, text in docs:
        for no, line in enumerate((text or "").split("\n")):
            if re.search(r"[^ \t-\r]", line):
                places[line].append((doc_id, no))
    lines = list(places)

    def linked(a, b):
        return (min(len(a), len(b)) >= rules.min_chars and abs(len(a) - len(b)) <= rules.max_edits
                and distance(a, b) <= rules.max_edits)

    out = {}
    for members in groups(lines, linked):
        first = min(p for k in members for p in places[lines[k]])
        for k in members:
            out.update({p: (first, len(members)) for p in places[lines[k]]})
    return out


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_line_classes_match_all_pairs(spark, edits):
    rng = random.Random(edits)
    rules = line_dedup.Rules(max_edits=edits, min_chars=16)
    roots = ["".join(rng.choice("abcdé ") for _ in range(rng.randrange(14, 45))) for _ in range(14)]
    docs = [(i, "\n".join(changed(rng, rng.choice(roots), rng.randrange(5)) for _ in range(rng.randrange(6)))) for i in range(50)]
    want = plain_line_classes(docs, rules)
    got = line_dedup.line_classes(spark.createDataFrame(docs, "doc_id long, text string"), rules=rules).collect()
    assert len(got) == len(want)
    for r in got:
        first, n = want[r.doc_id, r.line_no]
        assert ((r.class_doc_id, r.class_line_no), r.n_lines, r.kept) == (first, n, first == (r.doc_id, r.line_no))


def test_line_classes_of_odd_rows(odd, odd_rows, empty):
    got = line_dedup.line_classes(odd).collect()
    assert len(got) == sum(bool(x.strip()) for _, t, *_ in odd_rows for x in (t or "").split("\n"))
    assert {(r.class_doc_id, r.kept) for r in got if r.doc_id == 6} == {(1, False)}
    assert [r.kept for r in got if r.doc_id is None] == [True]
    assert line_dedup.line_classes(empty).count() == 0


def test_repeated_lines_leave_the_text(spark, odd):
    docs = spark.createDataFrame([(1, "first line\n\nshared line", "en", 23), (2, "shared line\n \nlast line", "en", 23),
                                  (3, "shared line", "en", 11), (4, None, "en", None)], "doc_id long, text string, lang string, n_chars long")
    got = {r.doc_id: (r.text, r.n_chars) for r in line_dedup.dedup_lines(docs).collect()}
    assert got == {1: ("first line\n\nshared line", 23), 2: (" \nlast line", 11), 3: ("", 0), 4: (None, None)}
    assert line_dedup.dedup_lines(odd).columns == odd.columns


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def cuts(line):
    """(segment, number of its first word) of a line of prose, by plain loops."""
    words = line.split(" ")
    at = [i for i, w in enumerate(words) if i == 0 or signed(xxhash.xxh64_intdigest(w, 42)) % line_dedup.CUT == 0] + [len(words)]
    return [(tuple(words[x:y]), x) for x, y in zip(at, at[1:]) if y - x >= line_dedup.LEAST_WORDS]


def plainly_linked(a, b, rules=line_dedup.NEAR):
    """The rule of the docstring for two different lines, by full distances."""
    def prose(x):
        words = x.split(" ")
        return len(x) >= rules.long_chars and len(words) >= line_dedup.PROSE_WORDS and len(words) * line_dedup.WORD_CHARS >= len(x)

    def plain(x):
        return len(x) >= rules.min_chars and (len(x) <= rules.long_chars + rules.max_edits or not prose(x))

    if rules.short_chars <= min(len(a), len(b)) < rules.min_chars and distance(a, b) <= 1:
        return True
    if plain(a) and plain(b) and abs(len(a) - len(b)) <= 2 and distance(a, b) <= rules.max_edits:
        return True
    if not (prose(a) and prose(b)):
        return False
    x, y = a.split(" "), b.split(" ")
    k = min(line_dedup.MOST_WORD_EDITS, math.floor(rules.word_share * max(len(x), len(y))))
    met = any(s == t and abs(i - j) <= k for s, i in cuts(a) for t, j in cuts(b))
    return abs(len(x) - len(y)) <= k and met and distance(x, y) <= k


def test_near_copies_grow_with_the_line(spark):
    rng = random.Random(12)
    rules = line_dedup.NEAR
    vocabulary = ["".join(rng.choice("abcdefghé") for _ in range(rng.randrange(2, 9))) for _ in range(60)]
    roots = [[rng.choice(vocabulary) for _ in range(n)] for n in (2, 2, 3, 3, 8, 17, 19, 22, 40, 90, 260)] + [["".join(rng.choice("漢字語文") for _ in range(120))]]
    lines = set()
    for root in roots:
        for _ in range(7):
            line = list(root)
            for _ in range(rng.randrange(max(2, len(root) // 6))):
                line[rng.randrange(len(line))] = rng.choice(vocabulary)
            lines.add(changed(rng, " ".join(line), rng.randrange(3)))
            lines.add(" ".join(root))
    lines = sorted(x for x in lines if x.strip())
    docs = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "doc_id long, text string")
    got = {r.doc_id: (r.class_doc_id, r.n_lines) for r in line_dedup.line_classes(docs).collect()}
    linked = {(x, y) for x in lines for y in lines if x < y and plainly_linked(x, y)}
    want = {}
    for members in groups(lines, lambda x, y: (min(x, y), max(x, y)) in linked):
        want.update({k: (min(members), len(members)) for k in members})
    assert got == want
    assert sum(distance(x, y) > 2 for x, y in linked) > 15 and any(len(x) < rules.min_chars for x, _ in linked)
    assert any(len(x.split(" ")) > 200 for x, _ in linked)


def test_prose_within_two_code_points_is_linked(spark):
    """Also where the edits hit every word segment, part or join words, or make the line
    too short for prose."""
    rng = random.Random(31)
    rules, pairs = line_dedup.NEAR, []
    for n in [14, 14, 15, 16, 17, 20] * 12 + [40, 70] * 8:
        line = " ".join("".join(rng.choice("abcdefghé") for _ in range(rng.randrange(7, 13))) for _ in range(n))
        other = list(line)
        for _ in range(2):
            blanks = [i for i, c in enumerate(other) if c == " "]
            kind = rng.randrange(4)
            if kind == 0:
                del other[rng.choice(blanks)]
            elif kind == 1:
                other.insert(rng.randrange(1, len(other)), " ")
            else:
                other[rng.choice([i for i in range(len(other)) if i not in blanks])] = "z"
        pairs.append((line, "".join(other)))
    docs = spark.createDataFrame([(2 * i + k, x) for i, p in enumerate(pairs) for k, x in enumerate(p)], "doc_id long, text string")
    got = {r.doc_id: r.class_doc_id for r in line_dedup.line_classes(docs).collect()}
    assert all(got[2 * i + 1] == 2 * i for i in range(len(pairs)))
    apart = [not any(s == t for s, _ in cuts(a) for t, _ in cuts(b)) for a, b in pairs if min(len(a), len(b)) > rules.long_chars + 2]
    assert sum(apart) > 10


def test_a_large_family_costs_one_comparison_a_line(spark):
    """Near copies of one line are held against a pivot, not against each other; lines
    that are near some member but not the pivot are still found."""
    rng = random.Random(8)
    root = [f"word{rng.randrange(900)}" for _ in range(60)]

    def copy(edits):
        out = list(root)
        for at in rng.sample(range(60), edits):
            out[at] = f"new{rng.randrange(10 ** 6)}"
        return " ".join(out)
    lines = sorted({copy(2) for _ in range(200)} | {copy(8) for _ in range(12)} | {" ".join(f"o{rng.randrange(900)}" for _ in range(40)) for _ in range(30)})
    docs = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "doc_id long, text string")
    found = line_dedup.occurrences(docs)
    every = line_dedup.materialise(line_dedup.distinct_lines(found, line_dedup.NEAR), "test-lines")
    named = {r.h1: r.line for r in found.select("h1", "line").collect()}
    got = [(named[r.a], named[r.b]) for r in line_dedup.links(found, every, line_dedup.NEAR).collect()]
    linked = {(x, y) for x in lines for y in lines if x < y and plainly_linked(x, y)}
    assert len(linked) > 15_000 and len(got) < 4000
    assert {(min(p), max(p)) for p in got} <= linked

    def classes(pairs):
        return {frozenset(m) for m in groups(lines, lambda x, y: (min(x, y), max(x, y)) in pairs)}
    assert classes({(min(p), max(p)) for p in got}) == classes(linked)


@pytest.mark.parametrize("k", [4, 17, 30])
def test_banded_distance_of_words(spark, k):
    rng = random.Random(k)
    pairs = []
    for _ in range(60):
        a = [rng.choice("abcdefg") * 2 for _ in range(rng.randrange(90))]
        pairs.append((a, [x * 2 for x in changed(rng, [w[0] for w in a], rng.randrange(2 * k))]))
    for r in spark.createDataFrame(pairs, "a array<string>, b array<string>").withColumn(
            "d", line_dedup.array_distance(F.col("a"), F.col("b"), F.lit(k))).collect():
        want = distance(r.a, r.b)
        assert (r.d == want) if want <= k else r.d > k


@pytest.mark.parametrize("vocabulary", [3, 4000])
def test_words_within_and_sketches(spark, vocabulary):
    rng = random.Random(vocabulary)
    pairs = []
    for _ in range(60):
        a = [f"w{rng.randrange(vocabulary)}" for _ in range(rng.choice([1, 14, 40, 280]))]
        b = list(a)
        for _ in range(rng.randrange(6)):
            at = rng.randrange(len(b) + 1)
            b[at:at + rng.randrange(2)] = rng.choice([[], [f"w{rng.randrange(vocabulary)}"]])
        pairs.append((a, b or ["w0"], rng.randrange(5)))
    line = {x: F.array_join(x, " ") for x in "ab"}
    rows = spark.createDataFrame(pairs, "a array<string>, b array<string>, k int").select(
        "a", "b", "k", line_dedup.within(F.col("a"), F.col("b"), F.col("k")).alias("near"),
        F.levenshtein(line_dedup.sketch(line["a"]), line_dedup.sketch(line["b"])).alias("bound"))
    found = rows.collect()
    for r in found:
        assert r.near == (distance(r.a, r.b) <= r.k)
        assert r.bound <= distance(r.a, r.b)
    assert len({r.near for r in found}) == 2
    assert (vocabulary > line_dedup.SIGNS) == any(len({*r.a, *r.b}) > line_dedup.SIGNS for r in found)

def shuffle_files(spark):
    """Names of the shuffle files on this machine's disk."""
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {found.apply(i).getName() for i in range(found.size()) if found.apply(i).getName().startswith("shuffle_")}


def test_shuffle_files_go_when_a_table_is_written(spark):
    before = shuffle_files(spark)
    rows = spark.range(5000).groupBy((F.col("id") % 700).alias("k")).agg(F.max("id").alias("most"))
    out = materialise(rows, "cleaned")
    until = time.time() + 20
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    assert out.count() == 700 and spark.conf.get(*CLEANED) == "false"


def test_lines_that_share_a_segment_only_are_no_pairs(spark, monkeypatch):
    """Lines with one beginning and nothing else alike don't meet their texts; near
    copies among them are still found, also if their texts are joined in rounds."""
    rng = random.Random(11)
    start = [f"begin{k}" for k in range(24)]
    lines = [" ".join(start + [f"w{rng.randrange(10 ** 6)}" for _ in range(60)]) for _ in range(120)]
    near = [lines[5 * k].replace(" begin23 ", f" other{k} ") for k in range(12)]
    docs = spark.createDataFrame([(i, x) for i, x in enumerate(lines + near)], "doc_id long, text string")
    found = line_dedup.occurrences(docs)
    every = materialise(line_dedup.distinct_lines(found, line_dedup.NEAR), "test-lines")
    shared = line_dedup._shared(every)
    assert shared.groupBy("key").count().agg(F.max("count")).first()[0] >= len(lines)
    bounded = line_dedup._bounded(shared, line_dedup._texts(found, shared, line_dedup.NEAR))
    nobody = spark.createDataFrame([], "node long, component long")
    pairs = line_dedup.pivot_pairs(bounded, line_dedup.NEAR).union(line_dedup.other_pairs(bounded, nobody, line_dedup.NEAR)).distinct()
    assert 12 <= pairs.count() <= 30
    wanted = {(lines[5 * k], near[k]) for k in range(12)}
    named = {r.h1: r.line for r in found.select("h1", "line").collect()}
    monkeypatch.setattr(line_dedup, "LEAST_PAIRS", 5)
    monkeypatch.setattr(line_dedup, "PAIRS_AT_ONCE", 0)
    got = {tuple(sorted((named[r.a], named[r.b]))) for r in line_dedup.links(found, every, line_dedup.NEAR).collect()}
    assert got == {tuple(sorted(p)) for p in wanted}


def test_tables_of_line_dedup_go_when_they_are_read(spark):
    def tables():
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/meterlake")
        fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        return Counter(x.getPath().getName().rsplit("-", 1)[0] for x in fs.listStatus(folder)) if fs.exists(folder) else Counter()
    before = tables()
    text = " ".join(f"word{k}" for k in range(40))
    docs = spark.createDataFrame([(1, text), (2, text.replace("word20", "other")), (3, text)], "doc_id long, text string")
    assert {r.class_doc_id for r in line_dedup.line_classes(docs).collect()} == {1}
    left = tables() - before
    assert not {"line-distinct", "line-keys", "line-shared", "line-bounded", "line-others", "line-texts"} & set(left) and left["links"] <= 2


def test_replicas_are_not_broadcast(spark):
    distinct = materialise(spark.range(50).select(F.xxhash64("id").alias("fp")), "test-fps")
    plan = simhash.links(distinct)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_only_measured_tables_are_broadcast(spark, monkeypatch):
    seen = []
    real = simhash.materialise
    from pyspark.sql.readwriter import DataFrameWriter
    write = DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, *a, **k: (
        seen.append(spark.conf.get("spark.sql.autoBroadcastJoinThreshold")), write(self, *a, **k))[1])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    assert real(spark.range(5), "measured").count() == 5
    assert seen == ["-1"] and spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == before
    assert spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold", None) is None


def test_recall_of_near_copies_in_the_given_documents(spark, sf):
    """Of the lines that differ by a tenth of their code points at most, found by shared
    runs of eight code points and the full distance, nine of ten share a class."""
    docs = spark.read.parquet(f"{sf.replace('0.001', '0.01')}/documents.parquet")
    found = line_dedup.occurrences(docs)
    lines = sorted({r.line for r in found.select("line").distinct().collect() if len(r.line) >= 24})
    shared, pairs = defaultdict(list), Counter()
    for i, x in enumerate(lines):
        for gram in {x[p:p + 8] for p in range(len(x) - 7)}:
            shared[hash(gram)].append(i)
    for own in shared.values():
        if 2 <= len(own) <= 40:
            pairs.update((i, j) for n, i in enumerate(own) for j in own[n + 1:])
    close = {(i, j) for (i, j), n in pairs.items() if 10 * n >= 3 * len(lines[i]) and 10 * abs(len(lines[i]) - len(lines[j])) <= len(lines[i])
             and distance(lines[i], lines[j]) * 10 <= max(len(lines[i]), len(lines[j]))}
    of = {r.doc_id * 10_000 + r.line_no: (r.class_doc_id, r.class_line_no) for r in line_dedup.line_classes(docs).collect()}
    named = {r.line: of[r.doc_id * 10_000 + r.line_no] for r in found.collect()}
    assert len(close) > 100
    assert sum(named[lines[i]] == named[lines[j]] for i, j in close) >= 0.9 * len(close)


def test_rows_that_share_an_id_or_have_none_are_judged_apart(spark):
    words = [" ".join(f"w{k}x{i}" for i in range(30)) for k in range(4)]
    schema = "doc_id long, text string"
    docs = spark.createDataFrame([(1, words[0]), (None, words[0]), (None, words[1]), (None, words[2]), (None, words[2]),
                                  (7, words[3]), (7, words[0])], schema)
    got = sorted((tuple(r) for r in simhash.keep_one(docs).collect()), key=str)
    assert got == sorted([(1, words[0]), (None, words[1]), (None, words[2]), (7, words[3])], key=str)
    docs = spark.createDataFrame([(1, "a line that is shared"), (None, "some first line\na line that is shared"),
                                  (None, "another beginning\nunlike all others here")], schema)
    got = sorted(r.text for r in line_dedup.dedup_lines(docs).collect())
    assert got == ["a line that is shared", "another beginning\nunlike all others here", "some first line"]


def test_bad_rules_are_refused():
    with pytest.raises(ValueError):
        line_dedup.Rules(max_edits=2, min_chars=8)


def bag(text):
    return Counter((text or "").encode().lower().split())


def jaccard(a, b):
    return sum((a & b).values()) / sum((a | b).values()) if a or b else 1.0


def test_fingerprints_of_the_given_documents(spark, documents, sf):
    import hashlib

    rows = sorted(((i, t or "") for i, t in documents), reverse=True)
    got = {r.doc_id: r for r in queries.QUERIES["op6_document_fingerprints"](spark, sf).collect()}
    assert len(got) == len(rows)
    errors, same = [], defaultdict(set)
    for k, (i, text) in enumerate(rows):
        following, cut = rows[(k + 1) % len(rows)][1], len(text) // 3
        edited, r = text[:len(text) - cut] + following[:cut], got[i]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        errors += [r.near_edited - jaccard(bag(text), bag(edited)), r.near_next - jaccard(bag(text), bag(following))]
        same[text].add(r.fingerprint)
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.1
    assert all(len(x) == 1 for x in same.values())


def test_ranges_do_not_change_fingerprints(spark, monkeypatch):
    rng = random.Random(9)
    docs = spark.createDataFrame([(i * 3, " ".join(rng.choice("abcdefgh") for _ in range(20))) for i in range(60)], "doc_id long, text string")
    whole = sorted(wf.fingerprint_documents(docs).collect())
    monkeypatch.setattr(wf, "ROWS_PER_RANGE", 7)
    assert sorted(wf.fingerprint_documents(docs).collect()) == whole


def test_fingerprints_of_odd_rows(odd, odd_rows, empty):
    got = wf.fingerprint_documents(odd).collect()
    assert sorted(r.n_chars for r in got) == sorted(len(t or "") for _, t, *_ in odd_rows)
    assert len({r.fingerprint for r in got if r.doc_id in (1, 6)}) == 1
    assert len({r.fingerprint for r in got if r.doc_id in (2, 3, 4)}) == 1
    assert wf.fingerprint_documents(empty).count() == 0

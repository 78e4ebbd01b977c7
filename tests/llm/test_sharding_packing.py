import itertools
import zlib
from collections import defaultdict

from meterlake.llm import packing, sharding


def test_shards_of_the_given_documents(spark, documents, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = sharding.shard(docs, 4, ranges=64).collect()
    text = dict(documents)
    assert sorted(r.doc_id for r in rows) == sorted(text)
    slots, size = defaultdict(list), defaultdict(int)
    for r in rows:
        body = (text[r.doc_id] or "").encode()
        assert r["size"] == len(body) + 1 and r.text_crc32 == zlib.crc32(body)
        slots[r.shard].append(r.slot)
        size[r.shard] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    largest = max(len((t or "").encode()) for t in text.values()) + 1
    assert max(size.values()) - min(size.values()) <= 2 * (largest + 1.5 * sum(size.values()) / 64)


def test_a_hot_group_is_spread_and_small_groups_stay_whole(spark):
    rows = [(i, "the same text " * 20) for i in range(600)] + [(1000 + i, f"text {i // 2} " * 20) for i in range(1200)]
    got = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string"), 8).collect()
    size, places = defaultdict(int), defaultdict(set)
    for r in got:
        size[r.shard] += r["size"]
        places[r.text_crc32].add(r.shard)
    hot = zlib.crc32(("the same text " * 20).encode())
    assert len(size) == 8 and max(size.values()) < 1.1 * min(size.values())
    assert len(places[hot]) >= 2 and all(len(s) == 1 for c, s in places.items() if c != hot)


def torn(rows):
    """Groups of equal texts in several shards, and the spread of the shards' bytes."""
    places, size = defaultdict(set), defaultdict(int)
    for r in rows:
        places[r.text_crc32].add(r.shard)
        size[r.shard] += r["size"]
    return [c for c, s in places.items() if len(s) > 1], max(size.values()) / (sum(size.values()) / 8)


def test_no_group_of_the_given_documents_is_torn(spark, sf):
    for scale in ("0.001", "0.01"):
        docs = spark.read.parquet(f"{sf.replace('0.001', scale)}/documents.parquet")
        groups, most = torn(sharding.shard(docs, 8).collect())
        assert groups == [] and most < 1.1


def test_groups_that_fit_a_shard_stay_whole(spark):
    """Groups of up to four fifths of a shard are not torn, and shards stay equal."""
    rows, doc = [], 0
    for k, n in enumerate([640, 500, 320, 320, 160, 80, 40, 20]):
        for _ in range(n):
            rows.append((doc, f"group {k} " + "z" * 91))
            doc += 1
    rows += [(doc + i, f"single {i:05d} " + "y" * 86) for i in range(8 * 800 - len(rows))]
    groups, most = torn(sharding.shard(spark.createDataFrame(rows, "doc_id long, text string"), 8, ranges=128).collect())
    assert groups == [] and most < 1.05


def test_large_groups_go_where_there_is_room():
    places, held = sharding.whole_groups([(1, 60), (2, 60), (3, 50), (4, 10), (5, 45), (6, 200)], 200, 2)
    assert places == {1: 0, 4: 0, 2: 1} or 6 not in places
    assert max(held) <= 100 and sum(held) == sum(s for k, s in [(1, 60), (2, 60), (3, 50), (4, 10), (5, 45), (6, 200)] if k in places)


def test_odd_rows_are_placed_one_by_one(odd, odd_rows, empty):
    rows = sharding.shard(odd, 3).collect()
    assert len(rows) == len(odd_rows) and sum(r.doc_id is None for r in rows) == 1
    assert [r["size"] for r in rows if r.doc_id == 2] == [1]
    assert sharding.shard(empty, 3).count() == 0


def test_written_shards_read_back(spark, tmp_path, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    sharding.write_shards(docs, str(tmp_path / "out"), 4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == docs.count() and back.select("shard").distinct().count() == 4


def test_repeated_ids_are_written_once(spark, odd, odd_rows, tmp_path):
    sharding.write_shards(odd, str(tmp_path / "out"), 3)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(str((r.doc_id, r.text)) for r in back.collect()) == sorted(str(r[:2]) for r in odd_rows)


def padding(lengths, counts, bounds):
    return sum(c * (min(b for b in bounds if b >= n) - n) for n, c in zip(lengths, counts, strict=True))


def test_boundaries_are_the_best_of_all():
    lengths, counts = [1, 2, 5, 6, 9, 14, 15, 30], [5, 1, 7, 2, 9, 1, 1, 2]
    for k in (1, 2, 3, 4, 8, 9):
        bounds = packing.best_boundaries(lengths, counts, k)
        best = min(padding(lengths, counts, (*c, lengths[-1])) for c in itertools.combinations(lengths[:-1], min(k, len(lengths)) - 1))
        assert len(bounds) <= k and padding(lengths, counts, bounds) == best


def test_batches_hold_every_token_once(spark, documents, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = packing.pack(docs, n_buckets=4, max_len=256, token_budget=2048).collect()
    tokens, seen = defaultdict(int), set()
    for r in rows:
        tokens[r.doc_id] += r.n_tokens
        assert r.start == r.piece * 256 and r.n_tokens + r.padding == r.bucket_len
        assert (r.bucket, r.batch, r.slot) not in seen
        seen.add((r.bucket, r.batch, r.slot))
    assert dict(tokens) == {i: len((t or "").split(None)) + 1 if (t or "").isascii() else tokens[i] for i, t in documents}
    batches = defaultdict(list)
    for r in rows:
        batches[r.bucket, r.bucket_len].append((r.batch, r.slot))
    for (_, length), places in batches.items():
        full = max(1, 2048 // length)
        assert sorted(places) == [(k // full, k % full) for k in range(len(places))]


def test_packing_odd_rows(odd, odd_rows, empty):
    rows = packing.pack(odd).collect()
    assert sum(r.n_tokens for r in rows) == sum(len((t or "").split()) + 1 for _, t, *_ in odd_rows)
    assert packing.pack(empty).count() == 0

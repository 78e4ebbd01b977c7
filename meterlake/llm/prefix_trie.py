"""Prefix trie of conversations by whole-sequence collapse.

Identical conversations become one weighted sequence with the list of the
conversations that end there.  Sequences that are a proper prefix of another one are
dropped by an anti-join; what stays are the leaves.  Every distinct sequence is then
cut into its prefixes, the nodes, whose weights and leaves are added up.

Texts are read once and stand as two 64-bit hashes afterwards.  A prefix is named by
the exclusive or of its (position, turn) hashes, 128 bits in all, so that a running
aggregate over any part of a conversation can be carried on from the part before it.

Values that concern a whole subtree need no walk.  A node belongs to the sequence of
its smallest member; the nodes of one sequence are the lower end of its path.  A
subtree's sum is therefore the sum over all sequences through its top of what these
own, less what the top's own sequence holds above it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterlake.llm.common import materialise, words_of

# Turn numbers, places and depths of a conversation that are worked on together: 2 ** 10.
CHUNK_BITS = 10
# Ids of a block of an end list: 2 ** 12 neighbouring numbers.
BLOCK_BITS = 12
_NODE = ("p1", "p2")


@dataclass(frozen=True)
class Trie:
    """nodes, one row each: p1, p2 (its name; 0, 0 is the root), depth, conv_id (the
    smallest member), parent_conv_id, n_convs, n_children, n_leaves, words (of its last
    turn), saved_tokens, of_conv and of_place (where its last turn stands).
    ends: p1, p2, block, conv_ids (ascending, at most 4,096) of the conversations that
    end at a node; blocks are in the order of their ids."""
    nodes: DataFrame
    ends: DataFrame


def _running(df: DataFrame, key: str, place: str, totals: dict[str, tuple[str, Column]]) -> DataFrame:
    """Add running totals within ``key`` in the order of ``place`` (unique numbers from
    0): name -> ("sum" or "xor", value).  Chunks of a key are worked on apart and
    carried on from the chunks before them, so no task holds a key."""
    fold = {"sum": F.sum, "xor": F.bit_xor}
    rows = df.withColumn("_chunk", F.shiftright(place, CHUNK_BITS))
    inside = Window.partitionBy(key, "_chunk").orderBy(place).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("_key").orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)
    # only keys of several chunks have something to carry
    parts = (rows.filter(F.col(place) >= 1 << CHUNK_BITS).select(F.col(key).alias("_key")).distinct()
             .join(rows.withColumnRenamed(key, "_key").withColumnRenamed("_chunk", "_of"), "_key")
             .groupBy("_key", "_of").agg(*[fold[how](value).alias(name) for name, (how, value) in totals.items()]))
    carried = parts.select("_key", "_of", *[fold[how](name).over(before).alias(f"_{name}") for name, (how, _) in totals.items()])
    out = rows.select("*", *[fold[how](value).over(inside).alias(name) for name, (how, value) in totals.items()])
    out = out.join(carried, (F.col(key) == F.col("_key")) & (F.col("_chunk") == F.col("_of")), "left")
    for name, (how, _) in totals.items():
        more = F.coalesce(F.col(f"_{name}"), F.lit(0).cast("long"))
        out = out.withColumn(name, F.col(name).bitwiseXOR(more) if how == "xor" else F.col(name) + more)
    return out.drop("_chunk", "_key", "_of", *[f"_{name}" for name in totals])


def code(conversations: DataFrame) -> DataFrame:
    """conv_id, place (0, 1, ...), t1, t2 (hashes of role and text), words, of_conv and
    of_place (the turn itself) of every turn; written.

    Turns are ordered by ``turn``, null first; equal ones by role, then by a hash of the
    text.  A null role or text becomes empty.  Rows without a conv_id belong to no
    conversation and are left out; repeated rows are turns like others; other columns
    are ignored.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"),
        F.xxhash64(role, text).alias("t1"), F.xxhash64(F.lit("turn"), text, role).alias("t2"),
        F.size(words_of(text)).cast("long").alias("words"))
    rows = materialise(rows.withColumn("span", F.coalesce(F.shiftright("turn", CHUNK_BITS), F.lit(-(1 << 62)).cast("long"))), "trie-turns")
    counts = rows.groupBy("conv_id", "span").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("conv_id").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select(F.col("conv_id").alias("_conv"), F.col("span").alias("_span"),
                          F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_first"))
    inside = Window.partitionBy("conv_id", "span").orderBy(F.col("turn").asc_nulls_first(), "role", "t1", "t2")
    placed = rows.withColumn("_row", F.row_number().over(inside)).join(
        first, (F.col("conv_id") == F.col("_conv")) & (F.col("span") == F.col("_span")))
    place = (F.col("_first") + F.col("_row") - 1).cast("long")
    return materialise(placed.select("conv_id", place.alias("place"), "t1", "t2", "words",
                                     F.col("conv_id").alias("of_conv"), place.alias("of_place")), "trie-places")


def graft(coded: DataFrame, group: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin like their group's first one: the first h turns of
    conversation c - c % ``group`` (all if fewer, none if absent), then c's own turns
    after its first h, with h = crc32 of c in decimal, mod ``most``.  The turns, and the
    conv_id of every conversation (it may have lost all its turns)."""
    own = coded.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).select(
        "conv_id", (F.crc32(F.encode(F.col("conv_id").cast("string"), "UTF-8")) % most).alias("h"),
        (F.col("conv_id") - F.col("conv_id") % group).alias("lender"))
    turn = F.struct("place", "t1", "t2", "words", "of_conv", "of_place")
    lent = (coded.filter((F.col("conv_id") % group == 0) & (F.col("place") < most - 1))
            .groupBy(F.col("conv_id").alias("_lender")).agg(F.sort_array(F.collect_list(turn)).alias("turns")))  # at most `most` - 1
    some = F.filter(F.col("turns"), lambda t: t["place"] < F.col("h"))
    convs = materialise(own.join(lent, F.col("lender") == F.col("_lender"), "left").select(
        "conv_id", "h", F.coalesce(some, F.array().cast(lent.schema["turns"].dataType)).alias("first")), "trie-conversations")
    taken = convs.select("conv_id", F.explode("first").alias("t")).select("conv_id", "t.*")
    heads = convs.select(F.col("conv_id").alias("_conv"), "h", F.size("first").alias("k"))
    rest = (coded.join(heads, F.col("conv_id") == F.col("_conv")).filter(F.col("place") >= F.col("h"))
            .withColumn("place", (F.col("place") - F.col("h") + F.col("k")).cast("long")).select(*coded.columns))
    return materialise(rest.unionByName(taken), "trie-grafted"), convs.select("conv_id")


def build(turns: DataFrame, conversations: DataFrame | None = None) -> Trie:
    """The trie of coded turns (``code``).  conversations: conv_id of all, where some
    may have no turn; these end at the root.  Without any conversation the trie is empty."""
    x1, x2 = F.xxhash64("place", "t1", "t2"), F.xxhash64(F.lit("place"), "t2", "t1", "place")
    paths = _running(turns.withColumn("x1", x1).withColumn("x2", x2), "conv_id", "place",
                     {"p1": ("xor", F.col("x1")), "p2": ("xor", F.col("x2"))})
    paths = materialise(paths.select(
        "conv_id", (F.col("place") + 1).alias("depth"), "p1", "p2", F.col("p1").bitwiseXOR(F.col("x1")).alias("q1"),
        F.col("p2").bitwiseXOR(F.col("x2")).alias("q2"), "words", "of_conv", "of_place"), "trie-paths")

    # whole sequences: equal conversations meet, in blocks of neighbouring ids
    last = paths.groupBy(F.col("conv_id").alias("_conv")).agg(F.max("depth").alias("length"))
    everyone = conversations if conversations is not None else paths.select("conv_id").distinct()
    whole = everyone.join(last, F.col("conv_id") == F.col("_conv"), "left").select(
        "conv_id", F.coalesce("length", F.lit(0).cast("long")).alias("length"))
    tops = paths.select(F.col("conv_id").alias("_conv"), "depth", "p1", "p2")
    members = whole.join(tops, (F.col("conv_id") == F.col("_conv")) & (F.col("length") == F.col("depth")), "left").select(
        "conv_id", "length", *[F.coalesce(p, F.lit(0).cast("long")).alias(p) for p in _NODE])
    ends = materialise(members.groupBy("p1", "p2", F.shiftright("conv_id", BLOCK_BITS).alias("block")).agg(
        F.sort_array(F.collect_list("conv_id")).alias("conv_ids"), F.max("length").alias("length")), "trie-ends")
    sequences = materialise(ends.groupBy("p1", "p2").agg(
        F.min(F.col("conv_ids")[0]).alias("seq"), F.sum(F.size("conv_ids")).alias("weight"), F.max("length").alias("length")), "trie-sequences")

    # the prefixes of the distinct sequences, the root among them
    nothing = [F.lit(None).cast("long").alias(c) for c in ("q1", "q2", "words", "of_conv", "of_place")]
    of = sequences.select("seq", "weight", "length")
    cut = paths.join(of, F.col("conv_id") == F.col("seq")).drop("conv_id").unionByName(
        of.select("*", F.lit(0).cast("long").alias("depth"), *[F.lit(0).cast("long").alias(p) for p in _NODE], *nothing))
    cut = materialise(cut, "trie-prefixes")
    inner = cut.filter(F.col("depth") < F.col("length")).select("p1", "p2").distinct()
    leaves = sequences.join(inner, ["p1", "p2"], "left_anti").select(F.col("seq").alias("_leaf"))

    # nodes: members, and the sequence that owns a node
    smallest = F.min(F.struct("seq", "of_conv", "of_place"))
    nodes = cut.groupBy("p1", "p2").agg(
        F.max("depth").alias("depth"), F.sum("weight").alias("n_convs"), F.max("words").alias("words"), F.max("q1").alias("q1"),
        F.max("q2").alias("q2"), smallest.alias("top")).select(
        "p1", "p2", "depth", "n_convs", "words", "q1", "q2", F.col("top.seq").alias("conv_id"), "top.of_conv", "top.of_place",
        F.coalesce((F.col("n_convs") - 1) * F.col("words"), F.lit(0)).cast("long").alias("own"))
    nodes = materialise(nodes, "trie-nodes")
    owned = nodes.groupBy(F.col("conv_id").alias("_seq")).agg(F.min("depth").alias("highest"), F.sum("own").alias("owned"))
    shares = (of.select("seq").join(owned, F.col("seq") == F.col("_seq"), "left").join(leaves, F.col("seq") == F.col("_leaf"), "left")
              .select(F.col("seq").alias("_seq"), "highest", F.coalesce("owned", F.lit(0)).alias("owned"),
                      F.col("_leaf").isNotNull().cast("long").alias("leaf")))
    # a sequence brings a node the child that it owns there, if any
    child = (F.col("depth") < F.col("length")) & (F.col("highest") <= F.col("depth") + 1)
    sums = cut.join(shares, F.col("seq") == F.col("_seq")).groupBy(F.col("p1").alias("s1"), F.col("p2").alias("s2")).agg(
        F.sum("leaf").alias("n_leaves"), F.count_if(child).alias("n_children"), F.sum("owned").alias("below"))

    # what the owner holds above a node is not in the node's subtree
    above = _running(nodes, "conv_id", "depth", {"so_far": ("sum", F.col("own"))})
    names = ["p1", "p2", "depth", "conv_id", "q1", "q2", "n_convs", "n_children", "n_leaves", "words", "saved_tokens", "of_conv", "of_place"]
    saved = (F.col("below") - F.col("so_far") + F.col("own")).cast("long").alias("saved_tokens")
    full = materialise(above.join(sums, (F.col("p1") == F.col("s1")) & (F.col("p2") == F.col("s2")))
                       .select(*[c if c != "saved_tokens" else saved for c in names]), "trie-full")

    # the root has many children: they need no join
    root = nodes.filter("depth = 0").select(F.col("conv_id").alias("root_conv"))  # one row
    parents = nodes.filter("depth > 0").select(F.col("p1").alias("r1"), F.col("p2").alias("r2"), F.col("conv_id").alias("parent_conv_id"))
    high = full.filter("depth <= 1").join(F.broadcast(root)).withColumn("parent_conv_id", F.when(F.col("depth") == 1, F.col("root_conv")))
    low = full.filter("depth > 1").join(parents, (F.col("q1") == F.col("r1")) & (F.col("q2") == F.col("r2")))
    out = [c for c in names if c not in ("q1", "q2")] + ["parent_conv_id"]
    full = high.select(*out).union(low.select(*out))
    return Trie(full, ends.select("p1", "p2", "block", "conv_ids"))


def prefix_trie(conversations: DataFrame) -> Trie:
    """The trie of a table conv_id, turn, role, text (``code`` tells how rows are read)."""
    return build(code(conversations))


def with_texts(nodes: DataFrame, conversations: DataFrame, coded: DataFrame) -> DataFrame:
    """``nodes`` with role and text of their last turn (null at the root), taken from
    the turns that ``coded`` was made of."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    said = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("_c"), role.alias("role"), text.alias("text"), F.xxhash64(role, text).alias("_t1"),
        F.xxhash64(F.lit("turn"), text, role).alias("_t2")).dropDuplicates(["_c", "_t1", "_t2"])
    places = coded.select(F.col("of_conv").alias("_oc"), F.col("of_place").alias("_op"), "t1", "t2").distinct()
    at = nodes.join(places, (F.col("of_conv") == F.col("_oc")) & (F.col("of_place") == F.col("_op")), "left")
    return at.join(said, (F.col("of_conv") == F.col("_c")) & (F.col("t1") == F.col("_t1")) & (F.col("t2") == F.col("_t2")), "left").select(
        *nodes.columns, "role", "text")


def _digests(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's joined lists; rows come in the order of the blocks."""
    now, running = None, None

    def told() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"p1": [now[0]], "p2": [now[1]], "digest": [running.hexdigest()]})

    for part in parts:
        for p1, p2, listed in zip(*(part.column(c).to_pylist() for c in ("p1", "p2", "listed"))):
            if (p1, p2) != now:
                if now is not None:
                    yield told()
                now, running = (p1, p2), hashlib.sha256(listed.encode())
            else:
                running.update(b"," + listed.encode())
    if now is not None:
        yield told()


def ends_digest(ends: DataFrame) -> DataFrame:
    """p1, p2, digest (lower-case SHA-256 of the ids, joined by commas) of every end
    list.  A list of one block is hashed where it is; longer ones are streamed block
    by block, so that none is ever held whole."""
    text = ends.select("p1", "p2", "block", F.array_join(F.col("conv_ids").cast("array<string>"), ",").alias("listed"))
    several = ends.groupBy("p1", "p2").count().filter("count > 1").select("p1", "p2")
    one = text.join(several, ["p1", "p2"], "left_anti").select("p1", "p2", F.sha2(F.col("listed"), 256).alias("digest"))
    long = (text.join(several, ["p1", "p2"], "left_semi").repartition("p1", "p2").sortWithinPartitions("p1", "p2", "block")
            .select("p1", "p2", "listed").mapInArrow(_digests, "p1 long, p2 long, digest string"))
    return one.union(long)


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256 of every node of the trie of the grafted conversations."""
    trie = build(*graft(code(conversations)))
    digests = ends_digest(trie.ends).select(F.col("p1").alias("d1"), F.col("p2").alias("d2"), "digest")
    nodes = trie.nodes.join(digests, (F.col("p1") == F.col("d1")) & (F.col("p2") == F.col("d2")), "left")
    return nodes.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                        F.coalesce("digest", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"))

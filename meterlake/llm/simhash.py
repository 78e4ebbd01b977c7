"""SimHash near-duplicates by anchor-point covering.

A 64-bit fingerprint is cut into blocks.  Two fingerprints that differ in at most
k bits differ in at most k // blocks bits of some block.  The anchors of a block
are the words of a covering code: Hamming's (15, 11) code, of covering radius 1,
on 15 of the block's bits and every value on the rest.  A fingerprint is at home
at its nearest anchor and is replicated to every anchor within the covering
radius plus the block's threshold; each link is therefore found where one of its
two ends is at home.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.llm.common import fresh, materialise, text_of
from meterlake.llm.graph import components

SHINGLE = 4
MAX_BITS = 4
BLOCKS = 3
HASH_SEED = 42
# Bits of the Hamming code, its parity bits and its covering radius.
CODE_BITS, RADIUS = 15, 1
# Shingles counted at once: bounds a task's memory for very long texts.
CHUNK = 1 << 14


def simhash(text: str | None, shingle: int = SHINGLE) -> int:
    """Unsigned fingerprint: a bit is set if it is in over half of the XXH64
    hashes (seed 42) of the word shingles, repeats included; A-Z are lowered.
    Fewer words than a shingle: the whole sequence; none (null too): zero."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    n = max(1, len(words) - shingle + 1)
    first = np.concatenate([[0], ends[:-1]])[:n].tolist()
    last = (ends[min(shingle, len(words)) - 1:][:n] - 1).tolist()
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, dtype=np.int64)
    for at in range(0, n, CHUNK):
        hashes = np.array([digest(joined[a:b], HASH_SEED) for a, b in
                           zip(first[at:at + CHUNK], last[at:at + CHUNK])], dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                 shingle: int = SHINGLE) -> DataFrame:
    """doc_id, fp (the fingerprint as a signed 64-bit number), text_hash of every row."""
    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([simhash(t, shingle) for t in texts], dtype=np.uint64).view(np.int64))

    return docs.select(F.col(id_column).alias("doc_id"), of(F.col(text_column).cast("string")).alias("fp"),
                       F.xxhash64(text_of(text_column)).alias("text_hash"))


def block_layout(blocks: int) -> list[tuple[int, int]]:
    """(shift, bits) of each block of the 64 bits."""
    cuts = [64 * k // blocks for k in range(blocks + 1)]
    return [(a, b - a) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def covering(bits: int, reach: int) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """For a block of ``bits``: the syndrome of each value of its code bits, the
    differences of weight <= reach that lead to an anchor from each syndrome, and
    the one that leads to the home anchor.  The check matrix has the column
    j + 1 for code bit j, so a single error's syndrome names its bit."""
    values = np.arange(1 << CODE_BITS)
    syndrome = np.zeros(1 << CODE_BITS, dtype=np.int64)
    for j in range(CODE_BITS):
        syndrome ^= np.where(values >> j & 1, j + 1, 0)
    leads = [[] for _ in range(CODE_BITS + 1)]
    for weight in range(reach + 1):
        for flipped in combinations(range(bits), weight):
            change = sum(1 << j for j in flipped)
            leads[syndrome[change & ((1 << CODE_BITS) - 1)]].append(change)
    home = np.array([0] + [1 << j for j in range(CODE_BITS)], dtype=np.int64)
    return syndrome, [np.array(x, dtype=np.int64) for x in leads], home


def anchor_tables(max_bits: int = MAX_BITS, blocks: int = BLOCKS) -> list[tuple]:
    """(block, shift, bits) and the ``covering`` of each block."""
    return [(block, shift, bits, *covering(bits, RADIUS + max_bits // blocks))
            for block, (shift, bits) in enumerate(block_layout(blocks))]


def replicas(fps: np.ndarray, tables: list[tuple]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(anchor, fp, home) of every fingerprint; an anchor's number carries its block."""
    unsigned = fps.view(np.uint64)
    for block, shift, bits, syndrome, leads, home in tables:
        value = (unsigned >> np.uint64(shift) & np.uint64((1 << bits) - 1)).astype(np.int64)
        of = syndrome[value & ((1 << CODE_BITS) - 1)]
        for s, changes in enumerate(leads):
            at = np.flatnonzero(of == s)
            if len(at):
                anchors = (value[at, None] ^ changes[None, :]) | block << 40
                yield (anchors.ravel(), np.repeat(fps[at], len(changes)), np.tile(changes == home[s], len(at)))


def _replicate(max_bits: int, blocks: int):
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tables = anchor_tables(max_bits, blocks)
        for part in parts:
            for at in range(0, len(part), 4096):
                fps = part["fp"].to_numpy()[at:at + 4096].copy()
                found = list(replicas(fps, tables))
                yield pd.DataFrame({name: np.concatenate([x[k] for x in found]) for k, name in enumerate(("anchor", "fp", "home"))})
    return run


def links(distinct: DataFrame, max_bits: int = MAX_BITS, blocks: int = BLOCKS) -> DataFrame:
    """a, b of every two of the distinct fingerprints ``fp`` that differ in 1 to
    ``max_bits`` bits, each link once.

    A bucket is never listed: the comparison is part of the join's condition, and
    only links pass.  A link that several blocks would find is left to the first
    of them.  A hot anchor is an ordinary skewed join key, which AQE splits.  Spark
    sizes the replicas as if there were one for each fingerprint, so that it would
    broadcast all of them: the join is told to be a merge.
    """
    placed = distinct.select("fp").mapInPandas(_replicate(max_bits, blocks), "anchor long, fp long, home boolean")
    homes = placed.filter("home").select("anchor", F.col("fp").alias("a"))
    probes = placed.select(F.col("anchor").alias("at"), F.col("fp").alias("b"))
    differ = F.col("a").bitwiseXOR(F.col("b"))
    near = (F.col("a") < F.col("b")) & (F.bit_count(differ) <= max_bits)
    found_in = F.shiftright("anchor", 40)
    for block, (shift, bits) in enumerate(block_layout(blocks)):
        inside = F.bit_count(F.shiftrightunsigned(differ, shift).bitwiseAND(F.lit((1 << bits) - 1)))
        near &= F.when(found_in == block, inside <= max_bits // blocks).otherwise(
            (found_in < block) | (inside > max_bits // blocks))
    return homes.join(probes.hint("merge"), (F.col("anchor") == F.col("at")) & near).select("a", "b")


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle: int = SHINGLE,
                    max_bits: int = MAX_BITS, blocks: int = BLOCKS) -> DataFrame:
    """doc_id, fp, component_id (least id that links reach, itself included), root
    (a fingerprint naming the component), text_hash of every row.

    Null texts count as empty; all texts without a word have fingerprint zero and
    are linked like any other.  Null ids are not an id: they get their component's,
    null if no member has one.  Repeated rows give repeated results; other columns
    are ignored; an empty table gives an empty result.
    """
    found = materialise(fingerprints(docs, id_column, text_column, shingle), "simhash-fps")
    distinct = materialise(found.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-distinct")
    roots = components(links(distinct, max_bits, blocks))
    member = (distinct.join(roots, F.col("fp") == F.col("node"), "left")
              .select("fp", "first_id", F.coalesce("component", "fp").alias("root")))
    least = member.groupBy(F.col("root").alias("_root")).agg(F.min("first_id").alias("component_id"))
    groups = (member.join(least, F.col("root") == F.col("_root"))
              .select(F.col("fp").alias("_fp"), "root", "component_id"))
    return found.join(groups, F.col("fp") == F.col("_fp")).select("doc_id", "fp", "component_id", "root", "text_hash")


def keep_one(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options: int) -> DataFrame:
    """The rows of ``docs`` that stay if of each group the one with the least id
    does.  Of rows that share this id one stays; of a group without any id, one.
    A decision holds for an id and a text, so rows of other texts with the same id,
    or without one, are not touched by it."""
    own, text = fresh(docs, "group_id", "group_text")
    groups = materialise(near_duplicates(docs, id_column, text_column, **options), "simhash-groups")
    first = groups.groupBy(F.col("root").alias("_root")).agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("first"))
    stays = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_hash") == F.col("first.text_hash"))
    judged = groups.join(first, F.col("root") == F.col("_root")).select(
        F.col("doc_id").alias(own), F.col("text_hash").alias(text), stays.alias("stays"))
    judged = materialise(judged, "simhash-judged")
    same = F.col(id_column).eqNullSafe(F.col(own)) & (F.xxhash64(text_of(text_column)) == F.col(text))
    kept = docs.join(judged.filter(~F.col("stays")).select(own, text), same, "left_anti")
    repeated = judged.filter("stays").groupBy(own, text).count().filter("count > 1").select(own, text)
    if repeated.isEmpty():
        return kept
    few = kept.join(repeated, same, "inner").dropDuplicates([own, text]).select(*docs.columns)
    return kept.join(repeated, same, "left_anti").union(few)

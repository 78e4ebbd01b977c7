"""Centroid clustering (exact k-means on integer vectors) by Shallot's bounded search.

A vector remembers its centroid, the second-nearest one, an upper bound of the distance
to the first and a lower bound of the distance to every other.  Centroids that move
loosen the bounds.  While they still prove the assignment, the vector is left alone.
Else the distances to the two remembered centroids are taken anew and the search starts
from the closer one: its neighbours are scanned by their distance to it, inside a ball
of the radius (distance to the start + distance to the second best so far), which
shrinks with every better second.  What is inside is compared by exact integer squared
distances, ties to the smaller number; bounds carry a margin and only ever skip
centroids that are surely farther.

Vectors are packed into blocks of a table bucketed by block; each round writes a small
table of the blocks' states, bucketed alike, so that the next round joins the two
without moving a vector.  Only sums of centroids reach the driver.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.llm.common import discard
from meterlake.session import scratch_path

# Vectors of a block; blocks of a bucket, about; buckets (a task streams its own).
BLOCK, BUCKET_BLOCKS, MOST_BUCKETS = 4096, 32, 50_000
# Components beyond this could leave the 64 bits of a squared distance.
LARGEST = 1 << 27
# Share by which a bound must be clear to count.
MARGIN = 1e-9
STATE = "block long, near binary, second binary, upper binary, lower binary, sums array<long>, distances long"


def integers(vectors: DataFrame, column: str = "embedding", size: int = 64, scale: int = 1024) -> DataFrame:
    """The rows whose vector has ``size`` components, none null, NaN or infinite, with
    the array floor(scale * x) as ``components``."""
    x = F.col(column)
    usable = (F.size(x) == size) & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    scaled = F.transform(x, lambda v: F.floor(F.least(F.greatest(v.cast("double") * scale, F.lit(-2.0**62)), F.lit(2.0**62))))
    return vectors.filter(F.coalesce(usable, F.lit(False))).withColumn("components", scaled)


def first_centroids(rows: DataFrame, id_column: str, k: int, seed: int) -> np.ndarray:
    """The vectors of the k smallest SHA-256 of "seed:id", in that order; rows that
    share an id by their components, rows without an id never."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col(id_column).cast("string")), 256)
    found = rows.filter(F.col(id_column).isNotNull()).select(order.alias("o"), "components").orderBy("o", "components").limit(k)
    return np.array([r.components for r in found.collect()], dtype=np.int64)


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows of integers."""
    apart = x.astype(np.int64) - c
    return np.einsum("ij,ij->i", apart, apart)


@dataclass(frozen=True)
class Centres:
    """values: one row each; order and gaps: for each the others by their distance to
    it; moved: how far each came since the round before, most_other: the farthest move
    of any other one."""
    values: np.ndarray
    order: np.ndarray
    gaps: np.ndarray
    moved: np.ndarray
    most_other: np.ndarray

    @staticmethod
    def of(values: np.ndarray, before: np.ndarray | None) -> Centres:
        k = len(values)
        gaps = np.sqrt(np.array([squared(values, values[j]) for j in range(k)], dtype=np.float64)).reshape(k, k)
        np.fill_diagonal(gaps, -1.0)  # itself comes first
        order = np.argsort(gaps, axis=1, kind="stable")
        moved = np.zeros(k) if before is None else np.sqrt(squared(values, before).astype(np.float64))
        far = np.argsort(moved, kind="stable")[::-1]
        most = np.full(k, moved[far[0]])
        most[far[0]] = moved[far[1]] if k > 1 else 0.0
        return Centres(values, order, np.take_along_axis(gaps, order, axis=1), moved, most)


def nearest_two(x: np.ndarray, centres: Centres, near: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """The nearest and second-nearest centroid of each row and both squared distances,
    starting from two remembered ones; and how many distances were taken."""
    k = len(centres.values)
    a, b = near.astype(np.int64), second.astype(np.int64)
    da = squared(x, centres.values[a])
    if k == 1:
        return a, b, da, np.full(len(x), np.iinfo(np.int64).max), len(x)
    db = squared(x, centres.values[b])
    swap = (db < da) | ((db == da) & (b < a))
    a, b, da, db = np.where(swap, b, a), np.where(swap, a, b), np.where(swap, db, da), np.where(swap, da, db)
    start, known, reach = a.copy(), b.copy(), np.sqrt(da.astype(np.float64))
    taken, active = 2 * len(x), np.arange(len(x))
    for rank in range(1, k):
        radius = (reach[active] + np.sqrt(db[active].astype(np.float64))) * (1 + MARGIN)
        # gaps only grow and balls only shrink: who is out stays out
        active = active[centres.gaps[start[active], rank] * (1 - MARGIN) <= radius]
        if not len(active):
            break
        j = centres.order[start[active], rank]
        new = j != known[active]
        at, j = active[new], j[new]
        d = squared(x[at], centres.values[j])
        taken += len(at)
        first = (d < da[at]) | ((d == da[at]) & (j < a[at]))
        then = ~first & ((d < db[at]) | ((d == db[at]) & (j < b[at])))
        won, lost = at[first], at[then]
        b[won], db[won] = a[won], da[won]
        a[won], da[won] = j[first], d[first]
        b[lost], db[lost] = j[then], d[then]
    return a, b, da, db, taken


def assign(x: np.ndarray, centres: Centres, state: tuple | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """The next state (near, second, upper, lower) of the rows, and how many distances
    were taken.  Without a state the search starts from the first two centroids."""
    if state is None:
        near = np.zeros(len(x), dtype=np.int64)
        second = np.full(len(x), min(1, len(centres.values) - 1), dtype=np.int64)
        upper, lower = np.full(len(x), np.inf), np.zeros(len(x))
    else:
        near, second, upper, lower = state[0].astype(np.int64), state[1].astype(np.int64), state[2].copy(), state[3].copy()
        upper += centres.moved[near]
        lower -= centres.most_other[near]
    others = centres.gaps[:, 1] / 2 if len(centres.values) > 1 else np.full(1, np.inf)

    def proven(at: np.ndarray) -> np.ndarray:
        return upper[at] * (1 + MARGIN) < np.maximum(lower[at], others[near[at]]) * (1 - MARGIN)

    at = np.flatnonzero(~proven(np.arange(len(x))))
    taken = len(at)
    if state is not None and len(at):  # a tight upper bound may prove it
        upper[at] = np.sqrt(squared(x[at], centres.values[near[at]]).astype(np.float64))
        at = at[~proven(at)]
    if len(at):
        a, b, da, db, more = nearest_two(x[at], centres, near[at], second[at])
        near[at], second[at], upper[at] = a, b, np.sqrt(da.astype(np.float64))
        lower[at] = np.sqrt(db.astype(np.float64))
        taken += more
    return near, second, upper, lower, taken


def _pack(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 32
    for part in parts:
        for at in range(0, part.num_rows, BLOCK):
            some = part.slice(at, BLOCK)
            vectors = some.column("components").flatten().to_numpy(zero_copy_only=False).astype(np.int32)
            ids = some.column("id")
            yield pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                 pa.array([vectors.tobytes()], pa.binary())], names=["block", "ids", "vectors"])
            number += 1


@dataclass(frozen=True)
class Bucketed:
    """A written table bucketed by block."""
    name: str
    path: str
    rows: DataFrame

    @staticmethod
    def of(df: DataFrame, label: str, buckets: int) -> Bucketed:
        path, name = scratch_path(df.sparkSession, label), f"meterlake_{uuid.uuid4().hex}"
        df.write.format("parquet").bucketBy(buckets, "block").sortBy("block").option("path", path).saveAsTable(name)
        return Bucketed(name, path, df.sparkSession.table(name))

    def drop(self) -> None:
        self.rows.sparkSession.sql(f"DROP TABLE {self.name}")
        discard(self.rows.sparkSession, self.path)


def _unpacked(vectors: bytes, size: int) -> np.ndarray:
    return np.frombuffer(vectors, dtype=np.int32).reshape(-1, size)


def _state_of(row: dict) -> tuple:
    return tuple(np.frombuffer(row[name], dtype=kind) for name, kind in
                 (("near", np.int32), ("second", np.int32), ("upper", np.float64), ("lower", np.float64)))


def _round(centres: Centres, first: bool):
    """The next state of each block, with its sums: per centroid the components' and the rows'."""
    k, size = centres.values.shape

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for row in part.to_pylist():
                x = _unpacked(row["vectors"], size)
                near, second, upper, lower, taken = assign(x, centres, None if first else _state_of(row))
                sums = np.zeros((k, size + 1), dtype=np.int64)
                for j in range(k):
                    own = x[near == j]
                    sums[j, :size], sums[j, size] = own.sum(axis=0, dtype=np.int64), len(own)
                yield pa.RecordBatch.from_pydict({
                    "block": [row["block"]], "near": [near.astype(np.int32).tobytes()], "second": [second.astype(np.int32).tobytes()],
                    "upper": [upper.tobytes()], "lower": [lower.tobytes()], "sums": [sums.ravel()], "distances": [taken]},
                    schema=pa.schema([("block", pa.int64()), *[(c, pa.binary()) for c in ("near", "second", "upper", "lower")],
                                      ("sums", pa.list_(pa.int64())), ("distances", pa.int64())]))
    return run


def _result(centroids: np.ndarray):
    """id, cluster and distance of every vector."""
    size = centroids.shape[1]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for ids, vectors, near in zip(*(part.column(c) for c in ("ids", "vectors", "near")), strict=True):
                x, near = _unpacked(vectors.as_py(), size), np.frombuffer(near.as_py(), dtype=np.int32)
                yield pa.RecordBatch.from_arrays([ids.values, pa.array(near), pa.array(squared(x, centroids[near]))],
                                                 names=["id", "cluster", "distance"])
    return run


def moved_centroids(centroids: np.ndarray, sums: dict[int, int]) -> np.ndarray:
    """Exact floor(sum / count) of every centroid that has rows; the others stay."""
    k, size = centroids.shape
    out = centroids.copy()
    for j in range(k):
        n = sums.get(j * (size + 1) + size, 0)
        if n:
            out[j] = [sums[j * (size + 1) + i] // n for i in range(size)]
    return out


def cluster(vectors: DataFrame, id_column: str = "vec_id", column: str = "embedding", k: int = 8, rounds: int = 10,
            size: int = 64, scale: int = 1024, seed: int = 3) -> tuple[DataFrame, np.ndarray]:
    """id, cluster, distance (squared) of every usable vector, and the centroids.

    Each of ``rounds`` rounds assigns the vectors and moves the centroids; then the
    vectors are assigned once more.  Vectors of another length, or with a null or
    non-finite component, are left out.  Rows without an id are clustered but are never
    a first centroid; repeated rows count as often as they are there; other columns are
    ignored.  Fewer than k rows with an id give fewer centroids; without any the result
    is empty.  A component beyond 2 ** 27 in size is refused: distances would not fit.
    """
    spark = vectors.sparkSession
    rows = integers(vectors.select(F.col(id_column).alias("id"), F.col(column).alias("embedding")), "embedding", size, scale)
    of = rows.schema["id"].dataType.simpleString()
    centroids = first_centroids(rows, "id", k, seed)
    if not len(centroids):
        return rows.select("id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")).limit(0), np.zeros((0, size), np.int64)
    n, largest = rows.agg(F.count(F.lit(1)), F.max(F.array_max(F.transform("components", lambda v: F.abs(v))))).first()
    if largest > LARGEST:
        raise ValueError(f"a component of {largest} is beyond {LARGEST}: its distances could not be exact")
    buckets = min(MOST_BUCKETS, max(8, n // (BLOCK * BUCKET_BLOCKS)))
    packed = rows.select("id", "components").mapInArrow(_pack, f"block long, ids array<{of}>, vectors binary").repartition(buckets, "block")
    blocks = Bucketed.of(packed, "vectors", buckets).rows
    state = before = None
    for _ in range(rounds + 1):
        centres, held = Centres.of(centroids, before), blocks.select("block", "vectors")
        if state is not None:
            held = held.join(state.rows.select("block", "near", "second", "upper", "lower"), "block")
        after = Bucketed.of(held.mapInArrow(_round(centres, state is None), STATE), "vector-states", buckets)
        if state is not None:
            state.drop()
        state = after
        found = state.rows.select(F.posexplode("sums")).groupBy("pos").agg(F.sum("col").alias("n")).collect()  # k * (size + 1) rows
        before, centroids = centroids, moved_centroids(centroids, {r.pos: r.n for r in found})
    out = blocks.join(state.rows.select("block", "near"), "block").mapInArrow(_result(before), f"id {of}, cluster int, distance long")
    return out, before


def clustered(vectors: DataFrame, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every usable vector."""
    found, centroids = cluster(vectors, id_column, column)
    spark = vectors.sparkSession
    totals = {r.cluster: r.n for r in found.groupBy("cluster").agg(F.sum("distance").alias("n")).collect()}  # k rows
    digest = F.sha2(F.col("joined"), 256)
    names = spark.createDataFrame([(j, totals.get(j, 0), sum(totals.values()), ",".join(str(int(v)) for v in c)) for j, c in enumerate(centroids)],
                                  "of int, cluster_inertia long, inertia long, joined string")
    return (found.join(F.broadcast(names), F.col("cluster") == F.col("of"))
            .select(F.col("id").alias(id_column), "cluster", "distance", "cluster_inertia", "inertia", digest.alias("centroid_sha256")))

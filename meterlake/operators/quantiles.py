"""Exact quantiles (linear interpolation) without collecting a group.

Spark's exact ``percentile`` keeps every distinct value of a group in one
aggregation buffer; with one group (a whole column) or a hot group that is
the whole data in one task.  Instead the rank is *bracketed*, then counted:

1. one scan builds a mergeable KLL sketch per (group, column); for each wanted
   quantile it gives two values that the wanted ranks lie between, a small
   share of the rows apart;
2. a second scan counts, exactly, the values below each bracket and each
   distinct value inside it (partial aggregation: a hot value, like everything
   below a bracket, is one row per map task);
3. a running sum over the few values inside finds the ones at the wanted ranks.

The sketch only chooses where to look: a bracket that turns out not to hold its
ranks is widened and counted again.  No step has a limit on groups or values,
infinities are values like any other, and nothing reaches the driver but whether
all brackets held.  The input is scanned twice where it is a plain scan; any other
input is evaluated once, its profiled columns written to the shared folder.

Interpolation follows pandas / SQL ``quantile_cont``: position
h = (n - 1) p, value = x[floor h] + (h - floor h) (x[floor h + 1] - x[floor h]).
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterlake.operators.joins import maybe_broadcast
from meterlake.session import scratch_path

# Size of a sketch (a rank is off by some 0.13 %), and the share of the rows on either
# side of a quantile that its bracket spans; widened WIDER-fold if it does not hold.
SKETCH, MARGIN, WIDER = 4096, 0.003, 8
# Parts of a bracket whose values are summed up apart.
PARTS = 256


def long_values(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by..., column, x) with NULL and NaN values dropped."""
    stack = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x")) for c in columns]))
    out = df.select(*by, stack.alias("_kv")).select(*by, "_kv.column", "_kv.x")
    return out.where(F.col("x").isNotNull() & ~F.isnan("x"))


def _written(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _is_plain_scan(df: DataFrame) -> bool:
    """Whether reading ``df`` again costs no more than its files."""
    nodes = re.findall(r"^[\s:+|-]*'?(\w+)", df._jdf.queryExecution().optimizedPlan().toString(), re.MULTILINE)
    return set(nodes) <= {"Project", "Filter", "Relation", "RelationV2"}


def _source(df: DataFrame, columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    """k (the group as one struct: NULLs inside it compare equal), v0, v1, ... (the
    columns as doubles, NaN as NULL)."""
    def value(c: str) -> Column:
        x = F.col(c).cast("double")
        return F.when(~F.isnan(x), x)

    src = df.select(F.struct(F.lit(0).alias("_all"), *by).alias("k"), *[value(c).alias(f"v{i}") for i, c in enumerate(columns)])
    return src if _is_plain_scan(df) else _written(src, "quantile-values")


def _brackets(sketches: DataFrame, slots: list[tuple[int, float]], margin: float) -> DataFrame:
    """k and, per slot (a column and a probability), n, lo and hi.  Small groups, whose
    ranks lie far apart, and quantiles near an end have an open bracket."""
    out = []
    for s, (i, p) in enumerate(slots):
        n = F.col(f"n{i}")
        closed = n > 4 / margin
        low = F.when(closed, F.kll_sketch_get_quantile_double(f"s{i}", F.lit(p - margin))) if p > margin else F.lit(None)
        high = F.when(closed, F.kll_sketch_get_quantile_double(f"s{i}", F.lit(p + margin))) if p + margin < 1 else F.lit(None)
        out += [F.coalesce(low, F.lit(float("-inf"))).alias(f"lo{s}"), F.coalesce(high, F.lit(float("inf"))).alias(f"hi{s}")]
    return sketches.select("k", *[c for c in sketches.columns if c.startswith("n")], *out)


def _tally(src: DataFrame, bounds: DataFrame, slots: list[tuple[int, float]]) -> DataFrame:
    """k, slot, x, c: number of values of each slot's column that are below its bracket
    (x is NULL), and of each value inside."""
    of = bounds.select(F.col("k").alias("bk"), *[c for c in bounds.columns if c[:2] in ("lo", "hi")])
    cells = []
    for s, (i, _) in enumerate(slots):
        v, lo, hi = F.col(f"v{i}"), F.col(f"lo{s}"), F.col(f"hi{s}")
        cells.append(F.when(v < lo, F.struct(F.lit(s).alias("slot"), F.lit(None).cast("double").alias("x")))
                     .when(v <= hi, F.struct(F.lit(s).alias("slot"), v.alias("x"))))
    rows = src.join(maybe_broadcast(of), F.col("k") == F.col("bk")).select("k", F.explode(F.array(*cells)).alias("cell"))
    return (rows.where(F.col("cell").isNotNull()).select("k", "cell.slot", "cell.x")
            .groupBy("k", "slot", "x").agg(F.count(F.lit(1)).alias("c")))


def _wanted(bounds: DataFrame, slots: list[tuple[int, float]]) -> DataFrame:
    """wk, ws, r0, r1 (the ranks, from 0), f, lo, hi of every slot that has values."""
    cells = []
    for s, (i, p) in enumerate(slots):
        n = F.col(f"n{i}")
        h = (n - 1) * F.lit(p)
        cells.append(F.when(n > 0, F.struct(
            F.lit(s).alias("ws"), F.floor(h).alias("r0"), F.ceil(h).alias("r1"), (h - F.floor(h)).alias("f"),
            F.col(f"lo{s}").alias("lo"), F.col(f"hi{s}").alias("hi"))))
    out = bounds.select(F.col("k").alias("wk"), F.explode(F.array(*cells)).alias("w"))
    return out.where(F.col("w").isNotNull()).select("wk", "w.*")


def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float],
                    by: Sequence[str] = ()) -> DataFrame:
    """One row per (by..., column, p) with the exact linear quantile."""
    slots = [(i, float(p)) for i in range(len(columns)) for p in probs]
    src = _source(df, columns, by)
    sketches = _written(src.groupBy("k").agg(*[
        cell for i in range(len(columns)) for cell in (
            F.count(f"v{i}").alias(f"n{i}"), F.kll_sketch_agg_double(f"v{i}", F.lit(SKETCH)).alias(f"s{i}"))]), "quantile-sketches")
    margin = MARGIN
    while True:
        bounds = _written(_brackets(sketches, slots, margin), "quantile-brackets")
        wanted = _wanted(bounds, slots)
        tally = _written(_tally(src, bounds, slots), "quantile-counts")
        held = tally.groupBy("k", "slot").agg(F.sum(F.when(F.col("x").isNull(), F.col("c")).otherwise(0)).alias("below"), F.sum("c").alias("upto"))
        missed = wanted.join(held, (F.col("wk") == F.col("k")) & (F.col("ws") == F.col("slot")), "left").where(
            ~F.coalesce((F.col("below") <= F.col("r0")) & (F.col("r1") < F.col("upto")), F.lit(False)))
        if missed.isEmpty():
            break
        margin *= WIDER

    # the values of a bracket in parts: whole parts first, then inside those that hold a rank
    width = F.col("hi") - F.col("lo")
    inner = F.floor((F.col("x") - F.col("lo")) / width * PARTS)
    part = F.when(F.col("x").isNull(), -1).when((width > 0) & (width < float("inf")), F.least(inner, F.lit(PARTS - 1))).otherwise(0).cast("int")
    rows = tally.join(maybe_broadcast(wanted), (F.col("k") == F.col("wk")) & (F.col("slot") == F.col("ws"))).select(
        "k", "slot", "x", "c", "r0", "r1", "f", part.alias("part"))
    sizes = rows.groupBy(F.col("k").alias("pk"), F.col("slot").alias("ps"), F.col("part").alias("pp")).agg(
        F.sum("c").alias("m"), F.first("r0").alias("q0"), F.first("r1").alias("q1"))
    before = Window.partitionBy("pk", "ps").orderBy("pp").rowsBetween(Window.unboundedPreceding, -1)   # <= PARTS + 1 rows
    sizes = sizes.withColumn("base", F.coalesce(F.sum("m").over(before), F.lit(0)))
    sizes = sizes.where((F.col("base") <= F.col("q1")) & (F.col("base") + F.col("m") > F.col("q0"))).select("pk", "ps", "pp", "base")
    inside = rows.join(sizes, (F.col("k") == F.col("pk")) & (F.col("slot") == F.col("ps")) & (F.col("part") == F.col("pp")))
    upto = Window.partitionBy("k", "slot", "part").orderBy("x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = inside.withColumn("upto", F.col("base") + F.sum("c").over(upto))

    def at(rank: str) -> Column:
        return F.max(F.when((F.col(rank) < F.col("upto")) & (F.col(rank) >= F.col("upto") - F.col("c")), F.col("x")))

    out = placed.groupBy("k", "slot").agg(at("r0").alias("a"), at("r1").alias("b"), F.first("f").alias("f"))
    # equal ends need no interpolation; an infinite one takes the result along
    infinite = F.greatest(F.abs("a"), F.abs("b")) == float("inf")
    value = F.when((F.col("f") == 0) | (F.col("a") == F.col("b")), F.col("a")) \
        .when(infinite, F.col("a") * (1 - F.col("f")) + F.col("b") * F.col("f")) \
        .otherwise(F.col("a") + (F.col("b") - F.col("a")) * F.col("f"))
    name = F.element_at(F.array(*[F.lit(columns[i]) for i, _ in slots]), F.col("slot") + 1)
    prob = F.element_at(F.array(*[F.lit(p) for _, p in slots]), F.col("slot") + 1)
    return out.select(*[F.col("k")[c].alias(c) for c in by], name.alias("column"), prob.alias("p"), value.alias("value"))


def approx_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float],
                     by: Sequence[str] = (), accuracy: int = 10_000) -> DataFrame:
    """One pass with ``percentile_approx`` (rank error <= n / accuracy; the
    result is an observed value, not interpolated)."""
    by = list(by)
    long = long_values(df, columns, by)
    keys = by + ["column"]
    ps = F.array(*[F.lit(float(p)) for p in probs])
    q = long.groupBy(*keys).agg(F.percentile_approx("x", ps, accuracy).alias("_q"))
    z = F.arrays_zip(ps.alias("p"), F.col("_q").alias("value"))
    return q.select(*keys, F.explode(z).alias("_z")).select(*keys, "_z.p", "_z.value")


def quantile_table(df: DataFrame, columns: Sequence[str], probs: Sequence[float],
                   by: Sequence[str] = (), names: Sequence[str] | None = None,
                   approx: bool = False) -> DataFrame:
    """Wide form: one row per (by..., column) and one column per quantile."""
    names = list(names or [f"q{int(round(p * 100)):02d}" for p in probs])
    q = (approx_quantiles if approx else exact_quantiles)(df, columns, probs, by)
    aggs = [F.max(F.when(F.col("p") == float(p), F.col("value"))).alias(nm)
            for p, nm in zip(probs, names)]
    return q.groupBy(*by, "column").agg(*aggs)

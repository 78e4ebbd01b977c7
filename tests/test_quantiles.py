import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from meterlake.operators import quantiles


def _np(values, p):
    return float(np.quantile(np.array(values, dtype=float), p, method="linear"))


def test_matches_numpy_with_groups_and_skew(spark):
    rng = np.random.default_rng(7)
    rows = [("a", float(x)) for x in rng.normal(100, 30, 3000)]
    rows += [("hot", 42.0)] * 5000 + [("hot", float(x)) for x in rng.uniform(0, 1e6, 500)]
    rows += [("one", 5.0)]
    df = spark.createDataFrame(rows, "g string, x double")
    probs = [0.0, 0.25, 0.5, 0.75, 0.9, 1.0]
    got = {(r.g, r.p): r.value for r in quantiles.exact_quantiles(df, ["x"], probs, by=["g"]).collect()}
    for g in ("a", "hot", "one"):
        vals = [x for k, x in rows if k == g]
        for p in probs:
            assert abs(got[(g, p)] - _np(vals, p)) <= 1e-9 * max(1.0, abs(_np(vals, p)))


def test_nulls_and_nan_ignored(spark):
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (3.0,)], "x double")
    got = quantiles.exact_quantiles(df, ["x"], [0.5]).collect()[0].value
    assert got == 2.0


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(min_value=-1e6, max_value=1e6, allow_nan=False), min_size=1, max_size=60),
       st.sampled_from([0.1, 0.25, 0.5, 0.75, 0.99]))
def test_property_exact(spark, values, p):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = quantiles.exact_quantiles(df, ["x"], [p]).collect()[0].value
    want = _np(values, p)
    assert abs(got - want) <= 1e-9 * max(1.0, abs(want))


def test_heavy_tails_and_brackets_that_miss(spark, monkeypatch):
    """A tiny sketch with a margin it cannot meet: brackets are widened until they hold."""
    monkeypatch.setattr(quantiles, "SKETCH", 8)
    monkeypatch.setattr(quantiles, "MARGIN", 0.01)
    vals = [2.0 ** i for i in range(-200, 800, 3)] + [-(2.0 ** i) for i in range(0, 300, 7)] + [0.0] * 50
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    probs = [0.05, 0.25, 0.5, 0.75, 0.95]
    got = {r.p: r.value for r in quantiles.exact_quantiles(df, ["x"], probs).collect()}
    for p in probs:
        want = _np(vals, p)
        assert abs(got[p] - want) <= 1e-9 * max(1.0, abs(want))


def test_infinities_and_null_groups(spark):
    inf = float("inf")
    rows = [(None, float(v)) for v in range(1, 200)] + [(None, inf), ("g", inf), ("g", inf), ("h", -inf), ("h", 1.0), ("h", 2.0)]
    df = spark.createDataFrame(rows, "g string, x double")
    got = {(r.g, r.p): r.value for r in quantiles.exact_quantiles(df, ["x"], [0.25, 0.5, 0.75], by=["g"]).collect()}
    assert [got[None, p] for p in (0.25, 0.5, 0.75)] == [50.75, 100.5, 150.25]
    assert got["g", 0.5] == inf and got["h", 0.5] == 1.0 and got["h", 0.25] == -inf


def test_large_groups_have_narrow_brackets(spark):
    """The second scan keeps a small share of the values, and the result is exact."""
    df = spark.range(300_000).selectExpr("id % 3 AS g", "cast((id * 7919) % 300007 AS double) AS x", "cast(id % 5 AS double) AS y")
    src = quantiles._source(df, ["x", "y"], ["g"])
    slots = [(0, 0.25), (0, 0.5), (1, 0.5)]
    sketches = src.groupBy("k").agg(*[c for i in (0, 1) for c in (
        F.count(f"v{i}").alias(f"n{i}"), F.kll_sketch_agg_double(f"v{i}", F.lit(quantiles.SKETCH)).alias(f"s{i}"))])
    tally = quantiles._tally(src, quantiles._brackets(sketches, slots, quantiles.MARGIN), slots)
    assert tally.where("x is not null and slot < 2").count() < 0.02 * 2 * 300_000
    got = {(r.g, r.column, r.p): r.value for r in quantiles.exact_quantiles(df, ["x", "y"], [0.1, 0.25, 0.5, 0.999], by=["g"]).collect()}
    rows = df.toPandas()
    for (g, column, p), value in got.items():
        assert value == _np(rows[rows.g == g][column], p)


def test_a_stored_table_is_scanned_twice_and_not_written(spark, tmp_path):
    spark.range(5000).selectExpr("cast(id AS double) AS x", "id % 4 AS g").write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t")).where("g < 3")
    assert quantiles._is_plain_scan(stored) and not quantiles._is_plain_scan(stored.distinct())
    assert not quantiles._is_plain_scan(stored.join(stored.withColumnRenamed("x", "z"), "g"))
    got = quantiles.exact_quantiles(stored, ["x"], [0.5], by=["g"]).collect()
    assert {r.g: r.value for r in got} == {0: 2498.0, 1: 2499.0, 2: 2500.0}


def test_input_is_evaluated_once_and_stays_in_spark(spark, monkeypatch):
    from pyspark.sql import DataFrame
    df = spark.createDataFrame([(float(i), float(i % 7)) for i in range(500)], "x double, y double")

    def collected(self):
        raise AssertionError("rows on the driver")
    monkeypatch.setattr(DataFrame, "collect", collected)
    out = quantiles.exact_quantiles(df, ["x", "y"], [0.5])
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    monkeypatch.undo()
    assert "LogicalRDD" not in plan                 # the input itself is not in the plan any more
    assert {r.column: r.value for r in out.collect()} == {"x": 249.5, "y": 3.0}


def test_approx_option_is_close(spark):
    from meterlake.operators import quality
    rng = np.random.default_rng(3)
    vals = [float(x) for x in rng.normal(50, 10, 5000)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    ex = quality.describe_numeric(df, ["x"]).collect()[0]
    ap = quality.describe_numeric(df, ["x"], approx=True).collect()[0]
    assert abs(ex.q50 - ap.q50) < 1.0 and abs(ex.q25 - ap.q25) < 1.0

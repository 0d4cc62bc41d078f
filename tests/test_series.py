"""Order statistics, profiles, rolling means, autocorrelation, splits."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from heliotab.functions.scalars import hash32
from heliotab.operators.profile import (
    correlation_matrix,
    describe,
    deviation,
    ecdf,
    entropy,
    frequency_extremes,
    histogram,
    mad_flags,
    outlier_thresholds,
    overview,
)
from heliotab.operators.ranks import exact_quantiles, global_index, running_total
from heliotab.operators.series import autocorrelation, curve_summary, rolling_mean, with_lags
from heliotab.operators.splits import chronological_holdout, random_split

PROBS = {"q0": 0.0, "q10": 0.1, "q25": 0.25, "q50": 0.5, "q75": 0.75, "q99": 0.99, "q100": 1.0}


def skewed(spark, n=30_000):
    """Group 'hot' holds most rows, a third of them one value; one group has a single row."""
    rng = np.random.default_rng(7)
    hot = np.where(rng.random(n) < 0.33, 5.0, np.exp(rng.normal(0, 4, n)))
    rows = [("hot", float(v)) for v in hot] + [("few", float(v)) for v in (1, 2, 4, 8)] + [("one", -3.5), ("hot", None)]
    return spark.createDataFrame(rows, "k string, x double"), {"hot": hot, "few": np.array([1.0, 2, 4, 8]), "one": np.array([-3.5])}


@pytest.mark.parametrize("buckets", [2, 7, 200])
def test_quantiles_are_exact_whatever_the_buckets(spark, buckets):
    df, groups = skewed(spark)
    got = {r.k: r for r in exact_quantiles(df, ["k"], "x", PROBS, buckets=buckets).collect()}
    for k, values in groups.items():
        for name, p in PROBS.items():
            assert got[k][name] == pytest.approx(np.quantile(values, p), rel=1e-12), (k, name)


def test_quantiles_without_keys_and_constant_column(spark):
    df = spark.range(101).select((F.col("id") * 1.0).alias("x"))
    assert exact_quantiles(df, [], "x", {"m": 0.5, "q": 0.333}).first().asDict() == pytest.approx({"m": 50.0, "q": 33.3})
    assert exact_quantiles(spark.range(50).select(F.lit(2.0).alias("x")), [], "x", {"m": 0.5}).first().m == 2.0


def test_approximate_quantiles(spark):
    df, groups = skewed(spark)
    got = {r.k: r.m for r in exact_quantiles(df, ["k"], "x", {"m": 0.5}, approx=True).collect()}
    assert got["one"] == -3.5 and got["hot"] == pytest.approx(np.median(groups["hot"]), rel=0.05)
    for parts in (1, 7, 40):
        again = exact_quantiles(df.repartition(parts), ["k"], "x", {"m": 0.5}, approx=True).collect()
        assert {r.k: r.m for r in again} == got


@pytest.mark.parametrize("buckets", [1, 5, 64])
def test_running_total(spark, buckets):
    df, groups = skewed(spark, 3000)
    counts = df.dropna().groupBy("k", "x").agg(F.count("*").alias("n"))
    got = {(r.k, r.x): r.n_before for r in running_total(counts, ["k"], "x", ["n"], buckets=buckets).collect()}
    for k, values in groups.items():
        for v in np.unique(values):
            assert got[(k, v)] == int((values < v).sum())


def test_global_index(spark):
    df = spark.range(5000).withColumnRenamed("id", "key")
    rows = global_index(df, hash32("key"), ["key"], "i", buckets=37).collect()
    assert sorted(r.i for r in rows) == list(range(5000))
    hashes = {r.key: r.h for r in df.withColumn("h", hash32("key")).collect()}
    in_order = [hashes[r.key] for r in sorted(rows, key=lambda r: r.i)]
    assert in_order == sorted(in_order)
    same = global_index(df.repartition(13), hash32("key"), ["key"], "i", buckets=5).collect()
    assert {r.key: r.i for r in same} == {r.key: r.i for r in rows}


def test_rolling_mean(spark, frame):
    df = frame([("a", i, float(i)) for i in range(1, 6)], "installation string, n int, x double")
    assert [r.x_roll_4 for r in rolling_mean(df, ["x"], 4, ["n"]).orderBy("n").collect()] == [1, 1.5, 2, 2.5, 3.5]


def test_lags(spark, frame):
    df = frame([("a", f"2024-01-0{i}", float(i)) for i in (1, 2, 3)], "installation string, date date, a double")
    rows = with_lags(df, ["a"], [1, 2], drop_incomplete=False).orderBy("date").collect()
    assert [(r.a_lag_1, r.a_lag_2) for r in rows] == [(None, None), (1.0, None), (2.0, 1.0)]
    assert with_lags(df, ["a"], [1, 2]).count() == 1


def test_autocorrelation(spark, frame):
    df = frame([(i, float(i)) for i in range(1, 6)], "n int, x double")
    rows = autocorrelation(df, "x", ["n"]).orderBy("lag").collect()
    assert [r.acf for r in rows] == pytest.approx([1, 0.4, -0.1, -0.4, -0.4])
    assert [rows[1].variance, rows[2].variance] == pytest.approx([0.2, 0.264])


def test_mad(spark, frame):
    df = frame([(float(v) if v is not None else None,) for v in (1, 2, 3, 4, 100, None)], "value double")
    assert [r.value for r in mad_flags(df, []).filter("outlier").collect()] == [100.0]
    zero = mad_flags(frame([(5.0,), (5.0,), (5.0,), (9.0,)], "value double"), [])
    assert [r.value for r in zero.filter("outlier").collect()] == [9.0]
    r = outlier_thresholds(mad_flags(df, []), []).first()
    assert (r.lower, r.upper, r.share_below, r.share_above) == (1.0, 4.0, 0.0, 0.2)


def test_entropy_and_frequencies(spark, frame):
    df = frame([("a", "x")] * 9 + [("b", "x")], "c string, d string")
    assert {r.variable: r.norm_entropy for r in entropy(df, ["c", "d"]).collect()} == {"c": 0.47, "d": 0.0}
    r = {r.variable: r for r in frequency_extremes(df, ["c", "d"]).collect()}["c"]
    assert (r.most_value, r.most_n, r.least_value, r.least_n) == ("a", 9, "b", 1)


def test_correlation_is_pairwise_complete(spark, frame):
    df = frame([(1.0, 2.0), (2.0, 4.5), (3.0, None), (4.0, 8.0)], "x double, y double")
    got = {(r.col_a, r.col_b): (r.r, r.shown) for r in correlation_matrix(df).collect()}
    assert got[("x", "y")][0] == pytest.approx(0.995567, abs=1e-6) and got[("y", "x")][1] == 1.0


def test_overview_and_describe(spark, frame):
    df = frame([(1.0, "a"), (2.0, None), (None, "a"), (4.0, "b")], "x double, c string")
    o = {r.variable: r for r in overview(df).collect()}
    assert (o["c"].n_rows, o["c"].total, o["c"].missing, o["c"].n_uniques, o["x"].dtype) == (4, 3, 1, 2, "double")
    d = describe(df).first()
    assert (d["count"], d.q50, d.q25, d.min, d.max) == (3, 2.0, 1.5, 1.0, 4.0)
    v = deviation(df).first()
    assert (v.below, v.above) == (0.9, 1.1)


def test_histogram_and_ecdf(spark, frame):
    df = frame([("v", float(i)) for i in range(101)], "variable string, value double")
    bins = {r.bin: r.n for r in histogram(df, ["variable"], bins=10).collect()}
    assert bins == {**{i: 10 for i in range(9)}, 9: 11}
    subset = histogram(df, ["variable"], bins=10, subset=F.col("value") < 5).collect()
    assert [(r.bin, r.n) for r in subset] == [(0, 5)]
    steps = sorted((r.value, r.cumulative) for r in ecdf(df, ["variable"]).collect())
    assert steps[0][1] == pytest.approx(1 / 101) and steps[-1][1] == 1.0


def test_holdout(spark, frame):
    df = frame([(k, f"2024-01-{d:02d}") for k in "ab" for d in range(1, 11)], "installation string, date date")
    parts = chronological_holdout(df, 3).filter("installation = 'a'").orderBy("date").collect()
    assert [r.part for r in parts] == ["train"] * 8 + ["test"] * 2


def test_holdout_with_lag_gap(spark, frame):
    df = frame([("a", str(np.datetime64("2022-01-01") + i)) for i in range(400)], "installation string, date date")
    parts = [r.part for r in chronological_holdout(df, 365, lag=3).orderBy("date").collect()]
    assert parts == ["train_warmup"] * 3 + ["train"] * 30 + ["gap"] * 3 + ["test_warmup"] * 3 + ["test"] * 361


def test_random_split(spark):
    df = spark.range(20_000)
    a = {r.id: r.part for r in random_split(df, "id").collect()}
    b = {r.id: r.part for r in random_split(df.repartition(7), "id").collect()}
    assert a == b and 0.18 < sum(p == "test" for p in a.values()) / 20_000 < 0.22
    assert a != {r.id: r.part for r in random_split(df, "id", seed=387).collect()}


def test_curve_summary(spark, frame):
    df = frame([("r", s, v + d) for s, v in ((1, 1.0), (2, 2.0), (3, 4.0)) for d in (-0.5, 0.5)], "run string, train_size int, score double")
    rows = curve_summary(df, ["run"]).orderBy("train_size").collect()
    assert [r.smooth_score for r in rows] == pytest.approx([4 / 3, 7 / 3, 10 / 3])
    assert (rows[0].min_score, rows[0].max_score) == (1.0, 4.0)

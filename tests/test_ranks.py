"""Order statistics: sketches of bounded size, buckets that are cut again, partitions that change nothing."""

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from heliotab.operators import ranks

PROBS = {"q10": 0.1, "q50": 0.5, "q99": 0.99}


def values(seed=0, n=4000):
    rng = np.random.default_rng(seed)
    x = np.concatenate((rng.normal(size=n // 2), np.round(rng.normal(size=n // 4), 1), np.zeros(n // 4)))
    return [("a" if i % 3 else "b", float(v)) for i, v in enumerate(rng.permutation(x))] + [("a", None), ("a", float("nan")), ("c", None)]


def wanted(rows):
    out = {}
    for key in "ab":
        x = np.array([v for k, v in rows if k == key and v is not None and v == v])
        out[key] = tuple(float(np.quantile(x, p)) for p in PROBS.values())
    return out


def found(df):
    got = ranks.exact_quantiles(df, ["k"], "v", PROBS)
    return {r.k: (r.q10, r.q50, r.q99) for r in got.collect()}


@pytest.mark.parametrize("ordered,buckets", [(4_000_000, None), (50, 4), (1, 2), (10, 16)])
def test_buckets_cut_again_hold_the_same_ranks(frame, monkeypatch, ordered, buckets):
    monkeypatch.setattr(ranks, "ORDERED_ROWS", ordered)
    if buckets:
        monkeypatch.setattr(ranks, "BUCKETS", buckets)
    rows = values()
    got, want = found(frame(rows, "k string, v double")), wanted(rows)
    assert set(got) == set(want)
    for key in want:
        assert got[key] == pytest.approx(want[key], abs=1e-12)


def test_no_rows_and_one_value(frame):
    assert found(frame([], "k string, v double")) == {}
    assert found(frame([("a", 2.0)] * 5 + [("b", None)], "k string, v double")) == {"a": (2.0, 2.0, 2.0)}


def test_sketches_merge_over_levels_of_many_partitions(spark):
    """More input tasks than one merge takes: the cuts still deal the rows out evenly."""
    n = 60_000
    df = spark.range(n, numPartitions=600).select((F.xxhash64("id") / 2.0**40).alias("v"))
    cuts = ranks.cut_points(df, "v", 64)
    assert len(cuts) == 63
    counts = [r["count"] for r in ranks.with_bucket(df, "v", cuts).groupBy(ranks.BUCKET).count().collect()]
    assert len(counts) == 64 and max(counts) < 2 * n / 64


def test_cost_does_not_grow_with_the_number_of_partitions(spark):
    df = spark.range(10_000, numPartitions=4).select((F.xxhash64("id") / 2.0**40).alias("v"))
    ranks.cut_points(df, "v")  # start-up
    before, seconds = spark.conf.get("spark.sql.shuffle.partitions"), {}
    try:
        for partitions in (8, 20_000):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            start = time.time()
            assert len(ranks.cut_points(df, "v")) == ranks.BUCKETS - 1
            seconds[partitions] = time.time() - start
            assert ranks.hash_ranges(spark) <= 16_384
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert seconds[20_000] < seconds[8] + 2

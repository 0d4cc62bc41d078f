import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from heliotab.llm import nearest

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, k=20, every=20):
    ok = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    out = {}
    for q, x in ok:
        if q % every == 0:
            scores = sorted((-float(x @ y), i) for i, y in ok if i != q)
            out[q] = [(i, -s) for s, i in scores[:k]]
    return out


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).withColumn("vec", F.lit("clash")).withColumn("rank", F.lit(1))
    out = {}
    for r in sorted(nearest.search(df, **kw).collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return out


def recall(got, want):
    hit = sum(len({v for _, v, _ in got[q]} & {i for i, _ in w}) for q, w in want.items())
    return hit / sum(map(len, want.values()))


@pytest.mark.parametrize("tile,query_tile", [(20_000, 2_000), (40, 3)])
def test_recall_and_order(spark, tile, query_tile):
    rng = np.random.default_rng(1)
    centers = rng.normal(size=(12, 24)) * 2
    rows = [(i, (centers[i % 12] + rng.normal(size=24)).tolist()) for i in range(1500)]
    got, want = run(spark, rows, tile=tile, query_tile=query_tile), brute(rows)
    assert set(got) == set(want) and recall(got, want) > 0.9
    vectors = {i: np.array(v, np.float32).astype(float) for i, v in rows}
    for q, found in got.items():
        assert [r for r, _, _ in found] == list(range(1, 21))
        assert all(abs(s - vectors[q] @ vectors[v]) < 1e-9 and v != q for _, v, s in found)
        assert [(-s, v) for _, v, s in found] == sorted((-s, v) for _, v, s in found)


def test_hot_vector_ties_and_bad_rows(spark):
    rng = random.Random(2)
    hot = [1.0, 2.0, 0.5]
    rows = [(i, hot) for i in range(300, 500)] + [(i, [rng.gauss(0, 1) for _ in range(3)]) for i in range(40)]
    rows += [(1000, None), (1020, []), (1040, [0.0, 0.0, 0.0]), (1060, [1.0, None, 2.0]), (1080, [float("nan"), 1.0, 1.0]), (1100, [float("inf"), 1.0, 1.0])]
    rows += [(None, hot), (320, hot), (320, hot)]
    got, want = run(spark, rows), brute(list(dict.fromkeys((i, tuple(v) if v is not None else None) for i, v in rows)))
    assert set(got) == set(want) == {0, 20, 300, 320, 340, 360, 380, 400, 420, 440, 460, 480}
    for q in want:
        # Equal vectors have exactly equal scores, so the ids are the least ones.
        assert [v for _, v, _ in got[q]] == [i for i, _ in want[q]]


def test_few_candidates_and_none(spark):
    assert run(spark, [(0, [1.0, 0.0]), (20, [0.0, 1.0]), (3, [1.0, 1.0])]) == {0: [(1, 3, 1.0), (2, 20, 0.0)], 20: [(1, 3, 1.0), (2, 0, 0.0)]}
    assert run(spark, [(1, [1.0])]) == {}
    assert run(spark, []) == {}


def test_scan_keeps_the_nearest():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(5000, 65))
    hit = 0
    for _ in range(20):
        q = rng.normal(size=65)
        kept = nearest.adaptive_scan(np.asfortranarray(x), q, 21)
        best = np.argsort(((x - q) ** 2).sum(axis=1))[:21]
        hit += len(set(best) & set(kept))
    assert hit / (20 * 21) > 0.95

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from heliotab.llm import caps
from heliotab.llm.registry import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int"


def usable(v, label):
    return label is not None and bool(v) and None not in v and all(map(math.isfinite, v)) and any(v)


def brute(rows, cosine=0.93):
    """[(vec_id, n_links, component_id, kept)] by all pairs."""
    unit = [np.array(v, np.float32).astype(float) if usable(v, label) else None for _, v, label in rows]
    unit = [u if u is None else u / np.linalg.norm(u) for u in unit]
    near = {i: [] for i in range(len(rows))}
    for i, x in enumerate(unit):
        for j, y in enumerate(unit):
            if i != j and x is not None and y is not None and rows[i][2] == rows[j][2] and len(x) == len(y) and x @ y >= cosine:
                near[i].append(j)
    out = []
    for i, (vec_id, _, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        least = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out.append((vec_id, len(near[i]), least, vec_id == least))
    return sorted(out, key=repr)


def run(spark, rows, **kw):
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"vec": F.lit("clash"), "num": F.lit(1), "weight": F.lit("x")})
    return sorted((tuple(r) for r in caps.near_duplicates(df, **kw).collect()), key=repr)


def clustered(n, d, seed, spread):
    """Vectors around a few centres, many of them near the threshold."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(9, d))
    return [(i, (centres[i % 9] + spread * rng.normal(size=d)).tolist(), i % 2) for i in range(n)]


@pytest.mark.parametrize("d", [2, 3, 17, 64])
def test_equals_brute_force(spark, d):
    rows = clustered(300, d, d, 0.12)
    got, want = run(spark, rows), brute(rows)
    assert sum(w[1] for w in want) > 1000
    # Not one link is below the threshold, and at most a few at the threshold are missed.
    links = {w[0]: w[1] for w in want}
    assert all(g[1] <= links[g[0]] for g in got)
    assert sum(g[1] for g in got) >= 0.99 * sum(links.values())


@pytest.mark.parametrize("tile,shared", [(4096, 36), (40, 36), (40, 1), (7, 2)])
def test_tiles_and_parts_change_nothing(spark, tile, shared):
    rows = clustered(400, 24, 5, 0.1)
    assert run(spark, rows, tile=tile, shared=shared) == brute(rows)


def test_hot_group_is_counted_whole(spark):
    rng = np.random.default_rng(1)
    hot = rng.normal(size=16)
    rows = [(i, (hot + 0.02 * rng.normal(size=16)).tolist(), 0) for i in range(200)] + clustered(100, 16, 2, 1.0)[:100]
    rows = [(i, v, 0) for i, (_, v, _) in enumerate(rows)]
    assert run(spark, rows, tile=30) == brute(rows)


def test_defined_results(spark):
    a, b = [1.0, 2.0, 0.5], [0.0, 1.0, -3.0]
    rows = [(5, a, 0), (3, a, 0), (3, a, 0), (2, a, 1), (1, a, None), (None, a, 0), (None, b, 0), (7, [2.0, 4.0, 1.0], 0)]
    rows += [(10, None, 0), (11, [], 0), (12, [0.0, 0.0, 0.0], 0), (13, [1.0, None, 0.5], 0), (14, [float("nan"), 1.0, 1.0], 0)]
    rows += [(15, [float("inf"), 1.0, 1.0], 0), (16, [1.0, 2.0], 0), (17, [-1.0, -2.0, -0.5], 0), (18, [1e-38, 2e-38, 5e-39], 0), (19, [3e38, 2e38, 0.0], 0)]
    got, want = run(spark, rows), brute(rows)
    # A row without an id that links with nothing is kept.
    assert got == sorted(((*w[:3], True) if w[0] is None and w[2] is None else w for w in want), key=repr)
    assert run(spark, []) == []


def test_one_dimension_and_double_components(spark):
    df = spark.createDataFrame([(1, [2.0], "x"), (2, [0.1], "x"), (3, [-1.0], "x"), (4, [1e300], "x")], "vec_id long, embedding array<double>, label string")
    got = sorted(tuple(r) for r in caps.near_duplicates(df).collect())
    assert got == [(1, 2, 1, True), (2, 2, 1, False), (3, 0, 3, True), (4, 2, 1, False)]


def test_list_decoding_finds_all_directions():
    rng = np.random.default_rng(3)
    x = caps.unit_rows(rng.normal(size=(50, 20)))
    row, name = caps.list_decode(x, 16, 0.3)
    found, base = set(zip(row.tolist(), name.tolist())), 0
    want = set()
    for rotation, (c0, c1) in caps.codes(20, 16):
        for i in range(16):
            for j in range(16):
                direction = rotation @ np.concatenate((c0[i], c1[j]))
                want |= {(int(r), base + 16 * i + j) for r in np.flatnonzero(x @ direction >= 0.3)}
        base += 256
    assert found == want and len(found) > 50


def test_more_codewords_for_larger_classes():
    assert [caps.codewords(n) for n in (0, 5_000, 100_000, 10**6, 10**9)] == [16, 16, 16, 64, 256]


def test_registered_query(spark, sf):
    rows = clustered(120, 32, 9, 0.1)
    folder = sf(embeddings=spark.createDataFrame(rows, SCHEMA))
    assert sorted((tuple(r) for r in QUERIES["op11_embedding_near_dedup"](spark, folder).collect()), key=repr) == brute(rows)

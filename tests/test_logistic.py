"""The classifier against a plain optimiser on small data; wide sums as a tree of blocks."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from heliotab.operators import models
from heliotab.operators.logistic import classifier_curve, classify, logistic_fit, probability
from heliotab.operators.metrics import permutation_importance

CLASSES, XS = ["a", "b", "c"], ["x0", "x1"]


def data(seed=0, n=240):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 2)) * (1, 3) + (0, 5)
    y = np.argmax(x @ np.array([[1, -1, 0.3], [0.2, 0.1, -0.4]]) + rng.gumbel(size=(n, 3)), axis=1)
    return [(i, int(i % 2), CLASSES[y[i]], float(x[i, 0]), float(x[i, 1])) for i in range(n)]


def gradient_descent(rows, penalty=1.0):
    """Newton's method with a numeric Hessian would do; here plain, slow and independent: many damped gradient steps."""
    x = np.array([[r[3], r[4], 1.0] for r in rows])
    y = np.eye(3)[[CLASSES.index(r[2]) for r in rows]]
    scale = np.array([1.0, 1.0, 0.0]) * penalty
    w, step = np.zeros((3, 3)), 1.0 / (0.5 * np.linalg.eigvalsh(x.T @ x).max() + penalty)
    v = w.copy()
    for t in range(60_000):  # Nesterov's accelerated steps
        z = np.exp(v @ x.T - (v @ x.T).max(axis=0))
        g = (z / z.sum(axis=0) - y.T) @ x + scale * v
        new = v - step * g
        v, w = new + t / (t + 3) * (new - w), new
    w[:, 2] -= w[:, 2].mean()
    return w


def test_equals_a_plain_optimiser_for_every_key(frame):
    rows = data()
    df = frame(rows, "id long, k int, y string, x0 double, x1 double").repartition(5)
    for keys, parts in (((), {(): rows}), (("k",), {(i,): [r for r in rows if r[1] == i] for i in (0, 1)})):
        got = {}
        for r in logistic_fit(df, XS, "y", CLASSES, keys).collect():
            got.setdefault(tuple(r[k] for k in keys), {})[r.label] = [*r.coefficients, r.intercept]
        for key, part in parts.items():
            assert np.allclose([got[key][c] for c in CLASSES], gradient_descent(part), atol=1e-5)


def test_probabilities_importance_and_curve(frame):
    df = frame(data(1), "id long, k int, y string, x0 double, x1 double")
    model = logistic_fit(df, XS, "y", CLASSES).orderBy("label").collect()
    of = probability(model, {x: F.col(x) for x in XS}, XS)
    sums = df.agg(F.min(sum(of.values())), F.max(sum(of.values()))).first()
    assert sums[0] == pytest.approx(1) and sums[1] == pytest.approx(1)
    drops = permutation_importance(df, "id", XS, "y", classify(model, XS))
    value = next(c for c in drops.columns if c != "feature")
    found = {r.feature: r[value] for r in drops.collect()}
    assert set(found) == set(XS) and max(found.values()) > 0.05
    curve = classifier_curve(df, XS, "y", CLASSES, "id", shares=(0.5, 1.0)).collect()
    assert len(curve) == 10 and all(0.3 < r.validation_score <= 1 and 0.3 < r.train_score <= 1 for r in curve)


def test_separable_and_bad_rows(frame):
    df = frame([(i, "a" if i < 5 else "b", float(i)) for i in range(10)], "id long, y string, x double")
    model = {r.label: r for r in logistic_fit(df, ["x"], "y", ["a", "b"]).collect()}
    assert model["b"].coefficients[0] > 0 and abs(model["a"].coefficients[0] + model["b"].coefficients[0]) < 1e-9
    for bad in ([(1, "z", 1.0)], [(1, "a", None)], [(1, None, 1.0)]):
        with pytest.raises(Exception, match="not listed"):
            logistic_fit(frame(bad, "id long, y string, x double"), ["x"], "y", ["a", "b"]).collect()


@pytest.mark.parametrize("keys", [[], ["k"]])
def test_wide_sums_as_a_tree_of_blocks(spark, monkeypatch, keys):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 23)) + 1e4
    names = [f"c{i}" for i in range(23)]
    df = spark.createDataFrame([(i % 2 if i % 7 else None, *map(float, r)) for i, r in enumerate(x)], ["k", *names]).repartition(9)
    monkeypatch.setattr(models, "GRAM_BLOCK", 5)
    monkeypatch.setattr(models, "GRAM_FAN", 2)
    got = {tuple(r[k] for k in keys): r for r in models.gram(df, keys, names[:20], names[20:]).collect()}
    groups = {(): np.arange(300)} if not keys else {
        (v,): np.array([i for i in range(300) if (i % 2 if i % 7 else None) == v]) for v in (0, 1, None)
    }
    assert set(got) == set(groups)
    for key, rows in groups.items():
        part = x[rows]
        c, r = part - part.mean(axis=0), got[key]
        assert r.n == len(rows) and np.allclose(r.mx, part[:, :20].mean(axis=0), rtol=1e-12)
        assert np.allclose(r.xx, (c[:, :20].T @ c[:, :20])[np.triu_indices(20)], atol=1e-6)
        assert np.allclose(r.xy, (c[:, :20].T @ c[:, 20:]).ravel(), atol=1e-6) and np.allclose(r.yy, (c[:, 20:] ** 2).sum(axis=0), atol=1e-6)

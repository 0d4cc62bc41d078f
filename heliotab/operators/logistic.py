"""Multinomial logistic regression by Newton steps on sums that Spark adds up."""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import hash32
from .metrics import weighted_f1

STEPS = 50
HALVINGS = 30
TOLERANCE = 1e-10  # of the penalised loss, relative

Models = dict[tuple, np.ndarray]  # key -> coefficients, a row per class; the intercept comes last


def _probabilities(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    z = x @ w.T
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def _passed(rows: DataFrame, keys: list[str], d: int, classes: int, models: Models) -> dict[tuple, np.ndarray]:
    """Per key: loss, gradient and Hessian at its coefficients, in one pass.

    A task adds up its rows and emits one row of sums per key; Spark adds those element by element, so what
    reaches the driver are as many numbers as the models have.
    """
    p = classes * (d + 1)
    sent = rows.sparkSession.sparkContext.broadcast(models)
    key_ddl = "".join(f"{k} {rows.schema[k].dataType.simpleString()}, " for k in keys)

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple, np.ndarray] = {}
        for pdf in batches:
            groups = pdf.groupby(keys, sort=False) if keys else [((), pdf)]
            for key, part in groups:
                key = tuple(x.item() if hasattr(x, "item") else x for x in key)
                if key not in sent.value or not len(part):
                    continue
                x = np.column_stack((part.iloc[:, len(keys) + 1 :].to_numpy(float), np.ones(len(part))))
                y = part["_y"].to_numpy()
                q = _probabilities(x, sent.value[key])
                loss = -np.log(np.maximum(q[np.arange(len(y)), y], 1e-300)).sum()
                gap = q.copy()
                gap[np.arange(len(y)), y] -= 1
                hessian = np.zeros((classes, d + 1, classes, d + 1))
                for a in range(classes):
                    for b in range(a, classes):
                        w = q[:, a] * ((a == b) - q[:, b])
                        hessian[a, :, b, :] = hessian[b, :, a, :] = (x * w[:, None]).T @ x
                got = np.concatenate(([loss], (gap.T @ x).ravel(), hessian.reshape(p, p).ravel()))
                held[key] = held.get(key, 0) + got
        yield pd.DataFrame([(*k, v) for k, v in held.items()], columns=[*keys, "sums"])

    partial = rows.mapInPandas(sums, f"{key_ddl}sums array<double>")
    added = partial.select(*keys, F.posexplode("sums").alias("place", "value")).groupBy(*keys, "place").agg(F.sum("value").alias("value"))
    out: dict[tuple, np.ndarray] = {}
    for r in added.collect():
        out.setdefault(tuple(r[k] for k in keys), np.zeros(1 + p + p * p))[r.place] = r.value
    return out


def logistic_fit(
    df: DataFrame, xs: list[str], label: str, classes: list, keys: tuple[str, ...] = (), penalty: float = 1.0, steps: int = STEPS
) -> DataFrame:
    """One row per key and class: coefficients and intercept of the penalised maximum likelihood.

    Minimises the sum of -log p(label) plus ``penalty`` / 2 times the squared coefficients (intercepts are free and
    sum to zero). A missing feature or a label that is not listed fails the job. All keys take their Newton steps in the same passes;
    their models are held on the driver, so keys are for tens or hundreds of models.
    """
    keys, d, k = list(keys), len(xs), len(classes)
    number = F.array_position(F.array(*[F.lit(c) for c in classes]), F.col(label)) - 1
    whole = F.lit(True)
    for c in xs:
        whole = whole & F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    rows = df.filter(F.assert_true(F.coalesce(whole & (number >= 0), F.lit(False)), "a feature is missing or a label is not listed").isNull())
    rows = rows.select(*keys, number.cast("int").alias("_y"), *[F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(xs)])
    names = [tuple(r) for r in rows.select(*keys).distinct().collect()] if keys else [()]
    free = np.tile(np.append(np.full(d, penalty), 0.0), k)
    models: Models = {n: np.zeros((k, d + 1)) for n in names}
    last: dict[tuple, tuple] = {}
    open_ = dict(models)
    for _ in range(steps):
        if not open_:
            break
        for key, sums in _passed(rows, keys, d, k, open_).items():
            w = open_[key].ravel()
            loss = sums[0] + 0.5 * (free * w * w).sum()
            if key in last and not loss <= last[key][0] + TOLERANCE * abs(last[key][0]):
                # too far: half the step, from the last good place
                _, good, step, n = last[key]
                last[key] = last[key][0], good, step / 2, n + 1
                open_[key] = (good + step / 2).reshape(k, -1)
                if n >= HALVINGS:
                    models[key] = good.reshape(k, -1)
                    del open_[key]
                continue
            gradient, hessian = sums[1 : 1 + w.size] + free * w, sums[1 + w.size :].reshape(w.size, -1) + np.diag(free)
            step = -np.linalg.lstsq(hessian, gradient, rcond=1e-12)[0]
            models[key] = w.reshape(k, -1)
            if np.abs(gradient).max() <= 1e-9 * max(1.0, loss):
                del open_[key]
                continue
            last[key] = loss, w, step, 0
            open_[key] = (w + step).reshape(k, -1)
    spark, kinds = df.sparkSession, "".join(f"{c} {rows.schema[c].dataType.simpleString()}, " for c in keys)
    out = [
        (*key, c, [float(v) for v in w[i, :d]], float(w[i, d] - w[:, d].mean())) for key, w in models.items() for i, c in enumerate(classes)
    ]
    kind = df.schema[label].dataType.simpleString()
    return spark.createDataFrame(out, f"{kinds}label {kind}, coefficients array<double>, intercept double")


def class_values(model: list, values: dict[str, Column], xs: list[str]) -> list[tuple[object, Column]]:
    """(label, linear value) of every class of a collected model."""
    out = []
    for r in model:
        total = F.lit(r.intercept)
        for w, x in zip(r.coefficients, xs):
            total = total + F.lit(w) * values[x].cast("double")
        out.append((r.label, total))
    return out


def probability(model: list, values: dict[str, Column], xs: list[str]) -> dict[object, Column]:
    """Probability of every class as a column expression."""
    linear = class_values(model, values, xs)
    top = F.greatest(*[v for _, v in linear]) if len(linear) > 1 else linear[0][1]
    total = sum((F.exp(v - top) for _, v in linear), F.lit(0.0))
    return {c: F.exp(v - top) / total for c, v in linear}


def classify(model: list, xs: list[str]):
    """The likeliest class as a function of feature columns, as ``permutation_importance`` takes it."""

    def predict(values: dict[str, Column]) -> Column:
        linear = class_values(model, values, xs)
        best = F.array_max(F.array(*[F.struct(v.alias("v"), F.lit(-i).alias("i"), F.lit(c).alias("label")) for i, (c, v) in enumerate(linear)]))
        return best["label"]

    return predict


def classifier_curve(
    df: DataFrame, xs: list[str], label: str, classes: list, key: str, folds: int = 5, shares: tuple[float, ...] = tuple(i / 10 for i in range(1, 11)),
    penalty: float = 1.0, order: Column | None = None,
) -> DataFrame:
    """Weighted F1 on train subset and held-out fold for nested train sizes (fold, share, train_score, validation_score).

    Fold and train subset follow from a hash of the key, so subsets are nested and nothing is sorted; all models
    are fitted in the same passes.
    """
    h = order if order is not None else hash32(key)
    place = F.pmod(F.floor(h / folds), F.lit(1 << 20)) / F.lit(float(1 << 20))
    sizes = F.array(*[F.lit(float(s)) for s in shares])
    rows = df.select(key, label, *xs).withColumns({"_own": F.pmod(h, F.lit(folds)).cast("int"), "_place": place})
    rows = rows.withColumn("fold", F.explode(F.sequence(F.lit(0), F.lit(folds - 1)))).withColumn("share", F.explode(sizes))
    train = rows.filter((F.col("fold") != F.col("_own")) & (F.col("_place") < F.col("share")))
    model = logistic_fit(train, xs, label, classes, ("fold", "share"), penalty)
    fitted = model.groupBy("fold", "share").agg(F.array_sort(F.collect_list(F.struct("label", "coefficients", "intercept"))).alias("_m"))
    features = F.array(*[F.col(x).cast("double") for x in xs])
    value = lambda m: m["intercept"] + F.aggregate(F.zip_with(m["coefficients"], features, lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
    scored = rows.filter((F.col("fold") == F.col("_own")) | (F.col("_place") < F.col("share"))).join(F.broadcast(fitted), ["fold", "share"])
    best = F.array_max(F.transform("_m", lambda m, i: F.struct(value(m).alias("v"), (-i).alias("i"), m["label"].alias("label"))))["label"]
    counts = (
        scored.select("fold", "share", (F.col("fold") == F.col("_own")).alias("held"), F.col(label).alias("truth"), best.alias("pred"))
        .groupBy("fold", "share", "held", "truth", "pred").agg(F.count("*").alias("n"))
    )
    f1 = weighted_f1(counts, ["fold", "share", "held"])
    return f1.groupBy("fold", "share").agg(
        F.max(F.when(~F.col("held"), F.col("f1"))).alias("train_score"), F.max(F.when(F.col("held"), F.col("f1"))).alias("validation_score")
    )

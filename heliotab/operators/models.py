"""Climatology and ridge models, fitted for all installations in one pass each.

Ridge needs only sums over the rows (counts, means and cross products), which Spark adds up
with map-side combine. What is left per model is a row with d x d numbers; solving it is the
one place where NumPy runs, inside tasks, one small row per model.
"""

from collections.abc import Iterable, Iterator
from functools import reduce
from operator import and_

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import hash32, sum_or_zero
from ..functions.timeparts import hour_of_year
from ..session import join_stats, settle
from .ranks import global_index

# --------------------------------------------------------------------------- climatology


def climatology_daily_fit(df: DataFrame, value: str = "sol_prod", date: str = "date", keys=("installation",)) -> DataFrame:
    """Mean over years of the yearly sums per day of year; day 366 borrows day 365 if never seen."""
    keys = list(keys)
    yearly = df.groupBy(*keys, F.dayofyear(date).alias("doy"), F.year(date).alias("_y")).agg(
        sum_or_zero(value).alias("_s")
    )
    means = yearly.groupBy(*keys, "doy").agg(F.avg("_s").alias("pred"))
    return _borrow(means, keys, "doy", 365, 365, 1)


def climatology_hourly_fit(df: DataFrame, value: str = "sol_prod", ts: str = "timestamp", keys=("installation",)) -> DataFrame:
    """The same per hour of year; the hours of day 366 borrow those of the day before."""
    keys = list(keys)
    yearly = df.groupBy(*keys, hour_of_year(ts).alias("hoy"), F.year(ts).alias("_y")).agg(
        sum_or_zero(value).alias("_s")
    )
    means = yearly.groupBy(*keys, "hoy").agg(F.avg("_s").alias("pred"))
    return _borrow(means, keys, "hoy", 8736, 8759, 24)


def _borrow(means: DataFrame, keys: list[str], position: str, first: int, last: int, shift: int) -> DataFrame:
    lent = means.filter(F.col(position).between(first, last)).withColumn(
        position, (F.col(position) + shift).cast("int")
    )
    seen = means.select(*keys, position)
    return settle(means.unionByName(lent.join(seen, [*keys, position], "left_anti")), "climatology")


def climatology_predict(df: DataFrame, model: DataFrame, position: Column, name: str, keys=("installation",)) -> DataFrame:
    """Look the position up; a position the model never saw gets null."""
    return df.withColumn(name, position.cast("int")).join(model, [*keys, name], "left")


# --------------------------------------------------------------------------- ridge


def gram(df: DataFrame, keys: list[str], xs: list[str], ys: list[str], nulls: str = "raise") -> DataFrame:
    """Per key: n, means, and centred cross products of features and targets.

    The products are covariances times n, which Spark merges without cancellation, so a large offset
    costs no digits. A row with a missing value fails the job; ``nulls="drop"`` leaves such rows out.
    """
    complete = df.dropna(subset=[*xs, *ys])
    if nulls != "drop":
        whole = reduce(and_, [F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) for c in [*xs, *ys]])
        complete = df.filter(F.assert_true(whole, "a feature or target is missing").isNull())
    if len(xs) > WIDE:
        return _wide_gram(complete, keys, xs, ys)
    x, y = [F.col(c).cast("double") for c in xs], [F.col(c).cast("double") for c in ys]
    d, n = len(xs), F.count("*")
    return complete.groupBy(*keys).agg(
        n.alias("n"),
        F.array(*[F.avg(a) for a in x]).alias("mx"),
        F.array(*[F.avg(b) for b in y]).alias("my"),
        F.array(*[F.covar_pop(x[i], x[j]) * n for i in range(d) for j in range(i, d)]).alias("xx"),
        F.array(*[F.covar_pop(a, b) * n for a in x for b in y]).alias("xy"),
        F.array(*[F.var_pop(b) * n for b in y]).alias("yy"),
    )


# Columns beyond which d * d aggregate expressions are more than Spark compiles well.
WIDE = 16


# Columns of a block of the matrix of sums, and rows of sums that are merged together.
GRAM_BLOCK = 256
GRAM_FAN = 256


def _merge_tiles(rows: Iterable[dict]) -> dict:
    """Sums of disjoint sets of rows as one: counts, means of two blocks of columns and their centred products."""
    total = None
    for b in rows:
        b = {"n": float(b["n"])} | {k: np.asarray(b[k], float) for k in ("mi", "mj", "c")}
        if total is None:
            total = b
            continue
        a, n = total, total["n"] + b["n"]
        di, dj, w = b["mi"] - a["mi"], b["mj"] - a["mj"], a["n"] * b["n"] / n
        total = {"n": n, "mi": a["mi"] + di * b["n"] / n, "mj": a["mj"] + dj * b["n"] / n, "c": a["c"] + b["c"] + w * np.outer(di, dj).ravel()}
    return total


def _wide_gram(complete: DataFrame, keys: list[str], xs: list[str], ys: list[str]) -> DataFrame:
    """``gram`` of many features: matrix products per Arrow batch, totalled per key and task, merged as a tree.

    All columns meet in square blocks of ``GRAM_BLOCK``; a task emits one row per key and block, however many
    batches it reads, and ``GRAM_FAN`` neighbouring tasks are merged at each level, so no task holds more than so
    many blocks of a key, hot or not. Levels follow the number of shuffle partitions.
    """
    d, m = len(xs), len(ys)
    cuts = [slice(i, min(i + GRAM_BLOCK, d + m)) for i in range(0, d + m, GRAM_BLOCK)]
    doubles = [F.col(c).cast("double").alias(f"_{i}") for i, c in enumerate([*xs, *ys])]
    names = ["bi", "bj", "n", "mi", "mj", "c"]
    kinds = "bi int, bj int, n bigint, mi array<double>, mj array<double>, c array<double>"
    ddl = _key_ddl(complete, keys) + f"_part int, {kinds}"

    def parts(pdf: pd.DataFrame):
        if not keys:
            return [((), pdf)] if len(pdf) else []
        return [(k, p) for k, p in pdf.groupby(keys, dropna=False, sort=False)]

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple, tuple] = {}

        def emit() -> pd.DataFrame:
            out = []
            for n, mean, c, key in held.values():
                out += [(*key, part, i, j, n, mean[a], mean[b], c[a, b].ravel()) for i, a in enumerate(cuts) for j, b in enumerate(cuts) if i <= j]
            held.clear()
            return pd.DataFrame(out, columns=[*keys, "_part", *names])

        part = TaskContext.get().partitionId()
        for pdf in batches:
            for key, rows in parts(pdf):
                values = rows.iloc[:, len(keys) :].to_numpy(float)
                n, mean = len(values), values.mean(axis=0)
                c = values - mean
                c = c.T @ c
                name = tuple("" if x != x else x for x in key)  # NaN equals nothing
                if name in held:
                    n0, mean0, c0, _ = held[name]
                    step = mean - mean0
                    c = c + c0 + n0 * n / (n0 + n) * np.outer(step, step)
                    n, mean = n0 + n, mean0 + step * n / (n0 + n)
                held[name] = n, mean, c, key
            if len(held) * (d + m) ** 2 > 1 << 23:  # 64 MB of sums, where keys are many
                yield emit()
        yield emit()

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        total = _merge_tiles(pdf.to_dict("records"))
        out = pdf[[*keys, "_part", "bi", "bj"]].head(1).reset_index(drop=True)
        return out.assign(n=int(total["n"]), **{k: [total[k]] for k in ("mi", "mj", "c")})

    def whole(pdf: pd.DataFrame) -> pd.DataFrame:
        """The blocks of one key as one row."""
        mean, c = np.zeros(d + m), np.zeros((d + m, d + m))
        for (i, j), tiles in pdf.groupby(["bi", "bj"]):
            t = _merge_tiles(tiles.to_dict("records"))
            mean[cuts[i]], mean[cuts[j]] = t["mi"], t["mj"]
            c[cuts[i], cuts[j]] = t["c"].reshape(len(t["mi"]), -1)
            c[cuts[j], cuts[i]] = c[cuts[i], cuts[j]].T
        arrays = {"mx": mean[:d], "my": mean[d:], "xx": c[:d, :d][np.triu_indices(d)], "xy": c[:d, d:].ravel(), "yy": np.diag(c)[d:]}
        return pdf[keys].head(1).reset_index(drop=True).assign(n=int(t["n"]), **{k: [v] for k, v in arrays.items()})

    rows = complete.select(*keys, *doubles).mapInPandas(sums, ddl)
    width, block = int(complete.sparkSession.conf.get("spark.sql.shuffle.partitions")), [*keys, "bi", "bj"]
    while width > GRAM_FAN:
        rows = rows.withColumn("_part", F.floor(F.col("_part") / GRAM_FAN).cast("int")).groupBy(*block, "_part").applyInPandas(merge, ddl)
        width //= GRAM_FAN
    out = _key_ddl(complete, keys) + "n bigint, mx array<double>, my array<double>, xx array<double>, xy array<double>, yy array<double>"
    return rows.groupBy(*keys).applyInPandas(whole, out)


def _centred(row, d: int, m: int):
    """Means, centred X'X, X'Y and diag(Y'Y) of one Gram row."""
    xx = np.zeros((d, d))
    xx[np.triu_indices(d)] = np.asarray(row["xx"], float)
    xx = xx + np.triu(xx, 1).T
    arrays = [np.asarray(row[k], float) for k in ("mx", "my", "xy", "yy")]
    return float(row["n"]), arrays[0], arrays[1], xx, arrays[2].reshape(d, m), arrays[3]


def _merged(a: dict, b: dict, d: int) -> dict:
    """Gram rows of two disjoint sets of rows as one."""
    n = a["n"] + b["n"]
    dx, dy, w = b["mx"] - a["mx"], b["my"] - a["my"], a["n"] * b["n"] / n
    return {
        "n": n,
        "mx": a["mx"] + dx * b["n"] / n,
        "my": a["my"] + dy * b["n"] / n,
        "xx": a["xx"] + b["xx"] + w * np.outer(dx, dx)[np.triu_indices(d)],
        "xy": a["xy"] + b["xy"] + w * np.outer(dx, dy).ravel(),
        "yy": a["yy"] + b["yy"] + w * dy * dy,
    }


def _key_ddl(grams: DataFrame, keys: list[str]) -> str:
    return "".join(f"{k} {grams.schema[k].dataType.simpleString()}, " for k in keys)


def ridge_fit(
    df: DataFrame,
    xs: list[str],
    ys: list[str],
    keys: tuple[str, ...] = ("installation",),
    alphas: tuple[float, ...] = (1.0,),
    with_inverse: bool = False,
    nulls: str = "raise",
) -> DataFrame:
    """One settled row per key, alpha and target: intercept and coefficients (intercept unpenalised).

    ``with_inverse`` adds what leave-one-out errors need: the feature means and the inverse.
    """
    keys, d, m = list(keys), len(xs), len(ys)
    grams = gram(df, keys, xs, ys, nulls)

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for row in batch.to_dict("records"):
                n, mx, my, xx, xy, _ = _centred(row, d, m)
                for alpha in alphas:
                    penalised = xx + alpha * np.eye(d)
                    w = np.linalg.solve(penalised, xy)
                    inverse = np.linalg.inv(penalised) if with_inverse else None
                    for t, target in enumerate(ys):
                        record = {k: row[k] for k in keys} | {
                            "alpha": float(alpha),
                            "target": target,
                            "n": int(n),
                            "intercept": float(my[t] - mx @ w[:, t]),
                            "coefficients": w[:, t].tolist(),
                        }
                        if with_inverse:
                            record |= {"means": mx.tolist(), "inverse": inverse.ravel().tolist()}
                        out.append(record)
            yield pd.DataFrame(out, columns=names)

    ddl = _key_ddl(grams, keys) + (
        "alpha double, target string, n bigint, intercept double, coefficients array<double>"
    )
    names = [*keys, "alpha", "target", "n", "intercept", "coefficients"]
    if with_inverse:
        ddl += ", means array<double>, inverse array<double>"
        names += ["means", "inverse"]
    return settle(grams.mapInPandas(solve, ddl), "ridge")


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda v, w: v * w), F.lit(0.0), lambda s, v: s + v)


def linear_value(xs: list[str], coefficients: str = "coefficients", intercept: str = "intercept") -> Column:
    if len(xs) <= WIDE:
        return sum((F.col(coefficients)[i] * F.col(x) for i, x in enumerate(xs)), F.col(intercept))
    values = F.array(*[F.col(x).cast("double") for x in xs])
    return F.col(intercept) + _dot(values, F.col(coefficients))


def ridge_predict(df: DataFrame, model: DataFrame, xs: list[str], keys: tuple[str, ...] = ("installation",), out: str = "pred") -> DataFrame:
    """Single-target prediction as a plain column expression."""
    weights = model.select(*keys, "intercept", "coefficients")
    return join_stats(df, weights, list(keys)).withColumn(out, linear_value(xs)).drop("intercept", "coefficients")


def ridge_predict_multi(df: DataFrame, model: DataFrame, xs: list[str], ys: list[str], keys=("installation",)) -> DataFrame:
    """Long predictions (target, y, pred): every target of a row from its model row."""
    targets = F.explode(F.array(*[F.struct(F.lit(t).alias("target"), F.col(t).cast("double").alias("y")) for t in ys]))
    long = df.withColumn("_t", targets).select(*df.columns, "_t.target", "_t.y")
    weights = model.select(*keys, "target", "intercept", "coefficients")
    return (
        long.join(weights, [*keys, "target"], "left")
        .withColumn("pred", linear_value(xs))
        .drop("intercept", "coefficients", *xs, *[y for y in ys if y not in xs])
    )


def ridge_cv(
    df: DataFrame, xs: list[str], y: str, keys: tuple[str, ...] = ("installation",), alphas=(0.1, 1.0, 10.0), nulls: str = "raise"
) -> DataFrame:
    """Leave-one-out squared error of every alpha, and whether it is the best of its key.

    The left-out residual is resid / (1 - h) with h = 1/n + c' (X'X + alpha I)^-1 c and c the
    centred features, so all alphas need one more pass instead of n fits.
    """
    keys, d = list(keys), len(xs)
    models = ridge_fit(df, xs, [y], tuple(keys), alphas, with_inverse=True, nulls=nulls)
    rows = df.dropna(subset=[*xs, y]).select(*keys, y, *xs)
    if keys:
        joined = rows.join(models, keys)
    else:
        # one small constant per alpha
        fitted = [F.struct(*[F.lit(m[f.name]).cast(f.dataType).alias(f.name) for f in models.schema]) for m in models.collect()]
        joined = rows.withColumn("_m", F.explode(F.array(*fitted))).select(*rows.columns, "_m.*")
    # c' A c as a dot product of the flattened outer product with the stored inverse
    c = F.zip_with(F.array(*[F.col(x).cast("double") for x in xs]), "means", lambda v, m: v - m)
    joined = joined.withColumn("_c", c)
    weighted = F.transform("_c", lambda v, i: v * _dot(F.slice("inverse", i * d + 1, d), F.col("_c")))
    leverage = 1 / F.col("n") + F.aggregate(weighted, F.lit(0.0), lambda s, v: s + v)
    left_out = (F.col(y) - linear_value(xs)) / (1 - leverage)
    scored = joined.groupBy(*keys, "alpha").agg(
        F.avg(left_out * left_out).alias("loo_mse"),
        F.first("intercept").alias("intercept"),
        F.first("coefficients").alias("coefficients"),
    )
    best = scored.groupBy(*keys).agg(F.min_by("alpha", F.struct("loo_mse", "alpha")).alias("best_alpha"))
    out = join_stats(scored, best, keys)
    return out.withColumn("best", F.col("alpha") == F.col("best_alpha")).drop("best_alpha")


# --------------------------------------------------------------------------- learning curve


def learning_curve(
    df: DataFrame,
    xs: list[str],
    y: str,
    key: str,
    folds: int = 5,
    shares: tuple[float, ...] = tuple(i / 10 for i in range(1, 11)),
    alpha: float = 1.0,
    order: Column | None = None,
) -> DataFrame:
    """R2 on train subset and held-out fold for nested train sizes, long form.

    Rows get a position in hash order; the fold is position mod ``folds`` and a train subset is
    the first rows outside the fold. Subsets are nested, so each row adds to one band per fold,
    bands are summed up afterwards, and both scores follow from the sums alone: one pass fits
    and scores all models.
    """
    d = len(xs)
    rows = df.select(key, *xs, y)
    placed = global_index(rows, order if order is not None else hash32(key), [key], "_i")
    total = rows.count()
    i, f = F.col("_i"), F.col("fold")
    # rows of the fold before position i, and in all
    held_before = F.floor((i - f + (folds - 1)) / F.lit(folds))
    train_rows = F.lit(total) - F.floor((F.lit(total) - f + (folds - 1)) / F.lit(folds))
    place = F.col("_place")
    step = sum(((place >= F.floor(F.lit(s) * F.col("_train_rows") + 1e-9)).cast("int") for s in shares), F.lit(0))
    spread = (
        placed.withColumn("fold", F.explode(F.array(*[F.lit(k) for k in range(folds)])))
        .withColumns({"_place": i - held_before, "_train_rows": train_rows})
        .withColumn("band", F.when(i % folds == f, F.lit(-1)).otherwise(step))
    )
    sums = gram(spread.filter(F.col("band") < len(shares)), ["fold", "band"], xs, [y])

    def r2(row, w, b):
        n, mx, my, xx, xy, yy = _centred(row, d, 1)
        shift = my[0] - mx @ w - b
        sse = yy[0] - 2 * w @ xy[:, 0] + w @ xx @ w + n * shift * shift
        return 1 - sse / yy[0] if yy[0] > 0 else float(abs(sse) < 1e-12)

    def score(pdf: pd.DataFrame) -> pd.DataFrame:
        parts = {int(r["band"]): r for r in pdf.to_dict("records")}
        held, seen, out = parts.get(-1), None, []
        for step, share in enumerate(shares):
            part = parts.get(step)
            if part is not None:
                grown = {k: np.asarray(part[k], float) for k in ("n", "mx", "my", "xx", "xy", "yy")}
                seen = grown if seen is None else _merged(seen, grown, d)
            if seen is None or held is None:
                continue
            _, mx, my, xx, xy, _ = _centred(seen, d, 1)
            w = np.linalg.solve(xx + alpha * np.eye(d), xy)[:, 0]
            b = my[0] - mx @ w
            out.append((int(pdf["fold"].iloc[0]), share, int(seen["n"]), r2(seen, w, b), r2(held, w, b)))
        return pd.DataFrame(out, columns=["fold", "share", "train_size", "train_score", "validation_score"])

    # a group here is one fold: at most len(shares) + 1 rows of sums
    return sums.groupBy("fold").applyInPandas(
        score, "fold int, share double, train_size bigint, train_score double, validation_score double"
    )

"""Models and scores against hand-worked cases and brute force."""

from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from heliotab.operators.metrics import (
    average_scores,
    balanced_accuracy,
    class_scores,
    classification_record,
    classification_report,
    confusion_matrix,
    confusion_pivot,
    format_report,
    label_counts,
    permutation_importance,
    regression_metrics,
    regression_metrics_multi,
    regression_record,
    roc_auc,
    roc_auc_ovo,
    run_name,
    with_single_scores,
)
from heliotab.operators.models import (
    climatology_daily_fit,
    climatology_hourly_fit,
    climatology_predict,
    learning_curve,
    ridge_cv,
    ridge_fit,
    ridge_predict,
    ridge_predict_multi,
)
from heliotab.plans.jobs import history_window, load_model, retrain, save_model, score_batch, scoring_window, train_solar_model
from heliotab.sources.sinks import write_learning_curve


def numpy_ridge(x, y, alpha):
    mx, my = x.mean(0), y.mean(0)
    c = x - mx
    w = np.linalg.solve(c.T @ c + alpha * np.eye(x.shape[1]), c.T @ (y - my))
    return w, my - mx @ w


def test_climatology_daily(spark, frame):
    df = frame([("a", "2021-12-31", 1.0), ("a", "2021-12-31", 3.0), ("a", "2022-12-31", 6.0)], "installation string, date date, sol_prod double")
    model = climatology_daily_fit(df)
    ask = frame([("a", "2024-12-31"), ("a", "2024-01-10")], "installation string, date date")
    got = climatology_predict(ask, model, F.dayofyear("date"), "doy").orderBy("date").collect()
    assert [r.pred for r in got] == [None, 5.0]


def test_climatology_hourly_borrows(spark, frame):
    df = frame([("a", "2021-12-31 05:00", 4.0), ("a", "2024-12-31 06:00", 7.0)], "installation string, timestamp timestamp, sol_prod double")
    model = {r.hoy: r.pred for r in climatology_hourly_fit(df).collect()}
    assert model == {364 * 24 + 5: 4.0, 365 * 24 + 5: 4.0, 365 * 24 + 6: 7.0}


def test_ridge_small(spark, frame):
    df = frame([("a", float(i), float(i)) for i in range(4)], "installation string, x double, y double")
    r = ridge_fit(df, ["x"], ["y"]).first()
    assert (r.coefficients[0], r.intercept) == pytest.approx((0.833333, 0.25), abs=1e-6)


def wide(spark, n=400, d=12, m=3, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.random((n, d))
    y = x @ rng.normal(size=(d, m)) + rng.normal(0, 0.3, (n, m)) + 2
    names, targets = [f"x{i}" for i in range(d)], [f"y{i}" for i in range(m)]
    site = np.where(np.arange(n) % 3 == 0, "a", "b")
    rows = [(int(i), str(s), *map(float, a), *map(float, b)) for i, (s, a, b) in enumerate(zip(site, x, y))]
    return spark.createDataFrame(rows, ["id", "installation", *names, *targets]), x, y, site, names, targets


def test_ridge_many_targets(spark):
    df, x, y, site, names, targets = wide(spark)
    models = {(r.installation, r.target): r for r in ridge_fit(df, names, targets, alphas=(2.0,)).collect()}
    for s in "ab":
        w, b = numpy_ridge(x[site == s], y[site == s], 2.0)
        for t, name in enumerate(targets):
            assert models[(s, name)].coefficients == pytest.approx(w[:, t], abs=1e-9)
            assert models[(s, name)].intercept == pytest.approx(b[t], abs=1e-9)
    long = ridge_predict_multi(df, ridge_fit(df, names, targets), names, targets).collect()
    assert len(long) == 3 * len(x) and all(r.pred is not None for r in long)


def test_ridge_without_keys_and_prediction(spark):
    df, x, y, _, names, targets = wide(spark)
    model = ridge_fit(df, names, targets[:1], keys=())
    w, b = numpy_ridge(x, y[:, :1], 1.0)
    got = {r.id: r.pred for r in ridge_predict(df, model, names, keys=()).collect()}
    assert [got[i] for i in range(len(x))] == pytest.approx((x @ w + b)[:, 0], abs=1e-9)


def test_ridge_cv_is_leave_one_out(spark):
    df, x, y, site, names, targets = wide(spark, n=60, d=4, m=1)
    got = {(r.installation, r.alpha): r for r in ridge_cv(df, names, "y0").collect()}
    for s in "ab":
        xs, ys, losses = x[site == s], y[site == s], {}
        for alpha in (0.1, 1.0, 10.0):
            errors = []
            for i in range(len(xs)):
                keep = np.arange(len(xs)) != i
                w, b = numpy_ridge(xs[keep], ys[keep], alpha)
                errors.append((ys[i] - xs[i] @ w - b)[0] ** 2)
            losses[alpha] = np.mean(errors)
            assert got[(s, alpha)].loo_mse == pytest.approx(losses[alpha], rel=1e-9)
        assert got[(s, min(losses, key=losses.get))].best


def test_learning_curve_brute_force(spark):
    df, x, y, _, names, _ = wide(spark, n=103, d=3, m=1)
    got = {(r.fold, r.share): r for r in learning_curve(df, names, "y0", "id", order=F.col("id") * 1000).collect()}
    i = np.arange(len(x))
    for f in range(5):
        train, held = i[i % 5 != f], i[i % 5 == f]
        for share in (0.1, 0.5, 1.0):
            sub = train[: int(share * len(train) + 1e-9)]
            w, b = numpy_ridge(x[sub], y[sub], 1.0)

            def r2(rows):
                e = y[rows] - x[rows] @ w - b
                return 1 - (e**2).sum() / ((y[rows] - y[rows].mean()) ** 2).sum()

            r = got[(f, share)]
            assert r.train_size == len(sub)
            assert (r.train_score, r.validation_score) == pytest.approx((r2(sub), r2(held)), abs=1e-9)


def scores_of(frame, pairs):
    return regression_metrics(frame([("r", float(a), float(b)) for a, b in pairs], "run string, y double, pred double"), ["run"]).first()


def test_regression_scores(spark, frame):
    r = scores_of(frame, [(1, 1), (2, 2), (3, 2), (4, 6)])
    assert [r.MAE, r.MSE, r.RMSE, r.MAPE, r.MedAE, r.R2, r.ExplainedVar] == pytest.approx(
        [0.75, 1.25, 1.118034, 0.208333, 0.5, 0.0, 0.05], abs=1e-6
    )
    assert scores_of(frame, [(0, 1), (1, 1)]).MAPE == pytest.approx(2.2517998e15, rel=1e-6)
    assert (scores_of(frame, [(2, 2), (2, 2)]).R2, scores_of(frame, [(2, 2), (2, 3)]).R2) == (1.0, 0.0)


def test_multi_target_scores(spark, frame):
    rows = [("r", "a", float(v), v + 1.0) for v in range(5)] + [("r", "b", 10.0 * v, 10.0 * v + 20) for v in range(5)]
    out = regression_metrics_multi(frame(rows, "run string, target string, y double, pred double"), ["run"]).collect()
    single = {r.target: r for r in out if r.kind == "single"}
    scaled = next(r for r in out if r.kind == "scaled")
    assert (single["a"].MAE, single["b"].MAE) == (1.0, 20.0)
    assert scaled.MAE == pytest.approx((0.25 + 0.5) / 2) and scaled.RMSE == pytest.approx(np.sqrt((0.0625 + 0.25) / 2))
    record = with_single_scores(frame([("r",)], "run string"), spark.createDataFrame([r for r in out if r.kind == "single"], "run string, target string, n bigint, n_dropped bigint, MAE double, MSE double, RMSE double, MAPE double, MedAE double, R2 double, ExplainedVar double, kind string"), ["run"]).first()
    assert record.single_dim_scores["b"]["MAE"] == 20.0


def test_run_names(spark, frame):
    df = frame([(0.9103087,), (-0.01234,), (None,)], "r double")
    got = [r.n for r in df.select(run_name(F.lit("t"), F.lit("Ridge"), "r", F.lit("p"), F.lit("f")).alias("n")).collect()]
    assert got == ["t_Ridge_r209103_p_f", "t_Ridge_r2-0123_p_f", "t_Ridge_r200000_p_f"]


def test_classification_scores(spark, frame):
    df = frame([("r", t, p) for t, p in zip("aabbc", "abbba")], "run string, truth string, pred string")
    cells = confusion_matrix(df, ["run"], ["a", "b", "c"])
    assert {r.cell: r.n for r in cells.collect()} == {
        "C_0_0": 1, "C_0_1": 1, "C_0_2": 0, "C_1_0": 0, "C_1_1": 2, "C_1_2": 0, "C_2_0": 1, "C_2_1": 0, "C_2_2": 0,
    }
    scores = class_scores(cells, ["run"])
    avg = {r.avg_mode: (r.precision, r.recall, r.f1) for r in average_scores(scores, ["run"]).collect()}
    assert avg["weighted"] == pytest.approx((0.466667, 0.6, 0.52), abs=1e-6)
    assert avg["macro"] == pytest.approx((0.388889, 0.5, 0.433333), abs=1e-6)
    assert balanced_accuracy(scores, ["run"]).first().bal_accuracy == 0.5
    text = {r.label: r for r in format_report(classification_report(scores, ["run"]), ["run"]).collect()}
    assert (text["accuracy"].precision, text["accuracy"].f1, text["accuracy"].support) == ("", "0.6", "5")
    assert text["a"].precision == "0.5"
    meta = {k: F.lit(k) for k in ("timestamp", "model_purpose", "model_class", "special_features")}
    record = classification_record(df, ["run"], ["a", "b", "c"], meta)
    r = record.first()
    assert r.model_name == "timestamp_model_class_f105200_model_purpose_special_features"
    assert r.classification_report["a"]["f1-score"] == 0.5
    assert r.conf_matrix["C_2_0"] == 1 and r.classification_report["macro avg"].recall == 0.5 and r.roc_auc_score == ""
    back = {x.truth: (x.a, x.b, x.c) for x in confusion_pivot(record, ["run"], ["a", "b", "c"]).collect()}
    assert back == {"a": (1, 1, 0), "b": (0, 2, 0), "c": (1, 0, 0)}


def test_auc(spark, frame):
    df = frame([("r", t, s) for t, s in zip((0, 0, 1, 1), (0.1, 0.4, 0.4, 0.8))], "run string, truth int, score double")
    assert roc_auc(df, ["run"], F.col("truth") == 1).first().roc_auc == 0.875
    one_class = df.filter("truth = 1")
    assert roc_auc(one_class, ["run"], F.col("truth") == 1).first().roc_auc is None


def test_auc_ovo_brute_force(spark):
    rng = np.random.default_rng(1)
    truth = rng.choice(list("abc"), 300)
    p = rng.integers(0, 6, (300, 3)) / 5
    df = spark.createDataFrame([("r", str(t), *map(float, v)) for t, v in zip(truth, p)], ["run", "truth", "pa", "pb", "pc"])
    pairs = []
    for i, a in enumerate("abc"):
        for b in "abc":
            if a != b:
                pos, neg = p[truth == a, i][:, None], p[truth == b, i][None, :]
                pairs.append(((pos > neg) + 0.5 * (pos == neg)).mean())
    got = roc_auc_ovo(df, ["run"], list("abc"), "truth", {"a": "pa", "b": "pb", "c": "pc"}).first().roc_auc
    assert got == pytest.approx(np.mean(pairs))


def test_permutation_importance(spark):
    df = spark.range(2000).select(
        "id", (F.col("id") % 10).cast("double").alias("used"), (F.col("id") % 7).cast("double").alias("idle"),
        F.when(F.col("id") % 10 < 5, "lo").otherwise("hi").alias("truth"),
    )
    got = {r.feature: r for r in permutation_importance(df, "id", ["used", "idle"], "truth", lambda c: F.when(c["used"] < 5, "lo").otherwise("hi"), runs=3).collect()}
    assert got["idle"].importance_mean == 0.0 and 0.4 < got["used"].importance_mean < 0.6
    assert len({got["used"][f"imp_{i}"] for i in range(3)}) > 1


def test_regression_record(spark, frame):
    scores = regression_metrics(frame([("r", 1.0, 1.0), ("r", 2.0, 2.5)], "run string, y double, pred double"), ["run"])
    meta = {k: F.lit(k) for k in ("timestamp", "model_purpose", "model_class", "special_features")}
    r = regression_record(scores, ["run"], meta).first()
    assert r.model_name == "timestamp_model_class_r205000_model_purpose_special_features" and r.R2 == 0.5


def test_train_and_score_agree(spark, frame, tmp_path):
    """Training and batch scoring equal the same steps in NumPy."""
    rows = [
        ("a", f"2024-{m:02d}-{d:02d} {h:02d}:00", float((d * h + m) % 17) * 100, ["Rain", "Clear Sky"][d % 2])
        for m in (1, 2, 3) for d in range(1, 29) for h in range(24)
    ]
    weather = frame(rows, "installation string, timestamp timestamp, sunshine_duration double, weather_description string")
    power = weather.select("installation", "timestamp", (F.col("sunshine_duration") / 1000 + F.dayofmonth("timestamp") / 100).alias("sol_prod"))
    from heliotab.operators.aggregate import period_features
    from heliotab.operators.weather import enrich_weather, upsample_ffill

    quarter = upsample_ffill(power, additive=("sol_prod",))
    table = period_features(enrich_weather(quarter, weather), "daily", categories=["clear sky", "rain"])
    model = train_solar_model(table, holdout=15, categories=["clear sky", "rain"])
    metrics = model.metrics.first()
    assert metrics.n == 14

    days = table.orderBy("date").toPandas()
    doy = np.array([d.timetuple().tm_yday for d in days.date])
    x = days[["sunshine_duration", "clear_sky", "rain"]].to_numpy()
    lo, width = x[:-14].min(0), np.ptp(x[:-14], axis=0)
    angle = doy / 366 * 2 * np.pi
    features = np.column_stack([(x - lo) / np.where(width == 0, 1, width), np.sin(angle), np.cos(angle)])
    y = days.sol_prod.to_numpy()
    w, b = numpy_ridge(features[:-14], y[:-14, None], 1.0)
    expected = (features @ w + b)[:, 0]
    error = y[-14:] - expected[-14:]
    assert metrics.MAE == pytest.approx(np.abs(error).mean()) and metrics.MedAE == pytest.approx(np.median(np.abs(error)))

    save_model(model, str(tmp_path / "m"))
    for kept in (model, load_model(spark, str(tmp_path / "m"))):
        scored = {r.date: r.pred for r in score_batch(weather, kept).collect()}
        assert [scored[d] for d in days.date] == pytest.approx(expected, abs=1e-9)


def test_hourly_model(spark, frame):
    rows = [("a", f"2024-01-{d:02d} {h:02d}:00", float(max(0, 6 - abs(h - 12))) * (1 + d % 3), "Rain") for d in range(1, 25) for h in range(24)]
    weather = frame(rows, "installation string, timestamp timestamp, sunshine_duration double, weather_description string")
    power = weather.select("installation", "timestamp", (F.col("sunshine_duration") / 10).alias("sol_prod"))
    model = retrain(power, weather, "hourly", categories=["rain"], validate=True)
    assert model.features == ["sunshine_duration", "rain", "date_doy_sin", "date_doy_cos", "hour_sin", "hour_cos"]
    m = model.metrics.first()
    assert m.R2 > 0.95 and 60 < m.n < 170
    scored = score_batch(weather, model)
    # the last hour has a single step, every other one four
    assert scored.count() == 24 * 24 and {r.time.hour for r in scored.collect()} == set(range(24))


def test_windows():
    assert history_window(date(2025, 3, 1)) == (date(2012, 1, 1), date(2025, 2, 28))
    assert scoring_window(date(2025, 3, 1), "hourly") == (date(2025, 2, 26), date(2025, 3, 4))


def test_curve_files(spark, frame, tmp_path):
    curve = frame([(f, s, 10, s, -s) for f in (0, 1) for s in (0.5, 1.0)], "fold int, share double, train_size bigint, train_score double, validation_score double")
    write_learning_curve(curve, str(tmp_path / "c"), folds=2)
    back = spark.read.csv(str(tmp_path / "c/validation_scores"), sep=";", header=True, inferSchema=True)
    assert sorted(tuple(r) for r in back.collect()) == [(0.5, -0.5, -0.5), (1.0, -1.0, -1.0)]
    assert spark.read.json(str(tmp_path / "c/summary")).first().train_sizes == [0.5, 1.0]


def test_large_offsets_cost_no_digits(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 1))
    y = 3 * x[:, 0] + 1
    rows = [("a", float(v + 1e8), float(t)) for v, t in zip(x[:, 0], y)]
    df = spark.createDataFrame(rows, "installation string, x double, y double").repartition(7)
    fit = ridge_fit(df, ["x"], ["y"], alphas=(1e-6,)).first()
    assert fit.coefficients[0] == pytest.approx(3.0, abs=1e-6)
    curve = learning_curve(df.withColumn("id", F.monotonically_increasing_id()), ["x"], "y", "id", alpha=1e-6).collect()
    assert len(curve) == 50 and all(r.train_score > 0.999 and r.validation_score > 0.999 for r in curve if r.train_size > 50)


def test_missing_values_are_not_dropped_without_notice(spark, frame):
    df = frame([("a", 1.0, 1.0), ("a", 2.0, None), ("a", 3.0, 3.5)], "run string, y double, pred double")
    with pytest.raises(Exception, match="is missing"):
        regression_metrics(df, ["run"]).collect()
    counted = regression_metrics(df, ["run"], nulls="count").first()
    assert (counted.n, counted.n_dropped, counted.MAE) == (2, 1, 0.25)
    with pytest.raises(Exception, match="is missing"):
        ridge_fit(df, ["y"], ["pred"], ("run",)).collect()
    assert ridge_fit(df, ["y"], ["pred"], ("run",), nulls="drop").first().n == 2


def test_report_of_listed_labels(frame):
    df = frame([("r", t, p) for t, p in zip("aabbc", "abbba")], "run string, truth string, pred string")
    scores = class_scores(label_counts(df, ["run"]), ["run"])
    rows = {r.label: (round(r.f1, 6), r.support) for r in classification_report(scores, ["run"], ["a", "b", "z"]).collect()}
    assert rows["z"] == (0.0, 0) and "c" not in rows and "accuracy" not in rows
    assert rows["micro avg"] == (pytest.approx(2 * 3 / (4 + 5)), 4)
    # averages over the classes that occur, whatever is listed
    macro = {r.avg_mode: r for r in average_scores(scores, ["run"]).collect()}["macro"]
    assert macro.f1 == pytest.approx((0.5 + 0.8 + 0.0) / 3)


def test_importance_does_not_depend_on_partitions(spark):
    df = spark.range(300).selectExpr("id", "if(id % 2 = 0, 'x', 'y') truth", "cast(id % 2 as double) a", "cast(id % 7 as double) b")
    predict = lambda c: F.when(c["a"] == 0, "x").otherwise("y")
    runs = [
        {r.feature: r.importance_mean for r in permutation_importance(df.repartition(n), "id", ["a", "b"], "truth", predict).collect()}
        for n in (1, 9)
    ]
    assert runs[0] == pytest.approx(runs[1]) and runs[0]["b"] == 0.0 and runs[0]["a"] > 0.2

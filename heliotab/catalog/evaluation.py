"""Regression and classification scores."""

from pyspark.sql import functions as F

from ..operators.metrics import (
    average_scores,
    balanced_accuracy,
    class_scores,
    classification_record,
    classification_report,
    confusion_matrix,
    confusion_pivot,
    format_report,
    label_counts,
    regression_metrics,
    regression_metrics_multi,
    regression_record,
    roc_auc,
    roc_auc_ovo,
    run_name,
)
from .registry import query
from .stand_ins import (
    DAILY_WEATHER,
    EVENT_TYPES,
    PREDICTIONS,
    RUNS,
    SCORED,
    daily_weather,
    predictions,
    runs,
    scored,
    table,
)
from ..operators.series import with_lags

LABELS = sorted(EVENT_TYPES)

_SCORES_SQL = """count(*) AS n, avg(abs(y - pred)) AS "MAE", avg(pow(y - pred, 2)) AS "MSE", sqrt(avg(pow(y - pred, 2))) AS "RMSE",
  avg(abs(y - pred) / greatest(abs(y), 2.220446049250313e-16)) AS "MAPE", median(abs(y - pred)) AS "MedAE",
  1 - avg(pow(y - pred, 2)) / var_pop(y) AS "R2", 1 - var_pop(y - pred) / var_pop(y) AS "ExplainedVar" """
_ROUNDED = (
    'round("MAE", 6) AS "MAE", round("MSE", 3) AS "MSE", round("RMSE", 6) AS "RMSE", round("MAPE", 6) AS "MAPE", '
    'round("MedAE", 6) AS "MedAE", round("R2", 6) AS "R2", round("ExplainedVar", 6) AS "ExplainedVar"'
)


@query(
    "regression_metrics",
    f"""WITH {PREDICTIONS}, holes AS (SELECT run, y, CASE WHEN floor(y) % 7 <> 0 THEN pred END AS pred FROM predictions),
    known AS (SELECT * FROM holes WHERE y IS NOT NULL AND pred IS NOT NULL), s AS (SELECT run, {_SCORES_SQL} FROM known GROUP BY 1),
    lost AS (SELECT run, count(*) FILTER (y IS NULL OR pred IS NULL) AS n_dropped FROM holes GROUP BY 1)
    SELECT run, n, n_dropped, {_ROUNDED} FROM s JOIN lost USING (run)""",
    digits=6,
    MSE=3,
)
def scores(spark, sf_dir):
    """Scores with holes among the predictions: left out and counted."""
    found = predictions(spark, sf_dir)
    holes = found.withColumn("pred", F.when(F.floor("y") % 7 != 0, F.col("pred")))
    return regression_metrics(holes, ["run"], nulls="count")


_PERSISTENCE = """lagged AS (SELECT installation, date, sunshine_duration, cloud_cover, lag(sunshine_duration) OVER w AS sp, lag(cloud_cover) OVER w AS cp,
    row_number() OVER w AS rn FROM daily_weather WINDOW w AS (PARTITION BY installation ORDER BY date)),
  pairs AS (SELECT installation, 'sunshine_duration' AS target, sunshine_duration AS y, sp AS pred FROM lagged WHERE rn > 1
    UNION ALL SELECT installation, 'cloud_cover', cloud_cover, cp FROM lagged WHERE rn > 1),
  known AS (SELECT * FROM pairs WHERE y IS NOT NULL AND pred IS NOT NULL),
  lost AS (SELECT installation, target, count(*) FILTER (y IS NULL OR pred IS NULL) AS n_dropped FROM pairs GROUP BY 1, 2)"""
# MAPE divides by machine epsilon where the truth is zero: such values are compared by their leading digits
_MAPE_SQL = '''CASE WHEN "MAPE" > 1000 THEN round("MAPE" / pow(10, floor(log10("MAPE"))), 6) ELSE round("MAPE", 6) END'''


def _mape():
    big = F.round(F.col("MAPE") / F.pow(F.lit(10.0), F.floor(F.log10("MAPE"))), 6)
    return F.when(F.col("MAPE") > 1000, big).otherwise(F.round("MAPE", 6))


@query(
    "regression_metrics_multi",
    f"""WITH {DAILY_WEATHER}, {_PERSISTENCE}, single AS (SELECT installation, target, {_SCORES_SQL} FROM known GROUP BY 1, 2),
    lims AS (SELECT installation, target, min(y) AS lo, max(y) AS hi FROM known GROUP BY 1, 2),
    scaled AS (SELECT installation, target, (y - lo) / (hi - lo) AS y, (pred - lo) / (hi - lo) AS pred FROM known JOIN lims USING (installation, target)),
    per AS (SELECT installation, target, {_SCORES_SQL} FROM scaled GROUP BY 1, 2),
    overall AS (SELECT installation, CAST(NULL AS VARCHAR) AS target, CAST(sum(n) AS BIGINT) AS n, avg("MAE") AS "MAE", avg("MSE") AS "MSE",
      sqrt(avg("MSE")) AS "RMSE", avg("MAPE") AS "MAPE", avg("MedAE") AS "MedAE", avg("R2") AS "R2", avg("ExplainedVar") AS "ExplainedVar" FROM per GROUP BY 1)
    SELECT installation, target, n, n_dropped, round("MAE", 6) AS "MAE", round("MSE", 5) AS "MSE", round("RMSE", 6) AS "RMSE", {_MAPE_SQL} AS "MAPE",
      round("MedAE", 6) AS "MedAE", round("R2", 6) AS "R2", round("ExplainedVar", 6) AS "ExplainedVar", 'single' AS kind FROM single JOIN lost USING (installation, target)
    UNION ALL
    SELECT installation, target, n, (SELECT CAST(sum(n_dropped) AS BIGINT) FROM lost l WHERE l.installation = o.installation), round("MAE", 6), round("MSE", 5), round("RMSE", 6), {_MAPE_SQL}, round("MedAE", 6), round("R2", 6),
      round("ExplainedVar", 6), 'scaled' FROM overall o""",
    digits=6,
    MSE=5,
)
def scores_multi(spark, sf_dir):
    """Persistence forecast of two weather targets."""
    targets = ["sunshine_duration", "cloud_cover"]
    lagged = with_lags(daily_weather(spark, sf_dir), targets, [1])
    cells = [F.struct(F.lit(t).alias("target"), F.col(t).alias("y"), F.col(f"{t}_lag_1").alias("pred")) for t in targets]
    long = lagged.select("installation", F.explode(F.array(*cells)).alias("c")).select("installation", "c.*")
    return regression_metrics_multi(long, ["installation"], nulls="count").withColumn("MAPE", _mape())


@query(
    "run_name",
    f"""WITH {RUNS}, d AS (SELECT *, CAST(trunc("R2" * 10000) AS BIGINT) AS digits FROM runs)
        SELECT name, "timestamp" || '_' || model_class || '_r2' || printf('%05d', digits) || '_' || model_purpose || '_' || special_features AS model_name
        FROM d""",
)
def names(spark, sf_dir):
    r = runs(spark, sf_dir)
    return r.select("name", run_name("timestamp", "model_class", "R2", "model_purpose", "special_features").alias("model_name"))


_LABEL_ROWS = ", ".join(f"({i}, '{v}')" for i, v in enumerate(LABELS))
_CELLS = f"""labels(i, label) AS (VALUES {_LABEL_ROWS}), run_names AS (SELECT DISTINCT run FROM scored),
  cells AS (SELECT r.run, t.label AS truth, p.label AS pred, t.i AS ti, p.i AS pi,
    (SELECT count(*) FROM scored s WHERE s.run = r.run AND s.truth = t.label AND s.pred = p.label) AS n
    FROM run_names r, labels t, labels p)"""
_CLASSES = f"""{_CELLS}, classes AS (SELECT run, label, CAST(sum(CASE WHEN truth = label AND pred = label THEN n ELSE 0 END) AS DOUBLE) AS tp,
    CAST(sum(CASE WHEN truth = label THEN n ELSE 0 END) AS BIGINT) AS support, CAST(sum(CASE WHEN pred = label THEN n ELSE 0 END) AS BIGINT) AS predicted
    FROM cells, labels GROUP BY 1, 2),
  per_class AS (SELECT *, CASE WHEN predicted = 0 THEN 0 ELSE tp / predicted END AS precision, CASE WHEN support = 0 THEN 0 ELSE tp / support END AS recall,
    CASE WHEN predicted + support = 0 THEN 0 ELSE 2 * tp / (predicted + support) END AS f1 FROM classes)"""
_AVERAGES = """averages AS (
  SELECT run, 'weighted' AS mode, sum(precision * support) / sum(support) AS precision, sum(recall * support) / sum(support) AS recall,
    sum(f1 * support) / sum(support) AS f1, CAST(sum(support) AS BIGINT) AS support FROM per_class GROUP BY 1
  UNION ALL SELECT run, 'macro', avg(precision), avg(recall), avg(f1), CAST(sum(support) AS BIGINT) FROM per_class GROUP BY 1
  UNION ALL SELECT run, 'micro', sum(tp) / sum(predicted), sum(tp) / sum(support), 2 * sum(tp) / (sum(support) + sum(predicted)),
    CAST(sum(support) AS BIGINT) FROM per_class GROUP BY 1)"""


@query(
    "confusion_matrix",
    f"WITH {SCORED}, {_CELLS} SELECT run, truth, pred, 'C_' || CAST(ti AS VARCHAR) || '_' || CAST(pi AS VARCHAR) AS cell, n FROM cells",
)
def confusion(spark, sf_dir):
    return confusion_matrix(scored(spark, sf_dir), ["run"], LABELS)


def _counts(spark, sf_dir):
    return label_counts(scored(spark, sf_dir), ["run"])


@query(
    "confusion_pivot",
    f"WITH {SCORED}, {_CELLS} SELECT run, truth, "
    + ", ".join(f"max(CASE WHEN pred = '{v}' THEN n END) AS {v}" for v in LABELS)
    + " FROM cells GROUP BY 1, 2",
)
def confusion_table(spark, sf_dir):
    """Matrix to the stored ``C_i_j`` map and back."""
    entries = F.array_sort(F.collect_list(F.struct("cell", "n")))
    records = confusion_matrix(scored(spark, sf_dir), ["run"], LABELS).groupBy("run").agg(F.map_from_entries(entries).alias("conf_matrix"))
    return confusion_pivot(records, ["run"], LABELS)


@query(
    "prf_scores",
    f"""WITH {SCORED}, {_CLASSES}, {_AVERAGES} SELECT run, mode AS avg_mode, round(precision, 6) AS precision, round(recall, 6) AS recall,
        round(f1, 6) AS f1, support FROM averages""",
    digits=6,
)
def prf_scores(spark, sf_dir):
    return average_scores(class_scores(_counts(spark, sf_dir), ["run"]), ["run"])


@query(
    "balanced_accuracy",
    f"WITH {SCORED}, {_CLASSES} SELECT run, round(avg(recall), 6) AS bal_accuracy FROM per_class WHERE support > 0 GROUP BY 1",
    digits=6,
)
def balanced(spark, sf_dir):
    return balanced_accuracy(class_scores(_counts(spark, sf_dir), ["run"]), ["run"])


_REPORT = f"""{_CLASSES}, {_AVERAGES}, report AS (
  SELECT run, label, precision, recall, f1, support FROM per_class
  UNION ALL SELECT run, CASE mode WHEN 'micro' THEN 'accuracy' ELSE mode || ' avg' END, precision, recall, f1, support FROM averages)"""


@query(
    "classification_report",
    f"""WITH {SCORED}, {_REPORT} SELECT run, label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM report""",
    digits=6,
)
def report(spark, sf_dir):
    return classification_report(class_scores(_counts(spark, sf_dir), ["run"]), ["run"])


@query(
    "classification_report_fmt",
    f"""WITH {SCORED}, {_REPORT} SELECT run, label, CASE WHEN label = 'accuracy' THEN '' ELSE CAST(round(precision, 3) AS VARCHAR) END AS precision,
        CASE WHEN label = 'accuracy' THEN '' ELSE CAST(round(recall, 3) AS VARCHAR) END AS recall, CAST(round(f1, 3) AS VARCHAR) AS f1,
        CAST(support AS VARCHAR) AS support FROM report""",
)
def report_text(spark, sf_dir):
    return format_report(classification_report(class_scores(_counts(spark, sf_dir), ["run"]), ["run"]), ["run"])


# one listed label never occurs, and one that occurs is not listed
LISTED = ["error", "purchase", "refund", "signup", "view"]
_LISTED_SQL = f"""tally AS (SELECT run, truth, pred, count(*) AS n FROM scored GROUP BY 1, 2, 3),
  listed AS (SELECT unnest({LISTED}) AS label),
  totals AS (SELECT run, label, CAST(coalesce(sum(n) FILTER (truth = label AND pred = label), 0) AS DOUBLE) AS tp,
    CAST(coalesce(sum(n) FILTER (truth = label), 0) AS BIGINT) AS support, CAST(coalesce(sum(n) FILTER (pred = label), 0) AS BIGINT) AS predicted
    FROM tally, listed GROUP BY 1, 2),
  lines AS (SELECT *, CASE WHEN predicted = 0 THEN 0 ELSE tp / predicted END AS precision, CASE WHEN support = 0 THEN 0 ELSE tp / support END AS recall,
    CASE WHEN predicted + support = 0 THEN 0 ELSE 2 * tp / (predicted + support) END AS f1 FROM totals),
  listed_report AS (SELECT run, label, precision, recall, f1, support FROM lines
    UNION ALL SELECT run, 'macro avg', avg(precision), avg(recall), avg(f1), CAST(sum(support) AS BIGINT) FROM lines GROUP BY 1
    UNION ALL SELECT run, 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
      sum(f1 * support) / sum(support), CAST(sum(support) AS BIGINT) FROM lines GROUP BY 1
    UNION ALL SELECT run, 'micro avg', sum(tp) / sum(predicted), sum(tp) / sum(support), 2 * sum(tp) / (sum(support) + sum(predicted)),
      CAST(sum(support) AS BIGINT) FROM lines GROUP BY 1)"""


@query(
    "classification_report_listed",
    f"""WITH {SCORED}, {_LISTED_SQL} SELECT run, label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support
        FROM listed_report""",
    digits=6,
)
def report_listed(spark, sf_dir):
    """Lines for given labels, where the micro average is no accuracy."""
    return classification_report(class_scores(_counts(spark, sf_dir), ["run"]), ["run"], LISTED)


def _labelled(spark, sf_dir):
    labels = table(spark, sf_dir, "labels")
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", F.col("n_chars").cast("double").alias("score"))
    return docs.join(labels, "doc_id")


@query(
    "roc_auc_binary",
    """WITH s AS (SELECT lang, quality, n_chars AS score FROM documents JOIN labels USING (doc_id)),
    r AS (SELECT lang, quality, rank() OVER (PARTITION BY lang ORDER BY score) + (count(*) OVER (PARTITION BY lang, score) - 1) / 2.0 AS rk FROM s),
    a AS (SELECT lang, sum(CASE WHEN quality = 1 THEN rk END) AS rs, CAST(count(*) FILTER (quality = 1) AS DOUBLE) AS p,
      CAST(count(*) FILTER (quality <> 1) AS DOUBLE) AS q FROM r GROUP BY 1)
    SELECT lang, round((rs - p * (p + 1) / 2) / (p * q), 6) AS roc_auc FROM a""",
    digits=6,
)
def auc_binary(spark, sf_dir):
    """Text length as a score for the quality label, per language."""
    return roc_auc(_labelled(spark, sf_dir), ["lang"], F.col("quality") == 1)


_PAIRS = " UNION ALL ".join(
    f"SELECT run, '{a}' AS a, '{b}' AS b, truth = '{a}' AS pos, p_{a} AS score FROM scored WHERE truth IN ('{a}', '{b}')"
    for a in LABELS
    for b in LABELS
    if a != b
)


@query(
    "roc_auc_ovo",
    f"""WITH {SCORED}, pairs AS ({_PAIRS}),
    r AS (SELECT *, rank() OVER (PARTITION BY run, a, b ORDER BY score) + (count(*) OVER (PARTITION BY run, a, b, score) - 1) / 2.0 AS rk FROM pairs),
    s AS (SELECT run, a, b, sum(CASE WHEN pos THEN rk END) AS rs, CAST(count(*) FILTER (pos) AS DOUBLE) AS p,
      CAST(count(*) FILTER (NOT pos) AS DOUBLE) AS q FROM r GROUP BY 1, 2, 3)
    SELECT run, round(avg((rs - p * (p + 1) / 2) / (p * q)), 6) AS roc_auc FROM s GROUP BY 1""",
    digits=6,
)
def auc_ovo(spark, sf_dir):
    return roc_auc_ovo(scored(spark, sf_dir), ["run"], LABELS, "truth", {t: f"p_{t}" for t in LABELS})


def _metadata(purpose, cls):
    return {
        "timestamp": F.lit("20240131120000"),
        "model_purpose": F.lit(purpose),
        "model_class": F.lit(cls),
        "special_features": F.col("run"),
    }


@query(
    "evaluation_record",
    f"""WITH {PREDICTIONS}, s AS (SELECT run, {_SCORES_SQL} FROM predictions GROUP BY 1)
    SELECT run, '20240131120000_Ridge_r2' || CASE WHEN trunc("R2" * 10000) < 0 THEN '-' || lpad(CAST(CAST(-trunc("R2" * 10000) AS BIGINT) AS VARCHAR), 4, '0')
        ELSE lpad(CAST(CAST(trunc("R2" * 10000) AS BIGINT) AS VARCHAR), 5, '0') END || '_predict_' || run AS model_name,
      '20240131120000' AS "timestamp", 'predict' AS model_purpose, 'Ridge' AS model_class, run AS special_features, {_ROUNDED} FROM s""",
    digits=6,
    MSE=3,
)
def evaluation_record(spark, sf_dir):
    found = regression_metrics(predictions(spark, sf_dir), ["run"])
    return regression_record(found, ["run"], _metadata("predict", "Ridge"))


@query(
    "evaluation_record_classes",
    f"""WITH {SCORED}, {_CLASSES}, {_AVERAGES}, {_LISTED_SQL}, pairs AS ({_PAIRS}),
    ranked AS (SELECT *, rank() OVER (PARTITION BY run, a, b ORDER BY score) + (count(*) OVER (PARTITION BY run, a, b, score) - 1) / 2.0 AS rk FROM pairs),
    auc AS (SELECT run, a, b, sum(CASE WHEN pos THEN rk END) AS rs, CAST(count(*) FILTER (pos) AS DOUBLE) AS p,
      CAST(count(*) FILTER (NOT pos) AS DOUBLE) AS q FROM ranked GROUP BY 1, 2, 3),
    places AS (SELECT unnest({LISTED}) AS label, unnest(range({len(LISTED)})) AS i),
    matrix AS (SELECT r.run, 'C_' || t.i || '_' || p.i AS cell, coalesce((SELECT n FROM tally c WHERE c.run = r.run AND c.truth = t.label AND c.pred = p.label), 0) AS n
      FROM (SELECT DISTINCT run FROM scored) r, places t, places p)
    SELECT a.run, '20240131120000_RidgeClassifier_f1' || lpad(CAST(CAST(trunc(a.f1 * 10000) AS BIGINT) AS VARCHAR), 5, '0') || '_classify_' || a.run AS model_name,
      a.mode AS avg_mode, round(a.f1, 6) AS f1, round(a.recall, 6) AS recall, round(a.precision, 6) AS precision,
      (SELECT round(avg(p.recall), 6) FROM per_class p WHERE p.run = a.run AND p.support > 0) AS bal_accuracy,
      (SELECT round(avg((rs - p * (p + 1) / 2) / (p * q)), 6) FROM auc u WHERE u.run = a.run) AS roc_auc,
      (SELECT string_agg(cell || '=' || n, ' ' ORDER BY cell) FROM matrix m WHERE m.run = a.run) AS conf_matrix,
      (SELECT string_agg(label || printf(':%.9f:%.9f:%.9f:', precision, recall, f1) || support, ' ' ORDER BY label) FROM listed_report l WHERE l.run = a.run) AS report
    FROM averages a WHERE mode = 'macro'""",
    digits=6,
)
def evaluation_record_classes(spark, sf_dir):
    """The stored record, every value of its maps written out."""
    rows = scored(spark, sf_dir)
    auc = roc_auc_ovo(rows, ["run"], LABELS, "truth", {t: f"p_{t}" for t in LABELS})
    records = classification_record(rows, ["run"], LISTED, _metadata("classify", "RidgeClassifier"), auc=auc, avg_mode="macro")

    def spelled(column, text):
        return F.array_join(F.transform(F.array_sort(F.map_entries(column)), lambda e: text(e["key"], e["value"])), " ")

    def line(label, v):
        return F.concat(label, F.format_string(":%.9f:%.9f:%.9f:%d", v["precision"], v["recall"], v["f1-score"], v["support"]))

    return records.select(
        "run",
        "model_name",
        "avg_mode",
        "f1",
        "recall",
        "precision",
        "bal_accuracy",
        F.col("roc_auc_score").cast("double").alias("roc_auc"),
        spelled("conf_matrix", lambda cell, n: F.concat(cell, F.lit("="), n.cast("string"))).alias("conf_matrix"),
        spelled("classification_report", line).alias("report"),
    )

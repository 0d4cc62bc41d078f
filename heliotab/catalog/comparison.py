"""Stored runs: scan, rank, compare."""

from pyspark.sql import functions as F

from ..operators import compare
from ..operators.series import curve_summary
from ..session import scratch_dir
from ..sources.run_files import scan_runs, select_fields
from ..sources.sinks import write_run_records
from .registry import query
from .stand_ins import PREDICTIONS, RUNS, predictions, runs

METRICS = ["MAE", "MSE", "RMSE", "R2"]
_ROUNDED = 'round("MAE", 4) AS "MAE", round("MSE", 2) AS "MSE", round("RMSE", 4) AS "RMSE", round("R2", 6) AS "R2"'


@query(
    "registry_scan",
    f"""WITH {RUNS} SELECT name, "timestamp", model_purpose, model_class, special_features, round("MAE", 4) AS "MAE", round("R2", 6) AS "R2",
        CAST(NULL AS DOUBLE) AS "MedAE", round("MAE", 4) AS single_dim_scores__sol__MAE, CAST(NULL AS DOUBLE) AS single_dim_scores__sun__MAE FROM runs""",
    R2=6,
)
def registry_scan(spark, sf_dir):
    """Store the runs as nested JSON, one folder each, then read the registry back."""
    nested = F.create_map(F.lit("sol"), F.create_map(F.lit("MAE"), F.col("MAE")))
    root = scratch_dir(spark, "runs")
    write_run_records(runs(spark, sf_dir).withColumn("single_dim_scores", nested), root)
    fields = ["timestamp", "model_purpose", "model_class", "special_features", "MAE", "R2", "MedAE"]
    return select_fields(scan_runs(spark, root), [*fields, "single_dim_scores__sol__MAE", "single_dim_scores__sun__MAE"])


@query(
    "registry_baselines",
    f"""WITH {RUNS} SELECT name, model_purpose, round("R2", 6) AS "R2" FROM runs WHERE model_purpose LIKE 'baseline%'""",
    digits=6,
)
def registry_baselines(spark, sf_dir):
    return compare.baselines(runs(spark, sf_dir)).select("name", "model_purpose", "R2")


@query("registry_ranked", f'WITH {RUNS} SELECT name, {_ROUNDED} FROM runs ORDER BY "R2" DESC, name', MSE=2, R2=6)
def registry_ranked(spark, sf_dir):
    return compare.ranked(runs(spark, sf_dir)).select("name", *METRICS)


@query(
    "registry_latest",
    f'WITH {RUNS} SELECT name, "timestamp", {_ROUNDED} FROM runs ORDER BY "timestamp" DESC, name DESC LIMIT 1',
    MSE=2,
    R2=6,
)
def registry_latest(spark, sf_dir):
    return compare.latest(runs(spark, sf_dir)).select("name", "timestamp", *METRICS)


_LONG = f"WITH {RUNS}, long AS (" + " UNION ALL ".join(f"SELECT name, '{m}' AS metric, \"{m}\" AS value FROM runs" for m in METRICS) + ")"


@query(
    "registry_band",
    f"{_LONG} SELECT metric, round(min(value), 2) AS lowest, round(max(value), 2) AS highest, round(median(value), 2) AS median FROM long GROUP BY 1",
    digits=2,
)
def registry_band(spark, sf_dir):
    return compare.metric_band(runs(spark, sf_dir), METRICS)


_BEST = f"""{_LONG}, best AS (SELECT metric, CASE WHEN metric = 'R2' THEN first(name ORDER BY value DESC, name) ELSE first(name ORDER BY value, name) END AS name,
  CASE WHEN metric = 'R2' THEN max(value) ELSE min(value) END AS value FROM long GROUP BY 1)"""


@query("registry_best", f"{_BEST} SELECT metric, name, round(value, 2) AS value FROM best", digits=2)
def registry_best(spark, sf_dir):
    return compare.best_runs(runs(spark, sf_dir), METRICS)


_LABEL = """CASE WHEN model_class = 'RandomForestClassifier' THEN 'rf' ELSE model_class END || ' ' || substr("timestamp", 5, 2) || '-' ||
  substr("timestamp", 7, 2) || ' ' || substr("timestamp", 9, 2) || ':' || substr("timestamp", 11, 2) || ':' || substr("timestamp", 13, 2) || ' ' ||
  coalesce(nullif(special_features, ''), model_purpose)"""


@query("run_labels", f"WITH {RUNS} SELECT name, {_LABEL} AS label FROM runs")
def run_labels(spark, sf_dir):
    return runs(spark, sf_dir).select("name", compare.run_label().alias("label"))


@query(
    "registry_compare",
    f"""{_BEST}, wins AS (SELECT name, string_agg(metric, ',' ORDER BY metric) AS best_in FROM best GROUP BY 1)
    SELECT name, {_LABEL} AS label, round("R2", 6) AS "R2", model_purpose LIKE 'baseline%' AS is_baseline,
      "timestamp" = (SELECT max("timestamp") FROM runs) AS is_latest, coalesce(best_in, '') AS best_in
    FROM runs LEFT JOIN wins USING (name)""",
    digits=6,
)
def registry_compare(spark, sf_dir):
    compared = compare.compare_runs(runs(spark, sf_dir), METRICS)
    return compared.select("name", "label", "R2", "is_baseline", "is_latest", "best_in")


@query(
    "curve_smooth",
    f"""WITH {PREDICTIONS}, folds AS (SELECT run, year("timestamp") AS train_size, o_orderkey % 5 AS fold, avg(y) / 100000 AS score
          FROM predictions GROUP BY 1, 2, 3),
    m AS (SELECT run, train_size, avg(score) AS x FROM folds GROUP BY 1, 2)
    SELECT run, train_size, round(x, 8) AS mean_score, round(min(x) OVER (PARTITION BY run), 8) AS min_score, round(max(x) OVER (PARTITION BY run), 8) AS max_score,
      round((coalesce(lag(x) OVER w, x) + x + coalesce(lead(x) OVER w, x)) / 3, 8) AS smooth_score
    FROM m WINDOW w AS (PARTITION BY run ORDER BY train_size)""",
    digits=8,
)
def curve_smooth(spark, sf_dir):
    folds = predictions(spark, sf_dir).groupBy(
        "run", F.year("timestamp").alias("train_size"), (F.col("o_orderkey") % 5).alias("fold")
    ).agg((F.avg("y") / 100000).alias("score"))
    return curve_summary(folds, ["run"])

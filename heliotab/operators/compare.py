"""Comparing stored model runs."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import settle
from .ranks import exact_median

# Short names of model classes.
MODEL_ALIASES = {
    "HistGradientBoostingClassifier": "hgb",
    "RandomForestClassifier": "rf",
    "Sequential": "nn",
    "GradientBoostingClassifier": "gb",
    "ExtraTreesClassifier": "et",
    "BaggingClassifier": "bag",
    "DecisionTreeClassifier": "dt",
    "AdaBoostClassifier": "ada",
    "RidgeClassifier": "ridge",
    "KNeighborsClassifier": "knn",
    "LogisticRegression": "logreg",
    "MLPClassifier": "mlp",
    "GaussianNB": "gnb",
}
METRICS = ["MAE", "MSE", "RMSE", "MAPE", "MedAE", "R2", "ExplainedVar"]
HIGHER_IS_BETTER = {"R2", "ExplainedVar"}


def alias_of(model_class: str = "model_class") -> Column:
    table = F.create_map(*[F.lit(x) for pair in MODEL_ALIASES.items() for x in pair])
    return F.coalesce(F.try_element_at(table, F.col(model_class)), F.col(model_class))


def run_label(timestamp: str = "timestamp") -> Column:
    """Class alias, run time as ``MM-dd HH:mm:ss``, and features (or the purpose without any)."""
    at = F.date_format(F.to_timestamp(F.col(timestamp), "yyyyMMddHHmmss"), "MM-dd HH:mm:ss")
    what = F.coalesce(F.nullif(F.col("special_features"), F.lit("")), F.col("model_purpose"))
    return F.concat_ws(" ", alias_of(), at, what)


def baselines(runs: DataFrame, keep: bool = True) -> DataFrame:
    is_baseline = F.col("model_purpose").startswith("baseline")
    return runs.filter(is_baseline if keep else ~is_baseline)


def ranked(runs: DataFrame, descending: bool = True) -> DataFrame:
    return runs.orderBy(F.desc("R2") if descending else F.asc("R2"), "name")


def latest(runs: DataFrame) -> DataFrame:
    """The newest run; its name breaks ties."""
    newest = F.max_by(F.struct(*runs.columns), F.struct("timestamp", "name"))
    return runs.agg(newest.alias("r")).select("r.*")


def run_at(runs: DataFrame, timestamp: str) -> DataFrame:
    """The run of one timestamp; an unknown one fails."""
    found = runs.filter(F.col("timestamp") == timestamp)
    if found.isEmpty():
        raise ValueError(f"no run with timestamp {timestamp}")
    return found


def _long(runs: DataFrame, metrics: list[str]) -> DataFrame:
    return runs.select("name", *[F.col(m).cast("double").alias(m) for m in metrics]).unpivot(
        ["name"], metrics, "metric", "value"
    )


def metric_band(runs: DataFrame, metrics: list[str] = METRICS) -> DataFrame:
    """Minimum, maximum and median of each metric over the runs."""
    long = settle(_long(runs, metrics).filter("value is not null"))
    limits = long.groupBy("metric").agg(F.min("value").alias("lowest"), F.max("value").alias("highest"))
    return limits.join(exact_median(long, ["metric"], "value", "median"), "metric")


def best_runs(runs: DataFrame, metrics: list[str] = METRICS) -> DataFrame:
    """Best run per metric; the smaller name wins a tie."""
    up = F.col("metric").isin(*HIGHER_IS_BETTER)
    cost = F.when(up, -F.col("value")).otherwise(F.col("value"))
    best = F.min(F.struct(cost.alias("cost"), "name", "value"))
    return (
        _long(runs, metrics)
        .filter("value is not null")
        .groupBy("metric")
        .agg(best.alias("b"))
        .select("metric", "b.name", "b.value")
    )


def compare_runs(runs: DataFrame, metrics: list[str] = METRICS) -> DataFrame:
    """Every run with its label, baseline flag, newest flag and the metrics in which it is best."""
    runs = settle(runs, "registry")
    newest = latest(runs).select("name", F.lit(True).alias("_newest"))
    wins = best_runs(runs, metrics).groupBy("name").agg(F.array_sort(F.collect_set("metric")).alias("best_in"))
    return (
        runs.join(newest, "name", "left")
        .join(wins, "name", "left")
        .withColumns(
            {
                "label": run_label(),
                "is_baseline": F.col("model_purpose").startswith("baseline"),
                "is_latest": F.coalesce("_newest", F.lit(False)),
                "best_in": F.array_join(F.coalesce("best_in", F.array().cast("array<string>")), ","),
            }
        )
        .drop("_newest")
    )

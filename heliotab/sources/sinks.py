"""Writers. Nothing here gathers rows; files are bounded by row count, not by installation."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_ROWS_PER_FILE = 5_000_000


def write_series(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Power, weather or enriched table as Parquet, one directory per installation.

    Rows are rebalanced by installation: adaptive execution splits a dominant installation over
    many tasks and packs small ones together, so files are neither huge nor tiny.
    """
    (
        df.hint("rebalance", "installation")
        .write.mode(mode)
        .option("maxRecordsPerFile", MAX_ROWS_PER_FILE)
        .partitionBy("installation")
        .parquet(path)
    )


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).csv(path, sep=";", header=True)


def write_run_records(records: DataFrame, root: str, name: str = "name") -> None:
    """Evaluation records as JSON, one folder ``<root>/run=<run>`` each, which the registry scan reads.

    Spark's committer replaces the folders of the runs written and leaves all others alone, so a run
    that is written again has its last record only. Two records of one name fail before anything is
    written.
    """
    runs = records.withColumn("run", F.col(name)).drop("name")
    twice = runs.groupBy("run").count().filter("count > 1 or run is null").select("run").limit(5).collect()
    if twice:
        raise ValueError(f"several records, or none, for a name: {', '.join(str(r.run) for r in twice)}")
    writer = runs.repartition("run").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("run").json(root)


def curve_table(curve: DataFrame, score: str, folds: int = 5) -> DataFrame:
    """One row per train size with a column ``scores_i`` per fold."""
    per_fold = [F.max(F.when(F.col("fold") == i, F.col(score))).alias(f"scores_{i}") for i in range(folds)]
    return curve.groupBy(F.col("share").alias("train_sizes")).agg(*per_fold)


def write_learning_curve(curve: DataFrame, path: str, folds: int = 5, scoring: str = "r2", seconds: float | None = None) -> None:
    """Train and validation scores per fold as CSV, and a one-row summary as JSON."""
    root = path.rstrip("/")
    write_csv(curve_table(curve, "train_score", folds), f"{root}/train_scores")
    write_csv(curve_table(curve, "validation_score", folds), f"{root}/validation_scores")
    sizes = F.array_sort(F.collect_set("share")).alias("train_sizes")
    summary = curve.agg(
        F.lit(folds).alias("cv"), F.lit(scoring).alias("scoring"), sizes, F.lit(seconds).cast("double").alias("training_time_sec")
    )
    summary.write.mode("overwrite").json(f"{root}/summary")


def write_importance(importance: DataFrame, path: str) -> None:
    write_csv(importance, path)


def prediction_export(df: DataFrame, date: str = "date", pred: str = "pred", keys=("installation",)) -> DataFrame:
    """Date and prediction rounded to three decimals."""
    return df.select(*keys, F.to_date(date).alias("date"), F.round(F.col(pred), 3).alias("predicted"))

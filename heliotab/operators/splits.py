"""Train/test splits."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import hash32


def chronological_holdout(
    df: DataFrame, holdout: int, order: tuple[str, ...] = ("date",), keys: tuple[str, ...] = ("installation",), lag: int = 0
) -> DataFrame:
    """Add ``part``: the last ``holdout - 1`` rows of each series are test, the rest train.

    With ``lag`` rows are left out around the cut: ``lag`` rows before the test block belong to
    neither part, and the first ``lag`` rows of each part have no complete lags.
    Runs on daily or hourly series, whose length is bounded by the calendar.
    """
    newest = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order])
    rank = F.row_number().over(newest)
    if not lag:
        return df.withColumn("part", F.when(rank <= holdout - 1, "test").otherwise("train"))
    ranked = df.withColumn("_rank", rank).withColumn("_n", F.count("*").over(Window.partitionBy(*keys)))
    part = (
        F.when(F.col("_rank") <= holdout - 1 - lag, "test")
        .when(F.col("_rank") <= holdout - 1, "test_warmup")
        .when(F.col("_rank") <= holdout - 1 + lag, "gap")
        .when(F.col("_rank") <= F.col("_n") - lag, "train")
        .otherwise("train_warmup")
    )
    return ranked.withColumn("part", part).drop("_rank", "_n")


def random_split(df: DataFrame, key: Column | str, test_share: float = 0.2, seed: int = 42) -> DataFrame:
    """Add ``part`` from a hash of the key: repeatable on any partitioning, no shuffle."""
    position = key if isinstance(key, Column) else hash32(key, F.lit(seed))
    return df.withColumn("part", F.when(position < int(test_share * 2**32), "test").otherwise("train"))

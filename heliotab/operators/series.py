"""Rolling means, lags, autocorrelation and curves on aggregated series.

Everything here runs after aggregation to days, weeks or hours, where the rows of one
installation are bounded by the calendar, whatever the volume of raw readings.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Fixed value: two-sided 95 % quantile of the normal distribution.
Z_95 = 1.959964


def rolling_mean(df: DataFrame, cols: list[str], frame: int, order: list[str], keys=("installation",)) -> DataFrame:
    """Mean of the current and the ``frame - 1`` rows before it (fewer at the start)."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(1 - frame, 0)
    return df.withColumns({f"{c}_roll_{frame}": F.avg(c).over(w) for c in cols})


def with_lags(df: DataFrame, cols: list[str], lags: list[int], order: str = "date", keys=("installation",), drop_incomplete: bool = True) -> DataFrame:
    """``c_lag_k`` columns, lag by lag; the first ``max(lags)`` rows of a series drop out."""
    w = Window.partitionBy(*keys).orderBy(order)
    out = df.withColumns({f"{c}_lag_{k}": F.lag(c, k).over(w) for k in lags for c in cols})
    if not drop_incomplete:
        return out
    return out.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") > max(lags)).drop("_rn")


def autocorrelation(df: DataFrame, value: str, order: list[str], keys: tuple[str, ...] = (), max_lag: int = 400) -> DataFrame:
    """Autocorrelation of an aggregated series for lags 0..max_lag with its 95 % band.

    A series is one array of calendar length; each lag is a fold over it, so no pair of rows is
    ever shuffled. The band at lag k is Bartlett's, from the correlations below k.
    """
    known = df.filter(F.col(value).isNotNull()).withColumn("_one", F.lit(0))
    keys = list(keys) or ["_one"]
    ordered = F.array_sort(F.collect_list(F.struct(*order, F.col(value).cast("double").alias("_v"))))
    series = known.groupBy(*keys).agg(
        F.transform(ordered, lambda s: s["_v"]).alias("_x"),
        F.avg(F.col(value).cast("double")).alias("_mean"),
        F.count("*").cast("int").alias("_n"),
    )
    centred = series.withColumn("_c", F.transform("_x", lambda v: v - F.col("_mean"))).drop("_x", "_mean")
    lagged = centred.withColumn("lag", F.explode(F.sequence(F.lit(0), F.least(F.lit(max_lag), F.col("_n") - 1))))
    n, lag = F.col("_n"), F.col("lag")

    def dot(a, b):
        return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, v: acc + v)

    products = lagged.select(
        *keys, "_n", "lag", dot(F.slice("_c", 1, n - lag), F.slice("_c", lag + 1, n - lag)).alias("_dot")
    )
    by_key = Window.partitionBy(*keys).orderBy("lag")
    before = by_key.rowsBetween(Window.unboundedPreceding, -1)
    acf = products.withColumn("acf", F.try_divide(F.col("_dot"), F.first("_dot").over(by_key)))
    squares = F.sum(F.when(F.col("lag") > 0, F.col("acf") * F.col("acf"))).over(before)
    variance = F.when(F.col("lag") == 0, 0.0).otherwise((1 + 2 * F.coalesce(squares, F.lit(0.0))) / F.col("_n"))
    return acf.withColumn("variance", variance).select(
        *[k for k in keys if k != "_one"], "lag", "acf", "variance", (F.lit(Z_95) * F.sqrt("variance")).alias("band")
    )


def curve_summary(folds: DataFrame, run: list[str], size: str = "train_size", score: str = "score") -> DataFrame:
    """Mean score per train size, its extremes per run, and a centred mean of three sizes."""
    mean = folds.groupBy(*run, size).agg(F.avg(score).alias("mean_score"))
    w, whole = Window.partitionBy(*run).orderBy(size), Window.partitionBy(*run)
    x = F.col("mean_score")
    smooth = (F.coalesce(F.lag(x).over(w), x) + x + F.coalesce(F.lead(x).over(w), x)) / 3
    return mean.withColumns(
        {
            "min_score": F.min(x).over(whole),
            "max_score": F.max(x).over(whole),
            "smooth_score": smooth,
        }
    )

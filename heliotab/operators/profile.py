"""Column profiles, correlations, histograms and outliers over whole tables.

Tables are profiled in long form (variable, value): one shuffle with map-side counting
serves distinct counts, frequencies and entropy of every column at once.
"""

from itertools import combinations_with_replacement

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import join_stats, settle
from .clean import numeric_columns
from .ranks import exact_median, exact_quantiles, running_total

# Fixed value: upper quartile of the normal distribution, makes the MAD comparable to a standard deviation.
MAD_SCALE = 0.6744897501960817


def long_strings(df: DataFrame, cols: list[str]) -> DataFrame:
    """(variable, value as text), one row per cell."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot([], cols, "variable", "value")


def long_numbers(df: DataFrame, cols: list[str], ids: tuple[str, ...] = ()) -> DataFrame:
    return df.select(*ids, *[F.col(c).cast("double").alias(c) for c in cols]).unpivot(
        list(ids), cols, "variable", "value"
    )


def value_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    return long_strings(df, cols).groupBy("variable", "value").agg(F.count("*").alias("n"))


def overview(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Per column: type, rows, missing, distinct values and their percentages."""
    cols = cols or df.columns
    types = {f.name: f.dataType.simpleString() for f in df.schema}
    dtype = F.create_map(*[x for c in cols for x in (F.lit(c), F.lit(types[c]))])
    stats = value_counts(df, cols).groupBy("variable").agg(
        F.sum("n").alias("n_rows"),
        F.coalesce(F.sum(F.when(F.col("value").isNotNull(), F.col("n"))), F.lit(0)).alias("total"),
        F.count("value").alias("n_uniques"),
    )
    return stats.select(
        "variable",
        F.element_at(dtype, F.col("variable")).alias("dtype"),
        "n_rows",
        "total",
        (F.col("n_rows") - F.col("total")).alias("missing"),
        ((F.col("n_rows") - F.col("total")) * 100 / F.col("n_rows")).alias("missing_pct"),
        "n_uniques",
        (F.col("n_uniques") * 100 / F.col("n_rows")).alias("uniques_pct"),
    )


def distinct_values(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Every distinct value per column as text, and whether it is no number. Long form, uncapped."""
    return value_counts(df, cols or df.columns).select(
        "variable", "value", F.col("value").try_cast("double").isNull().alias("non_numeric")
    )


def deviation(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """How many standard deviations the extremes lie from the mean, one decimal."""
    x = F.col("value")
    return (
        long_numbers(df, cols or numeric_columns(df))
        .filter(x.isNotNull())
        .groupBy("variable")
        .agg(F.avg(x).alias("mean"), F.min(x).alias("lo"), F.max(x).alias("hi"), F.stddev_samp(x).alias("sd"))
        .select(
            "variable",
            F.round(F.try_divide(F.col("mean") - F.col("lo"), F.col("sd")), 1).alias("below"),
            F.round(F.try_divide(F.col("hi") - F.col("mean"), F.col("sd")), 1).alias("above"),
        )
    )


def frequency_extremes(df: DataFrame, cols: list[str]) -> DataFrame:
    """Most and least frequent value; among equals the smallest and the largest value."""
    counts = value_counts(df, cols).filter("value is not null")
    top = F.min(F.struct((-F.col("n")).alias("k"), "value"))
    rare = F.max(F.struct((-F.col("n")).alias("k"), "value"))
    return counts.groupBy("variable").agg(top.alias("t"), rare.alias("r")).select(
        "variable",
        F.col("t.value").alias("most_value"),
        (-F.col("t.k")).alias("most_n"),
        F.col("r.value").alias("least_value"),
        (-F.col("r.k")).alias("least_n"),
    )


def entropy(df: DataFrame, cols: list[str]) -> DataFrame:
    """Shannon entropy over its maximum; 0 for a single class, 1 for a uniform one.

    Uses sum(-p log2 p) = log2(N) - sum(n log2 n) / N, so one grouped pass is enough.
    """
    counts = value_counts(df, cols).filter("value is not null")
    n, total, k = F.col("n"), F.col("total"), F.col("k")
    return (
        counts.groupBy("variable")
        .agg(F.sum(n).alias("total"), F.count("*").alias("k"), F.sum(n * F.log2(n)).alias("s"))
        .select(
            "variable",
            F.round(
                (F.log2(total) - F.col("s") / total) / F.when(k > 1, F.log2(k)).otherwise(F.lit(1.0)), 2
            ).alias("norm_entropy"),
        )
    )


def describe(df: DataFrame, cols: list[str] | None = None, approx: bool = False) -> DataFrame:
    """count, mean, std, min, quartiles, max per numeric column."""
    x = F.col("value")
    long = long_numbers(df, cols or numeric_columns(df))
    basic = long.groupBy("variable").agg(
        F.count(x).alias("count"),
        F.avg(x).alias("mean"),
        F.stddev_samp(x).alias("std"),
        F.min(x).alias("min"),
        F.max(x).alias("max"),
    )
    quartiles = exact_quantiles(long, ["variable"], "value", {"q25": 0.25, "q50": 0.5, "q75": 0.75}, approx=approx)
    return basic.join(quartiles, "variable", "left")


def correlation_matrix(df: DataFrame, cols: list[str] | None = None, threshold: float = 0.3) -> DataFrame:
    """Pairwise-complete Pearson correlation of all columns from one aggregate.

    ``shown`` is rounded to two decimals and blank below the threshold.
    """
    cols = cols or numeric_columns(df)
    pairs = list(combinations_with_replacement(cols, 2))
    entries = [
        F.struct(
            F.lit(a).alias("a"),
            F.lit(b).alias("b"),
            F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias("r"),
        )
        for a, b in pairs
    ]
    r = F.col("e.r")
    cells = df.agg(F.array(*entries).alias("es")).select(F.explode("es").alias("e"))
    upper = cells.select(F.col("e.a").alias("col_a"), F.col("e.b").alias("col_b"), r.alias("r"))
    sides = F.when(
        F.col("col_a") != F.col("col_b"),
        F.array(F.struct("col_a", "col_b"), F.struct(F.col("col_b").alias("col_a"), F.col("col_a").alias("col_b"))),
    ).otherwise(F.array(F.struct("col_a", "col_b")))
    return upper.select(F.explode(sides).alias("s"), "r").select(
        "s.col_a", "s.col_b", "r", F.when(F.abs("r") >= threshold, F.round("r", 2)).alias("shown")
    )


def mad_flags(df: DataFrame, keys: list[str], value: str = "value", std: float = 3.0) -> DataFrame:
    """Rows with ``outlier``: |x - median| / (MAD / 0.6745) >= std; null is no outlier.

    With a MAD of zero every value off the median is an outlier.
    """
    medians = settle(exact_median(df, keys, value, "_median"))
    centred = join_stats(df, medians, keys).withColumn("_dev", F.abs(F.col(value) - F.col("_median")))
    mads = settle(exact_median(centred, keys, "_dev", "_mad"))
    scaled = F.col("_dev") * MAD_SCALE / F.col("_mad")
    flag = F.when(F.col("_mad") == 0, F.col("_dev") > 0).otherwise(scaled >= std)
    return join_stats(centred, mads, keys).withColumn("outlier", F.coalesce(flag, F.lit(False))).drop(
        "_median", "_dev", "_mad"
    )


def outlier_thresholds(flagged: DataFrame, keys: list[str], value: str = "value") -> DataFrame:
    """Smallest and largest inlier, and the share of values beyond them."""
    x = F.col(value)
    known = flagged.filter(x.isNotNull())
    inlier = F.when(~F.col("outlier"), x)
    limits = settle(known.groupBy(*keys).agg(F.min(inlier).alias("lower"), F.max(inlier).alias("upper")))
    return (
        join_stats(known, limits, keys)
        .groupBy(*keys)
        .agg(
            F.first("lower").alias("lower"),
            F.first("upper").alias("upper"),
            F.avg((x < F.col("lower")).cast("double")).alias("share_below"),
            F.avg((x > F.col("upper")).cast("double")).alias("share_above"),
        )
    )


def histogram(
    df: DataFrame, keys: list[str], value: str = "value", split: tuple[str, ...] = (), bins: int = 100, subset=None
) -> DataFrame:
    """Equal-width bins over the range of each key, split by flag columns; ``subset`` keeps the axis."""
    x = F.col(value)
    ranges = settle(df.filter(x.isNotNull()).groupBy(*keys).agg(F.min(x).alias("_lo"), F.max(x).alias("_hi")))
    rows = join_stats(df.filter(x.isNotNull() if subset is None else x.isNotNull() & subset), ranges, keys)
    width = F.col("_hi") - F.col("_lo")
    position = F.coalesce(F.floor(F.try_divide(x - F.col("_lo"), width) * bins), F.lit(0))
    counts = rows.withColumn("bin", F.least(position, F.lit(bins - 1))).groupBy(*keys, *split, "bin")
    return counts.agg(F.count("*").alias("n"), F.first(F.col("_lo") + F.col("bin") * width / bins).alias("bin_start"))


def ecdf(df: DataFrame, keys: list[str], value: str = "value") -> DataFrame:
    """Cumulative share at every distinct value, without ordering a whole column in one task."""
    counts = (
        df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("n"))
    )
    totals = settle(counts.groupBy(*keys).agg(F.sum("n").alias("_all")))
    ranked = running_total(counts, keys, value, ["n"])
    return join_stats(ranked, totals, keys).select(
        *keys, value, "n", ((F.col("n_before") + F.col("n")) / F.col("_all")).alias("cumulative")
    )

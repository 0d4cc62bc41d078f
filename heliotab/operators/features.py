"""Feature columns: flags, threshold categories, scaling, label codes."""

from pyspark.ml.feature import StringIndexer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import join_stats, settle


def missing_flags(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.withColumns({f"{c}_isna": F.col(c).isNull() for c in cols})


def threshold_categories(df: DataFrame, cols: list[str], thresholds: list) -> DataFrame:
    """``c_cat`` labels: ``<t`` below the first, ``[a-b)`` between, ``t+`` from the last, ``NA`` for null.

    One list of thresholds for a single column, or one list per column.
    """
    nested = [isinstance(t, (list, tuple)) for t in thresholds]
    if any(nested) and not all(nested):
        raise ValueError("thresholds must be numbers only or lists only")
    per_column = [sorted(t) for t in thresholds] if any(nested) else [sorted(thresholds)]
    if len(per_column) != len(cols):
        raise ValueError("one list of thresholds per column is needed")

    def label(c, cuts):
        out = F.when(F.col(c).isNull(), "NA").when(F.col(c) < cuts[0], f"<{cuts[0]}")
        for low, high in zip(cuts, cuts[1:]):
            out = out.when(F.col(c) < high, f"[{low}-{high})")
        return out.otherwise(f"{cuts[-1]}+")

    return df.withColumns({f"{c}_cat": label(c, cuts) for c, cuts in zip(cols, per_column)})


def minmax_fit(train: DataFrame, cols: list[str], keys: tuple[str, ...] = ("installation",)) -> DataFrame:
    """Minimum and width per column, one settled row per key; a constant column has width 1."""
    stats = train.groupBy(*keys).agg(
        *[F.min(F.col(c).cast("double")).alias(f"{c}__lo") for c in cols],
        *[F.max(F.col(c).cast("double")).alias(f"{c}__hi") for c in cols],
    )

    def width(c):
        span = F.col(f"{c}__hi") - F.col(f"{c}__lo")
        return F.when(span == 0, F.lit(1.0)).otherwise(span)

    return settle(
        stats.select(*keys, *[x for c in cols for x in (F.col(f"{c}__lo"), width(c).alias(f"{c}__width"))]), "scaler"
    )


def minmax_apply(df: DataFrame, scaler: DataFrame, cols: list[str], keys: tuple[str, ...] = ("installation",)) -> DataFrame:
    """Scale with the fitted ranges; values outside the training range are not clipped."""
    joined = join_stats(df, scaler, list(keys))
    scaled = {c: (F.col(c) - F.col(f"{c}__lo")) / F.col(f"{c}__width") for c in cols}
    return joined.withColumns(scaled).select(*df.columns)


def label_codes(df: DataFrame, col: str, out: str) -> DataFrame:
    """Class label to its position among the sorted labels."""
    indexed = StringIndexer(inputCol=col, outputCol=out, stringOrderType="alphabetAsc").fit(df).transform(df)
    return indexed.withColumn(out, F.col(out).cast("bigint"))

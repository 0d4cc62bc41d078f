"""Profiles, correlations, outliers and distributions."""

from ..operators.profile import (
    correlation_matrix,
    describe,
    deviation,
    distinct_values,
    ecdf,
    entropy,
    frequency_extremes,
    histogram,
    long_numbers,
    mad_flags,
    outlier_thresholds,
    overview,
)
from .registry import query
from .stand_ins import READINGS, WEATHER_LONG, readings, weather_long

NUMBERS = ["sol_prod", "sol_prod_1", "sol_prod_2", "soc"]
TEXTS = ["installation", "weather_description"]
PROFILED = ["installation", "user_id", "sol_prod", "soc", "weather_description"]


def _long_sql(cols, table="readings", ids=""):
    parts = [f"SELECT {ids}'{c}' AS variable, CAST({c} AS DOUBLE) AS value FROM {table}" for c in cols]
    return " UNION ALL ".join(parts)


def _texts_sql(cols):
    return " UNION ALL ".join(f"SELECT '{c}' AS variable, CAST({c} AS VARCHAR) AS value FROM readings" for c in cols)


_LONG = f"WITH {READINGS}, long AS ({_long_sql(NUMBERS, ids='event_id, ')})"
_TEXTS = f"WITH {READINGS}, counts AS (SELECT variable, value, count(*) AS n FROM ({_texts_sql(TEXTS)}) GROUP BY 1, 2)"


@query(
    "profile_overview",
    f"""WITH {READINGS}, cells AS ({_texts_sql(PROFILED)}) SELECT variable,
      CASE variable WHEN 'user_id' THEN 'bigint' WHEN 'sol_prod' THEN 'double' WHEN 'soc' THEN 'double' ELSE 'string' END AS dtype,
      count(*) AS n_rows, count(value) AS total, count(*) - count(value) AS missing,
      round((count(*) - count(value)) * 100 / CAST(count(*) AS DOUBLE), 6) AS missing_pct, count(DISTINCT value) AS n_uniques,
      round(count(DISTINCT value) * 100 / CAST(count(*) AS DOUBLE), 6) AS uniques_pct FROM cells GROUP BY 1""",
    digits=6,
)
def profile_overview(spark, sf_dir):
    return overview(readings(spark, sf_dir), PROFILED)


@query(
    "profile_values",
    f"""WITH {READINGS}, cells AS ({_texts_sql(["installation", "user_id", "weather_description"])})
      SELECT DISTINCT variable, value, TRY_CAST(value AS DOUBLE) IS NULL AS non_numeric FROM cells""",
)
def profile_values(spark, sf_dir):
    return distinct_values(readings(spark, sf_dir), ["installation", "user_id", "weather_description"])


@query(
    "profile_deviation",
    f"""{_LONG} SELECT variable, round((avg(value) - min(value)) / stddev_samp(value), 1) AS below,
        round((max(value) - avg(value)) / stddev_samp(value), 1) AS above FROM long GROUP BY 1""",
    digits=1,
)
def profile_deviation(spark, sf_dir):
    return deviation(readings(spark, sf_dir), NUMBERS)


@query(
    "profile_freq",
    f"""{_TEXTS} SELECT variable, first(value ORDER BY n DESC, value) AS most_value, max(n) AS most_n,
        first(value ORDER BY n, value DESC) AS least_value, min(n) AS least_n FROM counts WHERE value IS NOT NULL GROUP BY 1""",
)
def profile_freq(spark, sf_dir):
    return frequency_extremes(readings(spark, sf_dir), TEXTS)


@query(
    "profile_entropy",
    f"""{_TEXTS}, shares AS (SELECT variable, n / sum(n) OVER (PARTITION BY variable) AS p, count(*) OVER (PARTITION BY variable) AS k
          FROM counts WHERE value IS NOT NULL)
        SELECT variable, round(-sum(p * log2(p)) / CASE WHEN max(k) > 1 THEN log2(max(k)) ELSE 1 END, 2) AS norm_entropy
        FROM shares GROUP BY 1""",
    digits=2,
)
def profile_entropy(spark, sf_dir):
    return entropy(readings(spark, sf_dir), TEXTS)


@query(
    "describe_numeric",
    f"""{_LONG} SELECT variable, count(value) AS count, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std,
        min(value) AS min, max(value) AS max, round(quantile_cont(value, 0.25), 6) AS q25, round(median(value), 6) AS q50,
        round(quantile_cont(value, 0.75), 6) AS q75 FROM long GROUP BY 1""",
    digits=6,
)
def describe_numeric(spark, sf_dir):
    return describe(readings(spark, sf_dir), NUMBERS)


_CORR = ["sunshine_duration", "direct_radiation", "cloud_cover", "snow_depth", "is_day"]


@query(
    "corr_matrix",
    f"WITH {WEATHER_LONG}, c AS ("
    + " UNION ALL ".join(
        f"SELECT '{a}' AS col_a, '{b}' AS col_b, corr({a}, {b}) AS r FROM weather_long" for a in _CORR for b in _CORR
    )
    + ") SELECT col_a, col_b, round(r, 6) + 0.0 AS r, CASE WHEN abs(r) >= 0.3 THEN round(r, 2) END AS shown FROM c",
    digits=6,
)
def corr_matrix(spark, sf_dir):
    return correlation_matrix(weather_long(spark, sf_dir), _CORR)


_FLAGGED = f"""{_LONG}, med AS (SELECT *, median(value) OVER (PARTITION BY variable) AS m FROM long),
  dev AS (SELECT *, abs(value - m) AS d FROM med), mads AS (SELECT variable, median(d) AS mad FROM dev GROUP BY 1),
  flagged AS (SELECT event_id, variable, value, coalesce(CASE WHEN mad = 0 THEN d > 0 ELSE d * 0.6744897501960817 / mad >= 3 END, false) AS outlier
    FROM dev JOIN mads USING (variable))"""


def _flagged(spark, sf_dir):
    return mad_flags(long_numbers(readings(spark, sf_dir), NUMBERS, ids=("event_id",)), ["variable"])


@query("mad_outliers", f"{_FLAGGED} SELECT event_id, variable, outlier FROM flagged")
def mad_outliers(spark, sf_dir):
    return _flagged(spark, sf_dir).select("event_id", "variable", "outlier")


@query(
    "mad_thresholds",
    f"""{_FLAGGED}, limits AS (SELECT variable, min(value) AS lower, max(value) AS upper FROM flagged WHERE NOT outlier GROUP BY 1)
        SELECT variable, max(lower) AS lower, max(upper) AS upper, round(avg(CAST(value < lower AS INTEGER)), 9) AS share_below,
        round(avg(CAST(value > upper AS INTEGER)), 9) AS share_above FROM flagged JOIN limits USING (variable)
        WHERE value IS NOT NULL GROUP BY 1""",
    digits=9,
)
def mad_thresholds(spark, sf_dir):
    return outlier_thresholds(_flagged(spark, sf_dir), ["variable"])


@query(
    "histogram_bins",
    f"""{_FLAGGED}, ranges AS (SELECT variable, min(value) AS lo, max(value) AS hi FROM flagged GROUP BY 1)
        SELECT variable, outlier, CAST(least(floor((value - lo) / (hi - lo) * 100), 99) AS BIGINT) AS bin, count(*) AS n,
        round(max(lo + least(floor((value - lo) / (hi - lo) * 100), 99) * (hi - lo) / 100), 6) AS bin_start
        FROM flagged JOIN ranges USING (variable) WHERE value IS NOT NULL GROUP BY 1, 2, 3""",
    digits=6,
)
def histogram_bins(spark, sf_dir):
    return histogram(_flagged(spark, sf_dir), ["variable"], split=("outlier",))


@query(
    "ecdf",
    f"""{_LONG}, counts AS (SELECT variable, value, count(*) AS n FROM long WHERE value IS NOT NULL GROUP BY 1, 2)
        SELECT variable, value, n, round(sum(n) OVER (PARTITION BY variable ORDER BY value) / CAST(sum(n) OVER (PARTITION BY variable) AS DOUBLE), 9)
        AS cumulative FROM counts""",
    digits=9,
)
def cumulative_shares(spark, sf_dir):
    return ecdf(long_numbers(readings(spark, sf_dir), NUMBERS), ["variable"])

"""Daily, hourly and calendar aggregates."""

from pyspark.sql import functions as F

from ..functions.timeparts import with_calendar
from ..operators.aggregate import calendar_aggregate, daily_sum, hourly_sum, period_features, unpivot, weather_share
from ..operators.series import autocorrelation, rolling_mean, with_lags
from .registry import query
from .stand_ins import (
    DAILY_LONG,
    DAILY_WEATHER,
    DAILY_YIELD,
    EVENT_TYPES,
    READINGS,
    WEATHER_LONG,
    daily_long,
    daily_weather,
    daily_yield,
    readings,
    weather_long,
)

FLAGS = ["a_f", "a_o", "n_f", "n_o", "r_f", "r_o"]
_SHARES = ", ".join(
    f"round(avg(CASE WHEN weather_description = '{f.upper().replace('_', ' ')}' THEN 1.0 ELSE 0.0 END), 9) AS {f}"
    for f in FLAGS
)
_FEATURES = f"""round(sum(sunshine_duration), 2) AS sunshine_duration, round(sum(direct_radiation), 2) AS direct_radiation,
  round(avg(cloud_cover), 9) AS cloud_cover, round(avg(snow_depth), 9) AS snow_depth, round(avg(is_day), 9) AS is_day, {_SHARES}"""


@query(
    "daily_features",
    f"""WITH {WEATHER_LONG} SELECT installation, date_trunc('day', "timestamp")::TIMESTAMP AS date, {_FEATURES}
        FROM weather_long GROUP BY 1, 2""",
    digits=9,
    sunshine_duration=2,
    direct_radiation=2,
)
def daily_features(spark, sf_dir):
    return period_features(weather_long(spark, sf_dir), "daily", categories=FLAGS)


@query(
    "hourly_features",
    f"""WITH {WEATHER_LONG} SELECT installation, date_trunc('day', "timestamp")::TIMESTAMP AS date, hour("timestamp") AS hour, {_FEATURES}
        FROM weather_long GROUP BY 1, 2, 3""",
    digits=9,
    sunshine_duration=2,
    direct_radiation=2,
)
def hourly_features(spark, sf_dir):
    """Weather types are discovered from the data here."""
    return period_features(weather_long(spark, sf_dir), "hourly")


@query(
    "weather_share",
    f"""WITH {READINGS} SELECT installation, """
    + ", ".join(f"round(avg(CASE WHEN weather_description = '{t}' THEN 1.0 ELSE 0.0 END), 9) AS {t}" for t in EVENT_TYPES)
    + " FROM readings GROUP BY 1",
    digits=9,
)
def share(spark, sf_dir):
    return weather_share(readings(spark, sf_dir), ["installation"], categories=EVENT_TYPES)


@query(
    "daily_sum",
    f"""WITH {READINGS} SELECT installation, date_trunc('day', "timestamp")::TIMESTAMP AS date,
        round(coalesce(sum(sol_prod), 0), 2) AS sol_prod FROM readings GROUP BY 1, 2""",
    digits=2,
)
def by_day(spark, sf_dir):
    return daily_sum(readings(spark, sf_dir))


@query(
    "hourly_sum",
    f"""WITH {READINGS} SELECT installation, date_trunc('day', "timestamp")::TIMESTAMP AS date, hour("timestamp") AS hour,
        round(coalesce(sum(sol_prod), 0), 2) AS sol_prod FROM readings GROUP BY 1, 2, 3""",
    digits=2,
)
def by_hour(spark, sf_dir):
    return hourly_sum(readings(spark, sf_dir))


@query(
    "fleet_daily_sum",
    f"""WITH {READINGS} SELECT date_trunc('day', "timestamp")::TIMESTAMP AS date, round(coalesce(sum(sol_prod), 0), 2) AS sol_prod
        FROM readings GROUP BY 1""",
    digits=2,
)
def fleet_by_day(spark, sf_dir):
    return daily_sum(readings(spark, sf_dir), keys=())


_PARTS = """parts AS (SELECT *, year("timestamp") AS year, dayofyear("timestamp") AS day_of_year, week("timestamp") AS week,
  isodow("timestamp") - 1 AS day_of_week FROM {view})"""
_MEASURES = "round(avg(soc), 9) AS soc, round(coalesce(sum(sol_prod), 0), 2) AS sol_prod, round(coalesce(sum(sol_prod_1), 0), 3) AS sol_prod_1"
_READING_PARTS = f"WITH {READINGS}, " + _PARTS.format(view="readings")


def _reading_aggregate(spark, sf_dir, by):
    return calendar_aggregate(with_calendar(readings(spark, sf_dir)), by, ["soc", "sol_prod", "sol_prod_1"])


@query(
    "by_year_day",
    f"{_READING_PARTS} SELECT installation, year, day_of_year, {_MEASURES} FROM parts GROUP BY 1, 2, 3",
    soc=9,
    sol_prod=2,
    sol_prod_1=3,
)
def by_year_day(spark, sf_dir):
    return _reading_aggregate(spark, sf_dir, ["installation", "year", "day_of_year"])


@query(
    "by_year_weekday",
    f"{_READING_PARTS} SELECT installation, year, week, day_of_week, {_MEASURES} FROM parts GROUP BY 1, 2, 3, 4",
    soc=9,
    sol_prod=2,
    sol_prod_1=3,
)
def by_year_weekday(spark, sf_dir):
    return _reading_aggregate(spark, sf_dir, ["installation", "year", "week", "day_of_week"])


@query(
    "by_weekday_week",
    f"WITH {DAILY_LONG}, {_PARTS.format(view='daily_long')} SELECT installation, day_of_week, week, "
    "round(sum(sol_prod), 2) AS sol_prod FROM parts GROUP BY 1, 2, 3",
    digits=2,
)
def by_weekday_week(spark, sf_dir):
    return _weeks(spark, sf_dir)


def _weeks(spark, sf_dir):
    return calendar_aggregate(
        with_calendar(daily_long(spark, sf_dir)), ["installation", "day_of_week", "week"], ["sol_prod"]
    )


_WEEKS = (
    f"WITH {DAILY_LONG}, {_PARTS.format(view='daily_long')}, weeks AS (SELECT installation, day_of_week, week, "
    "sum(sol_prod) AS sol_prod FROM parts GROUP BY 1, 2, 3)"
)


def _rolling_sql(frame, order):
    return (
        f"{_WEEKS} SELECT installation, day_of_week, week, round(avg(sol_prod) OVER (PARTITION BY installation "
        f"ORDER BY {order} ROWS BETWEEN {frame - 1} PRECEDING AND CURRENT ROW), 5) AS sol_prod_roll_{frame} FROM weeks"
    )


@query("rolling_mean_4", _rolling_sql(4, "day_of_week, week"), digits=5)
def rolling_mean_4(spark, sf_dir):
    return rolling_mean(_weeks(spark, sf_dir), ["sol_prod"], 4, ["day_of_week", "week"]).drop("sol_prod")


@query("rolling_mean_12", _rolling_sql(12, "day_of_week, week"), digits=5)
def rolling_mean_12(spark, sf_dir):
    return rolling_mean(_weeks(spark, sf_dir), ["sol_prod"], 12, ["day_of_week", "week"]).drop("sol_prod")


@query("rolling_mean_week", _rolling_sql(4, "week, day_of_week"), digits=5)
def rolling_mean_week(spark, sf_dir):
    return rolling_mean(_weeks(spark, sf_dir), ["sol_prod"], 4, ["week", "day_of_week"]).drop("sol_prod")


@query(
    "unpivot_measures",
    f"""WITH {READINGS} SELECT event_id, u.variable, round(u.value, 4) AS value FROM (
        SELECT event_id, unnest(['sol_prod', 'sol_prod_1', 'soc']) AS variable, unnest([sol_prod, sol_prod_1, soc]) AS value
        FROM readings) u""",
)
def unpivot_measures(spark, sf_dir):
    return unpivot(readings(spark, sf_dir), ["event_id"], ["sol_prod", "sol_prod_1", "soc"])


_LAGGED = ["sunshine_duration", "cloud_cover"]


@query(
    "lag_features",
    f"""WITH {DAILY_WEATHER}, l AS (SELECT installation, date, """
    + ", ".join(
        f"lag({c}, {k}) OVER w AS {c}_lag_{k}" for k in (1, 2, 3) for c in _LAGGED
    )
    + """, row_number() OVER w AS rn FROM daily_weather WINDOW w AS (PARTITION BY installation ORDER BY date))
    SELECT installation, CAST(date AS TIMESTAMP) AS date, """
    + ", ".join(f"round({c}_lag_{k}, 9) AS {c}_lag_{k}" for k in (1, 2, 3) for c in _LAGGED)
    + " FROM l WHERE rn > 3",
    digits=9,
)
def lag_features(spark, sf_dir):
    return with_lags(daily_weather(spark, sf_dir).select("installation", "date", *_LAGGED), _LAGGED, [1, 2, 3]).drop(*_LAGGED)


@query(
    "acf_daily",
    f"""WITH {DAILY_YIELD}, s AS (SELECT year(date) AS y, dayofyear(date) AS d, sum(sol_prod) AS v FROM daily_yield GROUP BY 1, 2),
    x AS (SELECT row_number() OVER (ORDER BY y, d) AS rn, v - avg(v) OVER () AS c, count(*) OVER () AS n FROM s),
    lags AS (SELECT unnest(range(0, 401)) AS lag),
    dots AS (SELECT lag, max(a.n) AS n, sum(a.c * b.c) AS dot FROM lags JOIN x a ON TRUE JOIN x b ON b.rn = a.rn + lag GROUP BY 1),
    r AS (SELECT lag, n, dot / (SELECT dot FROM dots WHERE lag = 0) AS acf FROM dots),
    v AS (SELECT lag, acf, CASE WHEN lag = 0 THEN 0.0 ELSE (1 + 2 * coalesce(sum(CASE WHEN lag > 0 THEN acf * acf END)
        OVER (ORDER BY lag ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / n END AS variance FROM r)
    SELECT lag, round(acf, 6) AS acf, round(variance, 8) AS variance, round(1.959964 * sqrt(variance), 6) AS band FROM v""",
    digits=6,
    variance=8,
)
def acf_daily(spark, sf_dir):
    daily = daily_yield(spark, sf_dir).groupBy(F.year("date").alias("y"), F.dayofyear("date").alias("d")).agg(
        F.sum("sol_prod").alias("v")
    )
    return autocorrelation(daily, "v", ["y", "d"])

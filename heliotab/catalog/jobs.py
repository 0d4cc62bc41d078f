"""Whole jobs. Fits with many features are checked by their normal equations: X'(y - Xw) = alpha w."""

from pyspark.sql import functions as F

from ..functions.cyclic import with_doy_trig
from ..operators.aggregate import hourly_sum, period_features
from ..operators.models import linear_value, ridge_fit, ridge_predict
from ..operators.stations import station_list
from ..plans.jobs import enrich_observed, forecast_weather, hourly_baseline, load_model, retrain_from_exports, train_observed_model
from ..plans.stored_sums import arrivals, fit_from_sums, sums_table
from ..session import scratch_dir, settle
from ..sources.run_files import scan_runs
from ..sources.sinks import write_csv
from .cleaning import PEAKS, site_rows
from .enrichment import _CHOSEN, _COMBINED, _FILLED, _GRID, _IN_RANGE, _PIVOTED, _REGRID
from .registry import query
from .stand_ins import (
    DAILY_WEATHER,
    LISTED_STATIONS,
    OBSERVATIONS,
    READINGS,
    WEATHER_LONG,
    daily_weather,
    hourly_weather,
    listed_stations,
    observations,
    quarter_hourly,
    table,
    weather_long,
    yearly_readings,
)


def gradients(rows, keys, xs, y, coefficients, alpha=1.0):
    """Per key and feature: the derivative of the ridge loss at the fit, over n and both spreads; zero for a right fit."""
    pairs = F.arrays_zip(F.array(*[F.lit(x) for x in xs]).alias("f"), F.array(*[F.col(x).cast("double") for x in xs]).alias("v"), coefficients.alias("w"))
    long = rows.select(*keys, F.col(y).alias("_y"), (F.col(y) - F.col("_fit")).alias("_e"), F.explode(pairs).alias("p"))
    gradient = F.try_divide(F.covar_pop("p.v", "_e") - alpha * F.max("p.w") / F.count("*"), F.stddev_pop("p.v") * F.stddev_pop("_y"))
    return long.groupBy(*keys, F.col("p.f").alias("feature")).agg(F.count("*").alias("n"), F.coalesce(gradient, F.lit(0.0)).alias("gradient"))


_FEATURES = ["sunshine_duration", "cloud_cover", "snow_depth", "is_day", "records", "date_doy_sin", "date_doy_cos"]


@query(
    "ridge_normal_equations",
    f"""WITH {DAILY_WEATHER}, n AS (SELECT installation, count(*) AS n FROM daily_weather WHERE cloud_cover IS NOT NULL GROUP BY 1)
    SELECT installation, n, unnest({_FEATURES}) AS feature, 0.0::DOUBLE AS gradient FROM n""",
    digits=7,
)
def normal_equations(spark, sf_dir):
    """A fit on unscaled weather features, one of them far from zero."""
    more = weather_long(spark, sf_dir).groupBy("installation", F.to_date("timestamp").alias("date")).agg(
        (F.count("*") + 1e7).alias("records"), F.avg("direct_radiation").alias("y")
    )
    rows = with_doy_trig(daily_weather(spark, sf_dir).join(more, ["installation", "date"]), "date")
    model = ridge_fit(rows, _FEATURES, ["y"], nulls="drop")
    known = rows.dropna(subset=_FEATURES)
    fitted = ridge_predict(known, model, _FEATURES, out="_fit").join(model.select("installation", "coefficients"), "installation")
    return gradients(fitted, ["installation"], _FEATURES, "y", F.col("coefficients"))


_OBSERVED_DAYS = f"""{OBSERVATIONS}, {_COMBINED}, {LISTED_STATIONS}, {_IN_RANGE}, {_CHOSEN}, {_PIVOTED},
  {_GRID.format(t="pivoted")}, {_FILLED}, {_REGRID.format(t="filled")},
  days AS (SELECT installation, CAST("timestamp" AS DATE) AS date, coalesce(sum(radiation_global), 0) AS radiation_global,
    coalesce(sum(sunshine_duration), 0) AS sunshine_duration, CAST(sum(dayofyear("timestamp")) AS DOUBLE) AS sol_prod
    FROM yearly LEFT JOIN quarters USING (installation, "timestamp") GROUP BY 1, 2)"""


def _observed_parts(spark, sf_dir):
    o = observations(spark, sf_dir)
    readings = yearly_readings(spark, sf_dir).withColumn("sol_prod", F.dayofyear("timestamp").cast("double"))
    return readings, o.filter("period = 'historical'"), o.filter("period = 'recent'"), station_list(listed_stations(spark, sf_dir))


@query(
    "observed_features",
    f"""WITH {_OBSERVED_DAYS} SELECT installation, CAST(date AS TIMESTAMP) AS date, round(sol_prod, 4) AS sol_prod,
        round(radiation_global, 4) AS radiation_global, round(sunshine_duration, 4) AS sunshine_duration FROM days""",
)
def observed_features(spark, sf_dir):
    """Daily sums of the energy and of both station measures."""
    return period_features(enrich_observed(*_observed_parts(spark, sf_dir)), "daily", categories=[])


@query(
    "observed_model",
    f"""WITH {_OBSERVED_DAYS}, n AS (SELECT installation, least(count(*), 6) AS n, count(*) AS all_days FROM days GROUP BY 1)
    SELECT installation, n, 4 AS n_features, true AS has_scores FROM n WHERE all_days > 6""",
)
def observed_model(spark, sf_dir):
    """The job on station observations: features used and days scored."""
    model = train_observed_model(*_observed_parts(spark, sf_dir), holdout=7)
    fitted = model.coefficients.select("installation", F.size("coefficients").alias("n_features"))
    return model.metrics.join(fitted, "installation").select("installation", "n", "n_features", F.col("MAE").isNotNull().alias("has_scores"))


_TARGETS = ["sunshine_duration", "snow_depth", "is_day"]
_LAGS = 30


@query(
    "weather_forecast_job",
    f"""WITH {DAILY_WEATHER}, r AS (SELECT installation, count(*) AS days FROM daily_weather GROUP BY 1),
    t AS (SELECT unnest({_TARGETS}) AS target)
    SELECT installation, target, CAST(least(364 - {_LAGS}, days) AS BIGINT) AS n, CAST({_LAGS * len(_TARGETS) + 2} AS BIGINT) AS n_features, 'single' AS kind, true AS scored FROM r, t
    UNION ALL SELECT installation, NULL, CAST(least(364 - {_LAGS}, days) * {len(_TARGETS)} AS BIGINT), {_LAGS * len(_TARGETS) + 2}, 'scaled', true FROM r""",
)
def weather_forecast_job(spark, sf_dir):
    """Thirty lags of all targets, multi-target ridge, scores per target and overall."""
    found = forecast_weather(daily_weather(spark, sf_dir), _TARGETS, _LAGS)
    scored = F.col("MAE").isNotNull() & F.col("MAPE").isNotNull() & (F.col("n_dropped") == 0)
    return found.metrics.select("installation", "target", "n", F.lit(len(found.features)).alias("n_features"), "kind", scored.alias("scored"))


@query(
    "forecast_normal_equations",
    f"""WITH {DAILY_WEATHER}, r AS (SELECT installation, count(*) - 364 - {_LAGS} - {_LAGS} AS n FROM daily_weather GROUP BY 1),
    t AS (SELECT unnest({_TARGETS}) AS target)
    SELECT installation, target, n, 0.0::DOUBLE AS worst FROM r, t""",
    digits=6,
)
def forecast_normal_equations(spark, sf_dir):
    """The fit of the forecast job: largest derivative of the loss over all features of a target."""
    from ..operators.features import minmax_apply, minmax_fit
    from ..operators.series import with_lags
    from ..operators.splits import chronological_holdout

    found = forecast_weather(daily_weather(spark, sf_dir), _TARGETS, _LAGS)
    inputs = [f"{t}_lag_{k}" for k in range(1, _LAGS + 1) for t in _TARGETS]
    parted = with_lags(chronological_holdout(daily_weather(spark, sf_dir), 365, lag=_LAGS), _TARGETS, list(range(1, _LAGS + 1)))
    train = parted.filter("part = 'train'")
    scaled = with_doy_trig(minmax_apply(train, minmax_fit(train, [*inputs, *_TARGETS]), [*inputs, *_TARGETS]), "date")
    targets = F.explode(F.array(*[F.struct(F.lit(t).alias("target"), F.col(t).alias("y")) for t in _TARGETS]))
    long = scaled.withColumn("_t", targets).select("installation", *found.features, "_t.target", "_t.y")
    fitted = long.join(found.coefficients.drop("n"), ["installation", "target"]).withColumn("_fit", linear_value(found.features))
    each = gradients(fitted, ["installation", "target"], found.features, "y", F.col("coefficients"))
    return each.groupBy("installation", "target").agg(F.first("n").alias("n"), F.max(F.abs("gradient")).alias("worst"))


def _hours(spark, sf_dir):
    """Hourly sums of records at all hours of the day."""
    return hourly_sum(weather_long(spark, sf_dir).withColumnRenamed("sunshine_duration", "sol_prod"))


@query(
    "hourly_baseline_job",
    f"""WITH {WEATHER_LONG}, hours AS (SELECT installation, CAST("timestamp" AS DATE) AS date, hour("timestamp") AS hour, coalesce(sum(sunshine_duration), 0) AS y FROM weather_long GROUP BY 1, 2, 3),
    parted AS (SELECT *, row_number() OVER (PARTITION BY installation ORDER BY date DESC, hour DESC) <= 8759 AS test FROM hours),
    yearly AS (SELECT installation, hour + 24 * (dayofyear(date) - 1) AS hoy, year(date) AS yr, sum(y) AS s FROM parted WHERE NOT test GROUP BY 1, 2, 3),
    means AS (SELECT installation, hoy, avg(s) AS pred FROM yearly GROUP BY 1, 2),
    model AS (SELECT * FROM means UNION ALL SELECT installation, hoy + 24, pred FROM means m WHERE hoy BETWEEN 8736 AND 8759
      AND NOT EXISTS (SELECT 1 FROM means o WHERE o.installation = m.installation AND o.hoy = m.hoy + 24))
    SELECT p.installation, CAST(p.date AS TIMESTAMP) + to_hours(CAST(p.hour AS INTEGER)) AS "timestamp", round(y, 4) AS y, round(pred, 4) AS pred,
      round(pred - y, 4) AS diff, round(CASE WHEN y > 0 THEN pred / y END, 6) AS ratio
    FROM parted p LEFT JOIN model m ON m.installation = p.installation AND m.hoy = hour + 24 * (dayofyear(date) - 1) WHERE test""",
    ratio=6,
)
def hourly_baseline_job(spark, sf_dir):
    """Climatology of every hour of the year on the held-out last 8 759 hours, with residuals."""
    predicted, _ = hourly_baseline(_hours(spark, sf_dir))
    return predicted.select("installation", "timestamp", "y", "pred", "diff", "ratio")


@query(
    "hourly_baseline_scores",
    f"""WITH {WEATHER_LONG}, hours AS (SELECT installation, CAST("timestamp" AS DATE) AS date, hour("timestamp") AS hour, coalesce(sum(sunshine_duration), 0) AS y FROM weather_long GROUP BY 1, 2, 3),
    parted AS (SELECT *, row_number() OVER (PARTITION BY installation ORDER BY date DESC, hour DESC) <= 8759 AS test FROM hours),
    yearly AS (SELECT installation, hour + 24 * (dayofyear(date) - 1) AS hoy, year(date) AS yr, sum(y) AS s FROM parted WHERE NOT test GROUP BY 1, 2, 3),
    means AS (SELECT installation, hoy, avg(s) AS pred FROM yearly GROUP BY 1, 2),
    model AS (SELECT * FROM means UNION ALL SELECT installation, hoy + 24, pred FROM means m WHERE hoy BETWEEN 8736 AND 8759
      AND NOT EXISTS (SELECT 1 FROM means o WHERE o.installation = m.installation AND o.hoy = m.hoy + 24)),
    p AS (SELECT parted.installation, y, pred FROM parted LEFT JOIN model m ON m.installation = parted.installation AND m.hoy = hour + 24 * (dayofyear(date) - 1) WHERE test)
    SELECT installation, count(pred) AS n, count(*) - count(pred) AS n_dropped, round(avg(abs(y - pred)), 1) AS "MAE", round(median(abs(y - pred)), 1) AS "MedAE"
    FROM p GROUP BY 1""",
    digits=1,
)
def hourly_baseline_scores(spark, sf_dir):
    _, metrics = hourly_baseline(_hours(spark, sf_dir))
    return metrics.select("installation", "n", "n_dropped", "MAE", "MedAE")


@query(
    "retrain_from_exports",
    f"""WITH {READINGS}, {PEAKS} SELECT installation AS special_features, 'retrain' AS model_purpose, 'Ridge' AS model_class, '20240131120000' AS "timestamp",
      true AS named, true AS stored FROM peaks WHERE installation IN (SELECT installation FROM readings)""",
)
def retrain_exports(spark, sf_dir):
    """Exports to a stored model and its run records, with all weather measures and types; both are read back."""
    weather = hourly_weather(spark, sf_dir).withColumn("cloud_cover", F.coalesce("cloud_cover", F.lit(0.0)))
    last = weather.groupBy("installation").agg(F.max_by(F.struct(*weather.columns), "timestamp").alias("w")).select("w.*")
    covered = weather.unionByName(last.withColumn("timestamp", F.col("timestamp") + F.expr("INTERVAL 1 HOUR")))
    day = F.datediff("date", F.lit("1970-01-01").cast("date")) * 10 + F.substring("installation", 6, 9).cast("bigint")
    model_dir, runs_dir = scratch_dir(spark, "model"), scratch_dir(spark, "runs")
    exports = scratch_dir(spark, "exports")
    quarters = quarter_hourly(spark, sf_dir)
    for name, zone in (("inst_0", "+00:00"), ("inst_1", "+00:00"), ("inst_2", "Z"), ("inst_3", "")):
        stamp = F.concat(F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"), F.lit(zone))
        rows = quarters.filter(F.col("installation") == name).select(stamp.alias("timestamp"), F.col("sol_prod").cast("string").alias("Solarproduktion"))
        write_csv(rows, f"{exports}/{name}")
    model = retrain_from_exports(
        spark, exports, site_rows(spark), covered, model_dir, runs_dir, "20240131120000",
        categories=["click", "view", "purchase", "error", "signup"],
        position=day.cast("bigint") % 1000003 * F.lit(2654435761) % F.lit(4294967296),
    )
    weights = load_model(spark, model_dir).coefficients.select(F.col("installation").alias("special_features"), F.size("coefficients").alias("d"))
    expected = model.metrics.select(F.col("installation").alias("special_features"), F.col("R2").alias("_r2"))
    runs = scan_runs(spark, runs_dir).join(expected, "special_features").join(weights, "special_features")
    named = F.col("name") == F.col("model_name")
    stored = (F.abs(F.col("R2") - F.col("_r2")) < 1e-9) & (F.col("d") == len(model.features))
    return runs.select("special_features", "model_purpose", "model_class", "timestamp", named.alias("named"), stored.alias("stored"))


@query(
    "retrain_from_sums",
    """WITH d AS (SELECT 'inst_' || CAST(o_custkey % 3 AS VARCHAR) AS installation, date_trunc('day', o_orderdate) AS date, sum(o_totalprice) / 100000 AS y, CAST(count(*) AS DOUBLE) AS x
      FROM orders GROUP BY 1, 2),
    r AS (SELECT *, min(x) OVER (PARTITION BY installation) AS lo, max(x) OVER (PARTITION BY installation) AS hi FROM d),
    s AS (SELECT installation, y, (x - lo) / CASE WHEN hi > lo THEN hi - lo ELSE 1 END AS x FROM r),
    f AS (SELECT installation, count(*) AS n, avg(x) AS mx, avg(y) AS my, covar_pop(x, y) * count(*) AS sxy, var_pop(x) * count(*) AS sxx FROM s GROUP BY 1)
    SELECT installation, n, round(sxy / (sxx + 1), 6) AS coefficient, round(my - mx * sxy / (sxx + 1), 6) AS intercept FROM f""",
    digits=6,
)
def retrain_from_sums(spark, sf_dir):
    """Three exports, of which the last one corrects days of the first: the fit from stored sums is that of all data."""
    o = table(spark, sf_dir, "orders")
    name = F.concat(F.lit("inst_"), (F.col("o_custkey") % 3).cast("string"))
    days = o.groupBy(name.alias("installation"), F.date_trunc("day", "o_orderdate").alias("date")).agg(
        (F.sum("o_totalprice") / 100000).alias("y"), F.count("*").cast("double").alias("x")
    )
    days = settle(days, "days")
    early, odd = F.col("date") < "1995-06-01", F.dayofmonth("date") % 7 == 0
    wrong = days.filter(early).withColumn("y", F.when(odd, F.col("y") + 9).otherwise(F.col("y")))
    readings = sums_table(spark, scratch_dir(spark, "months"))
    sums = sums_table(spark, scratch_dir(spark, "sums"))
    arrivals(iter([wrong, days.filter(~early), days.filter(early & odd)]), readings, sums, ["x"], ["y"])
    fit = fit_from_sums(sums.read(), ["x"], ["y"])
    return fit.select("installation", "n", F.col("coefficients")[0].alias("coefficient"), "intercept")

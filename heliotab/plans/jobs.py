"""End-to-end jobs built from the operators."""

from dataclasses import dataclass, field
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.cyclic import with_doy_trig, with_periodic
from ..functions.scalars import hash32
from ..functions.timeparts import at_hour, hour_of_year
from ..operators.aggregate import AVERAGED, SUMMED, WEATHER_TYPES, period_features
from ..operators.clean import with_residuals
from ..operators.features import minmax_apply, minmax_fit
from ..operators.metrics import regression_metrics, regression_metrics_multi, regression_record
from ..operators.models import climatology_hourly_fit, climatology_predict, ridge_fit, ridge_predict, ridge_predict_multi
from ..operators.series import with_lags
from ..operators.splits import chronological_holdout, random_split
from ..operators.stations import (
    clip_observations,
    in_reading_range,
    pivot_parameters,
    prefer_historical,
    station_priority,
    wanted_stations,
)
from ..operators.weather import (
    climatology_fill,
    enriched_features,
    join_weather,
    regrid_10_to_15,
    regular_grid,
    upsample_ffill,
)
from ..session import settle
from ..sources.power_files import ingest_power
from ..sources.sinks import write_run_records

OBSERVED = ["radiation_global", "sunshine_duration"]
# Fixed value: first day of the weather history that jobs ask for.
HISTORY_START = date(2012, 1, 1)
PARAMS_SCHEMA = (
    "numeric array<string>, features array<string>, horizon string, categories array<string>, keys array<string>"
)


def history_window(run_date: date) -> tuple[date, date]:
    """First and last day of the weather archive as seen on a run date: up to the day before."""
    return HISTORY_START, run_date - timedelta(days=1)


def scoring_window(run_date: date, horizon: str = "daily") -> tuple[date, date]:
    """Days that may be scored on a run date: a year back and ten days ahead, hourly three each way."""
    back, ahead = {"daily": (365, 10), "hourly": (3, 3)}[horizon]
    return run_date - timedelta(days=back), run_date + timedelta(days=ahead)


@dataclass
class SolarModel:
    """A fitted model: scaler and coefficient tables, one row per installation each."""

    scaler: DataFrame
    coefficients: DataFrame
    numeric: list[str]
    features: list[str]
    horizon: str
    categories: list[str]
    keys: tuple[str, ...] = ("installation",)
    metrics: DataFrame | None = field(default=None)


def save_model(model: SolarModel, path: str) -> None:
    """Scaler and coefficients as Parquet, the column lists as one JSON row."""
    root = path.rstrip("/")
    model.scaler.write.mode("overwrite").parquet(f"{root}/scaler")
    model.coefficients.write.mode("overwrite").parquet(f"{root}/coefficients")
    lists = (model.numeric, model.features, model.horizon, model.categories, list(model.keys))
    params = model.scaler.sparkSession.createDataFrame([lists], PARAMS_SCHEMA)
    params.coalesce(1).write.mode("overwrite").json(f"{root}/params")


def load_model(spark: SparkSession, path: str) -> SolarModel:
    root = path.rstrip("/")
    p = spark.read.schema(PARAMS_SCHEMA).json(f"{root}/params").first()
    return SolarModel(
        spark.read.parquet(f"{root}/scaler"),
        spark.read.parquet(f"{root}/coefficients"),
        p.numeric,
        p.features,
        p.horizon,
        p.categories or [],
        tuple(p.keys or ()),
    )


def cyclic_features(df: DataFrame, horizon: str) -> tuple[DataFrame, list[str]]:
    """Day-of-year sin/cos, and hour sin/cos for hourly models."""
    out, names = with_doy_trig(df, "date"), ["date_doy_sin", "date_doy_cos"]
    if horizon == "hourly":
        out, names = with_periodic(out, "hour", 24), [*names, "hour_sin", "hour_cos"]
    return out, names


def train_solar_model(
    features: DataFrame,
    horizon: str = "daily",
    target: str = "sol_prod",
    alpha: float = 1.0,
    holdout: int | None = 365,
    test_share: float | None = None,
    seed: int = 42,
    categories: list[str] | None = None,
    keys: tuple[str, ...] = ("installation",),
    position: Column | None = None,
) -> SolarModel:
    """Scale, fit ridge on the train part and score the test part, for all installations at once.

    The test part is the last ``holdout - 1`` rows of a series, or a random ``test_share`` (by a hash
    of the row key, or by ``position``, any expression in [0, 2^32)). Features are days or hours, far
    fewer than readings; they are settled because scaler, fit and scores each read them.
    """
    features = settle(features, "features")
    order = ("date",) if horizon == "daily" else ("date", "hour")
    if test_share is None:
        parted = chronological_holdout(features, holdout, order, keys)
    else:
        row_hash = position if position is not None else hash32(*keys, *order, F.lit(seed))
        parted = random_split(features, row_hash, test_share)
    numeric = [c for c in features.columns if c not in (*keys, *order, target)]
    train = parted.filter("part = 'train'")
    scaler = minmax_fit(train, numeric, keys)
    scaled, cyclic = cyclic_features(minmax_apply(parted, scaler, numeric, keys), horizon)
    xs = [*numeric, *cyclic]
    model = ridge_fit(scaled.filter("part = 'train'"), xs, [target], keys, (alpha,))
    scored = settle(ridge_predict(scaled.filter("part = 'test'"), model, xs, keys).select(*keys, target, "pred"), "scored")
    metrics = regression_metrics(scored, list(keys), target, "pred")
    names = [c for c in numeric if c not in (*SUMMED, *AVERAGED)] if categories is None else categories
    return SolarModel(scaler, model, numeric, xs, horizon, names, keys, metrics)


def score_batch(weather: DataFrame, model: SolarModel, upsample: bool = True) -> DataFrame:
    """Hourly weather to predictions with a time column.

    The weather takes the same 15-minute grid as in training, so sums mean the same on both sides.
    """
    grid = upsample_ffill(weather) if upsample else weather
    table = period_features(grid, model.horizon, categories=model.categories)
    scaled = minmax_apply(table, model.scaler, model.numeric, model.keys)
    ready, _ = cyclic_features(scaled, model.horizon)
    scored = ridge_predict(ready, model.coefficients, model.features, model.keys)
    hour = F.col("hour") if model.horizon == "hourly" else F.lit(0)
    return scored.select(*model.keys, at_hour("date", hour).alias("time"), "date", "pred")


def retrain(
    power: DataFrame,
    weather: DataFrame,
    horizon: str = "daily",
    test_share: float = 0.2,
    seed: int = 387,
    categories: list[str] = WEATHER_TYPES,
    validate: bool = True,
    position: Column | None = None,
) -> SolarModel:
    """Power and hourly weather to a fitted and scored model."""
    table = enriched_features(power, weather, horizon, categories=categories, validate=validate)
    return train_solar_model(
        table, horizon, test_share=test_share, seed=seed, categories=categories, position=position
    )


def run_records(model: SolarModel, metadata: dict[str, Column]) -> DataFrame:
    """Registry rows of a fitted and scored model, one per key; ``name`` is the run's name."""
    records = regression_record(model.metrics, list(model.keys), metadata)
    return records.drop(*model.keys).withColumn("name", F.col("model_name"))


def retrain_from_exports(
    spark: SparkSession,
    exports: str,
    sites: DataFrame,
    weather: DataFrame,
    model_dir: str,
    runs_dir: str,
    run_time: str,
    horizon: str = "daily",
    categories: list[str] = WEATHER_TYPES,
    validate: bool = True,
    position: Column | None = None,
) -> SolarModel:
    """Uploaded exports to a stored model and its run records.

    Ingest, join with hourly weather, features, random 80/20 split, fit, scores; then scaler and
    coefficients go to ``model_dir`` and one record per installation to ``runs_dir``.
    """
    power = settle(ingest_power(spark, exports, sites).select("installation", "timestamp", "sol_prod"), "power")
    model = retrain(power, weather, horizon, categories=categories, validate=validate, position=position)
    save_model(model, model_dir)
    metadata = {
        "timestamp": F.lit(run_time),
        "model_purpose": F.lit("retrain"),
        "model_class": F.lit("Ridge"),
        "special_features": F.col("installation"),
    }
    write_run_records(run_records(model, metadata), runs_dir)
    return model


def train_observed_model(
    readings: DataFrame, historical: DataFrame, recent: DataFrame, listed: DataFrame, horizon: str = "daily", **options
) -> SolarModel:
    """The model on station observations: sums of sunshine and global radiation, day-of-year features."""
    enriched = enrich_observed(readings, historical, recent, listed)
    features = period_features(enriched, horizon, categories=[])
    return train_solar_model(features, horizon, categories=[], **options)


@dataclass
class Forecast:
    """Predicted weather of the test days, the fitted coefficients, and the scores per target and overall."""

    predictions: DataFrame
    coefficients: DataFrame
    metrics: DataFrame
    features: list[str]


def forecast_weather(
    daily: DataFrame, targets: list[str], lags: int = 30, holdout: int = 365, alpha: float = 1.0, keys: tuple[str, ...] = ("installation",)
) -> Forecast:
    """Each target's next day from ``lags`` days of all targets and the day of year, in one multi-target ridge.

    The test part is the last ``holdout - 1`` days with ``lags`` days left out before it; days without
    complete lags are in neither part. Targets and features are scaled on the train part.
    """
    parted = settle(chronological_holdout(daily, holdout, keys=keys, lag=lags), "parted")
    lagged = with_lags(parted, targets, list(range(1, lags + 1)), keys=keys)
    inputs = [f"{t}_lag_{k}" for k in range(1, lags + 1) for t in targets]
    used = lagged.filter("part in ('train', 'test')")
    scaler = minmax_fit(used.filter("part = 'train'"), [*inputs, *targets], keys)
    scaled, cyclic = cyclic_features(minmax_apply(used, scaler, [*inputs, *targets], keys), "daily")
    scaled = settle(scaled, "lagged")
    xs = [*inputs, *cyclic]
    model = ridge_fit(scaled.filter("part = 'train'"), xs, targets, keys, (alpha,))
    predicted = settle(
        ridge_predict_multi(scaled.filter("part = 'test'"), model, xs, targets, keys).select(*keys, "date", "target", "y", "pred"),
        "forecast",
    )
    return Forecast(predicted, model, regression_metrics_multi(predicted, list(keys)), xs)


def hourly_baseline(hourly: DataFrame, value: str = "sol_prod", holdout: int = 8_760, keys: tuple[str, ...] = ("installation",)) -> tuple[DataFrame, DataFrame]:
    """Hourly climatology fitted before the last ``holdout - 1`` hours: predictions with residuals there, and scores.

    Hours that the train part never saw have no prediction; the scores count them as dropped.
    """
    parted = settle(chronological_holdout(hourly, holdout, ("date", "hour"), keys), "hours")
    stamped = parted.withColumn("timestamp", at_hour("date", F.col("hour")))
    model = climatology_hourly_fit(stamped.filter("part = 'train'"), value, keys=keys)
    test = stamped.filter("part = 'test'").select(*keys, "timestamp", F.col(value).alias("y"))
    predicted = with_residuals(climatology_predict(test, model, hour_of_year("timestamp"), "hoy", keys))
    return predicted, regression_metrics(predicted, list(keys), nulls="count")


def observed_weather(
    historical: DataFrame,
    recent: DataFrame,
    listed: DataFrame,
    readings: DataFrame,
    parameters: list[str] = OBSERVED,
) -> DataFrame:
    """Station observations to a gapless 15-minute table per installation."""
    wanted = wanted_stations(readings, listed)
    combined = prefer_historical(clip_observations(historical, wanted), clip_observations(recent, wanted))
    chosen = station_priority(in_reading_range(combined, wanted, clipped=True))
    # the grid needs bounds and rows of this table, and the fill reads both again
    table = settle(pivot_parameters(chosen, parameters), "observed")
    filled = climatology_fill(regular_grid(table), parameters)
    return regrid_10_to_15(filled, parameters)


def enrich_observed(readings: DataFrame, historical: DataFrame, recent: DataFrame, listed: DataFrame) -> DataFrame:
    return join_weather(readings, observed_weather(historical, recent, listed, readings))

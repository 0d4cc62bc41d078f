"""Landed hourly weather responses, weather codes, seasonal events, station observations."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import nan_to_null
from ..functions.timeparts import parse_event_date
from ..operators.clean import describe_codes, fill_zero

# Variables of an hourly response in the order they are requested.
HOURLY_VARIABLES = [
    "weather_code",
    "cloud_cover",
    "snow_depth",
    "sunshine_duration",
    "is_day",
    "direct_radiation",
]
# A missing amount counts as zero; a missing code or day flag stays missing.
ZERO_FILLED = ["cloud_cover", "snow_depth", "sunshine_duration", "direct_radiation"]

RESPONSE_SCHEMA = (
    "installation string, latitude double, longitude double, elevation double, "
    "utc_offset_seconds int, start timestamp, end timestamp, interval int, "
    + ", ".join(f"{v} array<double>" for v in HOURLY_VARIABLES)
)
OBSERVATION_SCHEMA = (
    "resolution string, dataset string, station_id string, parameter string, "
    "date timestamp, value double, quality double"
)


def read_responses(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RESPONSE_SCHEMA).option("allowNonNumericNumbers", True).json(path)


def read_weather_codes(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep=";", header=True, schema="code_figure int, code_name string")


def read_seasonal_events(spark: SparkSession, path: str) -> DataFrame:
    """Raw event list (``Event;Date``) to ``event, date`` in UTC."""
    raw = spark.read.csv(path, sep=";", header=True, schema="Event string, Date string")
    return raw.select(F.col("Event").alias("event"), parse_event_date("Date").alias("date"))


def read_seasonal_events_clean(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep=";", header=True, schema="event string, date timestamp")


def read_observations(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.schema(OBSERVATION_SCHEMA).parquet(path)
    return df.withColumn("value", nan_to_null("value"))


def flatten_responses(responses: DataFrame, codes: DataFrame | None = None, keys=("installation",)) -> DataFrame:
    """One row per hour from parallel arrays; the time axis excludes its end."""
    steps = F.ceil((F.unix_timestamp("end") - F.unix_timestamp("start")) / F.col("interval")).cast("int")
    zipped = F.slice(F.arrays_zip(*HOURLY_VARIABLES), 1, F.greatest(steps, F.lit(0)))
    hourly = responses.select(*keys, "start", "interval", F.posexplode(zipped).alias("_pos", "_v")).select(
        *keys,
        F.timestamp_seconds(F.unix_timestamp("start") + F.col("_pos") * F.col("interval")).alias("timestamp"),
        *[nan_to_null(F.col(f"_v.{v}")).alias(v) for v in HOURLY_VARIABLES],
    )
    hourly = fill_zero(hourly, ZERO_FILLED)
    return describe_codes(hourly, codes) if codes is not None else hourly


def site_weather(responses: DataFrame, sites: DataFrame, codes: DataFrame | None = None) -> DataFrame:
    """Hourly weather of all known installations in one pass, keyed by installation."""
    known = responses.join(sites.select("installation").distinct(), "installation", "left_semi")
    return flatten_responses(known, codes)


def route_by_date(archive: DataFrame, forecast: DataFrame, run_date: str | Column, ts: str = "timestamp") -> DataFrame:
    """Archive rows before the run date, forecast rows from the run date on."""
    cut = (F.lit(run_date) if isinstance(run_date, str) else run_date).cast("timestamp")
    return archive.filter(F.col(ts) < cut).unionByName(forecast.filter(F.col(ts) >= cut), allowMissingColumns=True)

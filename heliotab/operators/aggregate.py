"""Daily, hourly and calendar aggregates."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import normalize_text, normalized_name, sum_or_zero
from ..functions.timeparts import utc_date

# Which measures add up over a period and which are averaged.
SUMMED = ["sol_prod", "sunshine_duration", "direct_radiation", "radiation_global"]
AVERAGED = ["cloud_cover", "snow_depth", "is_day"]
# Weather types the models use.
WEATHER_TYPES = ["clear_sky", "cloudy", "drizzle", "rain", "solid_precipitation"]

PERIODS = {"daily": ["date"], "hourly": ["date", "hour"]}


def discover_categories(df: DataFrame, col: str = "weather_description") -> list[str]:
    """Sorted normalised values of a code-like column; each becomes a column, so the list is not cut."""
    found = df.select(normalized_name(col).alias("v")).filter("v is not null").distinct()
    return sorted(r.v for r in found.collect())


def category_names(df: DataFrame, col: str, categories: list[str] | None) -> list[str]:
    return discover_categories(df, col) if categories is None else [normalize_text(c) for c in categories]


def one_hot(df: DataFrame, col: str = "weather_description", categories: list[str] | None = None) -> DataFrame:
    """0/1 column per category, null is 0 everywhere; given categories always appear.

    ``None`` takes all categories that occur, an empty list none.
    """
    names = category_names(df, col, categories)
    return df.withColumns({n: F.coalesce((normalized_name(col) == n).cast("double"), F.lit(0.0)) for n in names})


def _period_features(df, by, weather_column, categories, exclude):
    names = category_names(df, weather_column, categories)
    named = df.withColumn("_weather", normalized_name(weather_column)) if names else df
    sums = [c for c in SUMMED if c in df.columns and c not in exclude]
    means = [c for c in AVERAGED if c in df.columns and c not in exclude]
    return named.groupBy(*by).agg(
        *[sum_or_zero(c).alias(c) for c in sums],
        *[F.avg(F.col(c).cast("double")).alias(c) for c in means],
        *[(F.count_if(F.col("_weather") == n) / F.count("*")).alias(n) for n in names],
    )


def period_features(
    df: DataFrame,
    horizon: str = "daily",
    weather_column: str = "weather_description",
    categories: list[str] | None = None,
    exclude: tuple[str, ...] = (),
    ts: str = "timestamp",
) -> DataFrame:
    """Model features per installation and day (or day and hour), in one aggregate.

    Energy, sunshine and radiation add up; cloud cover, snow depth and day flag are averaged;
    a weather type becomes the share of rows that have it.
    """
    if horizon not in PERIODS:
        raise ValueError(f"unknown horizon {horizon!r}")
    dated = df.withColumns({"date": utc_date(ts), "hour": F.hour(ts)})
    return _period_features(dated, ["installation", *PERIODS[horizon]], weather_column, categories, exclude)


def weather_share(df: DataFrame, by: list[str], col: str = "weather_description", categories: list[str] | None = None) -> DataFrame:
    """Share of rows per weather type; rows without a description count as none of them."""
    return _period_features(df.select(*by, col), by, col, categories, ())


def daily_sum(df: DataFrame, value: str = "sol_prod", ts: str = "timestamp", keys=("installation",)) -> DataFrame:
    return df.groupBy(*keys, utc_date(ts).alias("date")).agg(sum_or_zero(value).alias(value))


def hourly_sum(df: DataFrame, value: str = "sol_prod", ts: str = "timestamp", keys=("installation",)) -> DataFrame:
    return df.groupBy(*keys, utc_date(ts).alias("date"), F.hour(ts).alias("hour")).agg(
        sum_or_zero(value).alias(value)
    )


def calendar_aggregate(df: DataFrame, by: list[str], measures: list[str], averaged=("soc",)) -> DataFrame:
    """Measures by calendar parts: ``averaged`` ones as mean, the others as sum; null keys drop out."""
    known = df
    for key in by:
        known = known.filter(F.col(key).isNotNull())
    return known.groupBy(*by).agg(
        *[(F.avg(m) if m in averaged else sum_or_zero(m)).alias(m) for m in measures]
    )


def unpivot(df: DataFrame, ids: list[str], measures: list[str]) -> DataFrame:
    doubles = df.select(*ids, *[F.col(m).cast("double").alias(m) for m in measures])
    return doubles.unpivot(ids, measures, "variable", "value")

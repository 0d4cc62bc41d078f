"""Bringing weather onto the grid of the readings and joining it."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import normalized_name, sum_or_zero
from ..functions.timeparts import slot_of_year
from .aggregate import AVERAGED, PERIODS, SUMMED, category_names

STEP_SECONDS = 15 * 60


def _next_in_series(df: DataFrame, keys: list[str], ts: str, out: str) -> DataFrame:
    """Following timestamp per key, ordered one day at a time.

    A window per key would sort a dominant installation in one task. Days are sorted instead,
    and the last row of a day takes the first timestamp of the next day that has rows.
    """
    daily = df.withColumn("_day", F.to_date(ts))
    in_day = Window.partitionBy(*keys, "_day").orderBy(ts)
    days = daily.groupBy(*keys, "_day").agg(F.min(ts).alias("_first"))
    over_days = Window.partitionBy(*keys).orderBy("_day")
    days = days.select(*keys, "_day", F.lead("_first").over(over_days).alias("_next_day"))
    return (
        daily.withColumn("_next", F.lead(ts).over(in_day))
        .join(days, [*keys, "_day"])
        .withColumn(out, F.coalesce("_next", "_next_day"))
        .drop("_day", "_next", "_next_day")
    )


def upsample_ffill(
    df: DataFrame,
    ts: str = "timestamp",
    keys: tuple[str, ...] = ("installation",),
    step_seconds: int = STEP_SECONDS,
    additive: tuple[str, ...] = ("sunshine_duration",),
    source_seconds: int = 3600,
) -> DataFrame:
    """Repeat each row up to the next one on a finer grid; nothing after the last row.

    Values are copied as they are (a null stays null). Only ``additive`` columns are divided by
    the number of steps in a source interval; the default follows the source system, where
    radiation sums are not divided.
    """
    step = F.make_interval(secs=F.lit(step_seconds))
    spread = _next_in_series(df, list(keys), ts, "_until")
    last = F.coalesce(F.col("_until") - step, F.col(ts))
    grid = F.sequence(F.col(ts), F.greatest(last, F.col(ts)), step)
    share = source_seconds / step_seconds
    return (
        spread.withColumn(ts, F.explode(grid))
        .drop("_until")
        .withColumns({c: F.col(c) / share for c in additive if c in df.columns})
    )


def join_weather(power: DataFrame, weather: DataFrame, on=("installation", "timestamp")) -> DataFrame:
    """One left equi-join for all installations."""
    return power.join(weather, list(on), "left")


def weather_coverage(power: DataFrame, weather: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Bounds of both series per installation and the first problem found, if any."""
    p = power.groupBy("installation").agg(F.min(ts).alias("power_min"), F.max(ts).alias("power_max"))
    w = weather.groupBy("installation").agg(F.min(ts).alias("weather_min"), F.max(ts).alias("weather_max"))
    problem = (
        F.when(F.col("weather_min").isNull(), "no weather")
        .when(F.col("weather_min") > F.col("power_min"), "weather starts late")
        .when(F.col("weather_max") < F.col("power_max"), "weather ends early")
    )
    return p.join(w, "installation", "left").withColumn("problem", problem)


def require_weather_coverage(power: DataFrame, weather: DataFrame, ts: str = "timestamp") -> None:
    """Raise with the bounds of one offending installation."""
    bad = weather_coverage(power, weather, ts).filter("problem is not null").orderBy("installation").first()
    if bad:
        raise ValueError(
            f"{bad.installation}: {bad.problem} (power {bad.power_min} to {bad.power_max}, "
            f"weather {bad.weather_min} to {bad.weather_max})"
        )


def weather_by_hour(weather: DataFrame, additive: tuple[str, ...], step_seconds: int, source_seconds: int) -> DataFrame:
    """Weather rows with the first and last step they hold for, once per source interval ("hour") touched.

    ``_start``, ``_end`` are microseconds, ``_hour`` counts source intervals.
    """
    spread = _next_in_series(weather, ["installation"], "timestamp", "_until")
    starts = F.unix_micros("timestamp")
    ends = F.greatest(F.coalesce(F.unix_micros("_until") - step_seconds * 1_000_000, starts), starts)
    hour = source_seconds * 1_000_000
    share = source_seconds / step_seconds
    return (
        spread.withColumns({"_start": starts, "_end": ends})
        .withColumn("_hour", F.explode(F.sequence(F.floor(F.col("_start") / hour), F.floor(F.col("_end") / hour))))
        .withColumns({c: F.col(c) / share for c in additive if c in weather.columns})
        .drop("timestamp", "_until")
    )


def enrich_weather(
    power: DataFrame,
    weather: DataFrame,
    validate: bool = True,
    additive: tuple[str, ...] = ("sunshine_duration",),
    step_seconds: int = STEP_SECONDS,
    source_seconds: int = 3600,
) -> DataFrame:
    """Check coverage, then give every reading the weather of its step on the finer grid.

    Equal to ``join_weather(power, upsample_ffill(weather))``, but weather rows are repeated per
    source interval instead of per step, so only a quarter of them is shuffled: readings and
    weather meet on the hour, and the step is checked in the join condition.
    """
    if validate:
        require_weather_coverage(power, weather)
    hourly = weather_by_hour(weather, additive, step_seconds, source_seconds)
    at = F.unix_micros("timestamp")
    readings = power.withColumns({"_at": at, "_hour": F.floor(at / (source_seconds * 1_000_000))})
    r, w = readings.alias("r"), hourly.alias("w")
    same_step = (
        (F.col("r.installation") == F.col("w.installation"))
        & (F.col("r._hour") == F.col("w._hour"))
        & F.col("r._at").between(F.col("w._start"), F.col("w._end"))
        & ((F.col("r._at") - F.col("w._start")) % (step_seconds * 1_000_000) == 0)
    )
    # a measure that the readings hold themselves stays theirs
    measures = [c for c in weather.columns if c not in power.columns]
    return r.join(w, same_step, "left").select("r.*", *[f"w.{c}" for c in measures]).drop("_at", "_hour")


def enriched_features(
    power: DataFrame,
    weather: DataFrame,
    horizon: str = "daily",
    weather_column: str = "weather_description",
    categories: list[str] | None = None,
    exclude: tuple[str, ...] = (),
    validate: bool = True,
    additive: tuple[str, ...] = ("sunshine_duration",),
    step_seconds: int = STEP_SECONDS,
    source_seconds: int = 3600,
) -> DataFrame:
    """Equal to ``period_features(enrich_weather(power, weather), horizon, ...)`` without joining readings.

    The features need only how many readings each weather row meets. Readings are therefore counted
    per hour and step before anything is shuffled; weather values are weighted with those counts.
    """
    if horizon not in PERIODS:
        raise ValueError(f"unknown horizon {horizon!r}")
    if validate:
        require_weather_coverage(power, weather)
    step, hour = step_seconds * 1_000_000, source_seconds * 1_000_000
    names = category_names(weather, weather_column, categories)
    own = [c for c in SUMMED if c in power.columns and c not in exclude]
    both = [c for c in weather.columns if c in power.columns and c not in ("installation", "timestamp", *own)]
    if both:
        raise ValueError(f"readings and weather both hold {', '.join(both)}: drop one of them")
    weather = weather.drop(*own)
    sums = [c for c in SUMMED if c in weather.columns and c not in (*exclude, *own)]
    means = [c for c in AVERAGED if c in weather.columns and c not in exclude]

    at, place = F.unix_micros("timestamp"), F.floor((F.col("_at") - F.col("_hour") * hour) / step)
    slots = range(source_seconds // step_seconds)
    counted = (
        power.withColumn("_at", at)
        .withColumn("_hour", F.floor(F.col("_at") / hour))
        .withColumns({"_place": place, "_phase": F.pmod(F.col("_at"), F.lit(step))})
        .groupBy("installation", "_hour", "_phase")
        .agg(
            *[F.count_if(F.col("_place") == k).alias(f"_n{k}") for k in slots],
            *[sum_or_zero(c).alias(c) for c in own],
        )
    )
    meeting = ["installation", "_hour", "_phase"]
    hourly = weather_by_hour(weather, additive, step_seconds, source_seconds)
    hourly = hourly.withColumn("_phase", F.pmod(F.col("_start"), F.lit(step)))
    if names:
        hourly = hourly.withColumn("_weather", normalized_name(weather_column))
    # several weather rows may share an hour; only the first one counts its readings themselves
    hourly = hourly.withColumn("_rank", F.row_number().over(Window.partitionBy(*meeting).orderBy("_start")))
    # readings of the slots that the weather row holds for
    slot = {k: F.col("_hour") * hour + k * step + F.col("_phase") for k in slots}
    met = sum(
        (F.when(slot[k].between(F.col("_start"), F.col("_end")), F.col(f"_n{k}")).otherwise(F.lit(0)) for k in slots),
        F.lit(0),
    )
    start_of_hour = F.timestamp_micros(F.col("_hour") * hour)
    joined = counted.join(hourly, meeting, "left").withColumns(
        {
            "_met": met,
            "_first": F.coalesce(F.col("_rank") == 1, F.lit(True)),
            "date": F.to_date(start_of_hour),
            "hour": F.hour(start_of_hour),
        }
    )
    readings = F.sum(F.when(F.col("_first"), sum((F.col(f"_n{k}") for k in slots), F.lit(0))))

    def weighted(c):
        return F.sum(F.col(c).cast("double") * F.col("_met"))

    return joined.groupBy("installation", *PERIODS[horizon]).agg(
        *[F.sum(F.when(F.col("_first"), F.col(c))).alias(c) for c in own],
        *[F.coalesce(weighted(c), F.lit(0.0)).alias(c) for c in sums],
        *[F.try_divide(weighted(c), F.sum(F.when(F.col(c).isNotNull(), F.col("_met")))).alias(c) for c in means],
        *[
            (F.coalesce(F.sum(F.when(F.col("_weather") == n, F.col("_met"))), F.lit(0)) / readings).alias(n)
            for n in names
        ],
    )


def regular_grid(
    df: DataFrame,
    ts: str = "date",
    keys: tuple[str, ...] = ("installation",),
    step_seconds: int = 600,
) -> DataFrame:
    """Every step from the first to the last timestamp of each key; absent rows become null.

    The grid is unfolded by day first and then within the day, from one bounds row per key.
    """
    bounds = df.groupBy(*keys).agg(F.min(ts).alias("_lo"), F.max(ts).alias("_hi"))
    step = F.make_interval(secs=F.lit(step_seconds))
    span = 86_400 // step_seconds * step_seconds
    blocks = bounds.withColumn(
        "_from", F.explode(F.sequence(F.col("_lo"), F.col("_hi"), F.make_interval(secs=F.lit(span))))
    )
    until = F.least(F.col("_hi"), F.col("_from") + F.make_interval(secs=F.lit(span - step_seconds)))
    grid = blocks.select(*keys, F.explode(F.sequence(F.col("_from"), until, step)).alias(ts))
    return grid.join(df, [*keys, ts], "left")


def climatology_fill(
    df: DataFrame, cols: list[str], ts: str = "date", keys: tuple[str, ...] = ("installation",)
) -> DataFrame:
    """Null takes the mean of the same month, day, hour and minute over all years.

    One shuffle; on a regular grid a slot holds one row per year.
    """
    same_slot = Window.partitionBy(*keys, slot_of_year(ts))
    return df.withColumns({c: F.coalesce(F.col(c), F.avg(c).over(same_slot)) for c in cols})


def forward_fill(df: DataFrame, cols: list[str], ts: str, keys: list[str]) -> DataFrame:
    """Null takes the last non-null value before it, ordered one day at a time.

    The value carried into a day is the last one known at the end of the days before.
    """
    daily = df.withColumn("_day", F.to_date(ts))
    in_day = Window.partitionBy(*keys, "_day").orderBy(ts)
    to_here = in_day.rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*keys).orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    days = daily.groupBy(*keys, "_day").agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(ts))).alias(f"_end_{c}") for c in cols]
    )
    carried = days.select(
        *keys, "_day", *[F.last(f"_end_{c}", ignorenulls=True).over(before).alias(f"_carry_{c}") for c in cols]
    )
    return (
        daily.withColumns({c: F.last(c, ignorenulls=True).over(to_here) for c in cols})
        .join(carried, [*keys, "_day"])
        .withColumns({c: F.coalesce(c, f"_carry_{c}") for c in cols})
        .select(*df.columns)
    )


def regrid_10_to_15(
    df: DataFrame, cols: list[str], ts: str = "date", keys: tuple[str, ...] = ("installation",)
) -> DataFrame:
    """10-minute sums to 15-minute sums through two 5-minute halves; totals are kept.

    Gaps left by the fill before take the last known half; what is still null counts as zero.
    """
    halves = df.select(
        *keys,
        F.explode(F.array(F.col(ts), F.col(ts) + F.make_interval(mins=F.lit(5)))).alias("_half"),
        *[(F.col(c) / 2).alias(c) for c in cols],
    )
    filled = forward_fill(halves, cols, "_half", list(keys))
    return (
        filled.groupBy(*keys, F.window("_half", "15 minutes").alias("_w"))
        .agg(*[F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in cols])
        .select(*keys, F.col("_w.start").alias("timestamp"), *cols)
    )

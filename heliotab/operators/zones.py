"""Local wall-clock text to UTC, with daylight-saving changes resolved by file order."""

from datetime import datetime, timedelta, timezone
from functools import lru_cache
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# wall-clock part ending in a time, then Z or a signed offset
_WITH_OFFSET = r"^(.*\d{1,2}:\d{2}(?::\d{2}(?:[.]\d+)?)?)\s*(?:Z|([+-])(\d{2}):?(\d{2})?)$"
_TRANSITION_SCHEMA = (
    "_zone string, _day date, _start timestamp_ntz, _end timestamp_ntz, "
    "_gap boolean, _instant timestamp, _second int"
)


@lru_cache(maxsize=None)
def _transitions(zone: str, first_year: int, last_year: int) -> list[tuple]:
    """Offset changes of one zone as (zone, day, local start, local end, gap?, UTC instant, offset after)."""
    found = []
    tz, step = ZoneInfo(zone), timedelta(days=1)
    at = datetime(first_year, 1, 1, tzinfo=timezone.utc)
    end = datetime(last_year + 1, 1, 1, tzinfo=timezone.utc)
    offset = at.astimezone(tz).utcoffset()
    while at < end:
        later = at + step
        new = later.astimezone(tz).utcoffset()
        if new != offset:
            low, high = at, later
            while high - low > timedelta(seconds=1):
                middle = low + timedelta(seconds=int((high - low).total_seconds()) // 2)
                low, high = (middle, high) if middle.astimezone(tz).utcoffset() == offset else (low, middle)
            wall = high.replace(tzinfo=None)
            start, stop = sorted((wall + offset, wall + new))
            day = start.date()
            while day <= stop.date():
                found.append((zone, day, start, stop, new > offset, high, int(new.total_seconds())))
                day += timedelta(days=1)
        at, offset = later, new
    return found


# Years whose clock changes are looked up; text outside them fails in a named zone.
YEARS = (1900, 2200)


def transition_table(spark: SparkSession, zones: list[str], first_year=YEARS[0], last_year=YEARS[1]) -> DataFrame:
    """About two rows per zone and year: bounded by the zone names in use, safe to broadcast."""
    rows = [t for z in sorted(set(zones)) for t in _transitions(z, first_year, last_year)]
    return spark.createDataFrame(rows, _TRANSITION_SCHEMA)


def to_utc(
    df: DataFrame,
    column: str = "timestamp",
    zone: str = "timezone",
    group: tuple[str, ...] = ("installation",),
    order: tuple[str, ...] = (),
    zones: list[str] | None = None,
    flag: str | None = None,
    continued: bool = False,
) -> DataFrame:
    """Replace the text in ``column`` by a UTC timestamp.

    Text with an offset is converted; other text is read in ``zone`` (``utc``, ``utc+2`` or a
    zone name), and a missing zone fails the job. Wall-clock times that a zone skips move to
    the instant of the change. Times that occur twice are told apart by their order: within
    ``group`` the first one (by ``order``) is summer time, the second one standard time; a time
    seen only once stays summer time, and ``flag`` names a column that marks it.

    With ``continued`` a group may be a piece of a longer series that was cut anywhere: a time is the second one
    if the clock has gone back before it in its piece, or if the piece begins within the repeated hour,
    passes it once and goes on behind it. So the pieces give what the whole series gives, in any order of arrival.
    """
    spark, z = df.sparkSession, F.trim(F.col(zone))
    text = F.trim(F.col(column).cast("string"))
    lowered = F.lower(z)
    aware = text.rlike(_WITH_OFFSET)
    fixed = lowered.rlike("^utc[+-]")
    named = ~(fixed | (lowered == "utc"))
    missing = F.raise_error(F.lit("timestamp without offset needs a time zone")).cast("timestamp")
    if zones is None:
        # a handful of names, however many rows there are
        found = df.filter(named & (z != "")).select(z.alias("z")).distinct().collect()
        zones = [r.z for r in found]

    def part(i):
        return F.regexp_extract(text, _WITH_OFFSET, i)

    minutes = F.coalesce(part(3).try_cast("int"), F.lit(0)) * 60 + F.coalesce(part(4).try_cast("int"), F.lit(0))
    offset = F.make_interval(mins=F.when(part(2) == "-", -minutes).otherwise(minutes))
    rows = df.withColumns(
        {
            "_local": F.when(~aware, text.cast("timestamp_ntz")),
            "_zone": F.when(~aware & named, z),
            "_shift": F.when(fixed, F.substring(lowered, 4, 6).try_cast("int")).otherwise(F.lit(0)),
        }
    ).withColumn("_day", F.to_date("_local"))
    plain = (
        F.when(text.isNull(), F.lit(None).cast("timestamp"))
        .when(aware, F.when(aware, part(1)).cast("timestamp") - offset)
        .when(z.isNull() | (z == ""), missing)
        .when(
            F.col("_zone").isNotNull(),
            F.to_utc_timestamp(F.col("_local").cast("timestamp"), F.coalesce("_zone", F.lit("UTC"))),
        )
        .otherwise(F.col("_local").cast("timestamp") - F.make_interval(hours=F.col("_shift")))
    )
    marks = [flag] if flag else []
    if not zones:
        return rows.withColumn(column, plain).select(*df.columns, *[F.lit(False).alias(m) for m in marks])

    covered = F.col("_zone").isNull() | F.col("_day").isNull() | F.year("_day").between(*YEARS)
    rows = rows.filter(F.assert_true(covered, F.concat(F.lit("no clock changes known for "), text)).isNull())
    changes = transition_table(spark, zones)
    hit = (F.col("_local") >= F.col("_start")) & (F.col("_local") < F.col("_end"))
    marked = rows.join(F.broadcast(changes), ["_zone", "_day"], "left").withColumn("_hit", F.coalesce(hit, F.lit(False)))
    # rows outside the repeated hours (nearly all) skip the shuffle that numbers the repeats
    twice = F.col("_hit") & ~F.col("_gap")
    once = marked.filter(F.coalesce(~twice, F.lit(True))).withColumn(
        column, F.when(F.col("_hit"), F.col("_instant")).otherwise(plain)
    )
    repeats = Window.partitionBy(*group, "_local").orderBy(*(order or (column,)))
    doubled = marked.filter(twice).withColumn("_times", F.count("*").over(Window.partitionBy(*group, "_local")))
    if continued:
        hour = Window.partitionBy(*group, "_zone", "_start")
        before = F.max("_local").over(hour.orderBy(*(order or (column,))).rowsBetween(Window.unboundedPreceding, -1))
        # one row per piece: where it begins, and how far it goes
        place = F.struct(*(order or (column,)))
        pieces = rows.groupBy(*group).agg(F.min_by("_local", place).alias("_begins"), F.max("_local").alias("_goes"))
        doubled = doubled.withColumn("_back", F.coalesce(before >= F.col("_local"), F.lit(False))).join(pieces, list(group))
        once_within = ~F.bool_or("_back").over(hour) & F.col("_begins").between(F.col("_start"), F.col("_end")) & (F.col("_goes") >= F.col("_end"))
        doubled = doubled.withColumn("_second_time", F.col("_back") | (once_within & (F.col("_begins") < F.col("_end"))))
    else:
        doubled = doubled.withColumn("_second_time", F.row_number().over(repeats) > 1)
    repeated = (
        doubled
        .withColumn(
            column,
            F.when(
                F.col("_second_time"),
                F.col("_local").cast("timestamp") - F.make_interval(secs=F.col("_second")),
            ).otherwise(
                F.col("_instant") - (F.col("_end") - F.col("_local"))
            ),
        )
    )
    return once.select(*df.columns, *[F.lit(False).alias(m) for m in marks]).unionByName(
        repeated.select(*df.columns, *[(F.col("_times") == 1).alias(m) for m in marks])
    )

"""Calendar expressions on UTC timestamps (the session time zone is UTC)."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scalars import as_column


def utc_date(ts) -> Column:
    return F.to_date(as_column(ts))


def days_in_year(d) -> Column:
    d = as_column(d)
    return F.dayofyear(F.make_date(F.year(d), F.lit(12), F.lit(31)))


def hour_of_year(ts) -> Column:
    """0-based hour of the year: hour + 24 * (day of year - 1)."""
    ts = as_column(ts)
    return F.hour(ts) + F.lit(24) * (F.dayofyear(ts) - 1)


def at_hour(d, hour) -> Column:
    """Timestamp of a date plus a number of hours."""
    return F.timestamp_seconds(
        F.unix_timestamp(as_column(d).cast("timestamp")) + as_column(hour).cast("bigint") * 3600
    )


def slot_of_year(ts) -> Column:
    """Key that is equal for the same month, day, hour and minute of every year."""
    return F.date_format(as_column(ts), "MM-dd-HH-mm")


def is_quarter_mark(ts, hourly: bool = False) -> Column:
    """First day of every third month; for hourly series only its first hour."""
    ts = as_column(ts)
    mark = (F.dayofmonth(ts) == 1) & (F.month(ts) % 3 == 0)
    return mark & (F.hour(ts) == 0) if hourly else mark


def parse_event_date(text) -> Column:
    """``March 20, 2021 at 10:37 AM GMT+1`` to UTC."""
    return F.to_timestamp(as_column(text), "MMMM d, yyyy 'at' h:mm a O")


def with_calendar(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Add year, month, day, hour, minute, day_of_week (Monday = 0), day_of_year, week (ISO)."""
    c = F.col(ts)
    return df.withColumns(
        {
            "year": F.year(c),
            "month": F.month(c),
            "day": F.dayofmonth(c),
            "hour": F.hour(c),
            "minute": F.minute(c),
            "day_of_week": F.weekday(c),
            "day_of_year": F.dayofyear(c),
            "week": F.weekofyear(c),
        }
    )

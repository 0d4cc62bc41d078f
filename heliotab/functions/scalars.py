"""Null-safe numeric and text column expressions."""

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the smallest divisor used by the percentage error (double machine epsilon).
EPSILON = 2.220446049250313e-16


def as_column(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c) -> Column:
    """Only nulls exist past a source; NaN would poison every Spark aggregate."""
    c = as_column(c)
    return F.nanvl(c, F.lit(None).cast("double"))


def to_number(c) -> Column:
    """Text to double, anything malformed becomes null.

    The cast would read ``5d`` and ``5f`` as numbers, as Java literals; here they are malformed.
    """
    c = as_column(c)
    return nan_to_null(F.when(~c.rlike(r"[0-9.][dDfF]\s*$"), c).try_cast("double"))


def total(*cols) -> Column:
    """Sum over columns of one row, nulls count as zero."""
    return reduce(lambda a, b: a + b, [F.coalesce(as_column(c), F.lit(0.0)) for c in cols])


def sum_or_zero(c) -> Column:
    """Grouped sum that is 0.0 when the group holds nulls only."""
    return F.coalesce(F.sum(as_column(c)), F.lit(0.0))


def normalized_name(c) -> Column:
    """Trimmed, lower case, blanks as underscores."""
    return F.replace(F.lower(F.trim(as_column(c))), F.lit(" "), F.lit("_"))


def normalize_text(name: str) -> str:
    return name.strip().lower().replace(" ", "_")


def hash32(*cols) -> Column:
    """Deterministic hash in [0, 2^32) that does not depend on partitioning."""
    return F.pmod(F.xxhash64(*[as_column(c) for c in cols]), F.lit(2**32))


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance in km on a sphere of radius 6371 km."""
    lat1, lon1, lat2, lon2 = map(as_column, (lat1, lon1, lat2, lon2))
    half_lat = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2)
    half_lon = F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    chord = half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon
    return F.lit(2 * 6371.0) * F.asin(F.least(F.lit(1.0), F.sqrt(chord)))


def rounded(c, digits: int) -> Column:
    """``F.round`` of a double, which goes through decimal text only where a tie is near.

    Elsewhere the nearest whole number of units is plain; one correctly rounded division gives the same double.
    """
    c, unit = as_column(c), F.lit(10.0**digits)
    whole = F.floor(c * unit + 0.5)
    plain = (F.abs(c * unit) < 2.0**40) & (F.abs(c * unit - F.floor(c * unit) - 0.5) > 0.001)
    return F.when(plain, whole / unit).otherwise(F.round(c, digits))

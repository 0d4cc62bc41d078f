"""Cyclic encodings of calendar positions."""

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scalars import as_column
from .timeparts import days_in_year

_TRIG = {"sin": F.sin, "cos": F.cos}


def _trig(kind: str):
    if kind not in _TRIG:
        raise ValueError(f"unknown function {kind!r}, use one of {sorted(_TRIG)}")
    return _TRIG[kind]


def periodic(c, period: float, kind: str = "sin") -> Column:
    """sin or cos of position / period on the full circle."""
    if period <= 0:
        raise ValueError("period must be positive")
    return _trig(kind)(as_column(c) / F.lit(float(period)) * F.lit(2 * math.pi))


def day_of_year_angle(d, kind: str = "sin") -> Column:
    """sin or cos of the day of year over the true length of that year."""
    d = as_column(d)
    return _trig(kind)(F.dayofyear(d) / days_in_year(d) * F.lit(2 * math.pi))


def with_doy_trig(df: DataFrame, date_col: str = "date") -> DataFrame:
    return df.withColumns(
        {f"{date_col}_doy_{k}": day_of_year_angle(date_col, k) for k in ("sin", "cos")}
    )


def with_periodic(df: DataFrame, col: str, period: float, kinds=("sin", "cos")) -> DataFrame:
    return df.withColumns({f"{col}_{k}": periodic(col, period, k) for k in kinds})


def with_doy_trig_366(df: DataFrame, date_col: str = "date") -> DataFrame:
    """The fixed-period variant: raw day of year plus sin/cos over 366 days."""
    doy = F.dayofyear(date_col)
    return df.withColumns(
        {
            f"{date_col}_dayofyear": doy,
            f"{date_col}_sin": periodic(doy, 366, "sin"),
            f"{date_col}_cos": periodic(doy, 366, "cos"),
        }
    )

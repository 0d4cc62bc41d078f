"""Registration of queries, and the output rules both sides share."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import rounded
from ..session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, digits: int = 4, many: bool = False, **rounding: int):
    """Register a function (spark, sf_dir) -> DataFrame.

    Doubles are rounded (``digits``, or per column by keyword), integers become bigint and
    timestamps lose their zone, so that both engines return the same types. ``many`` rows of
    plain columns are rounded with less work, to the same values.
    """

    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return shape(fn(configure(spark), sf_dir), digits, rounding, rounded if many else F.round)

        run.__name__, run.__doc__ = name, fn.__doc__
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return fn

    return register


def shape(df: DataFrame, digits: int, rounding: dict[str, int], to_digits=F.round) -> DataFrame:
    out = []
    for f in df.schema:
        c, kind = F.col(f"`{f.name}`"), f.dataType.typeName()
        if kind in ("double", "float"):
            # adding 0.0 turns a negative zero into a plain one
            c = to_digits(c.cast("double"), rounding.get(f.name, digits)) + F.lit(0.0)
        elif kind in ("byte", "short", "integer"):
            c = c.cast("bigint")
        elif kind in ("date", "timestamp"):
            c = c.cast("timestamp_ntz")
        out.append(c.alias(f.name))
    return df.select(*out)

"""Queries of this subpackage and their SQL twins."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Rows cross to Python in batches of about this many bytes, so that a batch stays small where texts are
# long and is not tiny where rows are short.
BATCH_BYTES = str(1 << 20)


def prepare(spark: SparkSession) -> SparkSession:
    """The library's settings, with Arrow batches bounded by bytes."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return spark


def query(name: str, sql: str | None = None):
    """Register a function (spark, sf_dir) -> DataFrame with its SQL twin, if SQL can express it."""

    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(prepare(spark), sf_dir)

        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")

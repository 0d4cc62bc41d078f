"""Order statistics that never put a whole group into one task.

Ranks, running totals and quantiles need an order. Ordering a group inside one window
partition fails once a single group holds a large share of all rows, so values are first
cut into buckets at sketched quantiles. A bucket holds at most about rows / buckets rows
whatever the group sizes are, bucket totals are tiny, and the offset of a bucket is the
running sum over those totals. The result does not depend on where the cuts fall, so the
sketch affects balance only, never values.

Sketches are mergeable and of fixed size: every input task makes one, and each further
level merges the sketches of ``FAN`` neighbours, so a task holds a bounded number of sketched
values however many tasks there are. The number of buckets is fixed too; where a wanted bucket
is still too large to be ordered at once, it is cut again.
"""

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scalars import nan_to_null
from ..session import settle

BUCKET = "_bucket"
BUCKETS = 1_024
SKETCH = 1_024  # size of a sketch: about three times as many values, ranks right to about 0.2 %
FAN_BITS = 8  # FAN = 256 sketches are merged together: fewer than a million values
LEVELS = 2  # of merges before the last one, enough for 2**24 input tasks
ORDERED_ROWS = 4_000_000  # rows that one task orders; a larger bucket is cut again
REFINED = 3  # at most so many times: a value that fills its bucket cannot be cut, nor need it be


def cut_points(df: DataFrame, value: str, buckets: int | None = None) -> list[float]:
    """Sketched quantiles of ``value``; at most ``buckets`` numbers reach the driver."""
    n = buckets or BUCKETS
    if n < 2:
        return []
    size = F.lit(SKETCH)
    sketches = df.select(F.col(value).cast("double").alias("_v"), F.shiftright(F.spark_partition_id(), FAN_BITS).alias("_part"))
    sketches = sketches.groupBy("_part").agg(F.kll_sketch_agg_double("_v", size).alias("_s"))
    for _ in range(LEVELS - 1):
        sketches = sketches.groupBy(F.shiftright("_part", FAN_BITS).alias("_part")).agg(F.kll_merge_agg_double("_s", size).alias("_s"))
    shares = F.expr(f"array({', '.join(f'{i / n!r}D' for i in range(1, n))})")
    row = sketches.agg(F.kll_merge_agg_double("_s", size).alias("_s")).select(F.kll_sketch_get_n_double("_s").alias("n"), "_s")
    row = row.select(F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("_s", shares)).alias("cuts")).first()
    return sorted({c for c in (row and row.cuts) or [] if math.isfinite(c)})


def with_bucket(df: DataFrame, value: str, cuts: list[float]) -> DataFrame:
    """Add the index of the bucket that ``value`` falls in (binary search in the JVM)."""
    if not cuts:
        return df.withColumn(BUCKET, F.lit(0))
    splits = [-math.inf, *cuts, math.inf]
    cut = Bucketizer(splits=splits, inputCol=value, outputCol=BUCKET).transform(df)
    return cut.withColumn(BUCKET, F.col(BUCKET).cast("int"))


def running_total(
    df: DataFrame,
    keys: list[str],
    value: str,
    weights: list[str],
    buckets: int | None = None,
    suffix: str = "_before",
) -> DataFrame:
    """For each distinct ``value`` per key: the sum of each weight over smaller values.

    ``df`` must hold one row per (keys, value); ``value`` is a double.
    """
    rows = with_bucket(df, value, cut_points(df, value, buckets))
    totals = rows.groupBy(*keys, BUCKET).agg(*[F.sum(w).alias(f"_total_{w}") for w in weights])
    earlier = Window.partitionBy(*keys).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *keys,
        BUCKET,
        *[F.coalesce(F.sum(f"_total_{w}").over(earlier), F.lit(0)).alias(f"_offset_{w}") for w in weights],
    )
    inside = (
        Window.partitionBy(*keys, BUCKET).orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    )
    local = rows.withColumns(
        {f"_local_{w}": F.coalesce(F.sum(w).over(inside), F.lit(0)) for w in weights}
    )
    return local.join(offsets, [*keys, BUCKET]).select(
        *df.columns,
        *[(F.col(f"_offset_{w}") + F.col(f"_local_{w}")).alias(f"{w}{suffix}") for w in weights],
    )


# Relative width of the bins of an approximate quantile; all doubles fit in about 72,000 of them.
APPROX_STEP = 0.02


def _binned_quantiles(rows: DataFrame, keys: list[str], value: str, probs: dict[str, float]) -> DataFrame:
    x = F.col(value)
    place = F.floor(F.ln(F.abs(F.when(x != 0, x))) / math.log1p(APPROX_STEP)) + 40_000
    bins = rows.groupBy(*keys, F.coalesce(F.signum(x) * place, F.lit(0.0)).alias(BUCKET)).agg(F.count("*").alias("_n"), F.min(x).alias("_v"))
    upto = F.sum("_n").over(Window.partitionBy(*keys).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, 0))
    placed = bins.withColumns({"_to": upto, "_size": F.sum("_n").over(Window.partitionBy(*keys))})
    rank = {name: F.floor(F.lit(float(p)) * (F.col("_size") - 1)) for name, p in probs.items()}
    return placed.groupBy(*keys).agg(*[F.min(F.when(F.col("_to") > r, F.struct(BUCKET, "_v"))).getField("_v").alias(n) for n, r in rank.items()])


def _before(keys: list[str]) -> Column:
    """Rows in the buckets below, per key."""
    earlier = Window.partitionBy(*keys).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum("_n").over(earlier), F.lit(0))


def _holding(counts: DataFrame) -> DataFrame:
    """The buckets that hold a wanted rank, with the ranks they hold."""
    first, last = F.col("_offset"), F.col("_offset") + F.col("_n")
    held = F.filter("_wanted", lambda q: (q["low"] < last) & (q["high"] >= first))
    return counts.withColumn("_wanted", held).filter(F.size("_wanted") > 0)


def _settled(targets: DataFrame) -> tuple[DataFrame, int]:
    """The wanted buckets, and the rows of the largest one, observed while they are written."""
    seen = Observation()
    held = settle(targets.observe(seen, F.max("_n").alias("n")), "ranks")
    return held, seen.get["n"] or 0


def exact_quantiles(
    df: DataFrame,
    keys: list[str],
    value: str,
    probs: dict[str, float],
    buckets: int | None = None,
    approx: bool = False,
) -> DataFrame:
    """Linear-interpolated quantiles per key, one column per entry of ``probs``.

    Only the buckets that hold a wanted rank are ordered: counting the buckets needs a
    scan with map-side combine (settled: a few rows per key), and of the rows themselves just
    those few buckets move. A wanted bucket of more than ``ORDERED_ROWS`` rows is cut again. ``approx`` takes one pass: values are counted in logarithmic bins, and a
    quantile is the least value of its bin, within ``APPROX_STEP`` of the exact one whatever the partitions.
    """
    rows = df.select(*keys, nan_to_null(F.col(value).cast("double")).alias(value)).dropna(subset=[value])
    if approx:
        return _binned_quantiles(rows, keys, value, probs)
    rows = with_bucket(rows, value, cut_points(rows, value, buckets))
    whole = Window.partitionBy(*keys)
    counts = rows.groupBy(*keys, BUCKET).agg(F.count("*").alias("_n"))
    counts = counts.withColumns({"_offset": _before(keys), "_size": F.sum("_n").over(whole)})
    # position = p * (size - 1); its floor and ceiling are the two 0-based ranks to look up
    wanted = F.array(
        *[
            F.struct(
                F.lit(name).alias("name"),
                F.floor(F.lit(float(p)) * (F.col("_size") - 1)).alias("low"),
                F.ceil(F.lit(float(p)) * (F.col("_size") - 1)).alias("high"),
                (F.lit(float(p)) * (F.col("_size") - 1)).alias("position"),
            )
            for name, p in probs.items()
        ]
    )
    targets, largest = _settled(_holding(counts.withColumn("_wanted", wanted)).select(*keys, BUCKET, "_offset", "_n", "_wanted"))
    places = [*keys, BUCKET]
    for level in range(REFINED):
        if largest <= ORDERED_ROWS:
            break
        # The rows of the wanted buckets alone, cut at their own quantiles.
        outer = [*places[:-1], f"{BUCKET}{level}"]
        rows = rows.join(targets.select(*places), places, "left_semi").withColumnRenamed(BUCKET, outer[-1])
        rows = with_bucket(rows, value, cut_points(rows, value, buckets))
        counts = rows.groupBy(*outer, BUCKET).agg(F.count("*").alias("_n")).withColumn("_inner", _before(outer))
        held = targets.drop("_n").withColumnRenamed(BUCKET, outer[-1])
        counts = counts.join(held, outer).withColumn("_offset", F.col("_offset") + F.col("_inner"))
        places = [*outer, BUCKET]
        targets, largest = _settled(_holding(counts).select(*places, "_offset", "_n", "_wanted"))
    inside = Window.partitionBy(*places).orderBy(value)
    ranked = (
        rows.join(targets.select(*places), places, "left_semi")
        .groupBy(*places, value)
        .agg(F.count("*").alias("_c"))
        .withColumn("_upto", F.sum("_c").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    )
    hits = (
        ranked.join(targets, places)
        .withColumn("_from", F.col("_offset") + F.col("_upto") - F.col("_c"))
        .withColumn("_to", F.col("_offset") + F.col("_upto"))
        .select(*keys, value, "_from", "_to", F.explode("_wanted").alias("_q"))
    )

    def holds(rank: Column) -> Column:
        return (rank >= F.col("_from")) & (rank < F.col("_to"))

    def at(name: str, side: str) -> Column:
        return F.max(F.when((F.col("_q.name") == name) & holds(F.col(f"_q.{side}")), F.col(value)))

    out = []
    for name in probs:
        low, high = at(name, "low"), at(name, "high")
        position = F.max(F.when(F.col("_q.name") == name, F.col("_q.position")))
        out.append((low + (high - low) * (position - F.floor(position))).alias(name))
    return hits.groupBy(*keys).agg(*out)


def exact_median(df: DataFrame, keys: list[str], value: str, name: str = "median", **options) -> DataFrame:
    return exact_quantiles(df, keys, value, {name: 0.5}, **options)


def hash_ranges(spark: SparkSession) -> int:
    """Ranges of a hash that are ordered apart: several per shuffle partition, and few enough for a broadcast of one row each."""
    return min(16_384, max(32, 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))))


def global_index(df: DataFrame, order: Column, tie: list[str], name: str, buckets: int | None = None) -> DataFrame:
    """0-based position of every row in the order of ``order`` (a hash in [0, 2^32)), then ``tie``.

    Hash ranges serve as buckets, so no task sorts more than its share of the rows.
    """
    n = buckets or hash_ranges(df.sparkSession)
    rows = df.withColumn("_hash", order.cast("bigint"))
    rows = rows.withColumn(BUCKET, F.floor(F.col("_hash") * F.lit(n) / F.lit(2**32)).cast("bigint"))
    counts = rows.groupBy(BUCKET).agg(F.count("*").alias("_n"))
    # one row per hash range: at most ``n`` rows in this window and in the broadcast
    earlier = Window.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(BUCKET, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy(BUCKET).orderBy("_hash", *tie)
    return (
        rows.withColumn("_rn", F.row_number().over(inside))
        .join(F.broadcast(offsets), BUCKET)
        .withColumn(name, F.col("_offset") + F.col("_rn") - 1)
        .select(*df.columns, name)
    )

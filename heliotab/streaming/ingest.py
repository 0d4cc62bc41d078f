"""Streaming versions of ingest and aggregation."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.clean import coerce_numeric, normalize_peak, rename_power_columns
from ..operators.zones import to_utc
from ..sources.power_files import ingest_lines, power_lines
from .tables import DayTable


def read_power_stream(spark: SparkSession, path: str, columns: list[str], files_per_trigger: int = 1000) -> DataFrame:
    """Files of one header arriving below ``path``; every column as text."""
    schema = ", ".join(f"`{c}` string" for c in columns)
    return (
        spark.readStream.schema(schema)
        .options(sep=";", header=True, enforceSchema=False, maxFilesPerTrigger=files_per_trigger)
        .csv(path)
    )


def clean_power_stream(raw: DataFrame, sites: DataFrame, late_by: str | None = None) -> DataFrame:
    """Rename, cast, scale, UTC, then drop repeats of (installation, timestamp).

    Files may arrive in any order, so nothing is late: the keys seen are kept in the state store. With
    ``late_by`` readings older than that behind the newest one are given up, and the state stays as small.
    Zones with summer time need the order of the rows in a file, which ``ingest_stream`` keeps: a named zone
    fails here.
    """
    zone = F.lower(F.trim("timezone"))
    named = sites.filter(~(zone.rlike("^utc([+-].*)?$") | (zone == ""))).select("timezone").distinct().limit(5).collect()
    if named:
        raise ValueError(f"named time zones need ingest_stream: {', '.join(r.timezone for r in named)}")
    renamed = rename_power_columns(raw)
    measures = [c for c in renamed.columns if c not in ("installation", "timestamp")]
    local = normalize_peak(coerce_numeric(renamed, measures), sites, keep=("timezone",))
    utc = to_utc(local, zones=[]).drop("timezone")
    keys = ["installation", "timestamp"]
    return utc.withWatermark("timestamp", late_by).dropDuplicatesWithinWatermark(keys) if late_by else utc.dropDuplicates(keys)


def stream_aggregate(df: DataFrame, width: str, sums: list[str], means: list[str] = (), late_by: str | None = None) -> DataFrame:
    """Sums and means per installation and tumbling window; with ``late_by`` rows beyond the watermark are late."""
    marked = df.withWatermark("timestamp", late_by) if late_by else df
    return (
        marked.groupBy("installation", F.window("timestamp", width).alias("_w"))
        .agg(
            *[F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in sums],
            *[F.avg(c).alias(c) for c in means],
        )
        .select("installation", F.col("_w.start").alias("timestamp"), *sums, *means)
    )


def write_stream(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append to Parquet and stop once all files present are done."""
    return (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def write_updates(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write the rows that each batch changed; ``read_latest`` gives the table.

    No window waits for a watermark to close it. A batch owns a folder and overwrites it, so a batch
    that is run again after a failure leaves the same files.
    """

    def keep(changed: DataFrame, batch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={batch}")

    return df.writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_latest(spark: SparkSession, path: str, schema, keys: tuple[str, ...] = ("installation", "timestamp")) -> DataFrame:
    """The last state of every key that ``write_updates`` wrote."""
    stored = spark.read.schema(schema).option("basePath", path).parquet(path).withColumn("_path", F.col("_metadata.file_path"))
    batch = F.regexp_extract("_path", "/batch=([0-9]+)/", 1).cast("bigint")
    rest = [c for c in stored.columns if c not in (*keys, "_path", "batch")]
    last = stored.groupBy(*keys).agg(F.max_by(F.struct(*rest), batch).alias("_last"))
    return last.select(*keys, *[F.col(f"_last.{c}").alias(c) for c in rest])


def ingest_stream(
    spark: SparkSession, root: str, sites: DataFrame, readings: DayTable, checkpoint: str, files_per_trigger: int = 1000,
    hourly: tuple[DayTable, list[str], list[str]] | None = None, keep: int = 2,
) -> StreamingQuery:
    """Exports that arrive below ``root/<installation>/`` into a table by day, as the batch job reads them.

    Files may have any headers (columns are added by name as they come), any time zone and any order, may be
    pieces of an export cut anywhere, and may come again. A file is within one batch, so the order of its
    rows tells the repeated hour apart; repeats are found among the days that a batch touches, and no state is kept
    between batches but the table. ``hourly`` is a table of hours with sums and means: the
    touched days are aggregated anew after each batch. The last ``keep`` versions of the tables stay.
    """
    reader = spark.readStream.option("maxFilesPerTrigger", files_per_trigger)

    def batch(lines: DataFrame, version: int) -> None:
        grown = readings.append(ingest_lines(lines, sites, continued=True), version)
        if hourly:
            table, sums, means = hourly
            days = sorted(grown)
            table.replace(stream_aggregate(readings.read(days, version), "1 hour", sums, means), days, version)
            table.vacuum(keep)
        readings.vacuum(keep)

    return power_lines(reader, root).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

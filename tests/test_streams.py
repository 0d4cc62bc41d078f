"""Streams equal the batch result on the same files."""

import pytest
from pyspark.sql import functions as F

from heliotab.session import scratch_dir
from heliotab.sources.power_files import SITE_SCHEMA
from heliotab.streaming.ingest import clean_power_stream, read_latest, read_power_stream, stream_aggregate, write_stream, write_updates


def test_stream_equals_batch(spark):
    sites = spark.createDataFrame([("a", 10, "", "", "utc+1", 0.0, 0.0), ("b", 20, "", "", "utc", 0.0, 0.0)], SITE_SCHEMA)
    raw = spark.range(4000).select(
        F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("installation"),
        F.date_format(F.timestamp_seconds(1_700_000_000 + F.col("id") * 300), "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
        (F.col("id") % 50).cast("string").alias("Solarproduktion"),
    )
    path, out = scratch_dir(spark, "in"), scratch_dir(spark, "out")
    raw.unionAll(raw).repartition(5).write.csv(path, sep=";", header=True)
    stream = clean_power_stream(read_power_stream(spark, path, raw.columns), sites)
    write_stream(stream, out, scratch_dir(spark, "state")).awaitTermination()
    got = spark.read.parquet(out)
    assert got.count() == 4000 and got.select("installation", "timestamp").distinct().count() == 4000
    assert got.filter("installation = 'a'").agg(F.min("timestamp")).first()[0].isoformat() == "2023-11-14T21:13:20"

    hourly_out = scratch_dir(spark, "hourly")
    hourly = stream_aggregate(spark.readStream.schema(got.schema).option("maxFilesPerTrigger", 1).parquet(out), "1 hour", ["sol_prod"])
    write_updates(hourly, hourly_out, scratch_dir(spark, "state")).awaitTermination()
    streamed = {(r.installation, r.timestamp): round(r.sol_prod, 9) for r in read_latest(spark, hourly_out, hourly.schema).collect()}
    batch = {(r.installation, r.timestamp): round(r.sol_prod, 9) for r in stream_aggregate(got, "1 hour", ["sol_prod"]).collect()}
    assert streamed == batch


def test_files_out_of_time_order_one_by_one(spark, tmp_path):
    sites = spark.createDataFrame([("a", 10, "", "", "utc", 0.0, 0.0)], SITE_SCHEMA)
    for i, day in enumerate((10, 1, 20, 2, 1)):
        (tmp_path / f"{i}.csv").write_text(f"installation;timestamp;Solarproduktion\na;2024-01-{day:02} 00:00:00;{day}\n")
    raw = read_power_stream(spark, str(tmp_path), ["installation", "timestamp", "Solarproduktion"], files_per_trigger=1)
    out = scratch_dir(spark, "out")
    write_stream(clean_power_stream(raw, sites), out, scratch_dir(spark, "state")).awaitTermination()
    assert sorted(r.sol_prod for r in spark.read.parquet(out).collect()) == [0.1, 0.2, 1.0, 2.0]


def test_named_zones_are_refused(spark, tmp_path):
    sites = spark.createDataFrame([("a", 10, "", "", "Europe/Berlin", 0.0, 0.0)], SITE_SCHEMA)
    with pytest.raises(ValueError, match="Europe/Berlin"):
        clean_power_stream(read_power_stream(spark, str(tmp_path), ["installation", "timestamp"]), sites)


def test_batches_of_the_hourly_stream_do_not_grow_with_the_partitions(spark, tmp_path, monkeypatch):
    from heliotab.catalog import streams

    spark.range(3000).select(
        F.col("id").alias("event_id"), F.timestamp_seconds(1_700_000_000 + F.col("id") * 60).cast("timestamp_ntz").alias("ts"),
        (F.col("id") % 40).alias("user_id"), F.lit("view").alias("event_type"), F.lit(1.0).alias("value"),
        F.concat(F.lit('{"k": '), (F.col("id") % 90).cast("string"), F.lit("}")).alias("props"),
    ).write.parquet(f"{tmp_path}/events.parquet")
    batches, before = {}, spark.conf.get("spark.sql.shuffle.partitions")

    def counted(name):
        inner = getattr(streams, name)

        def run(*args):
            query = inner(*args)
            query.awaitTermination()
            batches[name] = sum(p["numInputRows"] > 0 for p in query.recentProgress)
            return query

        monkeypatch.setattr(streams, name, run)

    counted("write_stream")
    counted("write_updates")
    spark.conf.set("spark.sql.shuffle.partitions", "20")
    try:
        out = streams.stream_hourly(spark, str(tmp_path))
        hours = F.sum((F.col("sol_prod") > 0).cast("int")).alias("sunny"), F.countDistinct("timestamp").alias("hours"), F.count("*").alias("rows")
        got = out.agg(*hours).first()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    # Minute 60 i + j of a user u = event % 40: every installation (u % 4) has readings in each of the 51 hours touched.
    assert (got.hours, got.rows) == (51, 204) and got.sunny > 0
    assert batches == {"write_stream": 4, "write_updates": 4}

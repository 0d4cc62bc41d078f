"""Streams of exports into tables by day: equal to the batch job, bounded, repeatable."""

from datetime import datetime, timedelta
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from heliotab.session import scratch_dir
from heliotab.sources.power_files import SITE_SCHEMA, ingest_power
from heliotab.streaming import tables
from heliotab.streaming.ingest import ingest_stream
from heliotab.streaming.tables import DayTable

BERLIN = ZoneInfo("Europe/Berlin")


def sites(spark, names, zone="Europe/Berlin"):
    return spark.createDataFrame([(n, 10, "", "", zone, 0.0, 0.0) for n in names], SITE_SCHEMA)


def export(path, rows, header="timestamp;Solarproduktion"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(header + "\n" + "".join(f"{';'.join(map(str, r))}\n" for r in rows))


def wall_clock(start, hours):
    """Every quarter of an hour from a UTC time on, as a logger in Berlin writes it."""
    out = []
    for i in range(4 * hours):
        at = start + timedelta(minutes=15 * i)
        out.append((at, at.replace(tzinfo=ZoneInfo("UTC")).astimezone(BERLIN).strftime("%Y-%m-%d %H:%M:%S")))
    return out


def stream(spark, root, names, table, state, files=1, zone="Europe/Berlin", **kw):
    ingest_stream(spark, str(root), sites(spark, names, zone), table, state, files, **kw).awaitTermination()


def rows_of(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)


def test_exports_cut_anywhere_over_both_clock_changes(spark, tmp_path):
    """Installation i's export is cut behind its i-th line; whole, in pieces and as a stream all give the true times."""
    spring, autumn = wall_clock(datetime(2024, 3, 31, 0), 3), wall_clock(datetime(2024, 10, 26, 23), 4)
    series, truth, names = spring + autumn, [], []
    for cut in range(0, len(series), 1):
        name = f"i{cut}"
        names.append(name)
        lines = [(text, k) for k, (_, text) in enumerate(series)]
        # the later piece may well arrive first
        export(tmp_path / "p" / name / "z.csv", lines[:cut])
        export(tmp_path / "p" / name / "a.csv", lines[cut:])
        truth += [(name, at, k / 10) for k, (at, _) in enumerate(series)]
    truth.sort(key=repr)
    batch = ingest_power(spark, str(tmp_path / "p"), sites(spark, names), continued=True)
    assert rows_of(batch, "installation", F.col("timestamp").cast("timestamp_ntz"), "sol_prod") == truth
    table = DayTable(spark, scratch_dir(spark, "days"))
    stream(spark, tmp_path / "p", names, table, scratch_dir(spark, "state"), files=40)
    assert rows_of(table.read(), "installation", F.col("timestamp").cast("timestamp_ntz"), "sol_prod") == truth


def test_mixed_headers_one_of_them_late(spark, tmp_path):
    root, state, table = tmp_path / "p", scratch_dir(spark, "state"), DayTable(spark, scratch_dir(spark, "days"))
    export(root / "a" / "1.csv", [("2024-01-01 00:00:00", 50)])
    export(root / "b" / "1.csv", [(7, "2024-01-01 00:15:00", 20)], "Hausverbrauch;timestamp;Solarproduktion")
    stream(spark, root, ["a", "b"], table, state, zone="utc")
    before = table.read()
    assert "note" not in before.columns
    export(root / "a" / "2.csv", [("x", "2024-01-01 00:30:00", 9)], "note;timestamp;Ladezustand")
    stream(spark, root, ["a", "b"], table, state, zone="utc")
    batch = ingest_power(spark, str(root), sites(spark, ["a", "b"], "utc"))
    columns = sorted(batch.columns)
    assert sorted(table.read().columns) == columns and "note" in columns
    assert rows_of(table.read(), *columns) == rows_of(batch, *columns)
    assert before.count() == 2  # a reader stays with its version


def test_any_order_repeats_and_replay(spark, tmp_path):
    days = {i: [(f"2024-01-{d:02} {h:02}:00:00", d * 10 + h) for h in range(3)] for i, d in enumerate((10, 1, 20, 10))}
    for i, lines in days.items():
        export(tmp_path / "p" / "a" / f"{i}.csv", lines)
    hours, table = DayTable(spark, scratch_dir(spark, "hours")), DayTable(spark, scratch_dir(spark, "days"))
    stream(spark, tmp_path / "p", ["a"], table, scratch_dir(spark, "state"), zone="utc", hourly=(hours, ["sol_prod"], ["soc"]))
    want = sorted({(str(t), v / 10) for lines in days.values() for t, v in lines})
    got = sorted((str(r.timestamp), r.sol_prod) for r in table.read().collect())
    assert got == want == sorted((str(r.timestamp), r.sol_prod) for r in hours.read().collect())
    schema, parts = table.manifest()
    version = table.versions()[-1]
    # a batch that is run again, with what it had and with rows that others have, changes nothing
    again = table.read(version=version)
    assert table.append(again, version) == sorted(d for d, p in parts.items() if f"batch-{version}" in p)
    assert table.manifest() == (schema, parts) and table.append(again, version + 1) == []
    assert table.read().count() == len(want)


def test_days_are_merged_and_old_versions_vacuumed(spark, monkeypatch):
    monkeypatch.setattr(tables, "MOST_PARTS", 3)
    table = DayTable(spark, scratch_dir(spark, "days"), ("k",))
    make = lambda n: spark.createDataFrame([(n, datetime(2024, 1, 1, n % 24)), (100 + n, None)], "k long, timestamp timestamp")
    for n in range(6):
        table.append(make(n), n)
        assert max(len(p) for p in table.manifest()[1].values()) <= 3
    assert set(table.manifest()[1]) == {"2024-01-01", tables.UNDATED}
    held = table.read()
    table.replace(make(50), ["2024-01-01"], 6)
    assert sorted(r.k for r in held.collect()) == [*range(6), *range(100, 106)]
    assert sorted(r.k for r in table.read().filter("timestamp is not null").collect()) == [50]
    table.vacuum(keep=1)
    assert table.versions() == [6]
    listed = {p for parts in table.manifest()[1].values() for p in parts}
    assert set(table._names("data")) == listed
    # a part without a manifest is not there for readers
    table._write(make(77).withColumn(tables.DAY, F.lit("2024-01-01")), "batch-7")
    assert 77 not in [r.k for r in table.read().collect()]


def test_empty_table(spark):
    table = DayTable(spark, scratch_dir(spark, "days"))
    assert table.versions() == [] and table.read().count() == 0


def test_text_is_read_once(spark, tmp_path):
    export(tmp_path / "p" / "a" / "1.csv", [("2024-10-27 02:00:00", 1)])
    plan = ingest_power(spark, str(tmp_path / "p"), sites(spark, ["a"]))._jdf.queryExecution().optimizedPlan().toString()
    assert "text" not in plan.lower().replace("timestamp", "") and plan.lower().count("parquet") >= 2


@pytest.mark.parametrize("continued", [False, True])
def test_a_series_that_never_repeats_stays_summer_time(spark, tmp_path, continued):
    export(tmp_path / "p" / "a" / "1.csv", [("2024-10-27 01:00:00", 1), ("2024-10-27 02:00:00", 2), ("2024-10-27 04:00:00", 3)])
    got = ingest_power(spark, str(tmp_path / "p"), sites(spark, ["a"]), continued)
    assert [str(r.timestamp) for r in got.orderBy("timestamp").collect()] == ["2024-10-26 23:00:00", "2024-10-27 00:00:00", "2024-10-27 03:00:00"]

"""Files: power exports, weather responses, runs, sinks."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from heliotab.operators.clean import clear_nan, label_of
from heliotab.operators.compare import baselines, ranked, run_at
from heliotab.sources.power_files import SITE_SCHEMA, ingest_power, read_power_files, read_series, read_sites
from heliotab.operators.metrics import classification_record, format_report
from heliotab.sources.run_files import scan_runs, select_fields, stored_reports
from heliotab.sources.sinks import prediction_export, write_csv, write_importance, write_run_records, write_series
from heliotab.sources.weather_files import (
    flatten_responses,
    read_observations,
    read_responses,
    read_seasonal_events,
    read_weather_codes,
    route_by_date,
    site_weather,
)


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


def test_headers_differ_by_file(spark, tmp_path):
    write(tmp_path / "p/a/one.csv", "timestamp;Solarproduktion;Ladezustand\n2024-01-01 00:00;2;50\n")
    write(tmp_path / "p/a/two.csv", "﻿Ladezustand;timestamp;Solarproduktion;Neu\n60;2024-01-01 00:15;4;x\n")
    write(tmp_path / "p/b/one.csv", 'timestamp;"Solarproduktion"\n2024-01-01 00:30;"5"\n\n')
    write(tmp_path / "p/b/notes.txt", "timestamp;Solarproduktion\n2024-01-01 00:45;99\n")
    write(tmp_path / "p/stray.csv", "timestamp;Solarproduktion\n2024-01-01 00:45;99\n")
    got = {
        (r.installation, r.timestamp, r.sol_prod, r.soc, r.Neu) for r in read_power_files(spark, str(tmp_path / "p")).collect()
    }
    assert got == {
        ("a", "2024-01-01 00:00", "2", "50", None),
        ("a", "2024-01-01 00:15", "4", "60", "x"),
        ("b", "2024-01-01 00:30", "5", None, None),
    }


def test_ingest_loses_nothing(spark, tmp_path):
    write(tmp_path / "p/Haus 1/a.csv", "timestamp;Solarproduktion\n2024-01-01 00:00;2\ntimestamp;Solarproduktion\n2024-01-01 00:15;4\n")
    write(tmp_path / "p/a+b/a.csv", "timestamp;Solarproduktion\n2024-01-01 00:00;6\n")
    sites = spark.createDataFrame([("Haus 1", 2, "", "", "utc", 1.0, 2.0), ("a+b", 2, "", "", "utc", 1.0, 2.0)], SITE_SCHEMA)
    root = str(tmp_path / "p")
    rows = ingest_power(spark, root, sites).collect()
    assert sorted((r.installation, r.sol_prod) for r in rows) == [("Haus 1", 1.0), ("Haus 1", 2.0), ("a+b", 3.0)]
    with pytest.raises(ValueError, match="a\\+b"):
        ingest_power(spark, root, sites.filter("installation <> 'a+b'"))
    with pytest.raises(ValueError, match="several rows"):
        ingest_power(spark, root, sites.union(sites))
    write(tmp_path / "p/a+b/bare.csv", "2024-01-01 00:30;6\n")
    with pytest.raises(ValueError, match="no header"):
        ingest_power(spark, root, sites)


def test_ingest_with_repeated_hour(spark, tmp_path):
    hours = ["01:45", "02:00", "02:15", "02:30", "02:45", "02:00", "02:15", "02:30", "02:45", "03:00"]
    lines = "".join(f"2024-10-27 {h};{i};abc\n" for i, h in enumerate(hours))
    write(tmp_path / "p/a/x.csv", "timestamp;Solarproduktion;Netzbezug\n" + lines)
    sites = spark.createDataFrame([("a", 10, "", "01|02", "Europe/Berlin", 1.0, 2.0)], SITE_SCHEMA)
    rows = ingest_power(spark, str(tmp_path / "p"), sites).orderBy("sol_prod").collect()
    assert [r.timestamp.strftime("%d %H:%M") for r in rows] == [
        "26 23:45", "27 00:00", "27 00:15", "27 00:30", "27 00:45", "27 01:00", "27 01:15", "27 01:30", "27 01:45", "27 02:00",
    ]
    assert [r.sol_prod for r in rows] == [i / 10 for i in range(10)] and all(r.grid_cons is None for r in rows)


def test_site_ids_keep_zeros(spark, tmp_path):
    write(tmp_path / "sites.csv", "installation;Wp;closest_weather_station_names;closest_weather_station_ids;timezone;latitude;longitude\na;5000;x|y;00433|00399;utc;52.5;13.4\n")
    r = read_sites(spark, str(tmp_path / "sites.csv")).first()
    assert (r.closest_weather_station_ids, r.Wp, r.latitude) == ("00433|00399", 5000, 52.5)


def test_weather_response(spark, frame, tmp_path):
    body = {
        "installation": "a",
        "start": "2024-01-01T00:00:00Z",
        "end": "2024-01-01T02:00:00Z",
        "interval": 3600,
        "weather_code": [0, 120],
        "cloud_cover": ["NaN", 50],
        "snow_depth": [None, 1],
        "sunshine_duration": [1, 2],
        "is_day": ["NaN", 1],
        "direct_radiation": [3, 4],
    }
    write(tmp_path / "r.json", json.dumps(body))
    codes = frame([(0, "Clear Sky")], "code_figure int, code_name string")
    rows = flatten_responses(read_responses(spark, str(tmp_path / "r.json")), codes).orderBy("timestamp").collect()
    sites = frame([("a",), ("z",)], "installation string")
    assert site_weather(read_responses(spark, str(tmp_path / "r.json")), sites).count() == 2
    assert site_weather(read_responses(spark, str(tmp_path / "r.json")), sites.filter("installation = 'z'")).count() == 0
    assert [(r.timestamp.hour, r.cloud_cover, r.snow_depth, r.is_day, r.weather_description) for r in rows] == [
        (0, 0.0, 0.0, None, "Clear Sky"),
        (1, 50.0, 1.0, 1.0, "Unknown"),
    ]


def test_route_by_date(spark, frame):
    df = frame([("2024-01-01 23:00",), ("2024-01-02 00:00",)], "timestamp timestamp")
    out = route_by_date(df.withColumn("o", F.lit("a")), df.withColumn("o", F.lit("f")), "2024-01-02").collect()
    assert sorted((r.timestamp.day, r.o) for r in out) == [(1, "a"), (2, "f")]


def test_seasonal_events(spark, tmp_path):
    write(tmp_path / "e.csv", "Event;Date\nMarch Equinox;March 20, 2021 at 10:37 AM GMT+1\nJune Solstice;June 21, 2021 at 5:31 AM GMT+2\n")
    rows = read_seasonal_events(spark, str(tmp_path / "e.csv")).orderBy("date").collect()
    assert [r.date for r in rows] == [datetime(2021, 3, 20, 9, 37), datetime(2021, 6, 21, 3, 31)]


def test_registry_scan(spark, tmp_path):
    run = "20250101_Ridge_r20,a"
    write(tmp_path / f"{run}/{run}.results.json", '{\n "model_name": "x", "timestamp": "20250101", "R2": NaN, "MAE": 1.5,\n "single_dim_scores": {"sun": {"MAE": 2.0}}}')
    write(tmp_path / "other/different.results.json", '{"MAE": 9}')
    write(tmp_path / ".hidden/.hidden.results.json", '{"MAE": 9}')
    rows = select_fields(scan_runs(spark, str(tmp_path)), ["MAE", "R2", "single_dim_scores__sun__MAE", "single_dim_scores__x__MAE"]).collect()
    assert [tuple(r) for r in rows] == [(run, 1.5, None, 2.0, None)]


def test_run_records_round_trip(spark, frame, tmp_path):
    records = frame([("r=1, a+b", 0.5), ("r2", 0.25)], "name string, R2 double")
    write_run_records(records, str(tmp_path / "runs"))
    rows = scan_runs(spark, str(tmp_path / "runs")).select("name", "R2").collect()
    assert sorted(tuple(r) for r in rows) == [("r2", 0.25), ("r=1, a+b", 0.5)]
    # a run written again is replaced, others stay; one name twice is refused
    write_run_records(frame([("r2", 0.75)], "name string, R2 double"), str(tmp_path / "runs"))
    rows = scan_runs(spark, str(tmp_path / "runs")).select("name", "R2").collect()
    assert sorted(tuple(r) for r in rows) == [("r2", 0.75), ("r=1, a+b", 0.5)]
    with pytest.raises(ValueError, match="several records"):
        write_run_records(frame([("x", 0.5), ("x", 0.25)], "name string, R2 double"), str(tmp_path / "runs"))
    # runs stored by hand stand beside them
    write(tmp_path / "runs/old/old.results.json", '{"R2": 0.1}')
    assert {r.name for r in scan_runs(spark, str(tmp_path / "runs")).collect()} == {"r2", "r=1, a+b", "old"}


def test_series_sink(spark, frame, tmp_path):
    df = frame([("a", "2024-01-01 00:00", 1.0), ("b", "2024-02-01 00:00", 2.0)], "installation string, timestamp timestamp, sol_prod double")
    write_series(df, str(tmp_path / "s"))
    back = spark.read.parquet(str(tmp_path / "s"))
    assert sorted((r.installation, r.sol_prod) for r in back.collect()) == [("a", 1.0), ("b", 2.0)]
    assert read_series(spark, str(tmp_path / "s"), ["installation", "sol_prod"]).columns == ["installation", "sol_prod"]
    write_csv(df, str(tmp_path / "c"))
    assert spark.read.csv(str(tmp_path / "c"), sep=";", header=True).count() == 2


def test_prediction_export(spark, frame):
    r = prediction_export(frame([("a", "2024-01-01", 1.23456)], "installation string, date date, pred double")).first()
    assert r.predicted == pytest.approx(1.235)


def test_codes_and_observations(spark, frame, tmp_path):
    write(tmp_path / "codes.csv", 'code_figure;code_name\n0;"Clear Sky"\n1;"Cloudy"\n')
    assert [(r.code_figure, r.code_name) for r in read_weather_codes(spark, str(tmp_path / "codes.csv")).collect()] == [(0, "Clear Sky"), (1, "Cloudy")]
    rows = frame(
        [("r", "d", "01", "p", "2024-01-01", float("nan"), 1.0)],
        "resolution string, dataset string, station_id string, parameter string, date timestamp, value double, quality double",
    )
    rows.write.parquet(str(tmp_path / "obs"))
    assert read_observations(spark, str(tmp_path / "obs")).first().value is None
    assert clear_nan(rows).first().value is None


def test_run_helpers(spark, frame, tmp_path):
    runs = frame([("a", "2024", "baseline-x", 0.1), ("b", "2025", "predict", 0.9)], "name string, timestamp string, model_purpose string, R2 double")
    assert [r.name for r in ranked(runs).collect()] == ["b", "a"] and [r.name for r in ranked(runs, False).collect()] == ["a", "b"]
    assert [r.name for r in baselines(runs, keep=False).collect()] == ["b"]
    assert run_at(runs, "2024").first().name == "a"
    with pytest.raises(ValueError):
        run_at(runs, "1999")
    assert runs.select(label_of("name", F.lit(2024)).alias("l")).first().l == "a 2024"
    write_importance(frame([("f", 0.5)], "feature string, importance_mean double"), str(tmp_path / "i"))
    assert spark.read.csv(str(tmp_path / "i"), sep=";", header=True).first().feature == "f"


def test_stored_reports(spark, frame, tmp_path):
    body = {
        "classification_report": {
            "a": {"precision": 0.5, "recall": 1.0, "f1-score": 0.25, "support": 2.0},
            "accuracy": 0.6,
            "macro avg": {"precision": 0.1, "recall": 0.2, "f1-score": 0.3, "support": 5.0},
        },
        "conf_matrix": {"C_0_0": 1},
    }
    write(tmp_path / "r1/r1.results.json", json.dumps(body))
    runs = scan_runs(spark, str(tmp_path))
    got = {r.label: (r.precision, r.recall, r.f1, r.support) for r in stored_reports(runs).collect()}
    assert got == {"a": (0.5, 1.0, 0.25, 2), "accuracy": (0.6, 0.6, 0.6, 5), "macro avg": (0.1, 0.2, 0.3, 5)}
    assert runs.first().conf_matrix == {"C_0_0": 1}


def test_classification_records_round_trip(spark, frame, tmp_path):
    df = frame([("r", t, p) for t, p in zip("aabbc", "abbba")], "run string, truth string, pred string")
    meta = {k: F.lit(k) for k in ("timestamp", "model_purpose", "model_class", "special_features")}
    record = classification_record(df, ["run"], ["a", "b", "c"], meta).withColumn("name", F.col("model_name"))
    write_run_records(record, str(tmp_path))
    runs = scan_runs(spark, str(tmp_path))
    text = {r.label: r for r in format_report(stored_reports(runs), ["name"]).collect()}
    assert (text["accuracy"].f1, text["accuracy"].support, text["weighted avg"].f1) == ("0.6", "5", "0.52")
    assert runs.first().bal_accuracy == 0.5

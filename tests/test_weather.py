"""Grids, fills, stations and coverage."""

import math
import random
from datetime import datetime, timedelta

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from heliotab.functions.scalars import rounded
from heliotab.operators import stations as station_module
from heliotab.operators.aggregate import period_features
from heliotab.operators.stations import (
    closest_station_ids,
    in_reading_range,
    nearest_stations,
    pivot_parameters,
    prefer_historical,
    station_list,
    station_priority,
    unknown_installations,
    wanted_stations,
)
from heliotab.operators.weather import (
    climatology_fill,
    enrich_weather,
    enriched_features,
    forward_fill,
    join_weather,
    regrid_10_to_15,
    regular_grid,
    require_weather_coverage,
    upsample_ffill,
)

OBS = "resolution string, dataset string, station_id string, parameter string, date timestamp, value double"


def test_upsample(spark, frame):
    df = frame(
        [("a", "2024-01-01 00:00", 1.0, 400.0), ("a", "2024-01-01 01:00", None, 800.0), ("a", "2024-01-01 02:00", 3.0, 1200.0)],
        "installation string, timestamp timestamp, x double, sunshine_duration double",
    )
    rows = upsample_ffill(df).orderBy("timestamp").collect()
    assert [r.x for r in rows] == [1.0] * 4 + [None] * 4 + [3.0]
    assert [r.sunshine_duration for r in rows] == [100.0] * 4 + [200.0] * 4 + [300.0]
    assert rows[-1].timestamp == datetime(2024, 1, 1, 2)


def test_upsample_spans_gaps_over_midnight(spark, frame):
    df = frame([("a", "2024-01-01 22:00", 1.0), ("a", "2024-01-03 01:00", 2.0), ("b", "2024-01-01 00:00", 9.0)], "installation string, timestamp timestamp, x double")
    counts = {(r.installation, r.x): r["count"] for r in upsample_ffill(df).groupBy("installation", "x").count().collect()}
    assert counts == {("a", 1.0): 27 * 4, ("a", 2.0): 1, ("b", 9.0): 1}


def test_enrich_equals_upsampled_join(spark, frame):
    start = datetime(2024, 1, 1)
    hours = [0, 1, 2, 5, 26, 27, 30]
    weather = frame(
        [("a", str(start + timedelta(hours=h)), float(h), 4.0 * h, f"d{h}") for h in hours]
        + [("b", str(start + timedelta(hours=1)), 7.0, 8.0, "x")],
        "installation string, timestamp timestamp, x double, sunshine_duration double, d string",
    )
    power = frame(
        [(i, str(start + timedelta(minutes=m)), float(m)) for i in "ab" for m in range(-30, 32 * 60, 5)],
        "installation string, timestamp timestamp, p double",
    )
    fast = enrich_weather(power, weather, validate=False).select("installation", "timestamp", "p", "x", "sunshine_duration", "d")
    plain = join_weather(power, upsample_ffill(weather)).select(*fast.columns)
    key = lambda r: (r.installation, r.timestamp)
    assert sorted(fast.collect(), key=key) == sorted(plain.collect(), key=key)
    assert fast.filter("x is not null").count() > 100


@pytest.mark.parametrize("horizon", ["daily", "hourly"])
def test_enriched_features_equal_the_joined_ones(spark, frame, horizon):
    rng = random.Random(5)
    start = datetime(2024, 1, 1)
    kinds = ["Rain", " rain", "Clear Sky", None]

    def some(v):
        return None if rng.random() < 0.2 else v

    times = [0, 60, 120, 300, 330, 1200, 1260, 1267, 1320, 3000, 3060]
    weather = frame(
        [
            (i, str(start + timedelta(minutes=m)), some(rng.random()), some(rng.random()), some(1.0), rng.choice(kinds))
            for i in "ab"
            for m in times
        ],
        "installation string, timestamp timestamp, sunshine_duration double, cloud_cover double, is_day double, weather_description string",
    )
    power = frame(
        [(i, str(start + timedelta(minutes=m)), some(float(m))) for i in "abc" for m in [*range(-60, 3100, 15), *range(0, 1500, 7), 15, 15]],
        "installation string, timestamp timestamp, sol_prod double",
    )
    joined = period_features(enrich_weather(power, weather, validate=False), horizon, categories=["rain", "cloudy"])
    direct = enriched_features(power, weather, horizon, categories=["rain", "cloudy"], validate=False)
    assert sorted(direct.columns) == sorted(joined.columns)

    def rows(df):
        cells = df.select(*sorted(joined.columns)).collect()
        return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in cells), key=repr)

    assert rows(direct) == rows(joined) and direct.count() >= 9


def test_coverage_errors(spark, frame):
    ddl = "installation string, timestamp timestamp"
    power = frame([("a", "2024-01-01 00:00"), ("a", "2024-01-02 00:00"), ("b", "2024-01-01 00:00")], ddl)
    late = frame([("a", "2024-01-01 01:00"), ("a", "2024-01-03 00:00")], ddl)
    with pytest.raises(ValueError, match="a: weather starts late"):
        require_weather_coverage(power, late)
    with pytest.raises(ValueError, match="b: no weather"):
        require_weather_coverage(power, frame([("a", "2024-01-01 00:00"), ("a", "2024-01-03 00:00")], ddl))


def test_regular_grid(spark, frame):
    df = frame([("a", "2024-01-01 23:50", 1.0), ("a", "2024-01-03 00:10", 2.0)], "installation string, date timestamp, x double")
    rows = regular_grid(df).orderBy("date").collect()
    assert len(rows) == 147 and rows[0].x == 1.0 and rows[-1].x == 2.0 and rows[1].x is None
    assert all(b.date - a.date == timedelta(minutes=10) for a, b in zip(rows, rows[1:]))


def test_climatology_fill(spark, frame):
    df = frame([("a", f"{y}-06-01 12:00", v) for y, v in ((2021, 2.0), (2022, None), (2023, 4.0))], "installation string, date timestamp, x double")
    assert [r.x for r in climatology_fill(df, ["x"]).orderBy("date").collect()] == [2.0, 3.0, 4.0]


def test_forward_fill_crosses_days(spark, frame):
    values = [("2024-01-01 00:00", None), ("2024-01-01 05:00", 1.0), ("2024-01-02 00:00", None), ("2024-01-04 00:00", None), ("2024-01-04 01:00", 2.0), ("2024-01-05 00:00", None)]
    df = frame([("a", t, v) for t, v in values], "installation string, date timestamp, x double")
    assert [r.x for r in forward_fill(df, ["x"], "date", ["installation"]).orderBy("date").collect()] == [None, 1.0, 1.0, 1.0, 2.0, 2.0]


def test_regrid_keeps_sums(spark, frame):
    df = frame([("a", f"2024-01-01 00:{m:02d}", v) for m, v in ((0, 6.0), (10, 12.0), (20, 18.0))], "installation string, date timestamp, x double")
    assert [r.x for r in regrid_10_to_15(df, ["x"]).orderBy("timestamp").collect()] == [12.0, 24.0]


def test_prefer_historical(spark, frame):
    def obs(*rows):
        return frame([("r", "d", s, "p", t, v) for s, t, v in rows], OBS)

    out = prefer_historical(obs(("1", "2024-01-01", 5.0)), obs(("1", "2024-01-01", 7.0), ("2", "2024-01-01", 9.0)))
    assert sorted((r.station_id, r.value) for r in out.collect()) == [("1", 5.0), ("2", 9.0)]


def test_station_priority_null_blocks(spark, frame):
    df = frame(
        [("i", "r", "d", "p", "2024-01-01", 0, None), ("i", "r", "d", "p", "2024-01-01", 1, 4.0), ("i", "r", "d", "p", "2024-01-02", 1, 6.0)],
        "installation string, resolution string, dataset string, parameter string, date timestamp, station_rank int, value double",
    )
    assert [r.value for r in station_priority(df).orderBy("date").collect()] == [None, 6.0]


def test_pivot_rejects_duplicates(spark, frame):
    df = frame([("i", "2024-01-01", "p", 1.0), ("i", "2024-01-01", "q", 2.0)], "installation string, date timestamp, parameter string, value double")
    r = pivot_parameters(df, ["p", "q"]).first()
    assert (r.p, r.q) == (1.0, 2.0)
    with pytest.raises(Exception, match="more than one value of p"):
        pivot_parameters(df.unionAll(df), ["p", "q"]).collect()


def test_station_list(spark, frame):
    sites = frame([("a", "01| 02")], "installation string, closest_weather_station_ids string")
    assert [(r.station_rank, r.station_id) for r in station_list(sites).collect()] == [(0, "01"), (1, "02")]
    with pytest.raises(Exception, match="no weather station"):
        station_list(frame([("a", "")], "installation string, closest_weather_station_ids string")).collect()


def test_nearest_stations(spark, frame):
    sites = frame([("a", 52.52, 13.405)], "installation string, latitude double, longitude double")
    stations = frame([("s1", 52.39, 13.06), ("s2", 53.55, 9.99)], "station_id string, latitude double, longitude double")
    rows = nearest_stations(sites, stations).collect()
    assert [r.station_id for r in rows] == ["s1"] and rows[0].distance == pytest.approx(27, abs=1)
    assert closest_station_ids(nearest_stations(sites, stations)).first().closest_weather_station_ids == "s1"


def test_nearest_stations_far_north_and_date_line(spark, frame):
    sites = [("fiji", -17.0, 179.9), ("north", 85.0, 10.0), ("pole", 89.9, -170.0), ("eq", 0.0, 0.0)]
    stations = [(f"s{i}", lat, lon) for i, (lat, lon) in enumerate([(-17.0, -179.9), (85.1, 14.0), (89.95, 10.0), (0.3, 0.3), (0.0, 0.46), (-16.7, 179.7), (85.0, 4.0)])]
    got = {
        (r.installation, r.station_id)
        for r in nearest_stations(
            frame(sites, "installation string, latitude double, longitude double"), frame(stations, "station_id string, latitude double, longitude double")
        ).collect()
    }

    def km(a, b, c, d):
        a, b, c, d = map(math.radians, (a, b, c, d))
        h = math.sin((c - a) / 2) ** 2 + math.cos(a) * math.cos(c) * math.sin((d - b) / 2) ** 2
        return 2 * 6371 * math.asin(math.sqrt(h))

    assert got == {(s[0], t[0]) for s in sites for t in stations if km(s[1], s[2], t[1], t[2]) <= 50}
    assert ("fiji", "s0") in got and ("pole", "s2") in got


def test_nearest_stations_many_sites_repeated_and_moved(spark, frame, monkeypatch):
    """Small blocks and batches; an installation with two rows, in one cell and in several; null ids; equal distances."""
    monkeypatch.setattr(station_module, "PAIRS", 50)
    monkeypatch.setattr(station_module, "BLOCK_PAIRS", 200)
    monkeypatch.setattr(station_module, "ROWS", 7)
    rng = random.Random(4)
    sites = [(f"i{n}", 50 + rng.random(), 8 + rng.random()) for n in range(120)]
    sites += [("i3", 50.4, 8.4), ("i3", 50.4, 8.4), ("i5", 10.0, 8.0), (None, 50.5, 8.5), (None, 50.5, 8.6), ("none", None, 8.0), ("far", 0.0, 0.0)]
    stations = [(f"s{n}", 50 + rng.random(), 8 + rng.random()) for n in range(30)]
    stations += [("b", 50.5, 8.5), ("a", 50.5, 8.5), ("a", 50.5, 8.5), (None, 50.6, 8.5), ("z", 10.1, 8.0), ("n", None, None)]
    near = nearest_stations(
        frame(sites, "installation string, latitude double, longitude double"),
        frame(stations, "station_id string, latitude double, longitude double"),
    )

    def km(a, b, c, d):
        a, b, c, d = map(math.radians, (a, b, c, d))
        h = math.sin((c - a) / 2) ** 2 + math.cos(a) * math.cos(c) * math.sin((d - b) / 2) ** 2
        return 2 * 6371 * math.asin(math.sqrt(h))

    want = {}
    for i, a, b in sites:
        for s, c, d in stations:
            if None not in (a, c) and km(a, b, c, d) <= 50:
                want.setdefault(i, []).append((round(km(a, b, c, d), 9), s is not None, s or ""))
    got = {}
    for r in near.orderBy("station_rank").collect():
        own = got.setdefault(r.installation, [])
        own.append((round(r.distance, 9), r.station_id is not None, r.station_id or ""))
        assert r.station_rank == len(own)
    assert got == {i: sorted(v) for i, v in want.items()}
    lists = nearest_stations(
        frame(sites, "installation string, latitude double, longitude double"),
        frame(stations, "station_id string, latitude double, longitude double"),
        listed=True,
    )
    texts = {r.installation: r.closest_weather_station_ids for r in closest_station_ids(lists).collect()}
    assert texts == {r.installation: r.closest_weather_station_ids for r in closest_station_ids(near).collect()}
    assert texts["i3"] == "|".join(s for _, known, s in sorted(want["i3"]) if known)
    assert "z" in texts["i5"].split("|")


def test_pairs_of_sites_and_stations_are_never_shuffled(spark, frame):
    sites = frame([("a", 52.52, 13.405)], "installation string, latitude double, longitude double")
    stations = frame([("s1", 52.39, 13.06)], "station_id string, latitude double, longitude double")
    for df in (nearest_stations(sites, stations), closest_station_ids(nearest_stations(sites, stations, listed=True))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan[: plan.index("MapInArrow")] and "Window" not in plan


@pytest.mark.parametrize("rows", [5, 1000])
def test_an_installation_crosses_from_python_as_lists_not_as_pairs(rows):
    stations = pa.record_batch({"_block": [1] * 30, "_site": [False] * 30, "installation": pa.nulls(30, pa.string()), "station_id": [f"s{n:02d}" for n in range(30)], "latitude": [50 + n / 1000 for n in range(30)], "longitude": [8.0] * 30})
    sites = pa.record_batch({"_block": [1] * 4, "_site": [True] * 4, "installation": list("abcd"), "station_id": pa.nulls(4, pa.string()), "latitude": [50.0, 50.0145, 50.029, 60.0], "longitude": [8.0] * 4})
    sent = [r for b in station_module._rank_blocks(50.0, False, 40, rows)(iter([stations, sites])) for r in b.to_pylist()]
    assert len(sent) == 3 * -(-30 // rows)
    got = {}
    for r in sent:
        own = got.setdefault(r["installation"], [])
        assert r["before"] == len(own) and len(r["station_ids"]) == len(r["distances"]) <= rows
        own += zip(r["distances"], r["station_ids"])
    assert sorted(got) == ["a", "b", "c"] and all(len(own) == 30 and own == sorted(own) for own in got.values())
    assert [s for _, s in got["c"]] == [f"s{n:02d}" for n in reversed(range(30))]


@pytest.mark.parametrize("one_by_one", [1, 10**9])
@pytest.mark.parametrize("ordered", [True, False])
def test_by_distance_is_exact(monkeypatch, one_by_one, ordered):
    """Equal distances, distances a few units in the last place apart, and any others; as a sort by three columns."""
    monkeypatch.setattr(station_module, "ONE_BY_ONE", one_by_one)
    rng = np.random.default_rng(3)
    for most, longest in ((50.0, 3), (50.0, 400), (20037.0, 90), (0.0, 20)):
        size = rng.integers(1, longest, 60)
        group = np.repeat(np.arange(len(size)), size)
        distance = rng.choice([0.0, most / 7, most / 3, most], len(group))
        near = rng.random(len(group)) < 0.7
        for _ in range(3):
            distance = np.where(near & (rng.random(len(group)) < 0.5) & (distance > 0), np.nextafter(distance, 0), distance)
        distance = np.where(rng.random(len(group)) < 0.3, rng.random(len(group)) * most, distance)
        t = rng.integers(0, 50, len(group))
        if ordered:
            t = t[np.lexsort((t, group))]
        want = np.lexsort((t, distance, group))
        got_t, got_distance = station_module._by_distance(size, t, distance, most, ordered)
        assert got_t.tolist() == t[want].tolist() and got_distance.tolist() == distance[want].tolist()


def test_rounded_is_round(spark):
    values = [0.0, -0.0, 1.5, 0.0000005, 1.0000005, 2.0000015, -0.0000005, 12.3456785, 12.34567849999, 1e300, -1e300, 49.9999995, math.nan, math.inf, None]
    rng = random.Random(1)
    values += [rng.uniform(-50, 50) for _ in range(500)] + [rng.randrange(10**8) / 1e7 for _ in range(500)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    different = df.filter(~(rounded("x", 6) + 0.0).eqNullSafe(F.round("x", 6) + 0.0)).collect()
    assert different == []


def test_unknown_installations(spark, frame):
    readings, sites = frame([("a",), ("b",), ("b",)], "installation string"), frame([("a",)], "installation string")
    assert [r.installation for r in unknown_installations(readings, sites).collect()] == ["b"]


def test_regrid_total_is_kept_on_gappy_input(spark, frame):
    rows = [("a", str(datetime(2024, 1, 1) + timedelta(minutes=10 * i)), float(i)) for i in range(300)]
    df = frame(rows, "installation string, date timestamp, x double")
    assert regrid_10_to_15(df, ["x"]).agg(F.sum("x")).first()[0] == sum(range(300))


def test_observations_stay_in_the_range_of_each_installation(spark, frame):
    readings = frame(
        [("a", "2024-01-02"), ("a", "2024-01-04"), ("b", "2024-01-04"), ("b", "2024-01-06")],
        "installation string, timestamp timestamp",
    )
    listed = station_list(frame([("a", "1|2"), ("b", "2")], "installation string, closest_weather_station_ids string"))
    obs = frame([("r", "d", s, "p", f"2024-01-0{d}", float(d)) for s in "123" for d in range(1, 8)], OBS)
    got = {(r.installation, r.station_id, r.date.day) for r in in_reading_range(obs, wanted_stations(readings, listed)).collect()}
    assert got == {("a", s, d) for s in "12" for d in (2, 3, 4)} | {("b", "2", d) for d in (4, 5, 6)}


def test_a_measure_on_both_sides_stays_the_readings_own(frame):
    power = frame([("a", "2024-01-01 00:15", 1.0, 7.0)], "installation string, timestamp timestamp, sol_prod double, sunshine_duration double")
    weather = frame(
        [("a", "2024-01-01 00:00", 400.0, 0.5), ("a", "2024-01-01 01:00", 800.0, 0.5)],
        "installation string, timestamp timestamp, sunshine_duration double, cloud_cover double",
    )
    joined = enrich_weather(power, weather, validate=False)
    assert joined.columns == ["installation", "timestamp", "sol_prod", "sunshine_duration", "cloud_cover"]
    assert (joined.first().sunshine_duration, joined.first().cloud_cover) == (7.0, 0.5)
    features = enriched_features(power, weather, categories=[], validate=False).first()
    assert (features.sunshine_duration, features.cloud_cover) == (7.0, 0.5)
    with pytest.raises(ValueError, match="cloud_cover"):
        enriched_features(power.withColumn("cloud_cover", F.lit(1.0)), weather, categories=[], validate=False)

"""Casting, normalising, time zones, calendar parts, features."""

import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from heliotab.functions.cyclic import day_of_year_angle, periodic
from heliotab.functions.scalars import to_number
from heliotab.functions.timeparts import parse_event_date, with_calendar
from heliotab.operators.aggregate import discover_categories, one_hot, period_features, weather_share
from heliotab.operators.clean import coerce_numeric, normalize_peak, recover_total, strict_numeric, sum_trackers, with_residuals
from heliotab.operators.features import label_codes, minmax_apply, minmax_fit, missing_flags, threshold_categories
from heliotab.operators.zones import to_utc


def utc(spark, frame, rows, **kw):
    df = frame(rows, "n int, installation string, timestamp string, timezone string")
    out = to_utc(df, order=("n",), **kw).orderBy("n").collect()
    return [r.timestamp for r in out]


def at(text):
    return datetime.fromisoformat(text)


def test_fixed_offsets(spark, frame):
    t = "2024-07-01 12:00"
    got = utc(spark, frame, [(1, "a", t, "utc+1"), (2, "a", t, "UTC-3"), (3, "a", t, "utc")])
    assert got == [at("2024-07-01 11:00"), at("2024-07-01 15:00"), at("2024-07-01 12:00")]


def test_aware_text_ignores_zone(spark, frame):
    assert utc(spark, frame, [(1, "a", "2024-07-01 12:00+02:00", "Asia/Tokyo")]) == [at("2024-07-01 10:00")]


def test_skipped_hour_moves_to_the_change(spark, frame):
    z = "Europe/Berlin"
    rows = [(1, "a", "2024-03-31 01:30", z), (2, "a", "2024-03-31 02:30", z), (3, "a", "2024-03-31 03:30", z)]
    assert utc(spark, frame, rows) == [at("2024-03-31 00:30"), at("2024-03-31 01:00"), at("2024-03-31 01:30")]


def test_repeated_hour_follows_file_order(spark, frame):
    z = "Europe/Berlin"
    rows = [(i, "a", f"2024-10-27 {h}", z) for i, h in enumerate(["01:30", "02:30", "02:30", "03:30"])]
    assert utc(spark, frame, rows) == [
        at("2024-10-26 23:30"),
        at("2024-10-27 00:30"),
        at("2024-10-27 01:30"),
        at("2024-10-27 02:30"),
    ]


def test_repeated_hour_seen_once_is_marked(spark, frame):
    z = "Europe/Berlin"
    rows = [(1, "a", "2024-10-27 02:30", z), (2, "b", "2024-10-27 02:30", z), (3, "b", "2024-10-27 02:30", z), (4, "a", "2024-10-27 05:00", z)]
    out = to_utc(frame(rows, "n int, installation string, timestamp string, timezone string"), order=("n",), flag="unsure")
    assert [(r.timestamp.hour, r.unsure) for r in out.orderBy("n").collect()] == [(0, True), (0, False), (1, False), (4, False)]


def test_half_hour_change(spark, frame):
    z = "Australia/Lord_Howe"
    rows = [(1, "a", "2024-10-06 02:15", z), (2, "a", "2024-04-07 01:45", z), (3, "a", "2024-04-07 01:45", z)]
    assert utc(spark, frame, rows) == [at("2024-10-05 15:30"), at("2024-04-06 14:45"), at("2024-04-06 15:15")]


def test_missing_zone_fails(spark, frame):
    with pytest.raises(Exception, match="time zone"):
        utc(spark, frame, [(1, "a", "2024-07-01 12:00", "")])


def test_peak_normalisation(spark, frame):
    raw = frame([("a", "1250", "87"), ("a", "abc", None), ("a", None, "1,5")], "installation string, sol_prod string, soc string")
    sites = frame([("a", 5000)], "installation string, Wp int")
    out = raw.transform(coerce_numeric, ["sol_prod", "soc"]).transform(normalize_peak, sites)
    got = sorted(((r.sol_prod, r.soc) for r in out.collect()), key=repr)
    assert got == sorted([(0.25, 0.87), (None, None), (None, None)], key=repr)


def test_unknown_installation_fails(spark, frame):
    raw, sites = frame([("b", 1.0)], "installation string, sol_prod double"), frame([("a", 5000)], "installation string, Wp int")
    with pytest.raises(Exception, match="no metadata"):
        normalize_peak(raw, sites).collect()


def test_strict_numeric_fails(spark, frame):
    with pytest.raises(Exception):
        strict_numeric(frame([("abc",)], "x string"), ["x"]).collect()


@pytest.mark.parametrize("text, number", [("NaN", None), ("5d", None), ("5.f ", None), (" 5 ", 5.0), ("1e3", 1000.0), ("inf", math.inf), ("", None)])
def test_number_text(spark, text, number):
    assert spark.range(1).select(to_number(F.lit(text)).alias("x")).first().x == number


def test_totals(spark, frame):
    df = frame([(1, None, 1.0, 2.0), (2, None, 1.0, None), (3, 5.0, 1.0, 2.0)], "n int, sol_prod double, sol_prod_1 double, sol_prod_2 double")
    assert [r.sol_prod for r in recover_total(df).orderBy("n").collect()] == [3.0, None, 5.0]
    assert [r.sol_prod for r in sum_trackers(df).orderBy("n").collect()] == [3.0, 1.0, 3.0]


def test_residuals(spark, frame):
    out = with_residuals(frame([(2.0, 3.0), (0.0, 1.0)], "y double, pred double")).collect()
    assert [(r.diff, r.ratio) for r in out] == [(1.0, 1.5), (1.0, None)]


def test_calendar(spark, frame):
    r = with_calendar(frame([("2024-12-30 05:15:00",)], "timestamp timestamp")).first()
    assert (r.year, r.week, r.day_of_week, r.day_of_year, r.hour, r.minute) == (2024, 1, 0, 365, 5, 15)


def test_event_date(spark):
    r = spark.range(1).select(parse_event_date(F.lit("March 20, 2021 at 10:37 AM GMT+1")).alias("d")).first()
    assert r.d == at("2021-03-20 09:37:00")


def test_day_of_year_angle(spark, frame):
    df = frame([("2022-01-01",), ("2022-06-30",), ("2024-12-31",)], "date date")
    got = [r.s for r in df.select(day_of_year_angle("date", "sin").alias("s")).collect()]
    assert got == pytest.approx([0.0172134, 0.0258184, 0.0], abs=1e-6)


def test_periodic(spark):
    r = spark.range(1).select(periodic(F.lit(6), 24, "sin").alias("s"), periodic(F.lit(6), 24, "cos").alias("c")).first()
    assert (r.s, r.c) == pytest.approx((1, 0), abs=1e-12)
    for bad in ({"period": 0}, {"period": 24, "kind": "tan"}):
        with pytest.raises(ValueError):
            periodic(F.lit(6), **bad)


def test_threshold_categories(spark, frame):
    df = frame([(i, v) for i, v in enumerate([5.0, 10.0, 19.9, 20.0, None])], "n int, x double")
    got = [r.x_cat for r in threshold_categories(df, ["x"], [20, 10]).orderBy("n").collect()]
    assert got == ["<10", "[10-20)", "[10-20)", "20+", "NA"]
    with pytest.raises(ValueError):
        threshold_categories(df, ["x"], [[1], 2])
    with pytest.raises(ValueError):
        threshold_categories(df, ["x"], [[1], [2]])


def test_minmax(spark, frame):
    train = frame([("a", 0.0, 7.0), ("a", 10.0, 7.0)], "installation string, x double, c double")
    test = frame([("a", -5.0, 7.0), ("a", 20.0, 7.0)], "installation string, x double, c double")
    out = minmax_apply(test, minmax_fit(train, ["x", "c"]), ["x", "c"]).collect()
    assert sorted((r.x, r.c) for r in out) == [(-0.5, 0.0), (2.0, 0.0)]
    fleet = minmax_apply(test, minmax_fit(train, ["x"], ()), ["x"], ()).collect()
    assert sorted(r.x for r in fleet) == [-0.5, 2.0]


def test_flags_and_codes(spark, frame):
    df = frame([("b",), ("a",), (None,)], "x string")
    assert [r.x_isna for r in missing_flags(df, ["x"]).collect()] == [False, False, True]
    assert {r.x: r.c for r in label_codes(df.dropna(), "x", "c").collect()} == {"a": 0, "b": 1}


def test_one_hot_and_shares(spark, frame):
    df = frame([("a", "Rain"), ("a", " rain "), ("a", "Fog"), ("a", None)], "installation string, weather_description string")
    out = one_hot(df, categories=["Rain", "cloudy"])
    assert out.columns == ["installation", "weather_description", "rain", "cloudy"]
    share = weather_share(df, ["installation"], categories=["rain", "cloudy"]).first()
    assert (share.rain, share.cloudy) == (0.5, 0.0)
    assert discover_categories(df) == ["fog", "rain"]
    assert len(discover_categories(spark.range(1001).selectExpr("cast(id as string) as weather_description"))) == 1001


def test_period_features_nulls(spark, frame):
    df = frame(
        [("a", "2024-01-01 10:00", None, None, None), ("a", "2024-01-01 11:00", None, None, "Rain")],
        "installation string, timestamp timestamp, sol_prod double, cloud_cover double, weather_description string",
    )
    r = period_features(df, categories=["rain"]).first()
    assert (r.sol_prod, r.cloud_cover, r.rain) == (0.0, None, 0.5)
    assert period_features(df, "hourly").count() == 2
    assert "cloud_cover" not in period_features(df, exclude=("cloud_cover",)).columns
    with pytest.raises(ValueError):
        period_features(df, "weekly")


def test_angle_is_finite(spark):
    assert math.isfinite(spark.range(1).select(periodic(F.lit(3), 12).alias("x")).first().x)

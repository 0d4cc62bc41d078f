"""Ingest, casting, time zones, calendar parts and row-wise features."""

from pyspark.sql import functions as F

from ..functions.cyclic import with_doy_trig, with_doy_trig_366, with_periodic
from ..functions.timeparts import is_quarter_mark, parse_event_date, with_calendar
from ..operators.aggregate import one_hot
from ..operators.clean import (
    coerce_numeric,
    describe_codes,
    events_on_series_days,
    label_of,
    normalize_peak,
    recover_total,
    recoverable_rows,
    sum_trackers,
    with_residuals,
)
from ..operators.features import label_codes, missing_flags, threshold_categories
from ..operators.stations import unknown_installations
from ..operators.zones import to_utc as text_to_utc
from ..session import scratch_dir
from ..sources.power_files import SITE_SCHEMA, ingest_power as ingest
from ..sources.sinks import prediction_export
from .registry import query
from .stand_ins import DAILY_LONG, EVENT_TYPES, PREDICTIONS, READINGS, daily_long, predictions, readings, table

SITE_ROWS = [
    ("inst_0", 5000, "", "", "", 52.5, 13.4),
    ("inst_1", 8000, "", "", "utc+1", 48.1, 11.6),
    ("inst_2", 10000, "", "", "Europe/Berlin", 53.6, 10.0),
    ("inst_3", 4000, "", "", "utc", 50.9, 6.9),
]


def site_rows(spark):
    """Metadata of the four stand-in installations."""
    return spark.createDataFrame(SITE_ROWS, SITE_SCHEMA)


PEAKS = """peaks(installation, wp) AS (VALUES ('inst_0', 5000.0::DOUBLE), ('inst_1', 8000.0::DOUBLE),
  ('inst_2', 10000.0::DOUBLE), ('inst_3', 4000.0::DOUBLE))"""

RAW_TEXT = """raw_text AS (
  SELECT event_id, installation, "timestamp", CASE WHEN k % 17 = 0 THEN 'abc' ELSE CAST(k AS VARCHAR) END AS soc_text,
         CASE WHEN user_id % 11 = 0 THEN NULL ELSE CAST(event_id % 4000 AS VARCHAR) END AS prod_text,
         CASE WHEN k % 5 = 0 THEN '1,5' ELSE ' ' || CAST(k AS VARCHAR) || 'e2' END AS cons_text FROM readings)"""


def raw_text(spark, sf_dir):
    """Readings as untyped text with malformed entries by rule."""
    k, e = F.col("k"), F.col("event_id")
    return readings(spark, sf_dir).select(
        "event_id",
        "installation",
        "timestamp",
        F.when(k % 17 == 0, "abc").otherwise(k.cast("string")).alias("soc_text"),
        F.when(F.col("user_id") % 11 != 0, (e % 4000).cast("string")).alias("prod_text"),
        F.when(k % 5 == 0, "1,5").otherwise(F.concat(F.lit(" "), k.cast("string"), F.lit("e2"))).alias("cons_text"),
    )


def land_power_files(spark, sf_dir):
    """Write the readings as exports: one folder per installation, two different headers."""
    root = scratch_dir(spark, "power")
    raw = raw_text(spark, sf_dir)
    second = F.date_trunc("second", F.col("timestamp"))
    for i, (name, *_) in enumerate(SITE_ROWS):
        hours = {"inst_0": 2, "inst_1": 1, "inst_2": 1, "inst_3": 0}[name]
        local = F.date_format(second + F.make_interval(hours=F.lit(hours)), "yyyy-MM-dd HH:mm:ss")
        stamp = F.concat(local, F.lit("+02:00")) if name == "inst_0" else local
        cols = [
            stamp.alias("timestamp"),
            F.col("soc_text").alias("Ladezustand"),
            F.col("prod_text").alias("Solarproduktion"),
            F.col("event_id").cast("string").alias("reading_no"),
        ]
        if i % 2:
            cols = [cols[3], cols[2], F.col("cons_text").alias("Σ Verbrauch"), cols[0], cols[1]]
        raw.filter(F.col("installation") == name).select(*cols).write.csv(f"{root}/{name}", sep=";", header=True)
    return root


@query(
    "ingest_power",
    f"""WITH {READINGS}, {RAW_TEXT}, {PEAKS}
    SELECT installation, date_trunc('second', "timestamp") AS "timestamp", event_id AS reading_no,
           round(TRY_CAST(soc_text AS DOUBLE) / 100, 6) AS soc, round(TRY_CAST(prod_text AS DOUBLE) / wp, 6) AS sol_prod,
           CASE WHEN installation IN ('inst_1', 'inst_3') THEN round(TRY_CAST(trim(cons_text) AS DOUBLE) / wp, 6) END AS tot_cons,
           CAST(NULL AS DOUBLE) AS wb_tot_charge
    FROM raw_text JOIN peaks USING (installation)""",
    digits=6,
)
def ingest_power(spark, sf_dir):
    power = ingest(spark, land_power_files(spark, sf_dir), site_rows(spark))
    return power.select(
        "installation",
        "timestamp",
        F.col("reading_no").cast("bigint").alias("reading_no"),
        "soc",
        "sol_prod",
        "tot_cons",
        "wb_tot_charge",
    )


@query(
    "coerce_numeric",
    f"""WITH {READINGS}, {RAW_TEXT} SELECT event_id, TRY_CAST(soc_text AS DOUBLE) AS soc_text,
        TRY_CAST(prod_text AS DOUBLE) AS prod_text, TRY_CAST(trim(cons_text) AS DOUBLE) AS cons_text FROM raw_text""",
)
def coerce(spark, sf_dir):
    cols = ["soc_text", "prod_text", "cons_text"]
    return raw_text(spark, sf_dir).select("event_id", *cols).transform(coerce_numeric, cols)


@query(
    "normalize_peak",
    f"""WITH {READINGS}, {PEAKS} SELECT event_id, installation, round(sol_prod / wp, 10) AS sol_prod,
        round(sol_prod_1 / wp, 10) AS sol_prod_1, round(sol_prod_2 / wp, 10) AS sol_prod_2, round(k / 100.0::DOUBLE, 10) AS soc
        FROM readings JOIN peaks USING (installation)""",
    digits=10,
)
def normalize(spark, sf_dir):
    r = readings(spark, sf_dir).withColumn("soc", F.col("k").cast("double"))
    return normalize_peak(r.select("event_id", "installation", "sol_prod", "sol_prod_1", "sol_prod_2", "soc"), site_rows(spark))


@query(
    "recover_sol_prod",
    f"""WITH {READINGS} SELECT event_id, round(coalesce(sol_prod, sol_prod_1 + sol_prod_2), 4) AS sol_prod FROM readings""",
)
def recover(spark, sf_dir):
    return readings(spark, sf_dir).transform(recover_total).select("event_id", "sol_prod")


@query(
    "sum_trackers",
    f"""WITH {READINGS} SELECT event_id, round(coalesce(sol_prod_1, 0) + coalesce(sol_prod_2, 0), 4) AS sol_prod FROM readings""",
)
def trackers(spark, sf_dir):
    return readings(spark, sf_dir).transform(sum_trackers).select("event_id", "sol_prod")


@query(
    "recoverable_rows",
    f"""WITH {READINGS} SELECT event_id, installation, round(sol_prod_1, 4) AS sol_prod_1 FROM readings
        WHERE sol_prod IS NULL AND sol_prod_1 IS NOT NULL AND sol_prod_1 > 0""",
)
def recoverable(spark, sf_dir):
    return readings(spark, sf_dir).transform(recoverable_rows).select("event_id", "installation", "sol_prod_1")


@query(
    "code_lookup",
    f"""WITH {READINGS} SELECT event_id, coalesce(n_name, 'Unknown') AS weather_description
        FROM readings LEFT JOIN nation ON n_nationkey = k""",
)
def code_lookup(spark, sf_dir):
    codes = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("code_figure"), F.col("n_name").alias("code_name")
    )
    r = readings(spark, sf_dir).select("event_id", F.col("k").cast("double").alias("weather_code"))
    return describe_codes(r, codes).select("event_id", "weather_description")


@query(
    "residuals",
    f"""WITH {PREDICTIONS} SELECT o_orderkey, round(pred - y, 2) AS diff, CASE WHEN y > 0 THEN round(pred / y, 6) END AS ratio
        FROM predictions""",
    diff=2,
    ratio=6,
)
def residuals(spark, sf_dir):
    """Truth and prediction come from different tables and meet on the key, never by position."""
    p = predictions(spark, sf_dir)
    truth, pred = p.select("o_orderkey", "y"), p.select("o_orderkey", "pred")
    return truth.join(pred, "o_orderkey").transform(with_residuals).select("o_orderkey", "diff", "ratio")


@query(
    "quarter_marks",
    f"""WITH {DAILY_LONG} SELECT o_orderkey, "timestamp" FROM daily_long
        WHERE day("timestamp") = 1 AND month("timestamp") % 3 = 0""",
)
def quarter_marks(spark, sf_dir):
    return daily_long(spark, sf_dir).filter(is_quarter_mark("timestamp", hourly=True)).select("o_orderkey", "timestamp")


LOCAL_TEXT = """local_text AS (
  SELECT o_orderkey, o_custkey % 4 AS zone_no, 'inst_' || CAST(o_custkey % 4 AS VARCHAR) AS installation,
         o_orderdate + to_hours(CAST(o_orderkey % 4 AS INTEGER)) + INTERVAL 30 MINUTE AS wall FROM orders)"""


@query(
    "to_utc",
    f"""WITH {LOCAL_TEXT}, spring AS (
      SELECT *, make_timestamp(year(wall), 3, 31, 0, 0, 0.0) AS m31,
        CASE WHEN year(wall) = 1995 THEN make_timestamp(1995, 9, 30, 0, 0, 0.0)
             ELSE make_timestamp(year(wall), 10, 31, 0, 0, 0.0) END AS o31 FROM local_text),
    sundays AS (SELECT *, m31 - to_days(CAST(dayofweek(m31) AS INTEGER)) AS summer, o31 - to_days(CAST(dayofweek(o31) AS INTEGER)) AS winter,
        row_number() OVER (PARTITION BY installation, wall ORDER BY o_orderkey) AS rn FROM spring)
    SELECT o_orderkey, CASE
        WHEN zone_no = 0 THEN wall - INTERVAL 2 HOUR
        WHEN zone_no = 1 THEN wall + INTERVAL 3 HOUR
        WHEN zone_no = 2 THEN wall
        WHEN wall >= summer + INTERVAL 2 HOUR AND wall < summer + INTERVAL 3 HOUR THEN summer + INTERVAL 1 HOUR
        WHEN wall >= summer + INTERVAL 3 HOUR AND wall < winter + INTERVAL 2 HOUR THEN wall - INTERVAL 2 HOUR
        WHEN wall >= winter + INTERVAL 2 HOUR AND wall < winter + INTERVAL 3 HOUR AND rn = 1 THEN wall - INTERVAL 2 HOUR
        ELSE wall - INTERVAL 1 HOUR END AS "timestamp" FROM sundays""",
)
def to_utc(spark, sf_dir):
    """Offsets, fixed zones, and a zone with both daylight-saving changes, repeats in key order."""
    zone_no = F.col("o_custkey") % 4
    wall = F.date_format(
        F.col("o_orderdate").cast("timestamp") + F.make_interval(hours=(F.col("o_orderkey") % 4).cast("int"), mins=F.lit(30)),
        "yyyy-MM-dd HH:mm:ss",
    )
    texts = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.concat(F.lit("inst_"), zone_no.cast("string")).alias("installation"),
        F.when(zone_no == 0, F.concat(wall, F.lit("+02:00"))).otherwise(wall).alias("timestamp"),
        F.array(F.lit(""), F.lit("UTC-3"), F.lit("utc"), F.lit("Europe/Berlin"))[zone_no.cast("int")].alias("timezone"),
    )
    return text_to_utc(texts, order=("o_orderkey",), zones=["Europe/Berlin"]).select("o_orderkey", "timestamp")


@query(
    "calendar_parts",
    f"""WITH {DAILY_LONG} SELECT o_orderkey, year("timestamp") AS year, month("timestamp") AS month, day("timestamp") AS day,
        hour("timestamp") AS hour, minute("timestamp") AS minute, isodow("timestamp") - 1 AS day_of_week,
        dayofyear("timestamp") AS day_of_year, week("timestamp") AS week FROM daily_long""",
)
def calendar_parts(spark, sf_dir):
    parts = with_calendar(daily_long(spark, sf_dir))
    return parts.drop("installation", "timestamp", "sol_prod", "weather_description")


@query(
    "parse_event_dates",
    """SELECT o_orderkey, o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)) + to_minutes(CAST(o_orderkey % 60 AS INTEGER))
              - to_hours(CAST(1 + o_custkey % 2 AS INTEGER)) AS date FROM orders""",
)
def parse_event_dates(spark, sf_dir):
    """Order dates written as ``March 20, 2021 at 10:37 AM GMT+1`` and parsed again."""
    key = F.col("o_orderkey")
    at = F.col("o_orderdate").cast("timestamp") + F.make_interval(
        hours=(key % 24).cast("int"), mins=(key % 60).cast("int")
    )
    text = F.concat(
        F.date_format(at, "MMMM d, yyyy 'at' h:mm a"), F.lit(" GMT+"), (1 + F.col("o_custkey") % 2).cast("string")
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", parse_event_date(text).alias("date"))


@query(
    "composite_labels",
    f"""WITH {READINGS} SELECT event_id, installation || ' ' || CAST(year("timestamp") AS VARCHAR) AS series,
        'day ' || CAST(isodow("timestamp") - 1 AS VARCHAR) AS weekday FROM readings""",
)
def composite_labels(spark, sf_dir):
    at = F.col("timestamp")
    return readings(spark, sf_dir).select(
        "event_id",
        label_of("installation", F.year(at)).alias("series"),
        label_of(F.lit("day"), F.weekday(at)).alias("weekday"),
    )


@query(
    "unknown_installations",
    """SELECT DISTINCT 'cust_' || CAST(o_custkey AS VARCHAR) AS installation FROM orders
       WHERE o_custkey NOT IN (SELECT s_suppkey FROM supplier)""",
)
def unknown(spark, sf_dir):
    def named(c):
        return F.concat(F.lit("cust_"), F.col(c).cast("string")).alias("installation")

    known = table(spark, sf_dir, "supplier").select(named("s_suppkey"))
    return unknown_installations(table(spark, sf_dir, "orders").select(named("o_custkey")), known)


@query(
    "one_hot_weather",
    f"""WITH {READINGS} SELECT event_id, """
    + ", ".join(f"CASE WHEN weather_description = '{t}' THEN 1.0 ELSE 0.0 END::DOUBLE AS {t}" for t in EVENT_TYPES)
    + ", 0.0::DOUBLE AS clear_sky FROM readings",
)
def one_hot_weather(spark, sf_dir):
    names = [*(f" {t.upper()} " for t in EVENT_TYPES), "Clear Sky"]
    return one_hot(readings(spark, sf_dir).select("event_id", "weather_description"), categories=names).drop(
        "weather_description"
    )


@query(
    "missing_flags",
    f"""WITH {READINGS} SELECT event_id, sol_prod IS NULL AS sol_prod_isna, soc IS NULL AS soc_isna,
        weather_description IS NULL AS weather_description_isna FROM readings""",
)
def missing(spark, sf_dir):
    cols = ["sol_prod", "soc", "weather_description"]
    return missing_flags(readings(spark, sf_dir), cols).select("event_id", *[f"{c}_isna" for c in cols])


@query(
    "threshold_category",
    f"""WITH {READINGS} SELECT event_id,
        CASE WHEN sol_prod IS NULL THEN 'NA' WHEN sol_prod >= 100 THEN '100+' WHEN sol_prod < 10 THEN '<10'
             WHEN sol_prod < 50 THEN '[10-50)' ELSE '[50-100)' END AS sol_prod_cat,
        CASE WHEN soc IS NULL THEN 'NA' WHEN soc >= 0.5 THEN '0.5+' ELSE '<0.5' END AS soc_cat FROM readings""",
)
def thresholds(spark, sf_dir):
    r = threshold_categories(readings(spark, sf_dir), ["sol_prod", "soc"], [[50, 100, 10], [0.5]])
    return r.select("event_id", "sol_prod_cat", "soc_cat")


@query(
    "doy_trig",
    f"""WITH {DAILY_LONG}, a AS (SELECT o_orderkey, dayofyear("timestamp") / CAST(dayofyear(make_date(year("timestamp"), 12, 31)) AS DOUBLE)
          * 2 * pi() AS x FROM daily_long)
        SELECT o_orderkey, round(sin(x), 6) + 0.0 AS date_doy_sin, round(cos(x), 6) + 0.0 AS date_doy_cos FROM a""",
    digits=6,
)
def doy_trig(spark, sf_dir):
    dated = daily_long(spark, sf_dir).select("o_orderkey", F.to_date("timestamp").alias("date"))
    return with_doy_trig(dated).drop("date")


@query(
    "doy_trig_366",
    f"""WITH {DAILY_LONG}, a AS (SELECT o_orderkey, dayofyear("timestamp") AS d FROM daily_long)
        SELECT o_orderkey, d AS date_dayofyear, round(sin(d / 366.0::DOUBLE * 2 * pi()), 6) + 0.0 AS date_sin,
               round(cos(d / 366.0::DOUBLE * 2 * pi()), 6) + 0.0 AS date_cos FROM a""",
    digits=6,
)
def doy_trig_366(spark, sf_dir):
    dated = daily_long(spark, sf_dir).select("o_orderkey", F.to_date("timestamp").alias("date"))
    return with_doy_trig_366(dated).drop("date")


@query(
    "hour_trig",
    f"""WITH {READINGS}, a AS (SELECT event_id, hour("timestamp") / 24.0::DOUBLE * 2 * pi() AS x FROM readings)
        SELECT event_id, round(sin(x), 6) + 0.0 AS hour_sin, round(cos(x), 6) + 0.0 AS hour_cos FROM a""",
    digits=6,
)
def hour_trig(spark, sf_dir):
    hours = readings(spark, sf_dir).select("event_id", F.hour("timestamp").alias("hour"))
    return with_periodic(hours, "hour", 24).drop("hour")


@query(
    "label_encode",
    f"""WITH {DAILY_LONG} SELECT o_orderkey, dense_rank() OVER (ORDER BY weather_description) - 1 AS code FROM daily_long""",
)
def label_encode(spark, sf_dir):
    return label_codes(daily_long(spark, sf_dir), "weather_description", "code").select("o_orderkey", "code")


@query(
    "predict_export",
    f"""WITH {PREDICTIONS} SELECT run, "timestamp" AS date, round(pred, 3) AS predicted, o_orderkey FROM predictions""",
    digits=3,
)
def predict_export(spark, sf_dir):
    return prediction_export(predictions(spark, sf_dir), "timestamp", "pred", keys=("run", "o_orderkey"))


@query(
    "solstice_semi",
    """SELECT o_orderkey AS event_no, o_orderdate AS date FROM orders WHERE o_orderpriority LIKE '%LOW%'
       AND o_orderdate IN (SELECT l_shipdate FROM lineitem)""",
)
def solstice_semi(spark, sf_dir):
    """Events whose name contains a word and whose date occurs in the series."""
    events = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("event_no"), F.col("o_orderdate").alias("date"), F.col("o_orderpriority").alias("event")
    )
    series = table(spark, sf_dir, "lineitem").select(F.col("l_shipdate").alias("date"))
    return events_on_series_days(events, series, "LOW").drop("event")

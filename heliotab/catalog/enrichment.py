"""Weather: landed responses, stations, grids, fills and the join to the readings."""

from pyspark.sql import functions as F

from ..operators.stations import (
    closest_station_ids,
    in_reading_range,
    nearest_stations,
    pivot_parameters,
    prefer_historical,
    station_list,
    station_priority,
    station_values,
    wanted_stations,
)
from ..operators.weather import (
    climatology_fill,
    enrich_weather,
    enriched_features,
    regrid_10_to_15,
    regular_grid,
    upsample_ffill,
    weather_coverage,
)
from ..plans.jobs import OBSERVED, enrich_observed, observed_weather
from ..session import scratch_dir
from ..sources.weather_files import flatten_responses, read_responses, route_by_date
from .registry import query
from .stand_ins import (
    EVENT_TYPES,
    HOURLY_WEATHER,
    LISTED_STATIONS,
    OBSERVATIONS,
    QUARTER_HOURLY,
    READINGS,
    SITES,
    TEN_MINUTE,
    WEATHER_LONG,
    hourly_weather,
    listed_stations,
    observations,
    quarter_hourly,
    readings,
    sites,
    stations,
    table,
    ten_minute,
    weather_long,
    yearly_readings,
)


def land_responses(spark, sf_dir):
    """One response per installation and day: parallel arrays of the hours present, as JSON files."""
    hours = (
        readings(spark, sf_dir)
        .groupBy("installation", F.date_trunc("hour", "timestamp").alias("h"))
        .agg(
            F.max("k").cast("double").alias("code"),
            F.when(F.sum("k") % 3 == 0, F.lit(float("nan"))).otherwise(F.sum("k").cast("double")).alias("cloud"),
            F.max("sol_prod_2").alias("sun"),
        )
    )
    day = F.date_trunc("day", "h")
    # at most 24 hours per response
    ordered = F.array_sort(F.collect_list(F.struct("h", "code", "cloud", "sun")))
    days = hours.groupBy("installation", day.alias("start")).agg(ordered.alias("v"))

    def pick(name):
        return F.transform("v", lambda s: s[name])

    responses = days.select(
        "installation",
        "start",
        (F.col("start") + F.make_interval(hours=F.size("v"))).alias("end"),
        F.lit(3600).alias("interval"),
        pick("code").alias("weather_code"),
        pick("cloud").alias("cloud_cover"),
        pick("sun").alias("snow_depth"),
        pick("sun").alias("sunshine_duration"),
        pick("cloud").alias("is_day"),
        pick("sun").alias("direct_radiation"),
    )
    path = scratch_dir(spark, "responses")
    responses.write.json(path)
    return path


@query(
    "weather_flatten",
    f"""WITH {READINGS}, hours AS (
      SELECT installation, date_trunc('hour', "timestamp") AS h, CAST(max(k) AS DOUBLE) AS code,
             CASE WHEN sum(k) % 3 = 0 THEN NULL ELSE CAST(sum(k) AS DOUBLE) END AS cloud, max(sol_prod_2) AS sun
      FROM readings GROUP BY 1, 2),
    placed AS (SELECT *, row_number() OVER (PARTITION BY installation, date_trunc('day', h) ORDER BY h) - 1 AS pos FROM hours)
    SELECT installation, CAST(date_trunc('day', h) AS TIMESTAMP) + to_hours(CAST(pos AS INTEGER)) AS "timestamp", code AS weather_code,
           coalesce(cloud, 0.0::DOUBLE) AS cloud_cover, coalesce(sun, 0.0::DOUBLE) AS snow_depth,
           coalesce(sun, 0.0::DOUBLE) AS sunshine_duration, cloud AS is_day, coalesce(sun, 0.0::DOUBLE) AS direct_radiation,
           coalesce(n_name, 'Unknown') AS weather_description
    FROM placed LEFT JOIN nation ON n_nationkey = code""",
)
def weather_flatten(spark, sf_dir):
    codes = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("code_figure"), F.col("n_name").alias("code_name")
    )
    return flatten_responses(read_responses(spark, land_responses(spark, sf_dir)), codes)


@query(
    "weather_route_union",
    f"""WITH {HOURLY_WEATHER}
    SELECT installation, "timestamp", round(sunshine_duration, 4) AS sunshine_duration, 'archive' AS origin FROM hourly_weather
    WHERE "timestamp" < TIMESTAMP '2024-01-15'
    UNION ALL
    SELECT installation, "timestamp", round(sunshine_duration * 2, 4), 'forecast' FROM hourly_weather
    WHERE "timestamp" >= TIMESTAMP '2024-01-15'""",
)
def weather_route_union(spark, sf_dir):
    hourly = hourly_weather(spark, sf_dir).select("installation", "timestamp", "sunshine_duration")
    archive = hourly.withColumn("origin", F.lit("archive"))
    forecast = hourly.withColumns(
        {"sunshine_duration": F.col("sunshine_duration") * 2, "origin": F.lit("forecast")}
    )
    return route_by_date(archive, forecast, "2024-01-15")


_UPSAMPLED = """spread AS (SELECT *, lead("timestamp") OVER (PARTITION BY installation ORDER BY "timestamp") AS nxt FROM hourly_weather),
  grid AS (SELECT installation, unnest(generate_series("timestamp", coalesce(nxt - INTERVAL 15 MINUTE, "timestamp"), INTERVAL 15 MINUTE)) AS "timestamp",
           sunshine_duration / 4 AS sunshine_duration, direct_radiation, cloud_cover, weather_description FROM spread)"""


@query(
    "upsample_ffill",
    f"""WITH {HOURLY_WEATHER}, {_UPSAMPLED} SELECT installation, "timestamp", round(sunshine_duration, 4) AS sunshine_duration,
        round(direct_radiation, 4) AS direct_radiation, round(cloud_cover, 9) AS cloud_cover, weather_description FROM grid""",
    cloud_cover=9,
)
def upsample(spark, sf_dir):
    return upsample_ffill(hourly_weather(spark, sf_dir))


@query(
    "enrich_weather",
    f"""WITH {HOURLY_WEATHER}, {QUARTER_HOURLY}, {_UPSAMPLED}
    SELECT installation, "timestamp", round(sol_prod, 2) AS sol_prod, round(sunshine_duration, 4) AS sunshine_duration,
           round(direct_radiation, 4) AS direct_radiation, round(cloud_cover, 9) AS cloud_cover, weather_description
    FROM quarter_hourly LEFT JOIN grid USING (installation, "timestamp")""",
    sol_prod=2,
    cloud_cover=9,
)
def enrich(spark, sf_dir):
    return enrich_weather(quarter_hourly(spark, sf_dir), hourly_weather(spark, sf_dir), validate=False)


@query(
    "enriched_features",
    f"""WITH {HOURLY_WEATHER}, {QUARTER_HOURLY}, {_UPSAMPLED}
    SELECT installation, CAST(date_trunc('day', "timestamp") AS TIMESTAMP) AS date, hour("timestamp") AS hour,
      round(coalesce(sum(sol_prod), 0), 2) AS sol_prod, round(coalesce(sum(sunshine_duration), 0), 6) AS sunshine_duration,
      round(coalesce(sum(direct_radiation), 0), 6) AS direct_radiation, round(avg(cloud_cover), 9) AS cloud_cover, """
    + ", ".join(f"round(avg(CASE WHEN weather_description = '{t}' THEN 1.0 ELSE 0.0 END), 9) AS {t}" for t in EVENT_TYPES)
    + """ FROM quarter_hourly LEFT JOIN grid USING (installation, "timestamp") GROUP BY 1, 2, 3""",
    digits=6,
    sol_prod=2,
    cloud_cover=9,
    **{t: 9 for t in EVENT_TYPES},
)
def features_of_enriched_readings(spark, sf_dir):
    return enriched_features(
        quarter_hourly(spark, sf_dir), hourly_weather(spark, sf_dir), "hourly", categories=EVENT_TYPES, validate=False
    )


@query(
    "weather_coverage",
    f"""WITH {READINGS}, {QUARTER_HOURLY}, {WEATHER_LONG},
    p AS (SELECT installation, min("timestamp") AS power_min, max("timestamp") AS power_max FROM quarter_hourly GROUP BY 1),
    w AS (SELECT installation, min("timestamp") AS weather_min, max("timestamp") AS weather_max FROM weather_long GROUP BY 1)
    SELECT installation, power_min, power_max, weather_min, weather_max,
      CASE WHEN weather_min IS NULL THEN 'no weather' WHEN weather_min > power_min THEN 'weather starts late'
           WHEN weather_max < power_max THEN 'weather ends early' END AS problem
    FROM p LEFT JOIN w USING (installation)""",
)
def coverage(spark, sf_dir):
    """Two unrelated tables: one installation has no weather at all, the others end too early."""
    return weather_coverage(quarter_hourly(spark, sf_dir), weather_long(spark, sf_dir))


_STATION_ROWS = """station_rows AS (SELECT CAST(s_suppkey % 7 AS VARCHAR) AS station_id, 'solar' AS dataset, '10_minutes' AS resolution,
  min(s_name) AS name FROM supplier GROUP BY 1)"""


@query(
    "dwd_station_values",
    f"""WITH {OBSERVATIONS}, {_STATION_ROWS} SELECT station_id, resolution, dataset, name, period, parameter, date, round(value, 4) AS value
        FROM station_rows LEFT JOIN observations USING (station_id, resolution, dataset)""",
)
def dwd_station_values(spark, sf_dir):
    rows = table(spark, sf_dir, "supplier").groupBy((F.col("s_suppkey") % 7).cast("string").alias("station_id")).agg(
        F.min("s_name").alias("name")
    )
    rows = rows.withColumns({"resolution": F.lit("10_minutes"), "dataset": F.lit("solar")})
    joined = station_values(rows, observations(spark, sf_dir))
    return joined.select("station_id", "resolution", "dataset", "name", "period", "parameter", "date", "value")


_COMBINED = """combined AS (SELECT * FROM observations WHERE period = 'historical'
  UNION ALL SELECT r.* FROM observations r WHERE period = 'recent' AND NOT EXISTS (
    SELECT 1 FROM observations h WHERE h.period = 'historical' AND h.station_id = r.station_id
      AND h.parameter = r.parameter AND h.date = r.date))"""
_IN_RANGE = """bounds AS (SELECT installation, min("timestamp") AS lo, max("timestamp") AS hi FROM yearly GROUP BY 1),
in_range AS (SELECT l.installation, l.station_rank, c.* FROM combined c JOIN listed l USING (station_id)
  JOIN bounds b USING (installation) WHERE c.date BETWEEN b.lo AND b.hi)"""
_CHOSEN = """chosen AS (SELECT * FROM in_range QUALIFY station_rank = min(station_rank) OVER (PARTITION BY installation, parameter, date))"""
_PIVOTED = """pivoted AS (SELECT installation, date, max(CASE WHEN parameter = 'radiation_global' THEN value END) AS radiation_global,
  max(CASE WHEN parameter = 'sunshine_duration' THEN value END) AS sunshine_duration FROM chosen GROUP BY 1, 2)"""


def _combined(spark, sf_dir):
    o = observations(spark, sf_dir)
    return prefer_historical(o.filter("period = 'historical'"), o.filter("period = 'recent'"))


def _in_range(spark, sf_dir):
    listed = station_list(listed_stations(spark, sf_dir))
    return in_reading_range(_combined(spark, sf_dir), wanted_stations(yearly_readings(spark, sf_dir), listed))


@query(
    "prefer_historical",
    f"WITH {OBSERVATIONS}, {_COMBINED} SELECT station_id, parameter, date, period, round(value, 4) AS value FROM combined",
)
def prefer(spark, sf_dir):
    return _combined(spark, sf_dir).select("station_id", "parameter", "date", "period", "value")


@query(
    "station_range_filter",
    f"""WITH {OBSERVATIONS}, {_COMBINED}, {LISTED_STATIONS}, {_IN_RANGE}
        SELECT installation, station_id, station_rank, parameter, date, round(value, 4) AS value FROM in_range""",
)
def station_range_filter(spark, sf_dir):
    return _in_range(spark, sf_dir).select("installation", "station_id", "station_rank", "parameter", "date", "value")


@query(
    "station_priority",
    f"""WITH {OBSERVATIONS}, {_COMBINED}, {LISTED_STATIONS}, {_IN_RANGE}, {_CHOSEN}
        SELECT installation, station_id, parameter, date, round(value, 4) AS value FROM chosen""",
)
def priority(spark, sf_dir):
    chosen = station_priority(_in_range(spark, sf_dir))
    return chosen.select("installation", "station_id", "parameter", "date", "value")


@query(
    "pivot_parameters",
    f"""WITH {OBSERVATIONS}, {_COMBINED}, {LISTED_STATIONS}, {_IN_RANGE}, {_CHOSEN}, {_PIVOTED}
        SELECT installation, date, round(radiation_global, 4) AS radiation_global, round(sunshine_duration, 4) AS sunshine_duration
        FROM pivoted""",
)
def pivot(spark, sf_dir):
    return pivot_parameters(station_priority(_in_range(spark, sf_dir)), OBSERVED)


_GRID = """grid AS (SELECT installation, unnest(generate_series(min(date), max(date), INTERVAL 10 MINUTE)) AS date FROM {t} GROUP BY installation),
  full_grid AS (SELECT installation, date, radiation_global, sunshine_duration FROM grid LEFT JOIN {t} USING (installation, date))"""
_FILLED = """filled AS (SELECT installation, date,
    coalesce(radiation_global, avg(radiation_global) OVER s) AS radiation_global,
    coalesce(sunshine_duration, avg(sunshine_duration) OVER s) AS sunshine_duration
  FROM full_grid WINDOW s AS (PARTITION BY installation, strftime(date, '%m-%d-%H-%M')))"""
_REGRID = """halves AS (SELECT installation, date + to_minutes(m) AS h, radiation_global / 2 AS r, sunshine_duration / 2 AS s
    FROM {t}, (VALUES (0), (5)) AS v(m)),
  carried AS (SELECT installation, h, last_value(r IGNORE NULLS) OVER w AS r, last_value(s IGNORE NULLS) OVER w AS s FROM halves
    WINDOW w AS (PARTITION BY installation ORDER BY h ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
  quarters AS (SELECT installation, time_bucket(INTERVAL 15 MINUTE, h) AS "timestamp", coalesce(sum(r), 0) AS radiation_global,
    coalesce(sum(s), 0) AS sunshine_duration FROM carried GROUP BY 1, 2)"""


@query(
    "regular_grid",
    f"""WITH {TEN_MINUTE}, {_GRID.format(t="ten_minute")} SELECT installation, date, round(radiation_global, 4) AS radiation_global,
        round(sunshine_duration, 4) AS sunshine_duration FROM full_grid""",
)
def grid(spark, sf_dir):
    return regular_grid(ten_minute(spark, sf_dir))


@query(
    "regrid_10_to_15",
    f"""WITH {TEN_MINUTE}, {_GRID.format(t="ten_minute")}, {_REGRID.format(t="full_grid")}
        SELECT installation, "timestamp", round(radiation_global, 4) AS radiation_global,
        round(sunshine_duration, 4) AS sunshine_duration FROM quarters""",
)
def regrid(spark, sf_dir):
    return regrid_10_to_15(regular_grid(ten_minute(spark, sf_dir)), OBSERVED)


@query(
    "climatology_fill",
    f"""WITH {OBSERVATIONS}, {_COMBINED},
    cells AS (SELECT station_id, date, max(CASE WHEN parameter = 'radiation_global' THEN value END) AS radiation_global,
      max(CASE WHEN parameter = 'sunshine_duration' THEN value END) AS sunshine_duration FROM combined GROUP BY 1, 2)
    SELECT station_id, date, round(coalesce(radiation_global, avg(radiation_global) OVER s), 6) AS radiation_global,
      round(coalesce(sunshine_duration, avg(sunshine_duration) OVER s), 6) AS sunshine_duration
    FROM cells WINDOW s AS (PARTITION BY station_id, strftime(date, '%m-%d-%H-%M'))""",
    digits=6,
)
def fill_by_climatology(spark, sf_dir):
    table_ = pivot_parameters(_combined(spark, sf_dir), OBSERVED, by=("station_id", "date"))
    return climatology_fill(table_, OBSERVED, keys=("station_id",))


@query(
    "observed_weather",
    f"""WITH {OBSERVATIONS}, {_COMBINED}, {LISTED_STATIONS}, {_IN_RANGE}, {_CHOSEN}, {_PIVOTED},
        {_GRID.format(t="pivoted")}, {_FILLED}, {_REGRID.format(t="filled")}
        SELECT installation, "timestamp", round(radiation_global, 4) AS radiation_global,
        round(sunshine_duration, 4) AS sunshine_duration FROM quarters""",
)
def observed(spark, sf_dir):
    """The whole station job: range, priority, pivot, grid, fill and regrid."""
    o = observations(spark, sf_dir)
    return observed_weather(
        o.filter("period = 'historical'"),
        o.filter("period = 'recent'"),
        station_list(listed_stations(spark, sf_dir)),
        yearly_readings(spark, sf_dir),
    )


@query(
    "enrich_observed",
    f"""WITH {OBSERVATIONS}, {_COMBINED}, {LISTED_STATIONS}, {_IN_RANGE}, {_CHOSEN}, {_PIVOTED},
        {_GRID.format(t="pivoted")}, {_FILLED}, {_REGRID.format(t="filled")}
        SELECT installation, "timestamp", year, round(radiation_global, 4) AS radiation_global,
        round(sunshine_duration, 4) AS sunshine_duration FROM yearly LEFT JOIN quarters USING (installation, "timestamp")""",
)
def readings_with_observed_weather(spark, sf_dir):
    o = observations(spark, sf_dir)
    return enrich_observed(
        yearly_readings(spark, sf_dir),
        o.filter("period = 'historical'"),
        o.filter("period = 'recent'"),
        station_list(listed_stations(spark, sf_dir)),
    )


_NEAR = """near AS (SELECT installation, station_id, 2 * 6371.0 * asin(least(1.0, sqrt(
    pow(sin(radians(t.latitude - s.latitude) / 2), 2) + cos(radians(s.latitude)) * cos(radians(t.latitude))
    * pow(sin(radians(t.longitude - s.longitude) / 2), 2)))) AS distance FROM sites s, stations t),
  nearest AS (SELECT *, row_number() OVER (PARTITION BY installation ORDER BY distance, station_id) AS station_rank
    FROM near WHERE distance <= 50)"""


@query(
    "nearest_stations",
    f"WITH {SITES}, {_NEAR} SELECT installation, station_id, round(distance, 6) AS distance, station_rank FROM nearest",
    digits=6,
    many=True,
)
def nearest(spark, sf_dir):
    return nearest_stations(sites(spark, sf_dir), stations(spark, sf_dir))


@query(
    "closest_station_ids",
    f"""WITH {SITES}, {_NEAR} SELECT installation, string_agg(station_id, '|' ORDER BY station_rank) AS closest_weather_station_ids
        FROM nearest GROUP BY 1""",
)
def closest(spark, sf_dir):
    return closest_station_ids(nearest_stations(sites(spark, sf_dir), stations(spark, sf_dir), listed=True))

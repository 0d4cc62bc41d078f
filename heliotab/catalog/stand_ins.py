"""Views of the driver tables in the role of solar data, in Spark and as SQL text.

Each view exists twice with the same content: a function for Spark, and a CTE for the SQL twin.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EVENT_TYPES = ["click", "view", "purchase", "error", "signup"]
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as quarter-hourly readings; nulls appear by rule."""
    k = F.regexp_extract("props", "[0-9]+", 0).cast("bigint")
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value", "event_type", k.alias("k"))
    k = F.col("k")
    return e.select(
        "event_id",
        "user_id",
        "k",
        F.concat(F.lit("inst_"), (F.col("user_id") % 4).cast("string")).alias("installation"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.when(F.col("user_id") % 11 != 0, F.col("value")).alias("sol_prod"),
        F.when(F.col("user_id") % 5 != 0, F.col("value") / 2).alias("sol_prod_1"),
        F.when(k % 3 != 0, k.cast("double")).alias("sol_prod_2"),
        F.when(k % 7 != 0, k / F.lit(100.0)).alias("soc"),
        F.when(k % 13 != 0, F.col("event_type")).alias("weather_description"),
    )


READINGS = """readings AS (
  SELECT event_id, user_id, k, 'inst_' || CAST(user_id % 4 AS VARCHAR) AS installation, ts AS "timestamp",
         CASE WHEN user_id % 11 <> 0 THEN value END AS sol_prod,
         CASE WHEN user_id % 5 <> 0 THEN value / 2 END AS sol_prod_1,
         CASE WHEN k % 3 <> 0 THEN CAST(k AS DOUBLE) END AS sol_prod_2,
         CASE WHEN k % 7 <> 0 THEN CAST(k AS DOUBLE) / 100.0 END AS soc,
         CASE WHEN k % 13 <> 0 THEN event_type END AS weather_description
  FROM (SELECT event_id, user_id, ts, value, event_type,
               CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS k FROM events))"""


def daily_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as a long table of dated yields."""
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.concat(F.lit("inst_"), (F.col("o_custkey") % 3).cast("string")).alias("installation"),
        F.col("o_orderdate").cast("timestamp").alias("timestamp"),
        F.col("o_totalprice").alias("sol_prod"),
        F.col("o_orderpriority").alias("weather_description"),
    )


DAILY_LONG = """daily_long AS (
  SELECT o_orderkey, 'inst_' || CAST(o_custkey % 3 AS VARCHAR) AS installation, o_orderdate AS "timestamp",
         o_totalprice AS sol_prod, o_orderpriority AS weather_description FROM orders)"""


def weather_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as a long table of weather records with nulls by rule."""
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.concat(F.lit("inst_"), (F.col("l_suppkey") % 3).cast("string")).alias("installation"),
        (F.col("l_shipdate").cast("timestamp") + F.make_interval(hours=(F.col("l_partkey") % 24).cast("int"))).alias(
            "timestamp"
        ),
        F.col("l_quantity").alias("sunshine_duration"),
        F.col("l_extendedprice").alias("direct_radiation"),
        F.when(F.col("l_partkey") % 10 != 0, F.col("l_discount")).alias("cloud_cover"),
        F.col("l_tax").alias("snow_depth"),
        F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0).alias("is_day"),
        F.concat("l_returnflag", F.lit(" "), "l_linestatus").alias("weather_description"),
    )


WEATHER_LONG = """weather_long AS (
  SELECT l_orderkey, l_linenumber, 'inst_' || CAST(l_suppkey % 3 AS VARCHAR) AS installation,
         l_shipdate + to_hours(CAST(l_partkey % 24 AS INTEGER)) AS "timestamp",
         l_quantity AS sunshine_duration, l_extendedprice AS direct_radiation,
         CASE WHEN l_partkey % 10 <> 0 THEN l_discount END AS cloud_cover, l_tax AS snow_depth,
         CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END::DOUBLE AS is_day,
         l_returnflag || ' ' || l_linestatus AS weather_description FROM lineitem)"""


def daily_yield(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per installation and day from orders: summed yield and number of records."""
    return daily_long(spark, sf_dir).groupBy("installation", F.to_date("timestamp").alias("date")).agg(
        F.sum("sol_prod").alias("sol_prod"), F.count("*").cast("double").alias("records")
    )


DAILY_YIELD = DAILY_LONG + """, daily_yield AS (
  SELECT installation, CAST("timestamp" AS DATE) AS date, sum(sol_prod) AS sol_prod,
         CAST(count(*) AS DOUBLE) AS records FROM daily_long GROUP BY 1, 2)"""


def daily_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per installation and day from lineitem."""
    return weather_long(spark, sf_dir).groupBy("installation", F.to_date("timestamp").alias("date")).agg(
        F.sum("sunshine_duration").alias("sunshine_duration"),
        F.avg("cloud_cover").alias("cloud_cover"),
        F.avg("snow_depth").alias("snow_depth"),
        F.avg("is_day").alias("is_day"),
    )


DAILY_WEATHER = WEATHER_LONG + """, daily_weather AS (
  SELECT installation, CAST("timestamp" AS DATE) AS date, sum(sunshine_duration) AS sunshine_duration,
         avg(cloud_cover) AS cloud_cover, avg(snow_depth) AS snow_depth, avg(is_day) AS is_day
  FROM weather_long GROUP BY 1, 2)"""


def hourly_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events aggregated to one weather row per installation and hour (hours without events are absent)."""
    r = readings(spark, sf_dir)
    return r.groupBy("installation", F.date_trunc("hour", "timestamp").alias("timestamp")).agg(
        F.sum("k").cast("double").alias("sunshine_duration"),
        F.max("sol_prod").alias("direct_radiation"),
        F.avg("soc").alias("cloud_cover"),
        F.max("weather_description").alias("weather_description"),
    )


HOURLY_WEATHER = READINGS + """, hourly_weather AS (
  SELECT installation, date_trunc('hour', "timestamp") AS "timestamp", CAST(sum(k) AS DOUBLE) AS sunshine_duration,
         max(sol_prod) AS direct_radiation, avg(soc) AS cloud_cover, max(weather_description) AS weather_description
  FROM readings GROUP BY 1, 2)"""


def quarter_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events aggregated to one reading per installation and quarter of an hour."""
    r = readings(spark, sf_dir)
    return r.groupBy("installation", F.window("timestamp", "15 minutes").alias("w")).agg(
        F.sum("sol_prod").alias("sol_prod")
    ).select("installation", F.col("w.start").alias("timestamp"), "sol_prod")


QUARTER_HOURLY = """quarter_hourly AS (
  SELECT installation, time_bucket(INTERVAL 15 MINUTE, "timestamp") AS "timestamp", sum(sol_prod) AS sol_prod
  FROM readings GROUP BY 1, 2)"""


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as station observations, unique per period, station, parameter and date."""
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(
            F.when(F.col("l_linestatus") == "F", "historical").otherwise("recent").alias("period"),
            (F.col("l_suppkey") % 5).cast("string").alias("station_id"),
            F.when(F.col("l_returnflag") == "R", "radiation_global").otherwise("sunshine_duration").alias("parameter"),
            F.col("l_shipdate").cast("timestamp").alias("date"),
        )
        .agg(F.max(F.when(F.col("l_partkey") % 4 != 0, F.col("l_quantity"))).alias("value"))
        .withColumns({"resolution": F.lit("10_minutes"), "dataset": F.lit("solar")})
    )


OBSERVATIONS = """observations AS (
  SELECT CASE WHEN l_linestatus = 'F' THEN 'historical' ELSE 'recent' END AS period,
         CAST(l_suppkey % 5 AS VARCHAR) AS station_id,
         CASE WHEN l_returnflag = 'R' THEN 'radiation_global' ELSE 'sunshine_duration' END AS parameter,
         l_shipdate AS date, max(CASE WHEN l_partkey % 4 <> 0 THEN l_quantity END) AS value,
         '10_minutes' AS resolution, 'solar' AS dataset FROM lineitem GROUP BY 1, 2, 3, 4)"""


def ten_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as 10-minute weather values per installation, gaps where no event fell."""
    r = readings(spark, sf_dir)
    return r.groupBy("installation", F.window("timestamp", "10 minutes").alias("w")).agg(
        F.max("sol_prod").alias("radiation_global"), F.max("sol_prod_2").alias("sunshine_duration")
    ).select("installation", F.col("w.start").alias("date"), "radiation_global", "sunshine_duration")


TEN_MINUTE = READINGS + """, ten_minute AS (
  SELECT installation, time_bucket(INTERVAL 10 MINUTE, "timestamp") AS date, max(sol_prod) AS radiation_global,
         max(sol_prod_2) AS sunshine_duration FROM readings GROUP BY 1, 2)"""


def yearly_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as readings of one installation per year, so that every installation has its own range."""
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("inst_"), F.year("o_orderdate").cast("string")).alias("installation"),
        F.year("o_orderdate").alias("year"),
        F.col("o_orderdate").cast("timestamp").alias("timestamp"),
    )


def listed_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranked station list a|b|c of each yearly installation."""
    y = F.col("year")
    return (
        yearly_readings(spark, sf_dir)
        .select("installation", "year")
        .distinct()
        .select(
            "installation",
            F.concat_ws("|", (y % 5).cast("string"), ((y + 2) % 5).cast("string"), ((y + 3) % 5).cast("string")).alias(
                "closest_weather_station_ids"
            ),
        )
    )


LISTED_STATIONS = """yearly AS (
  SELECT 'inst_' || CAST(year(o_orderdate) AS VARCHAR) AS installation, year(o_orderdate) AS year, o_orderdate AS "timestamp" FROM orders),
listed AS (
  SELECT DISTINCT installation, station_rank, CAST((year + shift) % 5 AS VARCHAR) AS station_id
  FROM yearly, (VALUES (0, 0), (1, 2), (2, 3)) AS r(station_rank, shift))"""


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer as installations with coordinates."""
    c = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit("cust_"), c.cast("string")).alias("installation"),
        (47 + (c * 37 % 800) / F.lit(100.0)).alias("latitude"),
        (6 + (c * 53 % 900) / F.lit(100.0)).alias("longitude"),
    )


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """supplier as weather stations with coordinates."""
    s = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        s.cast("string").alias("station_id"),
        F.col("s_name").alias("name"),
        (47 + (s * 211 % 800) / F.lit(100.0)).alias("latitude"),
        (6 + (s * 307 % 900) / F.lit(100.0)).alias("longitude"),
    )


SITES = """sites AS (
  SELECT 'cust_' || CAST(c_custkey AS VARCHAR) AS installation,
         47 + CAST(c_custkey * 37 % 800 AS DOUBLE) / 100.0 AS latitude,
         6 + CAST(c_custkey * 53 % 900 AS DOUBLE) / 100.0 AS longitude FROM customer),
stations AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS station_id, 47 + CAST(s_suppkey * 211 % 800 AS DOUBLE) / 100.0 AS latitude,
         6 + CAST(s_suppkey * 307 % 900 AS DOUBLE) / 100.0 AS longitude FROM supplier)"""


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as classified rows: truth, a prediction derived from the key, and class scores."""
    e = F.col("event_id")
    types = F.array(*[F.lit(t) for t in EVENT_TYPES])
    base = table(spark, sf_dir, "events").select(
        "event_id",
        F.concat(F.lit("run_"), (F.col("user_id") % 3).cast("string")).alias("run"),
        F.col("event_type").alias("truth"),
        F.when(e % 7 < 4, F.col("event_type")).otherwise(types[(e % 5).cast("int")]).alias("pred"),
        "value",
    )
    return base.withColumns(
        {
            f"p_{t}": (((e * (17 + 4 * i)) % 20) + F.when(F.col("pred") == t, 10).otherwise(0)) / F.lit(30.0)
            for i, t in enumerate(EVENT_TYPES)
        }
    )


SCORED = """scored0 AS (
  SELECT event_id, 'run_' || CAST(user_id % 3 AS VARCHAR) AS run, event_type AS truth,
         CASE WHEN event_id % 7 < 4 THEN event_type
              ELSE list_extract(['click', 'view', 'purchase', 'error', 'signup'], CAST(event_id % 5 AS INTEGER) + 1) END AS pred,
         value FROM events),
scored AS (SELECT *, """ + ", ".join(
    f"CAST((event_id * {17 + 4 * i}) % 20 + CASE WHEN pred = '{t}' THEN 10 ELSE 0 END AS DOUBLE) / 30.0 AS p_{t}"
    for i, t in enumerate(EVENT_TYPES)
) + " FROM scored0)"


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as predictions of runs: truth is the price, the prediction is off by a rule."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        "o_orderkey",
        F.concat(F.lit("run_"), F.substring("o_orderpriority", 1, 1)).alias("run"),
        F.col("o_totalprice").alias("y"),
        (F.col("o_totalprice") + (F.col("o_orderkey") % 97 - 40) * 1000.0).alias("pred"),
        F.col("o_orderdate").cast("timestamp").alias("timestamp"),
    )


PREDICTIONS = """predictions AS (
  SELECT o_orderkey, 'run_' || substr(o_orderpriority, 1, 1) AS run, o_totalprice AS y,
         o_totalprice + CAST(o_orderkey % 97 - 40 AS DOUBLE) * 1000.0 AS pred, o_orderdate AS "timestamp" FROM orders)"""


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders by priority and year as stored runs with plain error metrics."""
    return (
        predictions(spark, sf_dir)
        .groupBy("run", F.year("timestamp").alias("year"))
        .agg(
            F.avg(F.abs(F.col("y") - F.col("pred"))).alias("MAE"),
            F.avg((F.col("y") - F.col("pred")) * (F.col("y") - F.col("pred"))).alias("MSE"),
            F.var_pop("y").alias("_v"),
        )
        .select(
            F.concat_ws("_", "run", F.col("year").cast("string")).alias("name"),
            F.concat(F.col("year").cast("string"), F.lit("0"), F.substring("run", 5, 1), F.lit("15093000")).alias("timestamp"),
            F.when(F.col("year") % 2 == 0, "baseline-mean").otherwise("predict").alias("model_purpose"),
            F.when(F.col("run") == "run_1", "RandomForestClassifier").otherwise("Ridge").alias("model_class"),
            F.when(F.col("year") % 3 == 0, "").otherwise("doytrig").alias("special_features"),
            "MAE",
            "MSE",
            F.sqrt("MSE").alias("RMSE"),
            (1 - F.col("MSE") / F.col("_v")).alias("R2"),
        )
    )


RUNS = PREDICTIONS + """, runs AS (
  SELECT run || '_' || CAST(yr AS VARCHAR) AS name, CAST(yr AS VARCHAR) || '0' || substr(run, 5, 1) || '15093000' AS "timestamp",
         CASE WHEN yr % 2 = 0 THEN 'baseline-mean' ELSE 'predict' END AS model_purpose,
         CASE WHEN run = 'run_1' THEN 'RandomForestClassifier' ELSE 'Ridge' END AS model_class,
         CASE WHEN yr % 3 = 0 THEN '' ELSE 'doytrig' END AS special_features,
         MAE, MSE, sqrt(MSE) AS RMSE, 1 - MSE / v AS R2
  FROM (SELECT run, year("timestamp") AS yr, avg(abs(y - pred)) AS MAE, avg((y - pred) * (y - pred)) AS MSE, var_pop(y) AS v
        FROM predictions GROUP BY 1, 2))"""

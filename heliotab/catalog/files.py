"""Sources and sinks: tables are landed as the files a plant has, read back, and compared."""

from pyspark.sql import functions as F

from ..operators.clean import numeric_columns, strict_numeric
from ..operators.models import learning_curve
from ..operators.metrics import permutation_importance
from ..plans.jobs import history_window, scoring_window
from ..session import scratch_dir
from ..sources.power_files import SITE_SCHEMA, read_series, read_sites
from ..sources.sinks import write_csv, write_importance, write_learning_curve, write_series
from ..sources.weather_files import read_responses, read_seasonal_events, read_seasonal_events_clean, read_weather_codes, site_weather
from .enrichment import land_responses
from .modelling import _key_hash_sql, _rule, key_hash, readings_with_truth
from .registry import query
from .stand_ins import HOURLY_WEATHER, QUARTER_HOURLY, READINGS, hourly_weather, quarter_hourly, readings, sites, table


@query(
    "sites_read",
    """SELECT 'cust_' || c_custkey AS installation, CAST(c_custkey % 90 + 10 AS BIGINT) AS "Wp", c_name AS closest_weather_station_names,
       lpad(CAST(c_custkey AS VARCHAR), 5, '0') || '|' || lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS closest_weather_station_ids,
       CASE WHEN c_custkey % 2 = 0 THEN 'utc' ELSE 'Europe/Berlin' END AS timezone, round(47 + (c_custkey * 37 % 800) / 100.0, 4) AS latitude,
       round(6 + (c_custkey * 53 % 900) / 100.0, 4) AS longitude FROM customer""",
)
def sites_read(spark, sf_dir):
    """Metadata of many installations as CSV; ids keep their leading zeros."""
    c = table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    ids = F.concat_ws("|", F.lpad(key.cast("string"), 5, "0"), F.lpad(F.col("c_nationkey").cast("string"), 5, "0"))
    rows = c.select(F.concat(F.lit("cust_"), key.cast("string")).alias("installation"), (key % 90 + 10).cast("int").alias("Wp"),
                    F.col("c_name").alias("closest_weather_station_names"), ids.alias("closest_weather_station_ids"),
                    F.when(key % 2 == 0, "utc").otherwise("Europe/Berlin").alias("timezone"))
    rows = rows.join(sites(spark, sf_dir), "installation").select(*SITE_SCHEMA.fieldNames())
    path = scratch_dir(spark, "sites")
    write_csv(rows, path)
    return read_sites(spark, path)


@query("weather_codes_read", "SELECT CAST(p_partkey AS BIGINT) AS code_figure, p_name AS code_name FROM part")
def weather_codes_read(spark, sf_dir):
    path = scratch_dir(spark, "codes")
    write_csv(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("code_figure"), F.col("p_name").alias("code_name")), path)
    return read_weather_codes(spark, path)


@query(
    "power_table_read",
    f"""WITH {READINGS} SELECT installation, "timestamp", round(sol_prod, 4) AS sol_prod FROM readings""",
)
def power_table_read(spark, sf_dir):
    """The combined power table, written by installation, read with three of its columns."""
    path = scratch_dir(spark, "power")
    write_series(readings(spark, sf_dir), path)
    return read_series(spark, path, ["installation", "timestamp", "sol_prod"])


@query(
    "weather_table_read",
    f"""WITH {HOURLY_WEATHER} SELECT installation, "timestamp", round(sunshine_duration, 4) AS sunshine_duration, weather_description FROM hourly_weather""",
)
def weather_table_read(spark, sf_dir):
    path = scratch_dir(spark, "weather")
    write_series(hourly_weather(spark, sf_dir), path)
    return read_series(spark, path, ["installation", "timestamp", "sunshine_duration", "weather_description"])


@query(
    "enriched_table_read",
    f"""WITH {HOURLY_WEATHER}, {QUARTER_HOURLY}
    SELECT installation, "timestamp", round(sol_prod, 4) AS sol_prod, round(sunshine_duration, 4) AS sunshine_duration
    FROM quarter_hourly LEFT JOIN hourly_weather USING (installation, "timestamp")""",
)
def enriched_table_read(spark, sf_dir):
    """Power with weather as CSV export and as table; the table is read."""
    joined = quarter_hourly(spark, sf_dir).join(hourly_weather(spark, sf_dir), ["installation", "timestamp"], "left")
    path, text = scratch_dir(spark, "enriched"), scratch_dir(spark, "enriched-csv")
    write_series(joined, path)
    columns = ["installation", "timestamp", "sol_prod", "sunshine_duration"]
    write_csv(read_series(spark, path, columns), text)
    return spark.read.csv(text, sep=";", header=True, schema="installation string, timestamp timestamp, sol_prod double, sunshine_duration double")


@query(
    "site_weather",
    f"""WITH {READINGS}, hours AS (
      SELECT installation, date_trunc('hour', "timestamp") AS h, max(sol_prod_2) AS sun FROM readings WHERE installation <> 'inst_2' GROUP BY 1, 2),
    placed AS (SELECT *, row_number() OVER (PARTITION BY installation, date_trunc('day', h) ORDER BY h) - 1 AS pos FROM hours)
    SELECT installation, CAST(date_trunc('day', h) AS TIMESTAMP) + to_hours(CAST(pos AS INTEGER)) AS "timestamp",
           coalesce(sun, 0.0::DOUBLE) AS direct_radiation FROM placed""",
)
def gathered(spark, sf_dir):
    """Responses of all known installations in one read; one installation is not known."""
    known = readings(spark, sf_dir).select("installation").filter("installation <> 'inst_2'")
    rows = site_weather(read_responses(spark, land_responses(spark, sf_dir)), known)
    return rows.select("installation", "timestamp", "direct_radiation")


@query(
    "seasonal_events_read",
    """WITH e AS (SELECT o_orderkey, 'Event ' || o_orderkey AS event, o_orderdate + to_hours(CAST(o_custkey % 24 AS INTEGER)) AS local, o_orderkey % 3 AS off FROM orders)
    SELECT event, CAST(local - to_hours(CAST(off AS INTEGER)) AS TIMESTAMP) AS date, 'raw' AS kind FROM e
    UNION ALL SELECT event, CAST(local - to_hours(CAST(off AS INTEGER)) AS TIMESTAMP), 'clean' FROM e""",
)
def seasonal_events_read(spark, sf_dir):
    """Events as the raw list has them (text with an offset) and as the cleaned one."""
    o = table(spark, sf_dir, "orders")
    local = F.col("o_orderdate").cast("timestamp") + F.make_interval(hours=(F.col("o_custkey") % 24).cast("int"))
    off = F.col("o_orderkey") % 3
    zone = F.when(off == 0, "GMT").otherwise(F.concat(F.lit("GMT+"), off.cast("string")))
    text = F.concat(F.date_format(local, "MMMM d, yyyy 'at' h:mm a"), F.lit(" "), zone)
    event = F.concat(F.lit("Event "), F.col("o_orderkey").cast("string"))
    raw, clean = scratch_dir(spark, "events"), scratch_dir(spark, "events-clean")
    write_csv(o.select(event.alias("Event"), text.alias("Date")), raw)
    read = read_seasonal_events(spark, raw)
    write_csv(read, clean)
    return read.withColumn("kind", F.lit("raw")).unionByName(read_seasonal_events_clean(spark, clean).withColumn("kind", F.lit("clean")))


@query("strict_numeric", "SELECT o_orderkey, CAST(CAST(o_totalprice AS VARCHAR) AS DOUBLE) AS price FROM orders")
def strict(spark, sf_dir):
    text = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_totalprice").cast("string").alias("price"))
    return strict_numeric(text, ["price"])


@query("numeric_columns", "SELECT o_orderkey, o_custkey, round(o_totalprice, 4) AS o_totalprice FROM orders")
def numbers(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return orders.select(*numeric_columns(orders))


@query(
    "job_windows",
    """WITH last AS (SELECT CAST(max(o_orderdate) AS DATE) AS d FROM orders), day AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS x FROM orders)
    SELECT o_orderkey, x BETWEEN DATE '2012-01-01' AND d - 1 AS history, x BETWEEN d - 365 AND d + 10 AS daily, x BETWEEN d - 3 AND d + 3 AS hourly FROM day, last""",
)
def job_windows(spark, sf_dir):
    """Which days a job that runs on the last order date may use."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("x"))
    run_date = orders.agg(F.max("x")).first()[0]
    bounds = {"history": history_window(run_date), "daily": scoring_window(run_date), "hourly": scoring_window(run_date, "hourly")}
    return orders.select("o_orderkey", *[F.col("x").between(*b).alias(n) for n, b in bounds.items()])


@query("first_rows", "SELECT o_orderkey, round(o_totalprice, 4) AS o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def first_rows(spark, sf_dir):
    return table(spark, sf_dir, "orders").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(25).select("o_orderkey", "o_totalprice")


@query(
    "curve_files",
    f"""WITH rows0 AS (SELECT row_number() OVER (ORDER BY {_key_hash_sql('o_orderkey')}, o_orderkey) - 1 AS i,
          CAST(o_custkey % 50 AS DOUBLE) / 50 AS x, o_totalprice / 100000 + CAST(o_custkey % 50 AS DOUBLE) / 10 AS y FROM orders),
    placed AS (SELECT f.fold, x, y, row_number() OVER (PARTITION BY f.fold ORDER BY i) - 1 AS place, count(*) OVER (PARTITION BY f.fold) AS cnt
      FROM rows0, (VALUES (0), (1), (2), (3), (4)) AS f(fold) WHERE i % 5 <> f.fold),
    t AS (SELECT fold, s, covar_pop(x, y) * count(*) AS sxy, var_pop(x) * count(*) AS sxx, var_pop(y) * count(*) AS syy
      FROM placed, (SELECT unnest(range(1, 11)) AS s) WHERE place < cnt * s // 10 GROUP BY 1, 2),
    r AS (SELECT fold, s, 1 - (syy - 2 * sxy * sxy / (sxx + 1) + pow(sxy / (sxx + 1), 2) * sxx) / syy AS r2 FROM t)
    SELECT CAST(s AS DOUBLE) / 10 AS train_sizes, """
    + ", ".join(f"round(max(CASE WHEN fold = {i} THEN r2 END), 6) AS scores_{i}" for i in range(5))
    + " FROM r GROUP BY 1",
    digits=6,
)
def curve_files(spark, sf_dir):
    """The stored train scores of a learning curve."""
    x = (F.col("o_custkey") % 50).cast("double")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", (x / 50).alias("x"), (F.col("o_totalprice") / 100000 + x / 10).alias("y"))
    path = scratch_dir(spark, "curve")
    write_learning_curve(learning_curve(rows, ["x"], "y", "o_orderkey", order=key_hash("o_orderkey")), path)
    schema = "train_sizes double, " + ", ".join(f"scores_{i} double" for i in range(5))
    return spark.read.csv(f"{path}/train_scores", sep=";", header=True, schema=schema)


@query("importance_file", None)
def importance_file(spark, sf_dir):
    """The stored permutation importance (its values have a twin of their own)."""
    path = scratch_dir(spark, "importance")
    found = permutation_importance(
        readings_with_truth(spark, sf_dir), "event_id", ["value", "k"], "truth", _rule, order=lambda run: key_hash("event_id", 7919 * (run + 2))
    )
    write_importance(found, path)
    return spark.read.csv(path, sep=";", header=True, inferSchema=True)

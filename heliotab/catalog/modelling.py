"""Splits, scaling, climatology and ridge models."""

from pyspark.sql import functions as F

from ..functions.cyclic import with_doy_trig
from ..operators.features import minmax_apply, minmax_fit
from ..operators.metrics import permutation_importance
from ..operators.models import (
    climatology_daily_fit,
    climatology_hourly_fit,
    climatology_predict,
    learning_curve,
    ridge_cv,
    ridge_fit,
    ridge_predict,
)
from ..operators.splits import chronological_holdout, random_split
from ..operators.weather import enriched_features
from ..plans.jobs import retrain, score_batch, train_solar_model
from .registry import query
from .stand_ins import (
    DAILY_WEATHER,
    DAILY_YIELD,
    HOURLY_WEATHER,
    QUARTER_HOURLY,
    WEATHER_LONG,
    daily_weather,
    daily_yield,
    hourly_weather,
    quarter_hourly,
    table,
    weather_long,
)

HOLDOUT = 365


def parted_yield(spark, sf_dir):
    return chronological_holdout(daily_yield(spark, sf_dir), HOLDOUT)


_PARTED = """parted AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY installation ORDER BY date DESC) <= 364
  THEN 'test' ELSE 'train' END AS part FROM daily_yield)"""


@query("holdout_split", f"WITH {DAILY_YIELD}, {_PARTED} SELECT installation, CAST(date AS TIMESTAMP) AS date, part FROM parted")
def holdout_split(spark, sf_dir):
    return parted_yield(spark, sf_dir).select("installation", "date", "part")


@query(
    "holdout_split_lag",
    f"""WITH {DAILY_YIELD}, r AS (SELECT *, row_number() OVER (PARTITION BY installation ORDER BY date DESC) AS rn,
          count(*) OVER (PARTITION BY installation) AS n FROM daily_yield)
        SELECT installation, CAST(date AS TIMESTAMP) AS date, CASE WHEN rn <= 361 THEN 'test' WHEN rn <= 364 THEN 'test_warmup'
          WHEN rn <= 367 THEN 'gap' WHEN rn <= n - 3 THEN 'train' ELSE 'train_warmup' END AS part FROM r""",
)
def holdout_split_lag(spark, sf_dir):
    return chronological_holdout(daily_yield(spark, sf_dir), HOLDOUT, lag=3).select("installation", "date", "part")


def key_hash(key, shift=0):
    """Arithmetic hash in [0, 2^32) that SQL engines can repeat."""
    return (F.col(key) + shift) % 1000003 * F.lit(2654435761) % F.lit(4294967296)


def _key_hash_sql(key, shift="0"):
    return f"(({key} + {shift}) % 1000003 * 2654435761 % 4294967296)"


@query(
    "random_split",
    f"SELECT o_orderkey, CASE WHEN {_key_hash_sql('o_orderkey')} < 858993459 THEN 'test' ELSE 'train' END AS part FROM orders",
)
def random_parts(spark, sf_dir):
    return random_split(table(spark, sf_dir, "orders").select("o_orderkey"), key_hash("o_orderkey"))


_SCALED = ["sunshine_duration", "cloud_cover", "snow_depth", "is_day"]


@query(
    "minmax_scale",
    f"""WITH {DAILY_WEATHER}, parted AS (SELECT *, row_number() OVER (PARTITION BY installation ORDER BY date DESC) <= 364 AS test
          FROM daily_weather),
        fit AS (SELECT installation, """
    + ", ".join(f"min({c}) AS {c}_lo, max({c}) AS {c}_hi" for c in _SCALED)
    + """ FROM parted WHERE NOT test GROUP BY 1)
        SELECT installation, CAST(date AS TIMESTAMP) AS date, """
    + ", ".join(f"round(({c} - {c}_lo) / CASE WHEN {c}_hi = {c}_lo THEN 1 ELSE {c}_hi - {c}_lo END, 9) AS {c}" for c in _SCALED)
    + " FROM parted JOIN fit USING (installation)",
    digits=9,
)
def minmax_scale(spark, sf_dir):
    parted = chronological_holdout(daily_weather(spark, sf_dir), HOLDOUT)
    scaler = minmax_fit(parted.filter("part = 'train'"), _SCALED)
    return minmax_apply(parted, scaler, _SCALED).drop("part")


@query(
    "climatology_daily",
    f"""WITH {DAILY_YIELD}, {_PARTED},
    yearly AS (SELECT installation, dayofyear(date) AS doy, year(date) AS y, sum(sol_prod) AS s FROM parted WHERE part = 'train' GROUP BY 1, 2, 3),
    means AS (SELECT installation, doy, avg(s) AS pred FROM yearly GROUP BY 1, 2),
    model AS (SELECT * FROM means UNION ALL SELECT installation, 366, pred FROM means m WHERE doy = 365
      AND NOT EXISTS (SELECT 1 FROM means o WHERE o.installation = m.installation AND o.doy = 366))
    SELECT installation, CAST(date AS TIMESTAMP) AS date, round(sol_prod, 2) AS sol_prod, dayofyear(date) AS doy, round(pred, 6) AS pred
    FROM (SELECT * FROM parted WHERE part = 'test') t LEFT JOIN model m USING (installation) WHERE m.doy = dayofyear(date)
    UNION ALL
    SELECT installation, CAST(date AS TIMESTAMP), round(sol_prod, 2), dayofyear(date), NULL FROM parted t WHERE part = 'test'
      AND NOT EXISTS (SELECT 1 FROM model m WHERE m.installation = t.installation AND m.doy = dayofyear(t.date))""",
    digits=6,
    sol_prod=2,
)
def climatology_daily(spark, sf_dir):
    parted = parted_yield(spark, sf_dir)
    model = climatology_daily_fit(parted.filter("part = 'train'"))
    test = parted.filter("part = 'test'").select("installation", "date", "sol_prod")
    return climatology_predict(test, model, F.dayofyear("date"), "doy")


@query(
    "climatology_hourly",
    f"""WITH {WEATHER_LONG},
    yearly AS (SELECT installation, hour("timestamp") + 24 * (dayofyear("timestamp") - 1) AS hoy, year("timestamp") AS y,
      sum(sunshine_duration) AS s FROM weather_long GROUP BY 1, 2, 3),
    means AS (SELECT installation, hoy, avg(s) AS pred FROM yearly GROUP BY 1, 2)
    SELECT installation, hoy, round(pred, 6) AS pred FROM means
    UNION ALL SELECT installation, hoy + 24, round(pred, 6) FROM means m WHERE hoy BETWEEN 8736 AND 8759
      AND NOT EXISTS (SELECT 1 FROM means o WHERE o.installation = m.installation AND o.hoy = m.hoy + 24)""",
    digits=6,
)
def climatology_hourly(spark, sf_dir):
    return climatology_hourly_fit(weather_long(spark, sf_dir), "sunshine_duration").select("installation", "hoy", "pred")


_X = ["date_doy_sin", "date_doy_cos"]


def model_rows(spark, sf_dir):
    """Daily yield in millions with its cyclic features and holdout part."""
    rows = with_doy_trig(parted_yield(spark, sf_dir), "date")
    return rows.withColumn("y", F.col("sol_prod") / 1_000_000)


_ANGLE = "dayofyear(date) / CAST(dayofyear(make_date(year(date), 12, 31)) AS DOUBLE) * 2 * pi()"
_MODEL_ROWS = f"""{_PARTED}, model_rows AS (SELECT installation, date, part, sol_prod / 1000000 AS y, sin({_ANGLE}) AS x1,
  cos({_ANGLE}) AS x2 FROM parted)"""


def _ridge_sql(source, where, y="y", by="installation", alphas="(1.0)"):
    """Two-feature ridge in closed form: CTEs sums and fit."""
    return f"""sums AS (SELECT {by}, count(*) AS n, avg(x1) AS m1, avg(x2) AS m2, avg({y}) AS my,
      var_pop(x1) * count(*) AS s11, var_pop(x2) * count(*) AS s22, covar_pop(x1, x2) * count(*) AS s12,
      covar_pop(x1, {y}) * count(*) AS s1y, covar_pop(x2, {y}) * count(*) AS s2y FROM {source} {where} GROUP BY {by}),
    solved AS (SELECT *, (s11 + alpha) * (s22 + alpha) - s12 * s12 AS det FROM sums, (VALUES {alphas}) AS a(alpha)),
    fit AS (SELECT *, ((s22 + alpha) * s1y - s12 * s2y) / det AS w1, ((s11 + alpha) * s2y - s12 * s1y) / det AS w2 FROM solved)"""


@query(
    "ridge_fit",
    f"""WITH {DAILY_YIELD}, {_MODEL_ROWS}, {_ridge_sql('model_rows', "WHERE part = 'train'")}
    SELECT installation, CAST(alpha AS DOUBLE) AS alpha, n, round(my - w1 * m1 - w2 * m2, 8) AS intercept,
           round(w1, 8) AS w_sin, round(w2, 8) AS w_cos FROM fit""",
    digits=8,
)
def ridge_coefficients(spark, sf_dir):
    model = ridge_fit(model_rows(spark, sf_dir).filter("part = 'train'"), _X, ["y"])
    return model.select(
        "installation",
        "alpha",
        "n",
        "intercept",
        F.col("coefficients")[0].alias("w_sin"),
        F.col("coefficients")[1].alias("w_cos"),
    )


@query(
    "ridge_predict",
    f"""WITH {DAILY_YIELD}, {_MODEL_ROWS}, {_ridge_sql('model_rows', "WHERE part = 'train'")}
    SELECT installation, CAST(date AS TIMESTAMP) AS date, round(y, 8) AS y,
           round(my - w1 * m1 - w2 * m2 + w1 * x1 + w2 * x2, 8) AS pred
    FROM model_rows JOIN fit USING (installation) WHERE part = 'test'""",
    digits=8,
)
def ridge_predictions(spark, sf_dir):
    rows = model_rows(spark, sf_dir)
    model = ridge_fit(rows.filter("part = 'train'"), _X, ["y"])
    return ridge_predict(rows.filter("part = 'test'"), model, _X).select("installation", "date", "y", "pred")


@query(
    "ridge_cv",
    f"""WITH {DAILY_YIELD}, {_MODEL_ROWS}, {_ridge_sql('model_rows', '', alphas="(0.1), (1.0), (10.0)")},
    loo AS (SELECT installation, alpha, avg(pow((y - (my + w1 * (x1 - m1) + w2 * (x2 - m2))) / (1 - (1.0 / n +
      ((s22 + alpha) * pow(x1 - m1, 2) - 2 * s12 * (x1 - m1) * (x2 - m2) + (s11 + alpha) * pow(x2 - m2, 2)) / det)), 2)) AS loo_mse
      FROM model_rows JOIN fit USING (installation) GROUP BY 1, 2)
    SELECT installation, CAST(alpha AS DOUBLE) AS alpha, round(loo_mse, 8) AS loo_mse,
           alpha = arg_min(alpha, loo_mse) OVER (PARTITION BY installation) AS best FROM loo""",
    digits=8,
)
def ridge_cross_validated(spark, sf_dir):
    return ridge_cv(model_rows(spark, sf_dir), _X, "y").select("installation", "alpha", "loo_mse", "best")


_WEATHER_ROWS = f"""weather_rows AS (SELECT installation, t.target, CASE t.target WHEN 'cloud_cover' THEN cloud_cover
    ELSE sunshine_duration / 1000 END AS y, sin({_ANGLE}) AS x1, cos({_ANGLE}) AS x2
  FROM daily_weather, (VALUES ('cloud_cover'), ('sunshine')) AS t(target) WHERE cloud_cover IS NOT NULL)"""


@query(
    "ridge_multi",
    f"""WITH {DAILY_WEATHER}, {_WEATHER_ROWS}, {_ridge_sql('weather_rows', '', by='installation, target')}
    SELECT installation, target, n, round(my - w1 * m1 - w2 * m2, 8) AS intercept, round(w1, 8) AS w_sin, round(w2, 8) AS w_cos FROM fit""",
    digits=8,
)
def ridge_multi(spark, sf_dir):
    rows = with_doy_trig(daily_weather(spark, sf_dir), "date").withColumn("sunshine", F.col("sunshine_duration") / 1000)
    model = ridge_fit(rows, _X, ["cloud_cover", "sunshine"], nulls="drop")
    return model.select(
        "installation",
        "target",
        "n",
        "intercept",
        F.col("coefficients")[0].alias("w_sin"),
        F.col("coefficients")[1].alias("w_cos"),
    )


_UPSAMPLED = """spread AS (SELECT *, lead("timestamp") OVER (PARTITION BY installation ORDER BY "timestamp") AS nxt FROM hourly_weather),
  quarters AS (SELECT installation, sunshine_duration / 4 AS sunshine,
    unnest(generate_series("timestamp", coalesce(nxt - INTERVAL 15 MINUTE, "timestamp"), INTERVAL 15 MINUTE)) AS "timestamp" FROM spread)"""


_DAYS = f"""{_UPSAMPLED},
    days AS (SELECT installation, CAST("timestamp" AS DATE) AS date, coalesce(sum(sol_prod), 0) AS y, coalesce(sum(sunshine), 0) AS s
      FROM quarter_hourly LEFT JOIN quarters USING (installation, "timestamp") GROUP BY 1, 2)"""
# three-feature ridge by Cramer's rule, from the rows in ``train``
_SOLVED = f"""scaler AS (SELECT installation, min(s) AS lo, CASE WHEN max(s) = min(s) THEN 1 ELSE max(s) - min(s) END AS wd FROM train GROUP BY 1),
    x AS (SELECT installation, date, y, (s - lo) / wd AS a, sin({_ANGLE}) AS b, cos({_ANGLE}) AS c FROM train JOIN scaler USING (installation)),
    m AS (SELECT installation, avg(a) AS ma, avg(b) AS mb, avg(c) AS mc, avg(y) AS my, var_pop(a) * count(*) + 1 AS aa,
      var_pop(b) * count(*) + 1 AS bb, var_pop(c) * count(*) + 1 AS cc, covar_pop(a, b) * count(*) AS ab, covar_pop(a, c) * count(*) AS ac,
      covar_pop(b, c) * count(*) AS bc, covar_pop(a, y) * count(*) AS ay, covar_pop(b, y) * count(*) AS bz, covar_pop(c, y) * count(*) AS cy
      FROM x GROUP BY 1),
    d AS (SELECT *, aa * (bb * cc - bc * bc) - ab * (ab * cc - bc * ac) + ac * (ab * bc - bb * ac) AS det FROM m),
    w AS (SELECT *, ((bb * cc - bc * bc) * ay + (ac * bc - ab * cc) * bz + (ab * bc - ac * bb) * cy) / det AS wa,
      ((bc * ac - ab * cc) * ay + (aa * cc - ac * ac) * bz + (ab * ac - aa * bc) * cy) / det AS wb,
      ((ab * bc - bb * ac) * ay + (ab * ac - aa * bc) * bz + (aa * bb - ab * ab) * cy) / det AS wc FROM d)"""
_PRED = f"my + wa * ((s - lo) / wd - ma) + wb * (sin({_ANGLE}) - mb) + wc * (cos({_ANGLE}) - mc)"


@query(
    "score_batch",
    f"""WITH {HOURLY_WEATHER}, {QUARTER_HOURLY}, {_DAYS},
    train AS (SELECT * FROM days QUALIFY row_number() OVER (PARTITION BY installation ORDER BY date DESC) > 6), {_SOLVED},
    future AS (SELECT installation, CAST("timestamp" AS DATE) AS date, coalesce(sum(sunshine), 0) AS s FROM quarters GROUP BY 1, 2)
    SELECT installation, CAST(date AS TIMESTAMP) AS date, CAST(date AS TIMESTAMP) AS "time", round({_PRED}, 4) AS pred
    FROM future JOIN scaler USING (installation) JOIN w USING (installation)""",
)
def score(spark, sf_dir):
    """Train on power and weather, then predict every day of the weather table."""
    weather = _sunshine(spark, sf_dir)
    features = enriched_features(quarter_hourly(spark, sf_dir), weather, "daily", categories=[], validate=False)
    model = train_solar_model(features, holdout=7, categories=[])
    return score_batch(weather, model)


def _sunshine(spark, sf_dir):
    return hourly_weather(spark, sf_dir).select("installation", "timestamp", "sunshine_duration", "weather_description")


@query(
    "retrain_job",
    f"""WITH {HOURLY_WEATHER}, {QUARTER_HOURLY}, {_DAYS},
    placed AS (SELECT *, {_key_hash_sql("(date_diff('day', DATE '1970-01-01', date) * 10 + CAST(substr(installation, 6) AS BIGINT))")} < 858993459 AS test FROM days),
    train AS (SELECT * FROM placed WHERE NOT test), {_SOLVED},
    scored AS (SELECT installation, y, {_PRED} AS pred FROM (SELECT * FROM placed WHERE test) t JOIN scaler USING (installation) JOIN w USING (installation))
    SELECT installation, count(*) AS n, CAST(0 AS BIGINT) AS n_dropped, round(avg(abs(y - pred)), 4) AS "MAE", round(avg(pow(y - pred, 2)), 3) AS "MSE",
      round(sqrt(avg(pow(y - pred, 2))), 4) AS "RMSE", round(avg(abs(y - pred) / greatest(abs(y), 2.220446049250313e-16)), 4) AS "MAPE",
      round(median(abs(y - pred)), 4) AS "MedAE", round(1 - avg(pow(y - pred, 2)) / var_pop(y), 4) AS "R2",
      round(1 - var_pop(y - pred) / var_pop(y), 4) AS "ExplainedVar" FROM scored GROUP BY 1""",
    MSE=3,
)
def retrain_job(spark, sf_dir):
    """Readings and weather to a fitted daily model; its scores on the random test part."""
    day = F.datediff("date", F.lit("1970-01-01").cast("date")) * 10 + F.substring("installation", 6, 9).cast("bigint")
    position = day.cast("bigint") % 1000003 * F.lit(2654435761) % F.lit(4294967296)
    model = retrain(
        quarter_hourly(spark, sf_dir), _sunshine(spark, sf_dir), categories=[], validate=False, position=position
    )
    return model.metrics


def _rule(c):
    """A classifier as a column expression: event type from value and k."""
    return (
        F.when((c["value"] > 100) & (c["k"] > 50), "purchase")
        .when(c["value"] > 60, "view")
        .when(c["k"] > 70, "click")
        .when(c["k"] > 30, "error")
        .otherwise("signup")
    )


def _rule_sql(value, k):
    return (
        f"CASE WHEN {value} > 100 AND {k} > 50 THEN 'purchase' WHEN {value} > 60 THEN 'view' WHEN {k} > 70 THEN 'click' "
        f"WHEN {k} > 30 THEN 'error' ELSE 'signup' END"
    )


_HASH_RUN_SQL = _key_hash_sql("event_id", "7919 * (run + 2)")


@query(
    "permutation_importance",
    f"""WITH base AS (SELECT event_id, event_type AS truth, value, CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS k FROM events),
    hashed AS (SELECT *, {_HASH_RUN_SQL} AS h FROM base, (VALUES (0), (1), (2), (3), (4)) AS r(run)),
    shuffled AS (SELECT *, coalesce(lead(value) OVER w, first_value(value) OVER w) AS ov, coalesce(lead(k) OVER w, first_value(k) OVER w) AS ok
      FROM hashed WINDOW w AS (PARTITION BY run ORDER BY h, event_id)),
    preds AS (SELECT run, 'value' AS feature, truth, {_rule_sql('ov', 'k')} AS pred FROM shuffled
      UNION ALL SELECT run, 'k', truth, {_rule_sql('value', 'ok')} FROM shuffled
      UNION ALL SELECT -1, '', truth, {_rule_sql('value', 'k')} FROM base),
    classes AS (SELECT DISTINCT truth AS label FROM base),
    per_class AS (SELECT run, feature, label, count(*) FILTER (truth = label AND pred = label) AS tp, count(*) FILTER (truth = label) AS sup,
      count(*) FILTER (pred = label) AS prd FROM preds, classes GROUP BY 1, 2, 3),
    f AS (SELECT run, feature, sum(2.0 * tp / (sup + prd) * sup) / sum(sup) AS f1 FROM per_class GROUP BY 1, 2),
    drops AS (SELECT feature, run, (SELECT f1 FROM f WHERE run = -1) - f1 AS d FROM f WHERE run >= 0)
    SELECT feature, round(avg(d), 8) + 0.0 AS importance_mean, """
    + ", ".join(f"round(max(CASE WHEN run = {r} THEN d END), 8) + 0.0 AS imp_{r}" for r in range(5))
    + " FROM drops GROUP BY 1",
    digits=8,
)
def importance(spark, sf_dir):
    rows = readings_with_truth(spark, sf_dir)
    return permutation_importance(
        rows, "event_id", ["value", "k"], "truth", _rule, order=lambda run: key_hash("event_id", 7919 * (run + 2))
    )


def readings_with_truth(spark, sf_dir):
    k = F.regexp_extract("props", "[0-9]+", 0).cast("bigint").alias("k")
    return table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("truth"), "value", k)


@query(
    "learning_curve",
    f"""WITH rows0 AS (SELECT row_number() OVER (ORDER BY {_key_hash_sql('o_orderkey')}, o_orderkey) - 1 AS i,
          CAST(o_custkey % 50 AS DOUBLE) / 50 AS x, o_totalprice / 100000 + CAST(o_custkey % 50 AS DOUBLE) / 10 AS y FROM orders),
    placed AS (SELECT f.fold, i % 5 = f.fold AS held, x, y, row_number() OVER (PARTITION BY f.fold, i % 5 = f.fold ORDER BY i) - 1 AS place,
        count(*) OVER (PARTITION BY f.fold, i % 5 = f.fold) AS cnt
      FROM rows0, (VALUES (0), (1), (2), (3), (4)) AS f(fold)),
    shares AS (SELECT unnest(range(1, 11)) AS s),
    trained AS (SELECT fold, s, count(*) AS n, avg(x) AS mx, avg(y) AS my, covar_pop(x, y) * count(*) AS sxy, var_pop(x) * count(*) AS sxx,
        var_pop(y) * count(*) AS syy FROM placed, shares WHERE NOT held AND place < cnt * s // 10 GROUP BY 1, 2),
    fit AS (SELECT *, sxy / (sxx + 1) AS w, my - sxy / (sxx + 1) * mx AS b FROM trained),
    val AS (SELECT p.fold, f.s, 1 - sum(pow(p.y - f.b - f.w * p.x, 2)) / (var_pop(p.y) * count(*)) AS r2
      FROM placed p JOIN fit f USING (fold) WHERE p.held GROUP BY 1, 2)
    SELECT fold, CAST(s AS DOUBLE) / 10 AS share, n AS train_size, round(1 - (syy - 2 * w * sxy + w * w * sxx) / syy, 6) AS train_score,
      round(r2, 6) AS validation_score FROM fit JOIN val USING (fold, s)""",
    digits=6,
)
def curve(spark, sf_dir):
    x = (F.col("o_custkey") % 50).cast("double")
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey", (x / 50).alias("x"), (F.col("o_totalprice") / 100000 + x / 10).alias("y")
    )
    return learning_curve(rows, ["x"], "y", "o_orderkey", order=key_hash("o_orderkey"))

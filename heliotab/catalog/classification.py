"""A fitted classifier: its optimum, its importance and its learning curve."""

from pyspark.sql import functions as F

from ..operators.logistic import classifier_curve, classify, logistic_fit, probability
from ..operators.metrics import permutation_importance
from .registry import query
from .stand_ins import table

CLASSES, FEATURES = ["F", "O", "P"], ["day", "price"]


def _orders(spark, sf_dir):
    day = F.datediff("o_orderdate", F.lit("1992-01-01").cast("date")) / 1000
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", day.alias("day"), (F.col("o_totalprice") / 200000).alias("price"), F.col("o_orderstatus").alias("label")
    )


@query(
    "logistic_fit",
    """WITH o AS (SELECT o_orderstatus AS label, date_diff('day', DATE '1992-01-01', CAST(o_orderdate AS DATE)) / 1000 AS day, o_totalprice / 200000 AS price FROM orders),
    c AS (SELECT unnest(['F', 'O', 'P']) AS label)
    SELECT c.label, coalesce(sum(CASE WHEN o.label = c.label THEN 1.0::DOUBLE END), 0) AS expected_rows,
           round(coalesce(sum(CASE WHEN o.label = c.label THEN day END), 0), 3) AS expected_day,
           round(coalesce(sum(CASE WHEN o.label = c.label THEN price END), 0), 3) AS expected_price
    FROM o, c GROUP BY 1""",
    digits=3,
)
def fitted(spark, sf_dir):
    """At the optimum the gradient is zero: probabilities add up to the rows of a class, and weighted by a
    feature (plus the penalty's pull) to the feature's sum over the class."""
    rows = _orders(spark, sf_dir)
    model = logistic_fit(rows, FEATURES, "label", CLASSES).orderBy("label").collect()
    of = probability(model, {x: F.col(x) for x in FEATURES}, FEATURES)
    sums = [
        F.struct(
            F.lit(m.label).alias("label"), F.sum(of[m.label]).alias("expected_rows"),
            *[(F.sum(of[m.label] * F.col(x)) + F.lit(w)).alias(f"expected_{x}") for x, w in zip(FEATURES, m.coefficients)],
        )
        for m in model
    ]
    return rows.agg(F.array(*sums).alias("s")).select(F.explode("s").alias("s")).select("s.*")


@query("logistic_importance")
def importance(spark, sf_dir):
    """Drop of the weighted F1 of the fitted classifier when a feature is shuffled."""
    rows = _orders(spark, sf_dir)
    model = logistic_fit(rows, FEATURES, "label", CLASSES).orderBy("label").collect()
    return permutation_importance(rows, "o_orderkey", FEATURES, "label", classify(model, FEATURES))


@query("logistic_curve")
def curve(spark, sf_dir):
    """Weighted F1 by train size."""
    return classifier_curve(_orders(spark, sf_dir), FEATURES, "label", CLASSES, "o_orderkey", shares=(0.2, 0.6, 1.0))

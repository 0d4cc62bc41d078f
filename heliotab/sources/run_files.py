"""The registry of stored model runs: ``<root>/<run>/<run>.results.json``, or ``<root>/run=<run>`` as written here."""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

METADATA = ["model_name", "timestamp", "model_purpose", "model_class", "special_features"]
METRICS = ["MAE", "MSE", "RMSE", "MAPE", "MedAE", "R2", "ExplainedVar"]
CLASS_METRICS = ["f1", "recall", "precision", "bal_accuracy"]

RUN_SCHEMA = ", ".join(
    [f"{c} string" for c in METADATA]
    + [f"{m} double" for m in METRICS]
    + [f"{m}_scaled double" for m in METRICS]
    + ["single_dim_scores map<string, map<string, double>>", "predicts array<string>", "avg_mode string"]
    + [f"{m} double" for m in CLASS_METRICS]
    + ["roc_auc_score string", "conf_matrix map<string, bigint>", "classification_report string"]
)


def nested_field(path: str) -> Column:
    """``a__b__c`` looks up key c in map b of column a; anything missing is null."""
    head, *keys = path.split("__")
    found = F.col(head)
    for key in keys:
        found = F.try_element_at(found, F.lit(key))
    return found


def scan_runs(spark: SparkSession, root: str, schema: str = RUN_SCHEMA) -> DataFrame:
    """All runs below ``root``; ``name`` is the folder, hidden folders are skipped."""
    path = F.split(F.col("_metadata.file_path"), "/")
    folder = F.element_at(path, -2)
    written = folder.startswith("run=")
    plain = F.when(written, F.substring(folder, F.lit(5), F.length(folder))).otherwise(folder)
    stored = spark.read.schema(schema).option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").json(root)
    own = F.element_at(path, -1) == F.concat(folder, F.lit(".results.json"))
    return (
        stored
        # Partition folders escape twice: once by the writer, once in the path
        .withColumn("_once", F.url_decode(F.replace(plain, F.lit("+"), F.lit("%2B"))))
        .withColumn("name", F.when(written, F.url_decode(F.replace("_once", F.lit("+"), F.lit("%2B")))).otherwise(F.col("_once")))
        .filter(~F.col("name").startswith(".") & (written | own))
        .drop("_once")
        .withColumns({m: F.nanvl(m, F.lit(None).cast("double")) for m in METRICS})
    )


def stored_reports(runs: DataFrame, keys: tuple[str, ...] = ("name",)) -> DataFrame:
    """Lines of the stored classification reports: label, precision, recall, f1, support.

    The accuracy entry may be a bare number; it then stands for all three scores and takes the
    support of the macro average.
    """
    entries = F.explode(F.from_json("classification_report", "map<string, string>")).alias("label", "_json")
    line = F.from_json("_json", "precision double, recall double, `f1-score` double, support double")
    number = F.col("_json").try_cast("double")
    lines = runs.select(*keys, entries).withColumns({"_line": line, "_number": number})
    support = F.max(F.when(F.col("label") == "macro avg", F.col("_line.support"))).over(Window.partitionBy(*keys))
    scores = {"precision": "precision", "recall": "recall", "f1": "f1-score"}
    return lines.select(
        *keys,
        "label",
        *[F.coalesce("_number", F.col("_line").getField(field)).alias(name) for name, field in scores.items()],
        F.coalesce(F.col("_line.support"), support).cast("bigint").alias("support"),
    )


def select_fields(runs: DataFrame, fields: list[str]) -> DataFrame:
    return runs.select("name", *[nested_field(f).alias(f) for f in fields])

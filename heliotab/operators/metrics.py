"""Scores of regressors and classifiers, for many runs at once."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import EPSILON, as_column, hash32
from ..session import join_stats, settle
from .ranks import exact_median, hash_ranges, running_total

REGRESSION_SCORES = ["MAE", "MSE", "RMSE", "MAPE", "MedAE", "R2", "ExplainedVar"]


def _explained(error: Column, spread: Column) -> Column:
    """1 - error / spread; a truth without spread scores 1 if perfect, else 0."""
    return F.when(spread > 0, 1 - error / F.when(spread > 0, spread)).when(error == 0, 1.0).otherwise(0.0)


def _whole(truth: str, pred: str) -> Column:
    return F.col(truth).isNotNull() & F.col(pred).isNotNull()


def _checked(df: DataFrame, truth: str, pred: str, nulls: str) -> DataFrame:
    """``nulls="raise"`` fails on a row without truth or prediction, ``"count"`` leaves it to ``n_dropped``."""
    if nulls not in ("raise", "count"):
        raise ValueError(f"unknown nulls {nulls!r}")
    if nulls == "count":
        return df
    return df.filter(F.assert_true(_whole(truth, pred), f"{truth} or {pred} is missing").isNull())


def regression_metrics(df: DataFrame, keys: list[str], truth: str = "y", pred: str = "pred", nulls: str = "raise") -> DataFrame:
    """MAE, MSE, RMSE, MAPE, MedAE, R2 and explained variance per key.

    A row without truth or prediction fails the job; with ``nulls="count"`` it is left out of the
    scores and counted in ``n_dropped``.
    """
    whole = _whole(truth, pred)
    y, p = F.when(whole, F.col(truth).cast("double")), F.col(pred).cast("double")
    rows = _checked(df, truth, pred, nulls).select(*keys, whole.alias("_whole"), y.alias("_y"), (y - p).alias("_e"))
    rows = rows.withColumn("_abs", F.abs("_e"))
    sums = rows.groupBy(*keys).agg(
        F.count_if("_whole").alias("n"),
        F.count_if(~F.col("_whole")).alias("n_dropped"),
        F.avg("_abs").alias("MAE"),
        F.avg(F.col("_e") * F.col("_e")).alias("MSE"),
        F.avg(F.col("_abs") / F.greatest(F.abs("_y"), F.lit(EPSILON))).alias("MAPE"),
        F.var_pop("_y").alias("_vy"),
        F.var_pop("_e").alias("_ve"),
    )
    scored = sums.select(
        *keys,
        "n",
        "n_dropped",
        "MAE",
        "MSE",
        F.sqrt("MSE").alias("RMSE"),
        "MAPE",
        _explained(F.col("MSE"), F.col("_vy")).alias("R2"),
        _explained(F.col("_ve"), F.col("_vy")).alias("ExplainedVar"),
    )
    medians = exact_median(rows, keys, "_abs", "MedAE")
    return join_stats(scored, medians, keys).select(*keys, "n", "n_dropped", *REGRESSION_SCORES)


def regression_metrics_multi(
    df: DataFrame, keys: list[str], target: str = "target", truth: str = "y", pred: str = "pred", nulls: str = "raise"
) -> DataFrame:
    """Scores per target (``kind`` single), and per key their uniform mean on scaled values (``scaled``).

    Scaling to the range of the truth is affine, so all scaled scores but MAPE follow from the
    single ones and the width of the range; only the small tables of ranges and scores are settled.
    """
    by = [*keys, target]
    rows = df.select(*by, truth, pred)
    y, p = F.when(_whole(truth, pred), F.col(truth)), F.col(pred)
    span = F.max(y) - F.min(y)
    limits = rows.groupBy(*by).agg(F.min(y).alias("_lo"), F.when(span == 0, 1.0).otherwise(span).alias("_width"))
    limits = settle(limits, "limits")
    single = settle(regression_metrics(rows, by, truth, pred, nulls), "scores")
    relative = F.abs(y - p) / F.col("_width") / F.greatest(F.abs((y - F.col("_lo")) / F.col("_width")), F.lit(EPSILON))
    mape = rows.join(limits, by).groupBy(*by).agg(F.avg(relative).alias("MAPE"))
    width = F.col("_width")
    per_target = single.drop("MAPE").join(limits, by).join(mape, by).withColumns(
        {"MAE": F.col("MAE") / width, "MSE": F.col("MSE") / (width * width), "MedAE": F.col("MedAE") / width}
    )
    averaged = [m for m in REGRESSION_SCORES if m != "RMSE"]
    counts = [F.sum(c).alias(c) for c in ("n", "n_dropped")]
    mean = per_target.groupBy(*keys).agg(*counts, *[F.avg(m).alias(m) for m in averaged])
    overall = mean.withColumn("RMSE", F.sqrt("MSE")).withColumn(target, F.lit(None).cast("string"))
    return single.withColumn("kind", F.lit("single")).unionByName(overall.withColumn("kind", F.lit("scaled")))


def run_name(timestamp, model_class, score, purpose, features, score_tag: str = "r2") -> Column:
    """``<timestamp>_<class>_r2<score * 10^4, truncated, 5 digits>_<purpose>_<features>``."""
    digits = (F.coalesce(as_column(score), F.lit(0.0)) * 10_000).cast("int")
    return F.concat_ws(
        "_",
        as_column(timestamp),
        as_column(model_class),
        F.concat(F.lit(score_tag), F.format_string("%05d", digits)),
        as_column(purpose),
        as_column(features),
    )


# --------------------------------------------------------------------------- classification


def confusion_matrix(df: DataFrame, keys: list[str], labels: list, truth: str = "truth", pred: str = "pred") -> DataFrame:
    """Counts for every pair of ``labels`` per key, zeros included, with ``C_i_j`` cell names."""
    return complete_matrix(label_counts(df, keys, truth, pred), keys, labels)


def label_counts(df: DataFrame, keys: list[str], truth: str = "truth", pred: str = "pred") -> DataFrame:
    """(truth, pred, n) per key, settled: every classification score follows from these few rows."""
    pair = [F.col(truth).alias("truth"), F.col(pred).alias("pred")]
    return settle(df.groupBy(*keys, *pair).agg(F.count("*").alias("n")), "counts")


def complete_matrix(counts: DataFrame, keys: list[str], labels: list) -> DataFrame:
    """Label pairs that never occurred join the counts with zero."""

    def indexed(prefix):
        return F.explode(
            F.array(*[F.struct(F.lit(i).alias(f"{prefix}_i"), F.lit(v).alias(prefix)) for i, v in enumerate(labels)])
        )

    base = counts.select(*keys).distinct() if keys else counts.sparkSession.range(1)
    grid = (
        base.select(*keys, indexed("truth").alias("_t"))
        .select(*keys, "_t.*", indexed("pred").alias("_p"))
        .select(*keys, "truth_i", "truth", "_p.*")
    )
    return grid.join(counts, [*keys, "truth", "pred"], "left").select(
        *keys,
        "truth",
        "pred",
        F.concat(F.lit("C_"), F.col("truth_i").cast("string"), F.lit("_"), F.col("pred_i").cast("string")).alias("cell"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def confusion_pivot(records: DataFrame, keys: list[str], labels: list, matrix: str = "conf_matrix") -> DataFrame:
    """``C_i_j`` map back to a labelled matrix: one row per true label, one column per prediction."""
    names = F.array(*[F.lit(str(v)) for v in labels])
    cells = records.select(*keys, F.explode(matrix).alias("cell", "n"))
    part = F.split("cell", "_")
    placed = cells.select(*keys, part[1].cast("int").alias("i"), part[2].cast("int").alias("j"), "n")
    return placed.groupBy(*keys, names[F.col("i")].alias("truth")).agg(
        *[F.max(F.when(F.col("j") == j, F.col("n"))).alias(str(v)) for j, v in enumerate(labels)]
    )


def class_scores(counts: DataFrame, keys: list[str], truth: str = "truth", pred: str = "pred", n: str = "n") -> DataFrame:
    """Precision, recall, F1 and support per class from (truth, pred, n) counts; 0 where undefined."""
    sides = F.explode(
        F.array(
            F.struct(F.col(truth).alias("label"), F.lit(1).alias("t"), (F.col(truth) == F.col(pred)).cast("int").alias("h")),
            F.struct(F.col(pred).alias("label"), F.lit(0).alias("t"), F.lit(0).alias("h")),
        )
    )
    spread = counts.select(*keys, F.col(n).alias("_n"), sides.alias("s")).select(*keys, "_n", "s.*")
    sums = spread.groupBy(*keys, "label").agg(
        F.sum(F.col("_n") * F.col("h")).alias("tp"),
        F.sum(F.col("_n") * F.col("t")).alias("support"),
        F.sum(F.col("_n") * (1 - F.col("t"))).alias("predicted"),
    )

    def ratio(a, b):
        return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))

    tp = F.col("tp")
    return sums.select(
        *keys,
        "label",
        ratio(tp, F.col("predicted")).alias("precision"),
        ratio(tp, F.col("support")).alias("recall"),
        ratio(2 * tp, F.col("predicted") + F.col("support")).alias("f1"),
        "support",
        "predicted",
        "tp",
    )


def average_scores(scores: DataFrame, keys: list[str]) -> DataFrame:
    """Weighted, macro and micro averages of per-class scores; one row per key and mode."""
    w = F.col("support")
    total = F.sum(w)
    wanted = {
        "weighted": {m: F.sum(F.col(m) * w) / total for m in ("precision", "recall", "f1")},
        "macro": {m: F.avg(m) for m in ("precision", "recall", "f1")},
        "micro": {
            "precision": F.sum("tp") / F.sum("predicted"),
            "recall": F.sum("tp") / total,
            "f1": 2 * F.sum("tp") / (total + F.sum("predicted")),
        },
    }
    modes = F.array(
        *[
            F.struct(F.lit(mode).alias("avg_mode"), *[c.alias(m) for m, c in cols.items()])
            for mode, cols in wanted.items()
        ]
    )
    sums = scores.groupBy(*keys).agg(modes.alias("_modes"), total.alias("support"))
    return sums.select(*keys, F.explode("_modes").alias("m"), "support").select(*keys, "m.*", "support")


def balanced_accuracy(scores: DataFrame, keys: list[str]) -> DataFrame:
    """Mean recall over the classes that occur in the truth."""
    return scores.filter("support > 0").groupBy(*keys).agg(F.avg("recall").alias("bal_accuracy"))


def classification_report(scores: DataFrame, keys: list[str], labels: list | None = None) -> DataFrame:
    """Per-class rows followed by accuracy, macro and weighted averages.

    ``labels`` are the lines wanted: a listed label that never occurs has zeros, an occurring one that
    is not listed has no line and no part in the averages. Where that leaves out a label of the truth or
    the predictions, the micro average is no accuracy and is called ``micro avg``.
    """
    fields = [*keys, "label", "precision", "recall", "f1", "support"]
    if labels is None:
        shown, covered = scores, None
    else:
        listed = F.explode(F.array(*[F.lit(v) for v in labels])).alias("label")
        base = scores.select(*keys).distinct() if keys else scores.sparkSession.range(1).drop("id")
        zero = {c: F.coalesce(c, F.lit(0).cast(scores.schema[c].dataType)) for c in scores.columns if c not in (*keys, "label")}
        shown = base.select(*keys, listed).join(scores, [*keys, "label"], "left").withColumns(zero)
        # one row per key: whether every label that occurs is listed
        covered = scores.groupBy(*keys).agg(F.bool_and(F.col("label").isin(list(labels))).alias("_covered"))
    per_class = shown.withColumn("label", F.col("label").cast("string")).select(*fields)
    averages = average_scores(shown, keys)
    averages = averages.withColumn("_covered", F.lit(True)) if covered is None else join_stats(averages, covered, keys)
    accuracy = (F.col("avg_mode") == "micro") & F.col("_covered")
    rows = averages.select(
        *keys,
        F.when(accuracy, "accuracy").otherwise(F.concat(F.col("avg_mode"), F.lit(" avg"))).alias("label"),
        F.when(accuracy, F.col("recall")).otherwise(F.col("precision")).alias("precision"),
        "recall",
        F.when(accuracy, F.col("recall")).otherwise(F.col("f1")).alias("f1"),
        "support",
    )
    return per_class.unionByName(rows)


def format_report(report: DataFrame, keys: list[str], decimals: int = 3) -> DataFrame:
    """Rounded scores as plain text (``0.5``, ``1.0``); the accuracy row shows f1 and support only."""
    accuracy = F.col("label") == "accuracy"

    def text(c):
        fixed = F.format_string(f"%.{decimals}f", F.round(F.col(c), decimals))
        return F.regexp_replace(fixed, r"(\.\d+?)0+$", "$1")

    return report.select(
        *keys,
        "label",
        F.when(accuracy, "").otherwise(text("precision")).alias("precision"),
        F.when(accuracy, "").otherwise(text("recall")).alias("recall"),
        text("f1").alias("f1"),
        F.col("support").cast("bigint").cast("string").alias("support"),
    )


def roc_auc(df: DataFrame, keys: list[str], positive: Column, score: str = "score") -> DataFrame:
    """Area under the ROC curve with ties at half weight.

    Rows shrink to counts per distinct score first; ranks come from bucketed running totals.
    """
    counts = (
        df.filter(F.col(score).isNotNull() & positive.isNotNull())
        .select(*keys, F.col(score).cast("double").alias("_score"), positive.cast("int").alias("_p"))
        .groupBy(*keys, "_score")
        .agg(F.sum("_p").alias("_pos"), F.sum(1 - F.col("_p")).alias("_neg"))
    )
    return _auc_from_counts(counts, keys)


def _auc_from_counts(counts: DataFrame, keys: list[str]) -> DataFrame:
    ranked = running_total(counts, keys, "_score", ["_neg"])
    wins = F.sum(F.col("_pos") * (F.col("_neg_before") + F.col("_neg") / 2))
    return ranked.groupBy(*keys).agg(
        F.try_divide(wins, (F.sum("_pos") * F.sum("_neg")).cast("double")).alias("roc_auc")
    )


def roc_auc_ovo(df: DataFrame, keys: list[str], labels: list, truth: str, scores: dict) -> DataFrame:
    """One-versus-one macro AUC; ``scores`` maps a label to its probability column."""
    per_class = F.explode(
        F.array(*[F.struct(F.lit(v).alias("a"), F.col(scores[v]).cast("double").alias("_score")) for v in labels])
    )
    counts = (
        df.select(*keys, F.col(truth).alias("_truth"), per_class.alias("s"))
        .select(*keys, "_truth", "s.*")
        .groupBy(*keys, "a", "_score", "_truth")
        .agg(F.count("*").alias("_n"))
    )
    # on the score of class a, rows of a meet every other class, rows of b only the pair (a, b)
    others = F.filter(F.array(*[F.lit(v) for v in labels]), lambda v: v != F.col("a"))
    own = F.col("_truth") == F.col("a")
    paired = counts.withColumn("b", F.explode(F.when(own, others).otherwise(F.array("_truth"))))
    pair_counts = paired.groupBy(*keys, "a", "b", "_score").agg(
        F.coalesce(F.sum(F.when(own, F.col("_n"))), F.lit(0)).alias("_pos"),
        F.coalesce(F.sum(F.when(~own, F.col("_n"))), F.lit(0)).alias("_neg"),
    )
    pairs = _auc_from_counts(pair_counts, [*keys, "a", "b"])
    return pairs.groupBy(*keys).agg(F.avg("roc_auc").alias("roc_auc"))


def weighted_f1(counts: DataFrame, keys: list[str]) -> DataFrame:
    return average_scores(class_scores(counts, keys), keys).filter("avg_mode = 'weighted'").select(*keys, "f1")


def permutation_importance(
    df: DataFrame,
    key: str,
    features: list[str],
    truth: str,
    predict: Callable[[dict[str, Column]], Column],
    runs: int = 5,
    order: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """Drop of the weighted F1 when one feature is shuffled; mean over independent shuffles.

    ``key`` identifies a row. A shuffle hands every row the features of the row behind it in a
    hash order that differs by run (the last row gets those of the first). Ranges of the hash are
    ordered apart, and the last row of a range takes the first row of the next one from a table of at
    most one row per range and run; so the order is global, and the ranges change nothing.
    """
    order = order or (lambda run: hash32(key, run))
    rows = df.select(key, truth, *features)
    ranges = hash_ranges(df.sparkSession)
    spread = rows.withColumn("run", F.explode(F.array(*[F.lit(r) for r in range(runs)])))
    spread = spread.withColumn("_hash", order(F.col("run")).cast("bigint"))
    spread = spread.withColumn("_range", F.floor(F.col("_hash") * F.lit(ranges) / F.lit(2**32)))
    own = F.struct(*features)
    firsts = spread.groupBy("run", "_range").agg(F.min_by(own, F.struct("_hash", key)).alias("_own"))
    across = Window.partitionBy("run").orderBy("_range")
    after = F.coalesce(F.lead("_own").over(across), F.first("_own").over(across.rowsBetween(Window.unboundedPreceding, 0)))
    nexts = firsts.select("run", "_range", after.alias("_next"))
    w = Window.partitionBy("run", "_range").orderBy("_hash", key)
    shuffled = spread.withColumn("_lead", F.lead(F.struct(own.alias("v"))).over(w)).join(F.broadcast(nexts), ["run", "_range"])
    shuffled = shuffled.withColumn("_other", F.when(F.col("_lead").isNull(), F.col("_next")).otherwise(F.col("_lead.v")))
    plain = {f: F.col(f) for f in features}
    variants = F.array(
        *[
            F.struct(F.lit(f).alias("feature"), predict(plain | {f: F.col(f"_other.{f}")}).alias("pred"))
            for f in features
        ]
    )
    counts = (
        shuffled.select("run", F.col(truth).alias("truth"), F.explode(variants).alias("v"))
        .groupBy("run", "v.feature", "truth", F.col("v.pred").alias("pred"))
        .agg(F.count("*").alias("n"))
    )
    unshuffled = label_counts(rows.withColumn("_pred", predict(plain)), [], truth, "_pred")
    base = weighted_f1(unshuffled, []).withColumnRenamed("f1", "_base")
    drops = join_stats(weighted_f1(counts, ["run", "feature"]), base, []).withColumn("_drop", F.col("_base") - F.col("f1"))
    return drops.groupBy("feature").agg(
        F.avg("_drop").alias("importance_mean"),
        *[F.max(F.when(F.col("run") == r, F.col("_drop"))).alias(f"imp_{r}") for r in range(runs)],
    )


# --------------------------------------------------------------------------- records


def regression_record(scores: DataFrame, keys: list[str], metadata: dict[str, Column]) -> DataFrame:
    """One registry row per run: metadata, name and scores. ``metadata`` may use the key columns."""
    m = metadata
    name = run_name(m["timestamp"], m["model_class"], F.col("R2"), m["model_purpose"], m["special_features"])
    return scores.select(
        *keys,
        name.alias("model_name"),
        *[m[c].alias(c) for c in ("timestamp", "model_purpose", "model_class", "special_features")],
        *REGRESSION_SCORES,
    )


def with_single_scores(records: DataFrame, single: DataFrame, keys: list[str], target: str = "target") -> DataFrame:
    """Add ``single_dim_scores`` (target to score to value) of a multi-target evaluation."""
    scores = F.create_map(*[x for m in REGRESSION_SCORES for x in (F.lit(m), F.col(m))])
    entries = single.groupBy(*keys).agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col(target), scores.alias("s"))), _by_first)).alias(
            "single_dim_scores"
        )
    )
    return records.join(entries, keys, "left")


def _by_first(a: Column, b: Column) -> Column:
    return F.when(a["target"] < b["target"], -1).when(a["target"] > b["target"], 1).otherwise(0)


def classification_record(
    df: DataFrame,
    keys: list[str],
    labels: list,
    metadata: dict[str, Column],
    truth: str = "truth",
    pred: str = "pred",
    auc: DataFrame | None = None,
    avg_mode: str = "weighted",
) -> DataFrame:
    """One registry row per run with scores, confusion map and per-class report.

    Scores are taken over the classes that occur; the map and the report have the listed ``labels``.
    """
    counts = label_counts(df, keys, truth, pred)
    matrix = complete_matrix(counts, keys, labels)
    scores = class_scores(counts, keys)
    averaged = average_scores(scores, keys).filter(F.col("avg_mode") == avg_mode).drop("support")
    # labels x labels cells per run
    cells = matrix.groupBy(*keys).agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("cell", "n")))).alias("conf_matrix")
    )
    stored = ["precision", "recall", F.col("f1").alias("f1-score"), "support"]
    lines = classification_report(scores, keys, labels).groupBy(*keys).agg(
        F.map_from_entries(
            F.array_sort(F.collect_list(F.struct("label", F.struct(*stored).alias("s"))))
        ).alias("classification_report")
    )
    joined = averaged.join(balanced_accuracy(scores, keys), keys).join(cells, keys).join(lines, keys)
    joined = joined.join(auc, keys, "left") if auc is not None else joined.withColumn("roc_auc", F.lit(None).cast("double"))
    m = metadata
    name = run_name(m["timestamp"], m["model_class"], F.col("f1"), m["model_purpose"], m["special_features"], "f1")
    return joined.select(
        *keys,
        name.alias("model_name"),
        *[m[c].alias(c) for c in ("timestamp", "model_purpose", "model_class", "special_features")],
        F.array(*[F.lit(str(v)) for v in labels]).alias("predicts"),
        "avg_mode",
        "f1",
        "recall",
        "precision",
        "bal_accuracy",
        F.coalesce(F.col("roc_auc").cast("string"), F.lit("")).alias("roc_auc_score"),
        "conf_matrix",
        "classification_report",
    )

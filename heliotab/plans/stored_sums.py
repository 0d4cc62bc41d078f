"""Retraining from stored sums: models of all data from what was kept of it, without reading it again.

Ridge needs counts, means, cross products and (for scaling) ranges. These are kept per installation and month in a
table by month (``DayTable``). New or corrected readings replace the sums of the months they touch, which costs a read of
those months alone; a fit merges the stored rows of an installation, as many as it has months. Features are kept
as they are: scaling is linear, so the fit on scaled features follows from the unscaled sums and the
ranges at the time of the fit.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.models import _centred, _merged, gram
from ..session import settle
from ..streaming.tables import DayTable

PERIOD = "period"


def with_period(rows: DataFrame, time: str) -> DataFrame:
    return rows.withColumn(PERIOD, F.date_trunc("month", F.col(time).cast("timestamp")))


def months(rows: DataFrame, time: str) -> list[str]:
    """The months that rows touch, as ``DayTable`` names them."""
    return sorted(r[0] for r in with_period(rows, time).select(F.date_format(PERIOD, "yyyy-MM-dd")).distinct().collect())


def period_sums(rows: DataFrame, xs: list[str], ys: list[str], time: str = "date") -> DataFrame:
    """Sums and ranges per installation and month."""
    keyed = with_period(rows, time).select("installation", PERIOD, *[F.col(c).cast("double").alias(c) for c in dict.fromkeys([*xs, *ys])])
    ranges = keyed.groupBy("installation", PERIOD).agg(F.array(*[F.min(x) for x in xs]).alias("lo"), F.array(*[F.max(x) for x in xs]).alias("hi"))
    return gram(keyed, ["installation", PERIOD], xs, ys).join(ranges, ["installation", PERIOD])


def sums_table(spark, path: str) -> DayTable:
    return DayTable(spark, path, ("installation", PERIOD), PERIOD)


def update_sums(table: DayTable, rows: DataFrame, xs: list[str], ys: list[str], touched: list[str], version: int, time: str = "date") -> None:
    """Store the sums of some months anew; ``rows`` are all rows of these months as they are now."""
    table.replace(period_sums(rows, xs, ys, time), touched, version)


def fit_from_sums(sums: DataFrame, xs: list[str], ys: list[str], alpha: float = 1.0, scaled: bool = True) -> DataFrame:
    """One settled row per installation and target: intercept and coefficients for scaled (or plain) features, and the ranges.

    A feature that is constant has scale 1, as in ``minmax_scale``.
    """
    d, m = len(xs), len(ys)
    names = ["mx", "my", "xx", "xy", "yy"]

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        total, lo, hi = None, np.full(d, np.inf), np.full(d, -np.inf)
        for row in pdf.sort_values(PERIOD).to_dict("records"):
            part = {"n": float(row["n"])} | {k: np.asarray(row[k], float) for k in names}
            total = part if total is None else _merged(total, part, d)
            lo, hi = np.minimum(lo, row["lo"]), np.maximum(hi, row["hi"])
        n, mx, my, xx, xy, _ = _centred(total, d, m)
        width = np.where(hi > lo, hi - lo, 1.0) if scaled else np.ones(d)
        low = lo if scaled else np.zeros(d)
        w = np.linalg.solve(xx / np.outer(width, width) + alpha * np.eye(d), xy / width[:, None])
        intercept = my - ((mx - low) / width) @ w
        return pd.DataFrame(
            [(pdf["installation"].iloc[0], t, int(n), float(intercept[i]), w[:, i].tolist(), low.tolist(), (low + width).tolist()) for i, t in enumerate(ys)],
            columns=["installation", "target", "n", "intercept", "coefficients", "lo", "hi"],
        )

    schema = "installation string, target string, n bigint, intercept double, coefficients array<double>, lo array<double>, hi array<double>"
    return settle(sums.groupBy("installation").applyInPandas(solve, schema), "refit")


def arrivals(exports: Iterator[DataFrame], readings: DayTable, sums: DayTable, xs: list[str], ys: list[str], time: str = "date") -> None:
    """Exports one after the other: rows replace earlier ones of their installation and time, and the sums of their months follow.

    ``readings`` is a table by month of its own; a corrected export gives rows for keys that the table has.
    """
    start = (readings.versions() or [-1])[-1] + 1
    for version, rows in enumerate(exports, start):
        touched = months(rows, time)
        before = readings.read(touched)
        new = settle(with_period(rows, time), "export")
        if before.columns:
            others = before.join(new.select("installation", time), ["installation", time], "left_anti")
            new = others.unionByName(new, allowMissingColumns=True)
        readings.replace(new, touched, version)
        update_sums(sums, readings.read(touched), xs, ys, touched, version, time)

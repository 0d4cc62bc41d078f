"""A fit from stored sums equals the fit of all data, whatever arrived in what order."""

from datetime import datetime, timedelta

import numpy as np

from heliotab.operators.models import ridge_fit
from heliotab.plans.stored_sums import arrivals, fit_from_sums, months, sums_table
from heliotab.session import scratch_dir

XS, YS = ["a", "b", "c"], ["y", "z"]


def make(spark, days, shift=0.0, names=("p", "q")):
    rows = []
    for n in names:
        for d in days:
            rng = np.random.default_rng([d, len(n), ord(n[0])])
            a, b, e = rng.normal(size=3)
            rows.append((n, datetime(2024, 1, 1) + timedelta(days=d), float(a) + 1e5, float(b), 4.0, float(2 * a - b + 0.1 * e + shift), float(e)))
    return spark.createDataFrame(rows, "installation string, date timestamp, a double, b double, c double, y double, z double")


def test_incremental_equals_full(spark):
    exports = [make(spark, range(40, 120)), make(spark, range(0, 50), shift=3.0), make(spark, range(0, 50)), make(spark, range(115, 200), names=("q",))]
    readings, sums = sums_table(spark, scratch_dir(spark, "months")), sums_table(spark, scratch_dir(spark, "sums"))
    arrivals(iter(exports[:2]), readings, sums, XS, YS)
    held = {v: sums.manifest(v)[1] for v in sums.versions()}
    arrivals(iter(exports[2:]), readings, sums, XS, YS)
    # the last export left the sums of earlier months where they were
    last = sums.versions()[-1]
    assert months(exports[3], "date") == ["2024-04-01", "2024-05-01", "2024-06-01", "2024-07-01"]
    assert [d for d, p in sums.manifest(last)[1].items() if p == [f"batch-{last}"]] == months(exports[3], "date") and held
    whole = make(spark, range(0, 120)).union(make(spark, range(120, 200), names=("q",))).toPandas()
    got = {(r.installation, r.target): r for r in fit_from_sums(sums.read(), XS, YS).collect()}
    for name, part in whole.groupby("installation"):
        lo, hi = part[XS].min().to_numpy(), part[XS].max().to_numpy()
        scaled = part.copy()
        scaled[XS] = (part[XS] - lo) / np.where(hi > lo, hi - lo, 1.0)
        full = {r.target: r for r in ridge_fit(spark.createDataFrame(scaled), XS, YS).collect()}
        for y in YS:
            r = got[name, y]
            assert r.n == len(part) == full[y].n and r.lo == lo.tolist()
            assert np.allclose(r.coefficients, full[y].coefficients, atol=1e-9) and abs(r.intercept - full[y].intercept) < 1e-9

"""Time every registered query; prints one JSON line.

Each query runs to its last row (a write to the ``noop`` sink). ``BENCH_SF_DIR``, ``BENCH_CPUS``
and ``BENCH_ONLY`` (comma-separated names) choose data, cores and queries.
"""

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from heliotab.catalog import QUERIES  # noqa: E402
from heliotab.session import get_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [n for n in os.environ.get("BENCH_ONLY", "").split(",") if n]
    spark = get_session(
        "bench",
        f"local[{cpus}]",
        {"spark.checkpoint.dir": f"file://{tempfile.mkdtemp(prefix='bench-')}", "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "12g", "spark.log.level": "ERROR"},
    )
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_returnflag").count().collect()  # start-up
    seconds = {}
    for name, run in QUERIES.items():
        if only and name not in only:
            continue
        start = time.time()
        run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - start, 3)
    total = round(sum(seconds.values()), 3)
    scale = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "total_seconds", "value": total, "unit": "sec", "queries": seconds, "sf": float(scale)}))
    spark.stop()


if __name__ == "__main__":
    main()

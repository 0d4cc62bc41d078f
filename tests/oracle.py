"""Compare every registered query with its SQL twin: ``python tests/oracle.py [sf_dir] [name ...]``."""

import datetime
import math
import os
import sys
import time
import traceback

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def oracle_connection(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _type_of(kind):
    kind = str(kind).upper()
    if kind.startswith("TIMESTAMP"):
        return "TIMESTAMP"
    return {"STRING": "VARCHAR", "LONG": "BIGINT", "INTEGER": "BIGINT"}.get(kind, kind)


def _plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v + 0.0
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return v


def _sorted_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(plain, key=repr)


def compare(df, con, sql):
    """Empty string when schema, row count and all values agree; else the first difference."""
    rel = con.execute(sql)
    theirs = {d[0]: _type_of(d[1]) for d in rel.description}
    their_rows = rel.fetchall()
    ours = {f.name: _type_of(f.dataType.typeName()) for f in df.schema}
    our_rows = df.collect()
    if ours != theirs:
        return f"schema {sorted(ours.items())} != {sorted(theirs.items())}"
    if len(our_rows) != len(their_rows):
        return f"rows {len(our_rows)} != {len(their_rows)}"
    a, b = _sorted_rows(list(ours), our_rows), _sorted_rows(list(theirs), their_rows)
    wrong = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(wrong)} of {len(a)} rows differ, first {wrong[0]}" if wrong else ""


def main(sf_dir, names):
    import __spark_entry__ as entry
    from heliotab.session import get_session

    spark = get_session("oracle", "local[8]", {"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    queries, oracles = entry.queries(), entry.oracle_sql()
    con, bad = oracle_connection(sf_dir), 0
    for name in names or queries:
        start = time.time()
        try:
            df = queries[name](spark, sf_dir)
            if name in oracles:
                problem = compare(df, con, oracles[name])
            else:
                problem = "" if df.count() else "no rows"
        except Exception as exc:
            problem = "error " + "".join(traceback.format_exception_only(exc))[:700]
        bad += bool(problem)
        mark = "ok  " if not problem else "BAD "
        note = "" if name in oracles else " (rows only)"
        print(f"{mark}{name}{note} {time.time() - start:.1f}s {problem}", flush=True)
    print(f"{bad} problems")
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01", sys.argv[2:])))

import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from heliotab.llm import warc

SCHEMA = "page_id long, url string, html string"
BIG = "<p>é\r\n\r\nWARC/1.1\r\nWARC-Type: fake\r\n\r\n" + "x" * 200
ROWS = [
    (5, "http://a/5", BIG), (3, "http://a/3", BIG), (9, None, BIG), (4, "http://a/\r\nX: y", "small"), (6, "http://a/6", "small"), (7, "u", None),
    (8, "u", ""), (10, "u", "WARC/1.1\r\n" * 50), (11, "u", "z" * 300_000), (12, "u", "a" * 99), (13, "u", "a" * 99), (14, "u", "é" * 50), (15, "u", "é" * 50),
    (3, "http://a/3", BIG), (16, "u", "page-id: 1\r\n"), (None, "u", BIG), (None, "u", "n" * 150),
]


def captures(spark, path):
    return warc.resolved(warc.captures(warc.read_warc(spark, path)))


def test_round_trip(spark, tmp_path):
    df = spark.createDataFrame(ROWS, SCHEMA).withColumn("digest", F.lit("clash")).withColumn("id", F.lit(0)).repartition(3)
    warc.write_warc(df, f"{tmp_path}/w", records_per_file=4)
    out = captures(spark, f"{tmp_path}/w").select(
        warc.page_id(F.col("metadata")).cast("long").alias("id"), "response", "request", "original",
        warc.page_id(F.col("original.metadata")).cast("long").alias("of"),
    ).collect()
    assert len(out) == len(ROWS) and all(r.request is not None for r in out)
    payload = lambda r: r.original.response.payload.decode()
    assert sorted((str(r.id), payload(r)) for r in out) == sorted((str(i), h or "") for i, _, h in ROWS)
    least = {}
    for i, _, h in ROWS:
        if i is not None and h and len(h.encode()) >= 100:
            least[h] = min(i, least.get(h, i))
    kinds = {}
    for r in out:
        kinds.setdefault((r.id, payload(r)), []).append((r.response.type, r.of if r.response.type == "revisit" else None))
        assert r.original.response.payload_digest == hashlib.sha256(payload(r).encode()).hexdigest() == r.response.stated_digest
    for (i, h), found in kinds.items():
        first = least.get(h)
        if i is None or first is None:
            assert found == [("response", None)]
        elif i != first:
            assert found == [("revisit", first)]
        else:
            assert sorted(found)[0] == ("response", None) and all(f == ("revisit", first) for f in sorted(found)[1:])


def test_files_are_plain_warc(spark, tmp_path):
    warc.write_warc(spark.createDataFrame(ROWS[3:5], SCHEMA).coalesce(1), f"{tmp_path}/w")
    raw = b"".join(gzip.open(p).read() for p in sorted((tmp_path / "w").glob("*.gz")))
    assert raw.count(b"WARC/1.1\r\n") == 6 and raw.endswith(b"\r\n\r\n")
    assert b"%0D%0AX: y" in raw


def test_orphans_and_broken_archives(spark, tmp_path):
    (tmp_path / "o").mkdir()
    head = b"WARC/1.1\r\nWARC-Type: request\r\nWARC-Record-ID: <r>\r\nWARC-Concurrent-To: <gone>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    with gzip.open(tmp_path / "o/a.warc.gz", "wb") as f:
        f.write(head)
    row = warc.captures(warc.read_warc(spark, f"{tmp_path}/o")).collect()
    assert [(r.capture, r.response, r.request.record_id, r.metadata) for r in row] == [("gone", None, "r", [])]
    (tmp_path / "b").mkdir()
    with gzip.open(tmp_path / "b/a.warc.gz", "wb") as f:
        f.write(head.replace(b": 3", b": 99"))
    with pytest.raises(Exception, match="ends within a record"):
        warc.read_warc(spark, f"{tmp_path}/b").collect()


def crawl(*records, version=b"1.0"):
    """An archive of (type, id, concurrent ids, block)."""
    out = b""
    for kind, name, ids, block in records:
        lines = [b"WARC/" + version, b"WARC-Type: " + kind, b"WARC-Record-ID: <" + name + b">", *[b"WARC-Concurrent-To: <" + i + b">" for i in ids]]
        out += b"\r\n".join([*lines, b"Content-Length: %d" % len(block), b"", block, b"", b""])
    return out


def test_archives_of_both_versions_with_several_requests(spark, tmp_path):
    http = b"HTTP/1.1 200 OK\r\n\r\nWARC/1.0\r\nbody"
    old = crawl((b"warcinfo", b"i", [], b"software: x"), (b"response", b"r1", [b"q1"], http), (b"request", b"q1", [b"r1"], b"GET 1"),
                (b"request", b"q2", [b"r1", b"r2"], b"GET 2"), (b"metadata", b"m", [b"r1"], b"a: b"))
    new = crawl((b"response", b"r2", [], http), version=b"1.1")
    (tmp_path / "c").mkdir()
    with gzip.open(tmp_path / "c/a.warc.gz", "wb") as f:
        f.write(old + new)
    records = warc.read_warc(spark, f"{tmp_path}/c")
    assert sorted(r.record_id for r in records.collect()) == ["i", "m", "q1", "q2", "r1", "r2"]
    found = {r.capture: r for r in warc.captures(records).collect()}
    assert [q.record_id for q in found["r1"].requests] == ["q1", "q2"] and [q.record_id for q in found["r2"].requests] == ["q2"]
    assert found["r1"].response.payload == b"WARC/1.0\r\nbody" and len(found["r1"].metadata) == 1 and found["r2"].metadata == []


@pytest.mark.parametrize("raw", [crawl((b"request", b"q", [], b"abc")) + b"more", b"lost" + crawl((b"request", b"q", [], b"abc"))])
def test_bytes_that_belong_to_no_record_are_an_error(spark, tmp_path, raw):
    (tmp_path / "c").mkdir()
    with gzip.open(tmp_path / "c/a.warc.gz", "wb") as f:
        f.write(raw)
    with pytest.raises(Exception, match="Content-Length of a record|outside its records"):
        warc.read_warc(spark, f"{tmp_path}/c").collect()


def test_empty_table(spark, tmp_path):
    warc.write_warc(spark.createDataFrame([], SCHEMA), f"{tmp_path}/w")
    assert captures(spark, f"{tmp_path}/w").count() == 0

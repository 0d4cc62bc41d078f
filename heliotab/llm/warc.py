r"""WARC archives of captures, written with Spark's text writer and assembled again by concurrent-to ids.

A capture is three records: the response (or a revisit of an equal payload), the request and a metadata
record; request and metadata name the response as concurrent. Payloads of at least ``LEAST_BYTES`` are
stored once: of the captures with equal ones that with the least id is the response. Files are gzip
streams, each record ended by ``\r\n\r\n`` as the format has it.

Reading splits the files at the version line (1.0 or 1.1). A piece shorter than its Content-Length goes on in the next
ones, so payloads may hold that line; a record that ends early, or has more behind its block than line ends, is an error. Records meet again by the ids
they are concurrent to (each of them, where a record names several), and each capture becomes one nested row with all
its requests and metadata records; ``request`` is the first of them. A response is its own capture, also where it names others.

Defined results: a null payload counts as empty, a null url as an empty one; line ends in a url are
percent-encoded; a row without id is a response of its own that nothing refers to; of rows equal in id and
payload one is the response and the others revisit it; request or metadata records without a response give
a capture without one; a very long payload is one row; an empty table gives no rows; other columns are not read.
"""

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_dir, settle
from .registry import query, table

LEAST_BYTES = 100
VERSION = "WARC/1.1\r\n"
ANY_VERSION, VERSIONS = "WARC/1.", (b"0\r\n", b"1\r\n")
DATE = "2000-01-01T00:00:00Z"


def uuid(*parts: Column) -> Column:
    """A record id that depends on the parts alone, so a repeated task writes the same."""
    name = F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))
    return F.concat(F.lit("urn:uuid:"), F.regexp_replace(name, "^(.{8})(.{4})(.{4})(.{4})", "$1-$2-$3-$4-"))


def record(kind: Column, name: Column, url: Column, block: Column, *headers: Column) -> Column:
    lines = [
        F.concat(F.lit("WARC-Type: "), kind), F.concat(F.lit("WARC-Record-ID: <"), name, F.lit(">")),
        F.lit(f"WARC-Date: {DATE}"), F.concat(F.lit("WARC-Target-URI: "), url), *headers,
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")),
    ]
    return F.concat(F.lit(VERSION), F.concat_ws("\r\n", *lines), F.lit("\r\n\r\n"), block)


def write_warc(
    pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
    least_bytes: int = LEAST_BYTES, records_per_file: int = 300_000,
) -> None:
    """Archives of all rows, three records each."""
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_col).alias("id"), F.coalesce(F.col(url_col), F.lit("")).alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256)).withColumn("large", F.octet_length("payload") >= least_bytes)
    # The decision moves ids and digests only; the least id of a payload is found before the shuffle.
    slim = rows.filter("large and id is not null").select("id", "digest")
    least = slim.groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    others = slim.join(least, "digest").filter("id <> first").distinct()
    others = settle(others.select(F.col("id").alias("_id"), F.col("digest").alias("_digest"), "first"), "revisits")
    copy = Window.partitionBy("id", "digest").orderBy("url")
    marked = rows.join(others, F.col("id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest")), "left")
    marked = marked.withColumn("copy", F.row_number().over(copy))
    refers = F.coalesce("first", F.when((F.col("copy") > 1) & F.col("large"), F.col("id")))
    marked = marked.select("id", "digest", "copy", "payload", F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A")).alias("url"), refers.alias("refers"))
    name = uuid(F.lit("capture"), F.col("id"), F.col("digest"), F.col("copy"))
    original = uuid(F.lit("capture"), F.col("refers"), F.col("digest"), F.lit(1))
    revisit = F.col("refers").isNotNull()
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.octet_length("payload").cast("string"), F.lit("\r\n\r\n"), F.when(revisit, F.lit("")).otherwise(F.col("payload")),
    )
    digest = F.concat(F.lit("WARC-Payload-Digest: sha256:"), F.col("digest"))
    of = F.concat(F.lit("WARC-Concurrent-To: <"), name, F.lit(">"))
    again = [
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: <"), original, F.lit(">"))),
        F.when(revisit, F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
    ]
    as_http = lambda x: F.lit(f"Content-Type: application/http; msgtype={x}")
    get = F.concat(F.lit("GET "), F.col("url"), F.lit(" HTTP/1.1\r\n\r\n"))
    about = F.coalesce(F.concat(F.lit("page-id: "), F.col("id").cast("string"), F.lit("\r\n")), F.lit(""))
    part = lambda x: uuid(F.lit(x), F.col("id"), F.col("digest"), F.col("copy"))
    records = F.array(
        record(F.when(revisit, "revisit").otherwise("response"), name, F.col("url"), http, digest, as_http("response"), *again),
        record(F.lit("request"), part("request"), F.col("url"), get, of, as_http("request")),
        record(F.lit("metadata"), part("metadata"), F.col("url"), about, of, F.lit("Content-Type: application/warc-fields")),
    )
    writer = marked.select(F.explode(records).alias("value")).write.option("lineSep", "\r\n\r\n").option("compression", "gzip")
    writer.option("maxRecordsPerFile", records_per_file).text(path)


RECORD = [
    ("record_id", pa.string()), ("type", pa.string()), ("concurrent_to", pa.list_(pa.string())), ("refers_to", pa.string()),
    ("target_uri", pa.string()), ("date", pa.string()), ("stated_digest", pa.string()), ("payload_bytes", pa.int64()),
    ("payload_digest", pa.string()), ("fields", pa.string()), ("payload", pa.binary()),
]


def parse(raw: bytes, with_payload: bool) -> tuple | None:
    """One record without its version; None if it goes on."""
    head, found, rest = raw.partition(b"\r\n\r\n")
    if not found:
        return None
    headers, concurrent = {}, []
    for line in head.split(b"\r\n")[1:]:
        key, _, value = line.partition(b":")
        key, value = key.strip().lower(), value.strip()
        headers[key] = value
        if key == b"warc-concurrent-to":
            concurrent.append(value.strip(b"<>").decode("utf-8", "replace"))
    size = int(headers[b"content-length"])
    if len(rest) < size:
        return None
    if rest[size:].strip(b"\r\n"):
        raise ValueError(f"{len(rest) - size} bytes stand behind the Content-Length of a record")
    block = rest[:size]
    kind = headers[b"warc-type"].decode()
    text = lambda k: headers[k].strip(b"<>").decode("utf-8", "replace") if k in headers else None
    stated = text(b"warc-payload-digest")
    n = digest = fields = payload = None
    if kind == "response":
        payload = block.partition(b"\r\n\r\n")[2]
        n, digest = len(payload), hashlib.sha256(payload).hexdigest()
        if stated is not None and stated.startswith("sha256:") and stated[7:] != digest:
            raise ValueError(f"record {text(b'warc-record-id')}: the payload does not have the stated digest")
    elif kind == "metadata":
        fields = block.decode("utf-8", "replace")
    return (
        text(b"warc-record-id"), kind, concurrent, text(b"warc-refers-to"), text(b"warc-target-uri"),
        text(b"warc-date"), stated and stated.removeprefix("sha256:"), n, digest, fields, payload if with_payload else None,
    )


def read_warc(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """All records of the archives (gzip files) at a path."""
    kinds = dict.fromkeys((n for n, _ in RECORD), "string") | {"concurrent_to": "array<string>", "payload_bytes": "long", "payload": "binary"}
    mark = ANY_VERSION.encode()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: list[bytes] = []
        for batch in batches:
            out, size = [], 0
            for piece in batch.column(0).to_pylist():
                if not open_ and not piece.startswith(VERSIONS):
                    if piece.strip(b"\r\n"):
                        raise ValueError("an archive has text outside its records")
                    continue  # what stands before the first version line of a file
                open_.append(piece)
                found = parse(open_[0] if len(open_) == 1 else mark.join(open_), with_payload)
                if found is not None:
                    out.append(found)
                    open_ = []
            if out:
                yield pa.record_batch([pa.array(c, t) for c, (_, t) in zip(zip(*out), RECORD)], names=[n for n, _ in RECORD])
        if open_:
            raise ValueError("an archive ends within a record")

    pieces = spark.read.option("lineSep", ANY_VERSION).text(path).select(F.col("value").cast("binary").alias("value"))
    return pieces.mapInArrow(run, ", ".join(f"{n} {kinds[n]}" for n, _ in RECORD))


def captures(records: DataFrame) -> DataFrame:
    """One nested row per capture: its response or revisit, its requests, and its metadata records."""
    whole = F.struct(*[F.col(n) for n, _ in RECORD])
    of = lambda *kinds: F.when(F.col("type").isin(*kinds), whole)
    answer = F.col("type").isin("response", "revisit") | (F.size("concurrent_to") == 0)
    named = records.withColumn("capture", F.explode(F.when(answer, F.array("record_id")).otherwise(F.array_distinct("concurrent_to"))))
    return named.groupBy("capture").agg(
        F.max(of("response", "revisit")).alias("response"), F.sort_array(F.collect_list(of("request"))).alias("requests"),
        F.sort_array(F.collect_list(of("metadata"))).alias("metadata"),
    ).withColumn("request", F.get("requests", F.lit(0)))


def resolved(found: DataFrame) -> DataFrame:
    """Captures with the response that they are or refer to, as ``original``."""
    from_ = found.filter(F.col("response.type") == "response").select(F.col("response.record_id").alias("_of"), F.struct("capture", "response", "metadata").alias("_original"))
    target = F.coalesce("response.refers_to", "response.record_id")
    return found.withColumn("_target", target).join(from_, F.col("_target") == F.col("_of"), "left").drop("_target", "_of").withColumnRenamed("_original", "original")


def page_id(metadata: Column) -> Column:
    return F.nullif(F.regexp_extract(F.get(metadata, F.lit(0))["fields"], r"(?m)^page-id: (.*?)\r?$", 1), F.lit(""))


SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b) AS n, sha256(b) AS h FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first FROM d)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, h AS payload_digest,
       CASE WHEN n >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND page_id <> first THEN first END AS refers_to
FROM f
"""


@query("op2_warc", SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives of all pages, written and read back."""
    pages = table(spark, sf_dir, "pages")
    path = scratch_dir(spark, "warc")
    write_warc(pages, path)
    found = resolved(captures(read_warc(spark, path, with_payload=False)))
    kind = pages.schema["page_id"].dataType
    revisit = F.col("response.type") == "revisit"
    return found.select(
        page_id(F.col("metadata")).cast(kind).alias("page_id"), F.col("original.response.payload_bytes").alias("payload_bytes"),
        F.col("original.response.payload_digest").alias("payload_digest"), F.col("response.type").alias("record_type"),
        F.when(revisit, page_id(F.col("original.metadata")).cast(kind)).alias("refers_to"),
    )

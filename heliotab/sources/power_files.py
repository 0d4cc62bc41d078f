"""Semicolon-separated power exports: one folder per installation, headers differ by file."""

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamReader

from ..operators.clean import (
    CANONICAL_COLUMNS,
    POWER_COLUMN_NAMES,
    POWER_COLUMNS,
    coerce_numeric,
    normalize_peak,
)
from ..operators.zones import to_utc
from ..session import settle

SITE_SCHEMA = T.StructType(
    [
        T.StructField("installation", T.StringType()),
        T.StructField("Wp", T.IntegerType()),
        T.StructField("closest_weather_station_names", T.StringType()),
        T.StructField("closest_weather_station_ids", T.StringType()),
        T.StructField("timezone", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
    ]
)


def read_sites(spark: SparkSession, path: str) -> DataFrame:
    """Installation metadata; station ids stay text so that leading zeros survive."""
    return spark.read.csv(path, sep=";", header=True, schema=SITE_SCHEMA)


def power_lines(reader: DataFrameReader | DataStreamReader, root: str) -> DataFrame:
    """Lines of all ``root/<installation>/*.csv`` with file, block and decoded folder name."""
    path = F.col("_metadata.file_path")
    folder = F.replace(F.element_at(F.split(path, "/"), -2), F.lit("+"), F.lit("%2B"))
    return reader.text(f"{root.rstrip('/')}/*/*.csv").select(
        path.alias("_file"),
        F.url_decode(folder).alias("installation"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.col("value"),
    )


def landed(lines: DataFrame) -> DataFrame:
    """The lines as a table, numbered within their block, header lines with their cells.

    The text is read this once. Headers are found by reading one nearly empty column of the table, and
    the two branches of repeated and other times read its rows.
    """
    marked = lines.select(
        "_file", "installation", "_block", F.monotonically_increasing_id().alias("_line"), F.when(_is_header(), _cells()).alias("_head"), "value"
    )
    return settle(marked.filter(F.trim("value") != ""), "lines")


def _cells() -> Column:
    plain = F.regexp_replace("value", "^\\uFEFF", "")
    return F.transform(F.split(plain, ";"), lambda c: F.trim(F.replace(c, F.lit('"'), F.lit(""))))


def _is_header() -> Column:
    """A header line carries the literal column name, a data line never does."""
    return F.col("value").contains("timestamp") & F.array_contains(_cells(), "timestamp")


def power_headers(lines: DataFrame) -> DataFrame:
    """One row per file that has lines: its first header, null if there is none."""
    found = lines.groupBy("_file", "installation").agg(
        F.min(F.when(F.col("_head").isNotNull(), F.struct("_block", "_line", F.col("_head").alias("cells")))).alias("_first")
    )
    return settle(found.select("_file", "installation", F.col("_first.cells").alias("_header")), "headers")


def read_power_files(spark: SparkSession, root: str) -> DataFrame:
    """All ``root/<installation>/*.csv`` as text columns, matched by each file's own header."""
    lines = landed(power_lines(spark.read, root))
    return matched(lines, power_headers(lines))


def matched(lines: DataFrame, headers: DataFrame) -> DataFrame:
    """Landed lines as text columns, matched by each file's own header.

    Lines are read splittably, so one huge file is still many tasks. Headers are one short row
    per file, settled and joined back on the file path; the column names found are schema-sized.
    A file without a header fails the job, a header repeated within a file adds nothing.
    ``_file``, ``_block`` and ``_line`` keep the order of the rows within a file.
    """
    bare = headers.filter("_header is null").select("_file").limit(5).collect()
    if bare:
        raise ValueError(f"no header with a timestamp column in {', '.join(r._file for r in bare)}")
    shape = headers.agg(
        F.array_distinct(F.flatten(F.collect_set("_header"))).alias("names"),
        F.max(F.size("_header")).alias("width"),
    ).first()
    names, width = shape["names"] or [], shape["width"] or 1

    extra = sorted(set(names) - set(POWER_COLUMN_NAMES))
    wanted = [n for n in [*POWER_COLUMN_NAMES, *extra] if n in names]
    # where each column stands is looked up once per file, not once per row
    places = headers.select(
        "_file", *[(F.array_position("_header", F.lit(n)) - 1).cast("int").alias(f"_at_{i}") for i, n in enumerate(wanted)]
    )
    positional = ", ".join(f"c{i} string" for i in range(width))
    parsed = lines.filter(F.col("_head").isNull()).withColumn(
        "_row", F.from_csv("value", positional, {"sep": ";"})
    )
    cells = F.array(*[F.col(f"_row.c{i}") for i in range(width)])
    values = parsed.withColumn("_cells", cells).join(places, "_file")

    def cell(name: str):
        if name not in wanted:
            return F.lit(None).cast("string")
        place = F.col(f"_at_{wanted.index(name)}")
        return F.nullif(F.when(place >= 0, F.get("_cells", place)), F.lit(""))

    known = [n for n in POWER_COLUMN_NAMES if n != "installation"]
    return values.select(
        "installation",
        *[cell(n).alias(POWER_COLUMN_NAMES[n]) for n in known],
        *[cell(n).alias(n) for n in extra],
        "_file",
        "_block",
        "_line",
    )


def check_sites(sites: DataFrame, installations: DataFrame) -> None:
    """Fail on an installation without metadata, or with two rows of it."""
    twice = [r.installation for r in sites.groupBy("installation").count().filter("count > 1").limit(5).collect()]
    if twice:
        raise ValueError(f"several rows of metadata for installation {', '.join(map(str, twice))}")
    unknown = installations.select("installation").distinct().join(sites, "installation", "left_anti").limit(5).collect()
    if unknown:
        raise ValueError(f"no metadata for installation {', '.join(r.installation for r in unknown)}")


def ingest_lines(lines: DataFrame, sites: DataFrame, continued: bool = False) -> DataFrame:
    """Lines of exports (``power_lines``) to the power table: renamed, numeric, scaled by peak power, UTC.

    Folder names are checked against the metadata from the small table of headers, so no reading
    of an unknown installation is dropped without notice. ``continued``: files may be pieces of an export
    that was cut anywhere (see ``to_utc``).
    """
    sites, lines = settle(sites, "sites"), landed(lines)
    headers = power_headers(lines)
    check_sites(sites, headers)
    raw = matched(lines, headers)
    extra = [c for c in raw.columns if c not in CANONICAL_COLUMNS and not c.startswith("_")]
    numbers = raw.transform(coerce_numeric, ["soc", *POWER_COLUMNS])
    local = numbers.transform(normalize_peak, sites, keep=("timezone",))
    zones = [r.timezone for r in sites.select("timezone").distinct().collect()]
    named = [z for z in zones if z and not z.lower().startswith("utc")]
    utc = to_utc(
        local, "timestamp", "timezone", group=("installation", "_file"), order=("_block", "_line"), zones=named, continued=continued
    )
    return utc.select(*CANONICAL_COLUMNS, *extra)


def ingest_power(spark: SparkSession, root: str, sites: DataFrame, continued: bool = False) -> DataFrame:
    """Raw exports below ``root`` to the power table."""
    return ingest_lines(power_lines(spark.read, root), sites, continued)


def read_series(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """A stored power or weather table; only the asked columns are read."""
    stored = spark.read.parquet(path)
    return stored.select(*columns) if columns else stored

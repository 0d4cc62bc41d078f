"""Renaming, casting, normalising and filtering of readings."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import as_column, nan_to_null, to_number, total
from ..session import settle

# Export header of the power files -> canonical column name.
POWER_COLUMN_NAMES = {
    "installation": "installation",
    "timestamp": "timestamp",
    "Ladezustand": "soc",
    "Batterie (Laden)": "bat_charge",
    "Batterie (Entladen)": "bat_discharge",
    "Netzeinspeisung": "grid_feed_in",
    "Netzbezug": "grid_cons",
    "Solarproduktion Tracker 1": "sol_prod_1",
    "Solarproduktion Tracker 2": "sol_prod_2",
    "Solarproduktion Tracker 3": "sol_prod_3",
    "Solarproduktion": "sol_prod",
    "Hausverbrauch": "house_cons",
    "ADDITIONAL Verbrauch": "add_cons",
    "ext. Verbrauch": "ext_cons",
    "Σ Verbrauch": "tot_cons",
    "Wallbox (ID 0) Gesamtladeleistung": "wb_0_tot_charge",
    "Wallbox (ID 0) Netzbezug": "wb_0_grid_cons",
    "Wallbox (ID 0) Solarladeleistung": "wb_0_sol_charge",
    "Wallbox Gesamtladeleistung": "wb_tot_charge",
}

CANONICAL_COLUMNS = list(POWER_COLUMN_NAMES.values())
# Every measure but the state of charge is an amount of energy, scaled by peak power.
POWER_COLUMNS = [c for c in CANONICAL_COLUMNS if c not in ("installation", "timestamp", "soc")]


def rename_power_columns(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed(POWER_COLUMN_NAMES)


def clear_nan(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """NaN to null in all floating-point columns; run once behind every source."""
    cols = cols or [f.name for f in df.schema if f.dataType.typeName() in ("double", "float")]
    return df.withColumns({c: nan_to_null(F.col(c).cast("double")) for c in cols})


def numeric_columns(df: DataFrame, exclude: tuple[str, ...] = ()) -> list[str]:
    kinds = ("byte", "short", "integer", "long", "float", "double", "decimal")
    return [
        f.name
        for f in df.schema
        if f.dataType.typeName().split("(")[0] in kinds and f.name not in exclude
    ]


def coerce_numeric(df: DataFrame, cols: list[str]) -> DataFrame:
    """Text to double; malformed values become null."""
    text = {f.name for f in df.schema if f.dataType.typeName() == "string"}
    return df.withColumns({c: to_number(c) if c in text else nan_to_null(F.col(c).cast("double")) for c in cols})


def strict_numeric(df: DataFrame, cols: list[str]) -> DataFrame:
    """Text to double; a malformed value fails the job (ANSI cast)."""
    return df.withColumns({c: F.col(c).cast("double") for c in cols})


def normalize_peak(df: DataFrame, sites: DataFrame, peak: str = "Wp", keep: tuple[str, ...] = ()) -> DataFrame:
    """Power columns divided by the installation's peak power, ``soc`` from percent to share.

    The site table is settled and joined without a hint, so it is broadcast only while its size
    allows. An installation without metadata fails the job, whatever columns are read afterwards.
    ``keep`` names site columns to add.
    """
    peaks = settle(sites.select("installation", F.col(peak).cast("double").alias("_peak"), *keep), "peaks")
    present = [c for c in POWER_COLUMNS if c in df.columns]
    scaled = {c: F.try_divide(F.col(c), F.col("_peak")) for c in present}
    if "soc" in df.columns:
        scaled["soc"] = F.col("soc") / 100
    known = F.assert_true(F.col("_peak").isNotNull(), F.concat(F.lit("no metadata for installation "), F.col("installation")))
    return df.join(peaks, "installation", "left").filter(known.isNull()).withColumns(scaled).drop("_peak")


def recover_total(df: DataFrame, target: str = "sol_prod", parts=("sol_prod_1", "sol_prod_2")) -> DataFrame:
    """Fill a null total with the sum of its parts; a null part leaves it null."""
    return df.withColumn(target, F.coalesce(target, sum((F.col(p) for p in parts[1:]), F.col(parts[0]))))


def sum_trackers(
    df: DataFrame, target: str = "sol_prod", trackers=("sol_prod_1", "sol_prod_2", "sol_prod_3")
) -> DataFrame:
    """Overwrite the total with the sum of the trackers present, nulls as zero."""
    return df.withColumn(target, total(*[c for c in trackers if c in df.columns]))


def recoverable_rows(df: DataFrame, target: str = "sol_prod", part: str = "sol_prod_1") -> DataFrame:
    """Rows whose total is missing although a part was measured."""
    return df.filter(F.col(target).isNull() & F.col(part).isNotNull() & (F.col(part) > 0))


def describe_codes(
    df: DataFrame, codes: DataFrame, code: str = "weather_code", out: str = "weather_description"
) -> DataFrame:
    """Weather code to text; a code outside the table is ``Unknown``."""
    names = codes.select(F.col("code_figure").cast("int").alias("_code"), F.col("code_name").alias("_name"))
    return (
        df.withColumn("_code", F.col(code).try_cast("int"))
        .join(names, "_code", "left")
        .withColumn(out, F.coalesce("_name", F.lit("Unknown")))
        .drop("_code", "_name")
    )


def with_residuals(df: DataFrame, truth: str = "y", pred: str = "pred") -> DataFrame:
    """Difference, and ratio where the truth is positive."""
    return df.withColumns(
        {
            "diff": F.col(pred) - F.col(truth),
            "ratio": F.when(F.col(truth) > 0, F.try_divide(F.col(pred), F.col(truth))),
        }
    )


def label_of(*parts: Column | str, sep: str = " ") -> Column:
    return F.concat_ws(sep, *[as_column(p).cast("string") for p in parts])


def events_on_series_days(events: DataFrame, series: DataFrame, word: str, name: str = "event", date: str = "date") -> DataFrame:
    """Events whose name contains a word and whose date occurs in the series.

    The dates are made distinct before the join, so a date with many rows stays one row.
    """
    days = series.select(date).distinct()
    return events.filter(F.col(name).contains(word)).join(days, date, "left_semi")


def fill_zero(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.fillna(0.0, subset=cols)

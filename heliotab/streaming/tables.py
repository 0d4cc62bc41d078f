"""A table that a stream keeps by day: parts per day, and a manifest per version that makes them visible.

A batch writes its rows into a part of its own, folder per day, and then one small manifest that lists the parts of every
day and the columns. A manifest is one file, moved into place by Spark's committer, so a version is there whole or not at
all, and a reader stays with the version that it began with. A batch looks only at the days that it touches: what
it reads and holds does not grow with the history of the table. A batch that is run again starts from the
version before it and writes the same part and manifest. A day of more than ``MOST_PARTS`` parts is
written as one, so reading costs what the days hold and not how many batches there were; ``vacuum`` removes what no
kept version lists.
"""

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import settle

DAY = "_day"
MOST_PARTS = 8
UNDATED = "undated"
LOG_SCHEMA = "schema string, parts array<struct<day:string, part:string>>"


class DayTable:
    """Rows with unique ``keys``, kept by the day of ``time``."""

    def __init__(self, spark: SparkSession, path: str, keys: tuple[str, ...] = ("installation", "timestamp"), time: str = "timestamp"):
        self.spark, self.path, self.keys, self.time = spark, path.rstrip("/"), list(keys), time

    def _names(self, folder: str) -> list[str]:
        """Names in a folder, in whatever store it is."""
        place = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{folder}")
        files = place.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return [s.getPath().getName() for s in files.listStatus(place)] if files.exists(place) else []

    def _remove(self, folder: str) -> None:
        place = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{folder}")
        place.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(place, True)

    def versions(self) -> list[int]:
        """Versions whose manifest is in place."""
        folders = [n for n in self._names("log") if n.startswith("v=")]
        return sorted(int(n[2:]) for n in folders if any(f.endswith(".json") for f in self._names(f"log/{n}")))

    def manifest(self, version: int | None = None) -> tuple[T.StructType, dict[str, list[str]]]:
        """Columns, and the parts of each day, of a version (the last one)."""
        known = self.versions()
        version = version if version is not None else (known[-1] if known else None)
        if version is None:
            return T.StructType(), {}
        row = self.spark.read.schema(LOG_SCHEMA).json(f"{self.path}/log/v={version}").first()
        days: dict[str, list[str]] = {}
        for p in row.parts or []:
            days.setdefault(p.day, []).append(p.part)
        return T.StructType.fromJson(json.loads(row.schema)), days

    def _rows(self, schema: T.StructType, days: dict[str, list[str]]) -> DataFrame:
        paths = [f"{self.path}/data/{part}/{DAY}={day}" for day, parts in days.items() for part in parts]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def read(self, days: list[str] | None = None, version: int | None = None) -> DataFrame:
        """All rows of a version (the last one), or those of some days."""
        schema, held = self.manifest(version)
        return self._rows(schema, held if days is None else {d: held[d] for d in days if d in held})

    def _base(self, version: int, schema: T.StructType) -> tuple[T.StructType, dict[str, list[str]]]:
        """The version before ``version``, with new columns behind the old ones."""
        before = [v for v in self.versions() if v < version]
        old, days = self.manifest(before[-1]) if before else (T.StructType(), {})
        return T.StructType(old.fields + [f for f in schema if f.name not in old.names]), days

    def _write(self, rows: DataFrame, part: str) -> list[str]:
        """Write a part; the days that it has."""
        rows.hint("rebalance", DAY).write.mode("overwrite").partitionBy(DAY).parquet(f"{self.path}/data/{part}")
        return [n.split("=", 1)[1] for n in self._names(f"data/{part}") if n.startswith(f"{DAY}=")]

    def _commit(self, version: int, schema: T.StructType, days: dict[str, list[str]]) -> None:
        crowded = {d: p for d, p in days.items() if len(p) > MOST_PARTS}
        if crowded:
            part = f"merged-{version}"
            self._write(self._rows(schema, crowded).withColumn(DAY, self._day()), part)
            days = days | {d: [part] for d in crowded}
        listed = [(day, part) for day, parts in sorted(days.items()) for part in parts]
        row = self.spark.createDataFrame([(schema.json(), listed)], LOG_SCHEMA)
        row.coalesce(1).write.mode("overwrite").json(f"{self.path}/log/v={version}")

    def _day(self):
        return F.coalesce(F.date_format(self.time, "yyyy-MM-dd"), F.lit(UNDATED))

    def append(self, rows: DataFrame, version: int) -> list[str]:
        """Add the rows whose keys the table does not have yet; the days that grew.

        Of rows with equal keys within the batch the least one counts.
        """
        schema, days = self._base(version, rows.schema)
        rest = [c for c in rows.columns if c not in self.keys]
        one = rows.groupBy(*self.keys).agg(F.min(F.struct(*rest)).alias("_r")).select(*self.keys, "_r.*").withColumn(DAY, self._day())
        batch = settle(one, "batch")
        touched = [r[0] for r in batch.select(DAY).distinct().collect()]
        held = self._rows(schema, {d: days[d] for d in touched if d in days}).select(*[F.col(k).alias(f"_held_{k}") for k in self.keys])
        same = [F.col(k).eqNullSafe(F.col(f"_held_{k}")) for k in self.keys]
        fresh = batch.join(held, same, "left_anti")
        grown = self._write(fresh, f"batch-{version}")
        self._commit(version, schema, days | {d: [*days.get(d, []), f"batch-{version}"] for d in grown})
        return grown

    def replace(self, rows: DataFrame, days: list[str], version: int) -> None:
        """Give some days new rows, in place of all that they had."""
        schema, held = self._base(version, rows.schema)
        written = self._write(rows.withColumn(DAY, self._day()), f"batch-{version}")
        kept = {d: p for d, p in held.items() if d not in days}
        self._commit(version, schema, kept | {d: [f"batch-{version}"] for d in written})

    def vacuum(self, keep: int = 2) -> None:
        """Remove all but the last versions, and the parts that none of those lists."""
        known = self.versions()
        listed = {part for v in known[-keep:] for parts in self.manifest(v)[1].values() for part in parts}
        for v in known[:-keep]:
            self._remove(f"log/v={v}")
        for part in set(self._names("data")) - listed:
            self._remove(f"data/{part}")

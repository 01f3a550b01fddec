"""Stored star schema: immutable batch folders plus one list of what is live.

A batch writes new folders only. Nothing is visible until its list of live folders is
committed as one small parquet file, so a failed or half-done batch leaves no trace
and readers never see a path being overwritten.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import visits
from ..schemas import STORED, TARGET, conform, empty, literal_rows

_LIST = "_published"
#: How stored and intermediate tables are compressed: by a quarter smaller than Spark's default.
CODEC = "zstd"
#: A table kept in buckets gets as many, a power of two, as hold about so many rows each.
BUCKET_ROWS = 1 << 18
# Tables to which each batch adds folders.
_GROWING = (
    "fact_encounters", "fact_ids", "bridge_encounter_diagnoses", "bridge_encounter_procedures", "rejects",
    "month_visits", "batch_checks",
)
_LIST_COLUMNS = T.StructType(
    [T.StructField("table_name", T.StringType()), T.StructField("path", T.StringType())]
)


def bucket_of(key: Column, buckets: int) -> Column:
    """The bucket of a key; it follows from the key alone."""
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def buckets_for(rows: int) -> int:
    return 1 << max(0, -(-rows // BUCKET_ROWS) - 1).bit_length()


@dataclass(frozen=True)
class Snapshot:
    """Folders that make up each table, relative to the warehouse."""

    batch_id: int = 0
    paths: dict[str, tuple[str, ...]] = field(default_factory=dict)
    revision: int = 0

    def replaced(self, table: str, paths) -> "Snapshot":
        return Snapshot(self.batch_id, {**self.paths, table: tuple(paths)}, self.revision)

    def extended(self, table: str, paths) -> "Snapshot":
        return self.replaced(table, (*self.paths.get(table, ()), *paths))


class Warehouse:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def snapshot(self) -> Snapshot:
        """What the last published batch left live."""
        live = self._read_if_there("table_name string, path string, batch bigint, revision bigint", _LIST)
        newest = live and live.agg(F.max(F.struct("batch", "revision"))).first()[0]
        if newest is None:
            return Snapshot()
        # One row per live folder: calendar months times the batches since the last compact().
        rows = live.filter((F.col("batch") == newest.batch) & (F.col("revision") == newest.revision)).collect()
        paths: dict[str, list[str]] = {}
        for row in rows:
            paths.setdefault(row.table_name, []).append(row.path)
        return Snapshot(int(newest.batch), {t: tuple(sorted(p)) for t, p in paths.items()}, int(newest.revision))

    def _read_if_there(self, schema, folder: str) -> DataFrame | None:
        """A stored table, or None if its folder doesn't exist; other errors are not caught."""
        try:
            return self.spark.read.schema(schema).parquet(f"{self.root}/{folder}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def read(self, table: str, snapshot: Snapshot, only: str | None = None) -> DataFrame:
        """A table as of a snapshot; only keeps the folders whose path contains a part."""
        paths = [p for p in snapshot.paths.get(table, ()) if only is None or only in p]
        if not paths:
            return empty(self.spark, table)
        schema = STORED[table]
        df = (
            self.spark.read.schema(schema)
            .option("basePath", f"{self.root}/{table}")
            .parquet(*[f"{self.root}/{p}" for p in paths])
        )
        return df.select(schema.names)

    def write(self, df: DataFrame, table: str, batch_id: int, part: str = "", label: str = "") -> str:
        """Write one unpartitioned folder of this batch and return its path."""
        path = f"{table}/batch={batch_id}" + (f"-{label}" if label else "") + (f"/{part}" if part else "")
        names = [n for n in STORED[table].names if not part.startswith(f"{n}=")]
        conform(df, STORED[table]).select(names).write.mode("overwrite").parquet(f"{self.root}/{path}", compression=CODEC)
        return path

    def write_buckets(self, df: DataFrame, table: str, batch_id: int, part: str, key: str, buckets: int) -> list[str]:
        """Write rows into one folder per bucket of their key; return the folders that hold any."""
        base = f"{table}/batch={batch_id}/{part}/buckets={buckets}"
        names = [n for n in STORED[table].names if not part.startswith(f"{n}=")]
        rows = conform(df, STORED[table]).select(names)
        if buckets == 1:
            rows.write.mode("overwrite").parquet(f"{self.root}/{base}/bucket=0", compression=CODEC)
            return [f"{base}/bucket=0"]
        (
            rows.withColumn("bucket", bucket_of(F.col(key), buckets))
            .hint("rebalance", "bucket")
            .write.mode("overwrite").partitionBy("bucket").parquet(f"{self.root}/{base}", compression=CODEC)
        )
        # Partition values only, bounded by the number of buckets.
        written = self.spark.read.schema(f"{key} bigint, bucket int").parquet(f"{self.root}/{base}")
        return [f"{base}/bucket={r.bucket}" for r in written.select("bucket").distinct().orderBy("bucket").collect()]

    def write_ids(self, df: DataFrame, batch_id: int, label: str = "") -> str:
        """Write the ids of facts in their order, so that row groups hold narrow ranges."""
        ids = df.select("encounter_id").repartitionByRange("encounter_id").sortWithinPartitions("encounter_id")
        return self.write(ids, "fact_ids", batch_id, label=label)

    def write_fact(self, df: DataFrame, batch_id: int, label: str = "new") -> str:
        """Write fact rows by month into one folder and return its path.

        REBALANCE merges small months and splits a hot one, so no task writes a whole
        month alone; rows are sorted by specialty so that row-group statistics prune.
        """
        path = f"fact_encounters/batch={batch_id}/part={label}"
        (
            conform(df, TARGET["fact_encounters"])
            .hint("rebalance", "year_month")
            .sortWithinPartitions("year_month", "specialty_key", "encounter_id")
            .write.mode("overwrite")
            .partitionBy("year_month")
            .parquet(f"{self.root}/{path}", compression=CODEC)
        )
        return path

    def months_of(self, path: str) -> list[str]:
        """Months in a fact folder: partition values only, bounded by the calendar."""
        if "year_month=" in path:
            return [path.rsplit("year_month=", 1)[1]]
        rows = self.read("fact_encounters", Snapshot(0, {"fact_encounters": (path,)}))
        return sorted(r[0] for r in rows.select("year_month").distinct().collect())

    def months_written(self, before: "Snapshot", after: "Snapshot") -> set[str]:
        """Months of the fact folders that are in one snapshot and not in the other.

        A month folder that is left of a folder of the earlier snapshot is nothing new.
        """
        old = set(before.paths.get("fact_encounters", ()))
        fresh = [p for p in after.paths.get("fact_encounters", ()) if p not in old and p.rsplit("/year_month=", 1)[0] not in old]
        return {m for p in fresh for m in self.months_of(p)}

    def without_months(self, paths, months: set[str]) -> tuple[list[str], list[str]]:
        """Split live fact folders into those to keep and those of the given months.

        A folder that holds some of the months is replaced by its month folders.
        """
        kept, dropped = [], []
        for path in paths:
            inside = self.months_of(path)
            folder = path.rsplit("/year_month=", 1)[0]
            if not months.intersection(inside):
                kept.append(path)
                continue
            for month in inside:
                (dropped if month in months else kept).append(f"{folder}/year_month={month}")
        return kept, dropped

    def scratch(self, df: DataFrame, name: str, batch_id: int) -> DataFrame:
        """Write an intermediate result to a new folder and read it back: lineage ends here."""
        path = f"{self.root}/_scratch/batch={batch_id}/{name}-{uuid.uuid4().hex}"
        df.write.parquet(path, compression=CODEC)
        return self.spark.read.schema(df.schema).parquet(path)

    def publish(self, snapshot: Snapshot, batch_id: int, revision: int = 0) -> Snapshot:
        """Make a snapshot the live one; this single small write is the commit.

        A folder of that number can only be left over from a commit that never ended, as
        nobody asks to publish a number again; it is replaced.
        """
        rows = [(t, p) for t, paths in snapshot.paths.items() for p in paths]
        (
            literal_rows(self.spark, rows, _LIST_COLUMNS)
            .coalesce(1)
            .write.mode("overwrite")
            .parquet(f"{self.root}/{_LIST}/batch={batch_id}/revision={revision}")
        )
        return Snapshot(batch_id, snapshot.paths, revision)

    def compact(self) -> Snapshot:
        """Rewrite the folders of facts, bridges and rejects as one each, and publish that.

        The batch number stays, its revision grows: a stream goes on where it was, and
        readers of the old folders are not disturbed. This bounds the list of live folders.
        """
        old = self.snapshot()
        new, revision = old, old.revision + 1
        for table in _GROWING:
            if len(old.paths.get(table, ())) < 2:
                continue
            rows, label = self.read(table, old), f"compact{revision}"
            if table == "fact_encounters":
                path = self.write_fact(rows, old.batch_id, label)
            elif table == "fact_ids":
                path = self.write_ids(rows, old.batch_id, label)
            elif table == "month_visits":
                path = self.write(visits.united(rows, *visits.GROUP), table, old.batch_id, label=label)
            else:
                path = self.write(rows, table, old.batch_id, label=label)
            new = new.replaced(table, [path])
        return old if new is old else self.publish(new, old.batch_id, revision)

    def append_log(self, rows: list[tuple]) -> None:
        """Append step events; each is kept, the newest per step is its state."""
        (
            literal_rows(self.spark, rows, TARGET["etl_log"])
            .coalesce(1)
            .write.mode("append")
            .parquet(f"{self.root}/etl_log")
        )

    def log(self) -> DataFrame:
        stored = self._read_if_there(TARGET["etl_log"], "etl_log")
        return empty(self.spark, "etl_log") if stored is None else stored

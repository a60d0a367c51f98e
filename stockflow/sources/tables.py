"""The three clean tables on disk, and the layout that keeps scans short.

products   one Parquet table
sales      partitioned by `sale_month`, sorted by store and product
inventory  partitioned by `snapshot_date`, sorted by store and product

The partitions stand in for an index on the date, and the order for indexes on store and product:
row groups outside a filter's range are skipped by their minimum and maximum. `INDEXED` columns have Parquet Bloom filters, so that a
look-up of a few keys skips the row groups that do not hold them, in whatever order the rows lie. A manifest names the directories that are the table
now (`manifest.py`), and so the greatest partition value; which ones a write made is observed by the write itself.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema
from ..functions.dates import month
from ..session import clean_up, settings
from . import manifest
from .manifest import WHOLE, Manifest

PARTITIONED_BY = {"products": None, "sales": "sale_month", "inventory": "snapshot_date"}
PARTITION_TYPES = {"sale_month": "string", "snapshot_date": "date"}
#: Columns with a Bloom filter in each row group, sized by what the row group holds (1 MB at most).
INDEXED = {"products": ["product_id"], "sales": ["sale_id", "product_id"], "inventory": ["product_id"]}
#: Columns whose values are nearly all different: a dictionary of them would be begun and given up in each file.
PLAIN = {"products": [], "sales": ["sale_id"], "inventory": []}
#: Shuffled bytes of a task that sorts and writes: rows take some twenty times as much memory as they do compressed.
TASK_BYTES = "16m"
#: How Spark names the directory of a null partition value.
NULL_VALUE = "__HIVE_DEFAULT_PARTITION__"
#: The directory of a single write; each has its own, so that writers do not meet. Its rows lie apart by status: those of the table are CLEAN.
VERSION, STATUS, CLEAN = "v", "status", "clean"


@dataclass(frozen=True)
class Tables:
    products: DataFrame
    sales: DataFrame
    inventory: DataFrame
    # Sales summed by store, genre, format and condition, when a suite has made them beforehand.
    cube: DataFrame | None = None
    # The newest snapshot date of inventory and month of sales, as a table of one row, where a manifest tells them.
    snapshots: DataFrame | None = None
    months: DataFrame | None = None
    # What several results of a suite start from, by name.
    made: dict[str, DataFrame] | None = None


#: Gives rows the columns that follow from their others.
Widen = Callable[[DataFrame], DataFrame]


def layout(df: DataFrame, name: str, widen: Widen | None = None) -> DataFrame:
    """Rows arranged so that each partition directory gets few, evenly sized, sorted files.

    Rebalancing gathers a partition value's rows but splits a value that is much larger than
    the others, so a peak month does not end in one task. The sort within a task begins with the
    partition column, which the writer would have sorted by anyway. Columns that `widen` adds are made after that, so
    that they are neither shuffled nor sorted.
    """
    column = PARTITIONED_BY[name]
    if name == "sales":
        df = df.withColumn("sale_month", month(F.col("sale_date")))
    if column:
        df = df.hint("rebalance", column).sortWithinPartitions(column, "location", "product_id")
    return widen(df) if widen else df


@dataclass(frozen=True)
class Written:
    """Rows that lie below a table and are not part of it yet: the directory of the write, the partition values of each status, and what was observed."""

    name: str
    token: str
    values: dict[str, list[str]]
    observed: dict[str, object]

    def parts(self, status: str = CLEAN) -> dict[str, list[str]]:
        column = PARTITIONED_BY[self.name]
        below = {v: f"/{column}={v}" if column else "" for v in self.values.get(status, [])}
        return {v: [f"{VERSION}={self.token}/{STATUS}={status}{d}"] for v, d in below.items()}

    def directories(self, *statuses: str) -> list[str]:
        return [d for status in statuses for dirs in self.parts(status).values() for d in dirs]


def write_rows(df: DataFrame, root: str, name: str, status: Column | None = None, widen: Widen | None = None, **metrics: Column) -> Written:
    """Write rows below a table without making them part of it; `status` tells them apart.

    Partition values and `metrics` (aggregates over the rows) are observed by the tasks that write, each of which counts once, so nothing is read or
    evaluated a second time. The write's shuffles are let go, and the driver gives back the memory that its bookkeeping took, before the next table's are made.
    """
    column = PARTITIONED_BY[name]
    arranged = layout(df, name, widen).withColumn(STATUS, F.lit(CLEAN) if status is None else status)
    value = F.coalesce(F.col(column).cast("string"), F.lit(NULL_VALUE)) if column else F.lit(WHOLE)
    token, seen = f"w{uuid.uuid4().hex}", Observation()
    observed = arranged.observe(seen, F.collect_set(F.struct(F.col(STATUS), value.alias("value"))).alias("__values"), *[c.alias(n) for n, c in metrics.items()])
    # Only the whole write can be told to size its filters; without it each one has the full size.
    index = {"parquet.bloom.filter.adaptive.enabled": "true"} | {f"parquet.bloom.filter.enabled#{c}": "true" for c in INDEXED[name]}
    index |= {f"parquet.enable.dictionary#{c}": "false" for c in PLAIN[name]}
    with settings(df.sparkSession, adaptive__advisoryPartitionSizeInBytes=TASK_BYTES):
        observed.write.options(**index, compression="zstd").partitionBy(STATUS, *([column] if column else [])).parquet(f"{root}/{name}/{VERSION}={token}")
    found = seen.get
    clean_up(df.sparkSession)
    made: dict[str, list[str]] = {}
    for r in found.pop("__values"):
        made.setdefault(r[STATUS], []).append(r["value"])
    return Written(name, token, made, found)


def read_directories(spark: SparkSession, root: str, name: str, kind: T.StructType, directories: list[str]) -> DataFrame:
    """The rows of some directories below a table, as one table of this layout."""
    if not directories:
        return spark.createDataFrame([], kind)
    reader = spark.read.schema(kind).option("basePath", f"{root}/{name}")
    return reader.parquet(*[f"{root}/{name}/{d}" for d in directories]).select(*kind.names)


def write_table(df: DataFrame, root: str, name: str, widen: Widen | None = None) -> None:
    """Replace a table. Readers see the old one until the new one is whole; its files stay until `manifest.remove_unread`."""
    written = write_rows(df, root, name, widen=widen)
    manifest.commit(df.sparkSession, root, name, lambda now: now.overwritten(written.parts()))


def write_snapshots(df: DataFrame, root: str) -> None:
    """Add inventory snapshots; a snapshot date that is there already is replaced."""
    written = write_rows(df, root, "inventory")
    manifest.commit(df.sparkSession, root, "inventory", lambda now: now.replaced(written.parts()))


def table_schema(name: str, id_type: T.DataType) -> T.StructType:
    kind = getattr(schema, name)(id_type)
    if name == "sales":
        return T.StructType(kind.fields + [T.StructField("sale_month", T.StringType())])
    return kind


def _read(spark: SparkSession, root: str, name: str, id_type: T.DataType) -> tuple[DataFrame, Manifest | None]:
    kind, now = table_schema(name, id_type), manifest.current(spark, root, name)
    if now is None:  # written by something else: the newest partition is then looked for in the table
        return spark.read.schema(kind).parquet(f"{root}/{name}"), None
    return read_directories(spark, root, name, kind, now.directories), now


def read_table(spark: SparkSession, root: str, name: str, id_type: T.DataType = T.StringType()) -> DataFrame:
    """The table as it is now; what is written later does not change it."""
    return _read(spark, root, name, id_type)[0]


def _newest(spark: SparkSession, name: str, now: Manifest | None) -> DataFrame | None:
    if now is None:
        return None
    column = PARTITIONED_BY[name]
    newest = max((v for v in now.parts if v != NULL_VALUE), default=None)
    return spark.sql("SELECT 1").select(F.lit(newest).cast(PARTITION_TYPES[column]).alias(column))


def newest_partition(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    """The greatest partition value of a table as a table of one row, where a manifest tells it."""
    return _newest(spark, name, manifest.current(spark, root, name))


def read_tables(spark: SparkSession, root: str, id_type: T.DataType = T.StringType()) -> Tables:
    products, sales, inventory = (_read(spark, root, name, id_type) for name in PARTITIONED_BY)
    return Tables(
        products[0], sales[0], inventory[0], snapshots=_newest(spark, "inventory", inventory[1]), months=_newest(spark, "sales", sales[1])
    )


#: Keys of a look-up at most: the planner hands them to the scan as a list.
LOOK_UP_KEYS = 10_000


def look_up(table: DataFrame, column: str, keys: list) -> DataFrame:
    """The rows with one of a few keys; on an indexed column, row groups without them are skipped. For many keys a join is the way."""
    if len(keys) > LOOK_UP_KEYS:
        raise ValueError(f"{len(keys)} keys are too many for a look-up: join the table with them")
    return table.filter(F.col(column).isin(*keys) if keys else F.lit(False))


def row_counts(t: Tables) -> DataFrame:
    """(table_name, n_rows) for the three tables; Parquet answers from its footers."""
    counts = [
        getattr(t, name).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name in PARTITIONED_BY
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])

"""Landed orders to sales lines, as a stream of newly landed files.

The stream keeps one row of state for each line (Spark's state store, RocksDB): its newest version and whether it ever had other values. A batch
reads and writes the state of its own lines only; the sink is not read to recognise versions, so a batch costs what it
holds, however long the history. State has no time limit, since a line may be pulled again at any time: nothing is ever too late. It grows with the
number of lines and lies in the checkpoint, of which each batch writes its changes.

The sink holds versions of lines: a line that is pulled again unchanged is not written again, and one that is pulled
again with other values is written as a new version. The version of the newest pull counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from .. import schema
from ..functions.dates import month
from ..operators.dedupe import first_per_key
from ..plans.feed import order_lines
from ..session import clean_up, settings, settle
from ..sources.landed_json import OPEN_FILES, stream_landed

LINES = T.StructType(
    [
        T.StructField("sale_id", T.StringType()),
        T.StructField("sale_date", T.DateType()),
        T.StructField("location", T.StringType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("quantity", schema.WEIGHED),
        T.StructField("unit_price", schema.MONEY),
        T.StructField("discount", schema.MONEY),
    ]
)
VERSIONS = T.StructType(
    LINES.fields
    + [
        T.StructField("pull_date", T.DateType()),
        T.StructField("values", T.LongType()),
        # No earlier batch had the line; null in rows that were written before this was kept.
        T.StructField("is_new", T.BooleanType()),
        T.StructField("sale_month", T.StringType()),
        T.StructField("batch_id", T.LongType()),
    ]
)
# The partition of lines without a date.
NO_DATE = "no-date"
#: Lines of several versions that a reader of all lines looks up one by one; beyond them, every line's versions are grouped.
FEW = 100_000
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # A batch uploads what it changed, not the store.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Lines are mostly digits, which want a code of varying length.
    "spark.sql.streaming.stateStore.compression.codec": "zstd",
    "spark.sql.streaming.stateStore.rocksdb.compression": "zstd",
    # Else each write looks up first whether it adds a row, only to count the rows.
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}


def read_versions(spark: SparkSession, sink: str) -> DataFrame:
    """All versions of all lines; `sale_month` and `batch_id` are partition columns."""
    return spark.read.schema(VERSIONS).parquet(f"{sink}/lines")


def newest_first() -> list[Column]:
    """Of a line's versions, the newest pull first, then the newest batch; the other columns settle ties."""
    return [-F.unix_date("pull_date"), -F.col("batch_id")]


def line_key() -> Column:
    """A line without an id is told by its values."""
    return F.coalesce("sale_id", F.concat(F.lit("#"), F.col("values").cast("string")))


def months_bit() -> Column:
    """The bit of `sale_month` in a set of months: 64 bits, several months may share one."""
    return F.expr("shiftleft(1L, CAST(pmod(xxhash64(sale_month), 64L) AS INT))")


def newest(versions: DataFrame) -> DataFrame:
    """The newest of each line's versions, with the line's key."""
    return first_per_key(versions.withColumn("line", line_key()), ["line"], newest_first())


def read_lines(spark: SparkSession, sink: str) -> DataFrame:
    """The newest version of every line.

    A line of one version has one row, which says that it was new. If few lines have had more, the rows of those lines are grouped, and nothing else is shuffled.
    """
    versions = read_versions(spark, sink).withColumn("line", line_key())
    several = settle(versions.filter("NOT coalesce(is_new, false)").select("line").distinct(), "lines-of-versions")
    if several.count() > FEW:  # from the footers of the files
        return newest(versions).select(*VERSIONS.names)
    one = versions.join(F.broadcast(several), "line", "left_anti")
    more = newest(versions.join(F.broadcast(several), "line", "left_semi"))
    return one.unionByName(more).select(*VERSIONS.names)


def superseded_lines(spark: SparkSession, sink: str) -> DataFrame:
    """The versions that a newer pull replaced."""
    versions, now = read_versions(spark, sink), read_lines(spark, sink)
    same = versions["sale_id"].eqNullSafe(now["sale_id"]) & (versions["values"] == now["values"])
    return versions.join(now, same, "left_anti")


def _write_versions(lines: DataFrame, sink: str) -> None:
    """A dictionary of ids, which are all different, would be begun and given up in each file; a task has few months, whose files are open side by side."""
    writer = lines.select(*VERSIONS.names).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer = writer.options(**{f"parquet.enable.dictionary#{c}": "false" for c in ("sale_id", "values")})
    with settings(lines.sparkSession, maxConcurrentOutputFileWriters=OPEN_FILES):
        writer.partitionBy("sale_month", "batch_id").parquet(f"{sink}/lines")


def touched_lines(orders: DataFrame) -> DataFrame:
    """Of a stream of orders: after each batch, a row for every line that is in it.

    line; newest (its version of the newest pull so far); is_new (no earlier batch had it); changed (it has had several values); months (the bits of
    all that its versions were ever in). Copies inside a batch collapse before the shuffle.

    What is kept of a line has no lists and nothing twice (its id is the key, its month follows from its date), so that grouping sorts plain rows.
    """
    lines = order_lines(orders, "pull_date").withColumn("arrived", F.current_timestamp())  # the batch's time, the same if it runs again
    lines = lines.withColumn("values", F.xxhash64(*LINES.names)).withColumn("sale_month", _month())
    version = F.struct("pull_date", "arrived", "values", F.col("sale_id").isNotNull().alias("has_id"), *LINES.names[1:])
    state = lines.groupBy(line_key().alias("line")).agg(
        F.max(version).alias("newest"),
        F.min("arrived").alias("first"),
        F.max("arrived").alias("last"),
        F.min("values").alias("low"),
        F.max("values").alias("high"),
        F.bit_or(months_bit()).alias("months"),
    )
    return state.select("line", "newest", (F.col("first") == F.col("last")).alias("is_new"), (F.col("low") != F.col("high")).alias("changed"), "months")


def _month() -> Column:
    return F.coalesce(month(F.col("sale_date")), F.lit(NO_DATE))


def fresh_versions(touched: DataFrame, batch_id: int) -> DataFrame:
    """What a batch adds to the sink: the newest version of lines that are new, or that have had other values."""
    fresh = touched.filter("is_new OR changed").select("line", "newest.*", "is_new", "changed", "months")
    made = {"sale_id": F.when(F.col("has_id"), F.col("line")), "sale_month": _month(), "batch_id": F.lit(batch_id).cast("bigint")}
    return fresh.withColumns(made).drop("has_id")


def read_batch(spark: SparkSession, sink: str, batch_id: int) -> DataFrame:
    """What a batch has added to the sink (something, or else there is nothing to read): its own files, whatever the history."""
    reader = spark.read.schema(VERSIONS).option("basePath", f"{sink}/lines")
    return reader.parquet(f"{sink}/lines/sale_month=*/batch_id={batch_id}")


def append_fresh(fresh: DataFrame, sink: str, seen: Observation | None = None, **metrics: Column) -> None:
    """Add versions; a batch that runs again replaces its own output. `seen` gets `metrics` (aggregates over the rows) from the tasks that write."""
    rows = fresh.hint("rebalance", "sale_month")
    _write_versions(rows if seen is None else rows.observe(seen, *[c.alias(n) for n, c in metrics.items()]), sink)


def _ingest(touched: DataFrame, batch_id: int, sink: str) -> None:
    # A stream plans without adaptive execution; the batch's own writes want it for peak months and small files.
    touched.sparkSession.conf.set("spark.sql.adaptive.enabled", True)
    append_fresh(fresh_versions(touched, batch_id), sink)
    clean_up(touched.sparkSession)


def start(spark: SparkSession, landed_root: str, sink: str, handle, files_per_batch: int | None = None) -> StreamingQuery:
    """A stream of the lines touched by newly landed orders through `handle(touched, batch_id)`; it stops once every landed file has been taken in.

    The sink keeps the checkpoint, so a restart goes on where the last run ended.
    """
    for key, value in STATE.items():
        spark.conf.set(key, value)
    _write_versions(spark.createDataFrame([], VERSIONS), sink)
    return (
        touched_lines(stream_landed(spark, landed_root, "orders", files_per_batch))
        .writeStream.outputMode("update")
        .foreachBatch(handle)
        .option("checkpointLocation", f"{sink}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )


def ingest_orders(spark: SparkSession, landed_root: str, sink: str, files_per_batch: int | None = None) -> StreamingQuery:
    """Start the ingest of lines."""
    return start(spark, landed_root, sink, lambda touched, batch_id: _ingest(touched, batch_id, sink), files_per_batch)

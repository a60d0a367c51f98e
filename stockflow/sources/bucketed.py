"""Stock and products bucketed by product, so that their joins and sums per product need no shuffle.

Files of a bucketed table hold the rows of one hash of `product_id` each, which only a catalogue can tell the planner: the tables are
registered under `<prefix>_inventory` and `<prefix>_products`, over files at a given path. Sales are not bucketed: a bucket is read by one
task, and one product may have a third of all sales; they are summed per product and task before they meet the others.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import PARTITIONED_BY, Tables

KEY = "product_id"
#: Rows of a bucket, which one task sorts and writes, and buckets of small tables.
BUCKET_ROWS, LEAST_BUCKETS = 2_000_000, 8


def bucket_count(rows: int) -> int:
    """Buckets for so many rows of both tables together: a bucket does not grow with them."""
    return max(LEAST_BUCKETS, -(-rows // BUCKET_ROWS))


def _write(df: DataFrame, path: str, table: str, partition: str | None, buckets: int) -> DataFrame:
    spark = df.sparkSession
    # Rows are dealt out as the buckets are: a task writes one file per bucket and partition.
    writer = df.repartition(buckets, F.col(KEY)).write.mode("overwrite").format("parquet").option("path", path).bucketBy(buckets, KEY).sortBy(KEY)
    (writer.partitionBy(partition) if partition else writer).saveAsTable(table)
    return spark.table(table).select(*df.columns)


def write_bucketed(t: Tables, root: str, prefix: str, buckets: int) -> Tables:
    """Write stock and products into `buckets` each, and give the tables with those. `buckets`: `bucket_count` of their rows, the same for both."""
    inventory = _write(t.inventory, f"{root}/inventory", f"{prefix}_inventory", PARTITIONED_BY["inventory"], buckets)
    products = _write(t.products, f"{root}/products", f"{prefix}_products", None, buckets)
    return replace(t, inventory=inventory, products=products, made=None)


def read_bucketed(spark: SparkSession, t: Tables, prefix: str) -> Tables:
    """`t` with the bucketed tables that are registered in this session's catalogue."""
    tables = {name: spark.table(f"{prefix}_{name}").select(*getattr(t, name).columns) for name in ("inventory", "products")}
    return replace(t, **tables, made=None)

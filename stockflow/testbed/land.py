"""The driver's tables written once per application as clean tables, raw exports and documents.

Every query then reads what a job would read: partitioned Parquet, CSV or JSON lines. A table, export or
entity is written when a query first asks for it. Sales and stock go into exports and documents as they are made: they are
not shuffled, sorted and written as a clean table that the query does not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.recent import latest_snapshot
from ..session import new_path
from ..sources.landed_json import write_landed
from ..sources.raw_csv import write_raw_csv
from ..sources.tables import PARTITIONED_BY, Tables, newest_partition, read_table, read_tables, write_table
from . import nested, raw, views

ID = T.LongType()

_landed: dict[tuple[str, str, str], object] = {}


def _once(spark: SparkSession, sf_dir: str, kind: str, make):
    key = (spark.sparkContext.applicationId, sf_dir, kind)
    if key not in _landed:
        _landed[key] = make()
    return _landed[key]


def _root(spark: SparkSession, sf_dir: str, kind: str) -> str:
    return _once(spark, sf_dir, kind, lambda: new_path(spark, kind))


def _land_table(spark: SparkSession, sf_dir: str, name: str) -> str:
    root = _root(spark, sf_dir, "tables")
    make, widen = views.NARROW.get(name, (getattr(views, name), None))
    _once(spark, sf_dir, f"tables/{name}", lambda: write_table(make(spark, sf_dir), root, name, widen))
    return root


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the clean tables."""
    return read_table(spark, _land_table(spark, sf_dir, name), name, ID)


def rows(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The rows of a clean table: read, if it has been written, or else made where they are needed."""
    if name == "products" or (spark.sparkContext.applicationId, sf_dir, f"tables/{name}") in _landed:
        return table(spark, sf_dir, name)
    return getattr(views, name)(spark, sf_dir)


def latest_stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest snapshot; its date is that of the newest month end, so stock is not gone through for it."""
    ends = spark.range(1).select(F.explode(views.month_ends(spark, sf_dir)).alias("snapshot_date"))
    return latest_snapshot(rows(spark, sf_dir, "inventory"), ends)


def tables(spark: SparkSession, sf_dir: str) -> Tables:
    def make() -> Tables:
        root = [_land_table(spark, sf_dir, name) for name in PARTITIONED_BY][0]
        return read_tables(spark, root, ID)

    return _once(spark, sf_dir, "all tables", make)


_READ = {"products", "sales", "inventory", "snapshots", "months"}


class AskedTables(Tables):
    """Tables of which each field in _READ is made when it is first asked for."""

    def __getattribute__(self, name: str):
        value = super().__getattribute__(name)
        return value() if name in _READ and callable(value) else value


def asked_tables(spark: SparkSession, sf_dir: str) -> Tables:
    """The clean tables, each landed when a result first asks for it: a roll-up of sales neither waits for stock, nor has its driver the work of writing it."""

    def asked(what: str, name: str, read: Callable[[str], DataFrame]) -> Callable[[], DataFrame]:
        return lambda: _once(spark, sf_dir, f"{what} {name}", lambda: read(name))

    made = {name: asked("read", name, lambda name: table(spark, sf_dir, name)) for name in PARTITIONED_BY}
    newest = {field: asked("newest", name, lambda name: newest_partition(spark, _land_table(spark, sf_dir, name), name)) for field, name in (("snapshots", "inventory"), ("months", "sales"))}
    return _once(spark, sf_dir, "asked tables", lambda: AskedTables(**made, **newest))


def raw_exports(spark: SparkSession, sf_dir: str, *names: str) -> str:
    """The folder of the raw exports, with those of the given tables (all, if none are given)."""
    root = _root(spark, sf_dir, "raw")
    for name in names or PARTITIONED_BY:
        make = getattr(raw, f"raw_{name}")
        _once(spark, sf_dir, f"raw/{name}", lambda: write_raw_csv(make(rows(spark, sf_dir, name)), f"{root}/{name}"))
    return root


_DOCUMENTS = {
    "items": lambda spark, sf_dir: nested.items(spark, sf_dir, table(spark, sf_dir, "products")),
    "orders": lambda spark, sf_dir: nested.orders(rows(spark, sf_dir, "sales")),
    "payments": nested.payments,
    "refunds": nested.refunds,
    "item_stocks": lambda spark, sf_dir: nested.item_stocks(latest_stock(spark, sf_dir)),
}


def documents(spark: SparkSession, sf_dir: str, *entities: str) -> str:
    """The folder of the landed documents, with those of the given entities (all, if none are given)."""
    root = _root(spark, sf_dir, "feed")
    for entity in entities or _DOCUMENTS:
        _once(spark, sf_dir, f"feed/{entity}", lambda: write_landed(_DOCUMENTS[entity](spark, sf_dir), root, entity))
    return root

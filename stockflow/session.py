"""Session settings and the shared work folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_dirs: dict[str, str] = {}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and the bench; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("stockflow")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_dir(spark: SparkSession) -> str:
    """This application's folder below `spark.checkpoint.dir`.

    Tables written here outlive the executors that wrote them. Only a local master may run
    without the setting, and then gets a scratch folder of its own.
    """
    app = spark.sparkContext.applicationId
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        # "local-cluster[...]" has executors of its own, which do not see this process's folder.
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        if app not in _local_dirs:
            _local_dirs[app] = tempfile.mkdtemp(prefix="stockflow-")
        shared = _local_dirs[app]
    return f"{shared.rstrip('/')}/stockflow/{app}"


def new_path(spark: SparkSession, name: str) -> str:
    return f"{work_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """Session settings for one write, by their name after "spark.sql." with "__" for a dot; one that the application has set itself stays."""
    names = {f"spark.sql.{k.replace('__', '.')}": v for k, v in values.items()}
    unset = {k: v for k, v in names.items() if spark.conf.get(k, None) is None}
    for k, v in unset.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k in unset:
            spark.conf.unset(k)


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write `df` and read it back.

    The files cut the lineage, and give the planner a true size, so that a join against a
    small result is broadcast and a join against a large one is not.
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    settled = df.sparkSession.read.schema(df.schema).parquet(path)
    settled._settled_at = path
    return settled


def release(*tables: DataFrame | None) -> None:
    """Delete settled tables that nothing will read any more (what is no settled table is passed over), and clean up."""
    spark = None
    for table in tables:
        path = None if table is None else table.__dict__.pop("_settled_at", None)
        if path:
            spark = table.sparkSession
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(at, True)
    if spark:
        clean_up(spark)


def clean_up(spark: SparkSession) -> None:
    """Let Spark's cleaner remove the shuffles of plans that are gone: it acts when the driver's JVM collects garbage, which may otherwise come late.

    The listeners hold the plan of the last query that ended until another one does, so a query without tasks comes first.
    """
    spark.sql("SELECT 1").collect()
    spark._jvm.System.gc()

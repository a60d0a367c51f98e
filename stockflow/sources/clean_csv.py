"""Clean tables as CSV files, for exchange with tools that do not read Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def write_clean_csv(df: DataFrame, path: str) -> None:
    """A header row, ISO dates without a time of day, plain decimal amounts."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("dateFormat", "yyyy-MM-dd")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def read_clean_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The typed rows back. A value that does not fit its column stops the read."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("escape", '"')
        .option("dateFormat", "yyyy-MM-dd")
        .option("mode", "FAILFAST")
        .csv(path)
    )

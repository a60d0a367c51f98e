"""Raw exports: header row, every column a string, doubled quotes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import clean_up, settings
from .tables import TASK_BYTES

# The texts that pandas reads as missing by default.
NULL_WORDS = (
    "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)
CORRUPT = "corrupt_line"
#: Rows of an export's file at most: a compressed file is read by one task, and Spark gives a task some thirty small files.
ROWS_PER_FILE = 125_000


def read_raw_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    null_words: tuple[str, ...] = (),
    multi_line: bool = False,
    corrupt: bool = False,
) -> DataFrame:
    """An export as strings; empty fields are null, and so are `null_words`.

    A header that differs from the schema stops the read, so that no column is taken for another.
    `multi_line` admits line breaks inside quotes. It is off by default, because a file read that
    way cannot be split between tasks. With `corrupt`, a column holds the text of each row that has
    more or fewer fields than the header; those rows are otherwise read as far as they go.
    """
    kind = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())]) if corrupt else schema
    raw = (
        spark.read.schema(kind)
        .option("header", True)
        .option("enforceSchema", False)
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .csv(path)
    )
    if not null_words:
        return raw
    return raw.select(*[F.when(~F.col(c).isin(*null_words), F.col(c)).alias(c) if c != CORRUPT else F.col(c) for c in raw.columns])


def write_raw_csv(df: DataFrame, path: str) -> None:
    """Write an export where its rows are made, compressed; where they come out of a join that sorts both sides, its tasks take TASK_BYTES."""
    writer = df.write.mode("overwrite").option("header", True).option("escape", '"')
    writer = writer.option("compression", "gzip").option("maxRecordsPerFile", ROWS_PER_FILE)
    writer = writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    with settings(df.sparkSession, adaptive__advisoryPartitionSizeInBytes=TASK_BYTES):
        writer.csv(path)
    clean_up(df.sparkSession)

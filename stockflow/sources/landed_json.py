"""Point-of-sale documents landed as JSON lines: <root>/<entity>/pull_date=.../location=..."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..schema import LANDED
from ..session import clean_up, settings
from .tables import TASK_BYTES

#: Documents of a file at most: a compressed file is read by one task.
DOCUMENTS_PER_FILE = 500_000
#: Stores and pulls that a task writes side by side; rows of more are sorted by them first.
OPEN_FILES = "64"
#: Landed bytes that a batch of the stream takes in (one file at least): some million documents.
BATCH_BYTES = 336 << 20


def read_landed(spark: SparkSession, root: str, entity: str) -> DataFrame:
    """All stores and pulls of one entity; pull date and store come from the directories."""
    return spark.read.schema(LANDED[entity]).json(f"{root}/{entity}")


def read_corrupt(spark: SparkSession, root: str, entity: str) -> DataFrame:
    """Lines that are no document of this entity: what could be read of them, and their text.

    The other readers see null in a field of the wrong type, and nothing of a line that is no JSON.
    """
    kind = LANDED[entity]
    marked = T.StructType(kind.fields + [T.StructField("corrupt_line", T.StringType())])
    docs = spark.read.schema(marked).option("columnNameOfCorruptRecord", "corrupt_line").json(f"{root}/{entity}")
    # Every field is kept, since Spark only finds fault with the fields it is asked for.
    return docs.filter("corrupt_line IS NOT NULL")


def stream_landed(spark: SparkSession, root: str, entity: str, files_per_batch: int | None = None) -> DataFrame:
    """The same documents as a stream of newly landed files, in batches of so many files or else of BATCH_BYTES."""
    reader = spark.readStream.schema(LANDED[entity])
    reader = reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader.option("maxBytesPerTrigger", BATCH_BYTES)
    return reader.json(f"{root}/{entity}")


def write_landed(docs: DataFrame, root: str, entity: str, mode: str = "overwrite") -> None:
    """Land documents, compressed, where they are made: documents are the widest rows there are, so they are neither shuffled nor sorted by store.

    A task has a file open for each store and pull it meets, and begins another when one is full; it compresses at the fastest level. Where the rows come out of a join
    that sorts both sides, its tasks take TASK_BYTES.
    """
    writer = docs.write.mode(mode).option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").option("maxRecordsPerFile", DOCUMENTS_PER_FILE)
    with settings(docs.sparkSession, maxConcurrentOutputFileWriters=OPEN_FILES, adaptive__advisoryPartitionSizeInBytes=TASK_BYTES):
        writer.partitionBy("pull_date", "location").json(f"{root}/{entity}")
    clean_up(docs.sparkSession)

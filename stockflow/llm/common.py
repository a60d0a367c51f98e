"""What several operators share: tables, folds, Arrow slices."""

from __future__ import annotations

import ctypes
import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import stockflow

_shipped: set[str] = set()

#: Texts are worked on in slices of about so many bytes, which bounds a Python worker's memory; a longer text is a slice of its own.
SLICE_BYTES = 2 << 20
#: The same where a pipeline's workers go on to other stages, with what their largest slice took.
SMALL_SLICE_BYTES = 512 << 10


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def ship(spark: SparkSession) -> None:
    """Gives the executors' Python this package, once for an application, as Spark gives them any file."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    top = Path(stockflow.__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="stockflow-"), "stockflow.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for file in sorted(top.rglob("*.py")):
            z.write(file, file.relative_to(top.parent))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(app)


def fold(key: Column, folds: int) -> Column:
    """crc32 of the key as text, modulo `folds`; a null key counts as an empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % folds


def held_out(key: Column, folds: int) -> Column:
    """Rows of fold 2 are held out of learning."""
    return fold(key, folds) == 2


def word_count(text: Column) -> Column:
    """Number of words `[^\\x20\\x09-\\x0D]+`; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def give_back() -> None:
    """Give memory that nothing uses any more back to the system: Spark keeps its Python workers, and their pools keep what they once took."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library only
    if trim:
        trim(0)


#: Rows in a slice at most.
SLICE_ROWS = 8192


def text_slices(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = SLICE_BYTES, rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of each batch, at most `rows`, as many as have at most `most` bytes of text together (one row at least)."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column).cast(pa.large_binary())), 0).to_numpy(zero_copy_only=False)
        start, held = 0, 0
        for i, n in enumerate(sizes):
            if i > start and (held + n > most or i - start >= rows):
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += int(n)
        if len(sizes) > start:
            yield batch.slice(start)
        del batch
        give_back()

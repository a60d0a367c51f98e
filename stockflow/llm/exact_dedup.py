"""Exact dedup by two-pass Bloom filtering.

Pass one hashes every text and counts the cells of a Bloom filter: cells that two rows set remain. Pass two
probes each hash: a row whose cells are not all set has no equal, and passes straight through. Only the
others are shuffled, as (hash, id), to find their groups.

Defined results: a null text is an empty text; texts are equal when their bytes are (told by SHA-256); a null doc_id
is below any other; of rows with the same text and doc_id, one stays; an empty table gives an empty result; further columns
of the input are not looked at, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockflow.llm import bloom
from stockflow.session import settle


def digest(text: Column) -> Column:
    """SHA-256 of the text as it is, 32 bytes; null counts as empty."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def groups(docs: DataFrame, bits_per_key: int = 16, max_filter_bytes: int = 32 << 20) -> DataFrame:
    """For each row: doc_id, keep_id, group_size, kept, text_sha256."""
    prints = settle(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), digest(F.col("text")).alias("sha")).select(
            "doc_id", "sha", F.monotonically_increasing_id().alias("row")
        ),
        "text-prints",
    )
    repeats = bloom.build(prints, F.col("sha"), prints.count(), least=2, bits_per_key=bits_per_key, max_bytes=max_filter_bytes)
    probed = bloom.probe(prints, F.col("sha"), repeats, "maybe")
    single = probed.where("NOT maybe").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "sha"
    )
    unsure = probed.where("maybe").drop("maybe")
    # One row per group, written: the join below can then split the rows of a hot text over tasks.
    best = settle(
        unsure.groupBy(F.col("sha").alias("best_sha")).agg(
            F.max(F.struct("doc_id", "row")).alias("best"), F.count("*").alias("group_size")
        ),
        "text-groups",
    )
    grouped = unsure.join(best, F.col("sha") == F.col("best_sha")).select(
        "doc_id", F.col("best.doc_id").alias("keep_id"), "group_size", (F.col("row") == F.col("best.row")).alias("kept"), "sha"
    )
    return single.unionByName(grouped).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256")
    )


def dedup(docs: DataFrame, **sizes) -> DataFrame:
    """The rows of `docs` that stay, with their columns."""
    key = F.struct(F.col("doc_id").cast("long").alias("id"), digest(F.col("text")).alias("sha"))
    told = settle(groups(docs, **sizes), "text-decisions")
    keys = (
        told.groupBy(F.struct(F.col("doc_id").alias("id"), F.unhex("text_sha256").alias("sha")).alias("key"))
        .agg(F.count("*").alias("rows"), F.count_if("kept").alias("kept"))
        .where("rows > kept")
    )
    gone = settle(keys, "text-gone")
    left = bloom.without(docs, key, gone.select("key"), gone.count())
    # Rows repeated with their doc_id: all of them are gone, and one comes back.
    twins = gone.where("kept > 0").select(F.col("key.id").alias("id"), F.col("key.sha").alias("sha"))
    same = F.col("key.id").eqNullSafe(F.col("id")) & (F.col("key.sha") == F.col("sha"))
    back = docs.select(F.struct("*").alias("row"), key.alias("key")).join(twins, same, "left_semi")
    return left.union(back.dropDuplicates(["key"]).select("row.*")) if twins.take(1) else left

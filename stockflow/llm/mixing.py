"""Mixing sources to target weights by capped water-filling.

Targets: every source is poured words in proportion to its weight; one that reaches `most` times its own size is
clamped there, and what is left is reshared by weight among the others, until none is above its clamp. In
the order of clamp per weight this is one running sum over the sources.

Sampling: a document is taken as often as its source has whole epochs, and a seeded choice of documents once
more, so that the source's words come near the target. The choice is made in passes: documents that still
fit the gap are dealt into seeded bins, whole bins are taken while they fit, and the next pass looks at what
then still fits; in the end one document that is too large is taken if that brings the source nearer to its target. A pass
sums one row per source and bin, so no source is gathered or sorted.

Defined results: size is the number of words (null text: 0); a null source is a source of its own, the last in order; sources
and documents of size 0 have target and taken 0; rows repeated with their doc_id are chosen alike; an empty table gives an
empty result; the choice hangs on `seed` and the doc_id alone, so reruns agree; further columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stockflow.llm.common import word_count
from stockflow.session import settle

WEIGHTS = (5, 2, 1)
BINS = 1024
PASSES = 5


def _bin(doc_id: Column, seed: int, turn: int) -> Column:
    """The document's bin in a pass, 0 to 1023."""
    key = F.concat(F.lit(f"{seed}:{turn}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long") % BINS


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(source, source_size) to source, source_size, target. One row per source is sorted in one task."""
    named = W.orderBy(F.col("source").asc_nulls_last())
    clamped = W.orderBy(F.col("clamp") / F.col("weight"), F.col("place"))
    before = clamped.rowsBetween(W.unboundedPreceding, -1)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.col("place") - 1) % len(weights) + 1).cast("int"))
    everything = W.partitionBy()
    leveled = (
        sizes.withColumn("place", F.row_number().over(named))
        .withColumn("weight", weight)
        .withColumn("clamp", F.col("source_size") * F.lit(float(most)))
        .withColumn("pool", F.sum("source_size").over(everything) * F.lit(float(share)))
        .withColumn("all_weight", F.sum("weight").over(everything))
        .withColumn("used", F.coalesce(F.sum("clamp").over(before), F.lit(0.0)))
        .withColumn("used_weight", F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn("level", (F.col("pool") - F.col("used")) / (F.col("all_weight") - F.col("used_weight")))
        .withColumn("is_clamped", F.col("clamp") <= F.col("level") * F.col("weight"))
        .withColumn("order", F.row_number().over(clamped))
    )
    # The level that holds is that of the first source which is not clamped.
    held = F.min(F.when(~F.col("is_clamped"), F.struct("order", "level"))).over(everything)
    poured = leveled.withColumn("held", held)
    target = F.when(F.col("held").isNull() | (F.col("order") < F.col("held.order")), F.col("clamp")).otherwise(
        F.least(F.col("clamp"), F.col("held.level") * F.col("weight"))
    )
    return poured.select("source", "source_size", target.alias("target"))


def _extra(doc_id: Column, size: Column, seed: int, passes: int) -> Column:
    """Whether one of the first passes took the document, from its source's `gaps` and `cuts`."""
    taken = F.lit(False)
    for i in range(passes):
        taken = taken | ((size <= F.col("gaps")[i]) & (_bin(doc_id, seed, i) < F.col("cuts")[i]))
    return taken & (size > 0)


def _chosen(doc_id: Column, size: Column, seed: int, passes: int) -> Column:
    """Whether the document is taken once more than its source's whole epochs."""
    last = doc_id.eqNullSafe(F.col("last.doc_id")) & (size == F.col("last.size"))
    return _extra(doc_id, size, seed, passes) | F.coalesce(last, F.lit(False))


def plan(sized: DataFrame, weights=WEIGHTS, share: float = 1.5, most: float = 2.0, seed: int = 17, passes: int = PASSES) -> DataFrame:
    """(doc_id, source, size) to a row per source: source_size, target, whole (epochs), gaps, cuts."""
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    state = targets(sizes, weights, share, most).withColumn("whole", whole).select(
        "source", "source_size", "target", "whole",
        F.array(F.round(F.col("target") - F.col("whole") * F.col("source_size")).cast("long")).alias("gaps"),
        F.array().cast("array<long>").alias("cuts"),
    )
    state = settle(state, "mix-targets")
    for i in range(passes):
        known = state.select(F.col("source").alias("of"), "gaps", "cuts")
        fits = sized.join(known, F.col("source").eqNullSafe(F.col("of"))).where(
            (F.col("size") > 0) & (F.col("size") <= F.col("gaps")[i]) & ~_extra(F.col("doc_id"), F.col("size"), seed, i)
        )
        bins = fits.groupBy("of", "gaps", _bin(F.col("doc_id"), seed, i).alias("bin")).agg(F.sum("size").alias("words"))
        running = bins.withColumn("words", F.sum("words").over(W.partitionBy("of").orderBy("bin")))
        cut = running.where(F.col("words") <= F.col("gaps")[i]).groupBy("of").agg(
            (F.max("bin") + 1).alias("cut"), F.max("words").alias("words")
        )
        state = settle(
            state.join(cut, F.col("source").eqNullSafe(F.col("of")), "left").select(
                "source", "source_size", "target", "whole",
                F.concat("gaps", F.array(F.col("gaps")[i] - F.coalesce("words", F.lit(0)))).alias("gaps"),
                F.concat("cuts", F.array(F.coalesce("cut", F.lit(0)))).alias("cuts"),
            ),
            "mix-targets",
        )
    known = state.select(F.col("source").alias("of"), "gaps", "cuts")
    gap = F.col("gaps")[passes]
    near = sized.join(known, F.col("source").eqNullSafe(F.col("of"))).where((F.col("size") > gap) & (F.col("size") < 2 * gap))
    near = near.where(~_extra(F.col("doc_id"), F.col("size"), seed, passes))
    # Rows that repeat a doc_id and size are chosen alike, so they count together.
    whole = near.groupBy("of", gap.alias("gap"), "doc_id", "size").agg((F.count("*") * F.col("size")).alias("words")).where("words < 2 * gap")
    best = F.min_by(F.struct("doc_id", "size"), F.struct("words", _bin(F.col("doc_id"), seed, passes).alias("bin"), "doc_id"))
    last = whole.groupBy("of").agg(best.alias("last"))
    joined = state.join(last, F.col("source").eqNullSafe(F.col("of")), "left").drop("of")
    return settle(joined, "mix-targets")


def repeats(sized: DataFrame, state: DataFrame, seed: int = 17, passes: int = PASSES) -> DataFrame:
    """`sized` with its source's columns and `repeats`, the times that each row is taken."""
    joined = sized.join(state.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")))
    extra = _chosen(F.col("doc_id"), F.col("size"), seed, passes)
    return joined.withColumn("repeats", F.col("whole") + extra.cast("long"))


def _sized(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", word_count(F.col("text")).alias("size"))


def mix(docs: DataFrame, **rule) -> DataFrame:
    """For each row: doc_id, size, source_size, target, taken."""
    sized = settle(_sized(docs), "mix-sizes")
    return repeats(sized, plan(sized, **rule)).select(
        "doc_id", "size", "source_size", "target", (F.col("repeats") * F.col("size")).alias("taken")
    )


def mixed(docs: DataFrame, **rule) -> DataFrame:
    """The rows of `docs`, each as often as the mix takes it."""
    sized = settle(_sized(docs), "mix-sizes")
    state = plan(sized, **rule).select(F.col("source").alias("of"), "whole", "gaps", "cuts", "last")
    size, ident = word_count(F.col("text")), F.col("doc_id").cast("long")
    joined = docs.select(F.struct("*").alias("row"), F.col("source").alias("__source"), ident.alias("__id"), size.alias("__size"))
    joined = joined.join(state, F.col("__source").eqNullSafe(F.col("of")))
    times = F.col("whole") + _chosen(F.col("__id"), F.col("__size"), rule.get("seed", 17), rule.get("passes", PASSES)).cast("long")
    copies = F.array_repeat(F.lit(1), times.cast("int"))
    return joined.select("row", F.explode(copies)).select("row.*")

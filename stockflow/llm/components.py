"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockflow.session import release, settle


#: Links per file of what is written between steps: few links make few tasks, whatever the shuffles' number of partitions.
LINKS_PER_FILE = 500_000


def _stars(links: DataFrame, large: bool, files: int) -> DataFrame:
    """Large: each node's greater neighbours link to its least one; small: its lesser neighbours do, and it itself."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    near = both if large else both.where("b < a")
    # Written, so that the join below deals both sides anew and a node with very many links is split over tasks.
    least = settle(near.groupBy(F.col("a").alias("node")).agg(F.least(F.min("a"), F.min("b")).alias("least")).coalesce(files), "star-least")
    hung = near.join(least, F.col("a") == F.col("node")).where(F.col("b") > F.col("a") if large else F.col("b") != F.col("least"))
    hung = hung.select(F.col("least").alias("a"), "b")
    if not large:
        hung = hung.unionByName(least.where("node != least").select(F.col("least").alias("a"), F.col("node").alias("b")))
    stars = settle(hung.where("a != b").distinct().coalesce(files), "star-links")
    release(least)
    return stars


def components(links: DataFrame, rounds: int = 40) -> DataFrame:
    """(a, b) to (node, component): the least node reachable; nodes without a link have no row.

    Each round halves the distance to the least node at least roughly, so rounds grow with the logarithm of
    the longest chain; each is written, which cuts the lineage.
    """
    links = links.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    whole, seen = settle(links, "links"), None
    files = whole.count() // LINKS_PER_FILE + 1  # stars never have more links than they began with
    links = settle(whole.coalesce(files), "links")
    release(whole)
    for _ in range(rounds):
        large = _stars(links, True, files)
        small = _stars(large, False, files)
        release(links, large)
        links = small
        now = tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"links do not settle within {rounds} rounds")
    ends = links.select(F.col("b").alias("node"), F.col("a").alias("component"))
    return ends.unionByName(links.select(F.col("a").alias("node"), F.col("a").alias("component"))).distinct()

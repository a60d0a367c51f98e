"""Rows that every operator on documents must take: nulls, empty and very long texts, ties, repeated rows, clashing names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

LONG = " ".join(f"w{i}" for i in range(30_000))
ROWS = [
    (1, "one two three four five six seven", "en", "a", 33),
    (2, None, "en", "a", None),
    (3, "", None, None, 0),
    (4, "one two three four five six seven", "fr", "b", 33),
    (4, "one two three four five six seven", "fr", "b", 33),
    (None, "one two three four five six seven", None, "b", 33),
    (5, LONG, "en", "c", len(LONG)),
    (6, LONG + " more", "en", "c", len(LONG) + 5),
    (7, "%%% ### !!! 123", "de", "", 15),
    (8, " \t\r\n ", "de", "c", 5),
    (9, "Été, ΑΒΓ ñandú. 日本語 <|endoftext|> </s> & &lt; <|turn|>", "es", "c", 40),
]
#: Names that operators use in results or on the way.
CLASHING = ["kept", "sha", "maybe", "row", "component_id", "score", "held_out", "size", "of", "target", "gaps", "node", "tile", "length", "predicted", "key", "n", "a.b", "__key", "__maybe", "__gone", "__bits", "hash", "range", "v", "ids", "runs"]


def edge_docs(spark: SparkSession) -> DataFrame:
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string, n_chars long")
    return docs.selectExpr("*", *[f"'x' AS `{c}`" for c in CLASHING])


def no_docs(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")

"""The registered queries of the operators, each over its whole table, and their oracle statements."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockflow.llm import (
    chat,
    embedding_dedup,
    exact_dedup,
    hard_negatives,
    html_text,
    language,
    lm_scoring,
    mixing,
    ngram_join,
    packing,
    pieces,
    runs,
    toxicity,
)
from stockflow.llm.common import read


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return toxicity.scored(docs, toxicity.learn(docs, read(spark, sf_dir, "labels")))


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(read(spark, sf_dir, "documents"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.groups(read(spark, sf_dir, "documents"))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return language.identify(docs, language.learn(docs))


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(read(spark, sf_dir, "embeddings"))


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(read(spark, sf_dir, "pages"))


def op8_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"),
    )
    return chat.read_back(chat.windows(turns.unionByName(planted)))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents"))


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score(read(spark, sf_dir, "documents"))


def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A tenth of the texts are given a repeat: from word a on they go round in p words.
    repeated = """
        CASE WHEN crc32(string(doc_id)) % 10 = 0 AND size(words) > 0 THEN array_join(transform(sequence(0, size(words) - 1), i ->
            words[IF(i < a, i, a + (i - a) % p)]), ' ') ELSE text END
    """
    docs = read(spark, sf_dir, "documents").selectExpr("doc_id", "text", "floor(crc32(string(doc_id)) / 10) g")
    docs = docs.withColumn("words", F.expr(r"IF(crc32(string(doc_id)) % 10 = 0, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+', 0), NULL)"))
    docs = docs.withColumn("a", F.expr("int(g % size(words))")).withColumn("p", F.expr("int(1 + floor((size(words) - a) / (3 + g % 8)))"))
    found = runs.find(docs.select("doc_id", F.expr(repeated).alias("text")))
    best = F.expr("array_sort(runs, (x, y) -> IF(x.length <> y.length, int(sign(y.length - x.length)), IF(x.start <> y.start, int(sign(x.start - y.start)), int(sign(x.period - y.period)))))")
    found = found.withColumn("best", F.get(best, F.lit(0)))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.expr(r"array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op12_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    rows = pieces.round_trip(read(spark, sf_dir, "documents"), model)
    return rows.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "embeddings").where("not exists(embedding, x -> x is null or isnan(x) or abs(x) = double('infinity'))")
    whole = F.transform("embedding", lambda x: F.floor(256 * x.cast("double")))
    label = F.expr("IF(vec_id % 7 = 0, (label + 1) % 10, label)")
    return hard_negatives.mine(hard_negatives.whole_vectors(rows, whole, label), F.col("vec_id") % 100 == 0)


QUERIES = {
    f.__name__: f
    for f in (
        op1_packing, op2_toxicity, op3_ngram_join, op4_exact_dedup, op5_language, op6_embedding_dedup, op7_html_text, op8_chat_windows,
        op9_mixing, op10_lm_scoring, op11_runs, op12_pieces, op13_hard_negatives,
    )
}

ORACLES = {
    "op4_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
    """,
}

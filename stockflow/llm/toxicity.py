"""Toxicity by non-negative positive-unlabelled learning.

Positives are the confirmed toxic documents of the learning folds, the unlabelled set is a sample of all
documents of the learning folds; confirmed clean documents are used for the class prior only. The classifier is linear over
words and word beginnings, and minimises the class-prior-corrected risk
    prior * R_p(+) + max(0, R_u(-) - prior * R_p(-))
with the logistic loss: a batch whose negative part falls below 0 steps back along it.

Bounds (documented parameters): `positives` and `unlabelled` are the expected sizes of the two samples, drawn by a seeded
hash of the doc_id; `features` is the size of the vocabulary chosen from them. Scoring reads every whole text.

Defined results: null and empty texts get the score of a text without any known feature; a null doc_id belongs to a
learning fold; labels that are null or for unknown documents are ignored, repeated labels count as toxic if one of
them is; without a positive or an unlabelled document every score is the prior (0 without labels); further columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockflow.llm.common import SMALL_SLICE_BYTES, held_out, ship, text_slices
from stockflow.llm.words import Words, mix
from stockflow.session import settle

FOLDS = 4
THRESHOLD = 0.3
#: Bytes of a word's beginning that are features beside the whole word.
BEGINNINGS = (4, 5, 6, 7, 8)
#: A feature's count in a text is taken per so many words, in longer texts.
SPAN = 500.0
SEED = 29


def _tallied(doc: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, feature, count), sorted by document."""
    order = np.lexsort((key, doc))
    doc, key = doc[order], key[order]
    new = np.ones(len(key), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (key[1:] != key[:-1])
    at = np.flatnonzero(new)
    return doc[at], key[at], np.diff(np.append(at, len(key)))


def _features(words: Words):
    """(document, feature) of every word, and of the beginnings of every word that is longer."""
    begin, end = words.trimmed()
    yield words.doc, words.hash_of(begin, end)
    for size in BEGINNINGS:
        long = np.flatnonzero(end - begin > size)
        yield words.doc[long], mix(words.hash_of(begin[long], begin[long] + size) + np.uint64(size))


def counted(words: Words, keys: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, feature, count) of all features, or of the sorted `keys` only: then most words drop out before anything is sorted."""
    docs, found = [], []
    if keys is not None:
        slots = np.zeros(1 << 20, bool)
        slots[keys >> np.uint64(44)] = True
    for doc, key in _features(words):
        if keys is not None:
            near = np.flatnonzero(slots[key >> np.uint64(44)])
            place = np.minimum(np.searchsorted(keys, key[near]), len(keys) - 1)
            near = near[keys[place] == key[near]]
            doc, key = doc[near], key[near]
        docs.append(doc)
        found.append(key)
    return _tallied(np.concatenate(docs), np.concatenate(found))


def strength(count: np.ndarray, words: np.ndarray) -> np.ndarray:
    return np.log1p(count / np.maximum(1.0, words / SPAN))


@dataclass(frozen=True)
class Model:
    """Sorted feature hashes with their weights, and the bias."""

    keys: np.ndarray
    weights: np.ndarray
    bias: float

    def known(self, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, feature's index, strength) of the features that the model knows."""
        doc, key, count = counted(words, self.keys)
        return doc, np.searchsorted(self.keys, key), strength(count, np.diff(words.first)[doc])

    def score(self, texts: pa.Array) -> np.ndarray:
        words = Words(texts)
        total = np.full(len(texts), self.bias)
        if len(self.keys):
            doc, at, x = self.known(words)
            total += np.bincount(doc, weights=x * self.weights[at], minlength=len(texts))
        return 1 / (1 + np.exp(-np.clip(total, -40, 40)))


def sample(docs: DataFrame, labels: DataFrame, positives: int, unlabelled: int) -> tuple[DataFrame, float]:
    """(doc_id, text, positive) of the two samples, and the class prior."""
    known = (
        labels.where(~held_out(F.col("doc_id"), FOLDS))
        .where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").cast("long").alias("labelled"))
        .agg(F.max("toxic").alias("toxic"))
    )
    total, toxic = known.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    learn = docs.where(~held_out(F.col("doc_id"), FOLDS)).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    n = learn.count()
    draw = F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1 << 30)) / float(1 << 30)
    drawn = F.pmod(F.xxhash64("labelled", F.lit(SEED + 1)), F.lit(1 << 30)) / float(1 << 30)
    wanted = settle(known.where((F.col("toxic") == 1) & (drawn < positives / max(toxic, 1))).select("labelled"), "toxic-ids")
    # At most about `positives` ids: bounded by the parameter, so they may be broadcast.
    toxic_docs = learn.join(F.broadcast(wanted), F.col("doc_id") == F.col("labelled")).select("doc_id", "text", F.lit(True).alias("positive"))
    others = learn.where(draw < unlabelled / max(n, 1)).select("doc_id", "text", F.lit(False).alias("positive"))
    return settle(toxic_docs.unionByName(others), "toxicity-sample"), toxic / total if total else 0.0


def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many positive and unlabelled texts have each feature."""
    for part in text_slices(batches, most=SMALL_SLICE_BYTES):
        doc, key, _ = counted(Words(part.column("text")))
        positive = part.column("positive").to_numpy(zero_copy_only=False)[doc]
        keys, at = np.unique(key, return_inverse=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys.view(np.int64)), pa.array(np.bincount(at, positive).astype(np.int64)), pa.array(np.bincount(at, ~positive).astype(np.int64))],
            ["key", "p", "u"],
        )


def vocabulary(chosen: DataFrame, features: int) -> np.ndarray:
    """The features whose share differs most between the two samples, by their share of a likelihood ratio test."""
    p_all, u_all = chosen.agg(F.count_if("positive"), F.count_if(~F.col("positive"))).first()
    spread = chosen.select("text", "positive").mapInArrow(_spread, "key long, p long, u long").groupBy("key").agg(F.sum("p").alias("p"), F.sum("u").alias("u"))
    ratio = ((F.col("p") + 0.5) / (p_all + 1)) / ((F.col("u") + 0.5) / (u_all + 1))
    gain = F.abs(F.log(ratio)) * F.when(ratio > 1, F.col("p") / p_all).otherwise(F.col("u") / u_all)
    often = (F.col("p") >= max(4, 0.01 * p_all)) | (F.col("u") >= max(20, 0.02 * u_all))
    top = spread.where(often).orderBy(gain.desc(), "key").limit(features).select("key")
    return np.sort(np.array([r.key for r in top.collect()], np.int64).view(np.uint64))


def train(rows: list[tuple[bool, np.ndarray, np.ndarray]], size: int, prior: float, epochs: int = 60, rate: float = 0.05, decay: float = 5e-4) -> tuple[np.ndarray, float]:
    """Weights and bias of the non-negative risk estimator, by Adam over paired batches of the two samples."""
    rng = np.random.default_rng(SEED)
    sets = [[(at, x) for positive, at, x in rows if positive is kind] for kind in (True, False)]
    w, m, v = np.zeros(size + 1), np.zeros(size + 1), np.zeros(size + 1)
    w[size] = np.log(max(prior, 1e-6) / max(1 - prior, 1e-6))
    batches = max(1, len(sets[1]) // 512)
    step = 0

    def packed(part):
        lengths = np.array([len(at) for at, _ in part])
        return np.repeat(np.arange(len(part)), lengths), np.concatenate([at for at, _ in part] or [[]]).astype(np.int64), np.concatenate([x for _, x in part] or [[]])

    def margin(part):
        doc, at, x = part[:3]
        return np.bincount(doc, w[at] * x, minlength=part[3]) + w[size]

    def gradient(part, each):
        doc, at, x = part[:3]
        g = np.bincount(at, each[doc] * x, minlength=size + 1)[: size + 1]
        g[size] += each.sum()
        return g

    orders = [rng.permutation(len(s)) for s in sets]
    parts = [[(*packed([sets[k][i] for i in orders[k][b::batches]]), len(orders[k][b::batches])) for b in range(batches)] for k in (0, 1)]
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -40, 40)))
    for _ in range(epochs):
        for b in rng.permutation(batches):
            p, u = parts[0][b], parts[1][b]
            if not p[3] or not u[3]:
                continue
            step += 1
            zp, zu = margin(p), margin(u)
            negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
            g_negative = gradient(u, sigmoid(zu) / u[3]) - prior * gradient(p, sigmoid(zp) / p[3])
            g = prior * gradient(p, (sigmoid(zp) - 1) / p[3]) + g_negative if negative >= 0 else -g_negative
            g[:size] += decay * w[:size]
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    # The mean score of the unlabelled texts is the prior.
    whole = (*packed(sets[1]), len(sets[1]))
    z, low, high = margin(whole), -30.0, 30.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if sigmoid(z + middle).mean() < prior else (low, middle)
    return w[:size], float(w[size] + (low + high) / 2)


def learn(docs: DataFrame, labels: DataFrame, positives: int = 6000, unlabelled: int = 18000, features: int = 2048) -> Model:
    ship(docs.sparkSession)
    chosen, prior = sample(docs, labels, positives, unlabelled)
    keys = vocabulary(chosen, features)
    blank = Model(np.zeros(0, np.uint64), np.zeros(0), float(np.log(max(prior, 1e-9) / max(1 - prior, 1e-9))))
    if not len(keys):
        return blank
    model = Model(keys, np.zeros(len(keys)), 0.0)

    def known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, most=SMALL_SLICE_BYTES):
            doc, at, x = model.known(Words(part.column("text")))
            cuts = np.searchsorted(doc, np.arange(part.num_rows + 1))
            columns = (part.column("positive").to_numpy(zero_copy_only=False), cuts.astype(np.int32), at.astype(np.int32), x.astype(np.float32))
            yield pa.RecordBatch.from_arrays([pa.array([c.tobytes()], pa.binary()) for c in columns], ["positive", "cuts", "at", "x"])

    # A row per slice of texts: the samples and the vocabulary are bounded by their parameters, so this is too.
    found = chosen.select("doc_id", "text", "positive").mapInArrow(known, "positive binary, cuts binary, at binary, x binary")
    rows = []
    for r in found.toLocalIterator():
        kinds, cuts, at, x = (np.frombuffer(v, t) for v, t in ((r.positive, bool), (r.cuts, np.int32), (r.at, np.int32), (r.x, np.float32)))
        rows += [(bool(k), at[i:j], x[i:j]) for k, i, j in zip(kinds, cuts[:-1], cuts[1:], strict=True)]
    rows.sort(key=lambda r: (not r[0], len(r[1]), r[1].tobytes(), r[2].tobytes()))  # whatever order tasks ended in
    if not any(r[0] for r in rows) or all(r[0] for r in rows):
        return blank
    return Model(keys, *train(rows, len(keys), prior))


def scorer(model: Model):
    """A column function: the score of a text."""

    @F.arrow_udf("double")
    def score(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for array in texts:
            batch = pa.RecordBatch.from_arrays([array], ["text"])
            yield pa.array(np.concatenate([model.score(p.column("text")) for p in text_slices([batch], most=SMALL_SLICE_BYTES)] or [np.zeros(0)]))

    return score


def scored(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """For each row: doc_id, held_out, score, predicted."""
    score: Column = scorer(model)(F.col("text"))
    return docs.select("doc_id", held_out(F.col("doc_id"), FOLDS).alias("held_out"), score.alias("score")).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int")
    )


def without_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    return docs.where(scorer(model)(F.col("text")) < threshold)

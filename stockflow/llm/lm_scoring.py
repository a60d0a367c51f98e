"""Bigram language model in Elias-Fano tries, trained and queried in shards.

1. Texts become chunks: the distinct words of some thousand texts, and the texts as numbers of these words. A chunk is a row.
2. A chunk sends each distinct word and each distinct (word, word before) once, with its count in the learning folds, to the
   shard that the key's hash names. However often a pair occurs, a chunk sends it once, so no shard is hot.
3. A shard adds up the counts, builds its trie (words, then contexts searched relative to the word; counts as one-byte codes, exact to
   100 and on a logarithmic scale beyond), memory-maps it and answers the chunks' keys in their order.
4. A chunk and its answers meet, and its texts are scored:
       p(w | v) = (1 - mix) * c(v w) / c(v) + mix * (c(w) + 1) / (N + V + 1)
   smoothed by a weight that falls with the evidence on v: mix = 1 / (1 + strength * log2(1 + c(v))); V counts the distinct words and the end,
   one more type stands for all unknown words, a text begins after a start mark, and p sums to 1 over words, up to the rounding of the codes.
Everything is counted over all learning documents; chunks and shards grow in number with the input, not in size.

Defined results: null and empty texts are the end alone; a null doc_id belongs to a learning fold and is carried through; repeated
rows are learned and scored as often as they occur; an empty table gives an empty result; further columns are not looked at.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockflow.llm.common import held_out, ship, text_slices
from stockflow.llm.elias_fano import Trie
from stockflow.llm.words import Words, mix
from stockflow.session import settle

FOLDS = 7
#: Words of a chunk; a longer text is a chunk of its own.
CHUNK = 2_000_000
#: Keys of a shard, about.
SHARD = 3_000_000
#: What stands before a text's first word and after its last, as 32-bit names.
START, END = np.uint64(0x5354_4152), np.uint64(0x454E_4453)
#: Counts up to here have codes of their own.
EXACT = 100
RATIO = 1.13
NO_ID = np.iinfo(np.int64).min


def codes(counts: np.ndarray) -> np.ndarray:
    """One-byte codes of counts: 0 to `EXACT` themselves, then steps of `RATIO`."""
    beyond = EXACT + np.rint(np.log(np.maximum(counts, EXACT) / EXACT) / np.log(RATIO))
    return np.minimum(np.where(counts <= EXACT, counts, beyond), 255).astype(np.uint8)


def decoded(code: np.ndarray) -> np.ndarray:
    code = code.astype(np.float64)
    return np.where(code <= EXACT, code, EXACT * RATIO ** (code - EXACT))


def pressed(a: np.ndarray) -> bytes:
    """Numbers as planes of their bytes, compressed; planes that hardly change cost little."""
    planes = np.ascontiguousarray(a.view(np.uint8).reshape(-1, a.itemsize).T).tobytes()
    return len(planes).to_bytes(8, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def pressed_out(data: bytes, kind) -> np.ndarray:
    size = int.from_bytes(data[:8], "little")
    planes = np.frombuffer(pa.decompress(data[8:], size, codec="zstd", asbytes=True), np.uint8) if size else np.zeros(0, np.uint8)
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(planes.reshape(width, -1).T).view(kind).ravel()


class Chunk:
    """Texts as numbers of distinct words. `words`: their hashes, sorted; `tokens`: numbers; `sizes`: words of each text."""

    def __init__(self, ids: np.ndarray, held: np.ndarray, sizes: np.ndarray, words: np.ndarray, tokens: np.ndarray):
        self.ids, self.held, self.sizes, self.words, self.tokens = ids, held, sizes, words, tokens

    @classmethod
    def of(cls, parts: list[tuple]) -> Chunk:
        ids, held, sizes, hashes = (np.concatenate(x) for x in zip(*parts, strict=True))
        words, tokens = np.unique(hashes, return_inverse=True)
        return cls(ids, held, sizes, words, tokens.astype(np.uint32))

    def row(self, chunk: int) -> list:
        # Frequent words get small numbers while stored, which compress well.
        often = np.argsort(-np.bincount(self.tokens, minlength=len(self.words)), kind="stable")
        rank = np.empty(len(often), np.uint32)
        rank[often] = np.arange(len(often), dtype=np.uint32)
        learned = ~self.held
        return [
            chunk, int(self.sizes[learned].sum()), int(learned.sum()), len(self.words), len(self.tokens) + len(self.ids),
            pressed(self.ids), self.held.tobytes(), pressed(self.sizes), pressed(self.words[often]), pressed(rank[self.tokens]),
        ]

    @classmethod
    def read(cls, row: dict) -> Chunk:
        often = pressed_out(row["words"], np.uint64)
        order = np.argsort(often)
        number = np.empty(len(order), np.uint32)
        number[order] = np.arange(len(order), dtype=np.uint32)
        held = np.frombuffer(row["held"], bool)
        return cls(pressed_out(row["ids"], np.int64), held, pressed_out(row["sizes"], np.int32), often[order], number[pressed_out(row["tokens"], np.uint32)])

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.sizes)), self.sizes)

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """(text, word << 32 | word before) of all words and ends, text by text."""
        name = self.words >> np.uint64(32)
        text = np.repeat(np.arange(len(self.sizes)), self.sizes + 1)
        last = np.cumsum(self.sizes + 1) - 1
        word = np.full(len(text), END, np.uint64)
        inside = np.ones(len(text), bool)
        inside[last] = False
        word[inside] = name[self.tokens]
        before = np.empty(len(text), np.uint64)
        before[1:] = word[:-1]
        before[np.concatenate([[0], last[:-1] + 1])] = START
        return text, (word << np.uint64(32)) | before

    def messages(self, shards: tuple[int, int]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(level, shard, sorted keys, their learned counts); `answers` come back in the same order."""
        learned = ~self.held
        counts = np.bincount(self.tokens, np.repeat(learned, self.sizes), minlength=len(self.words)).astype(np.int64)
        yield from self._dealt(1, self.words, counts, shards[0])
        text, pairs = self.pairs()
        keys, at = np.unique(pairs, return_inverse=True)
        self.pair_text, self.pair_at, self.pair_keys = text, at, keys
        yield from self._dealt(2, keys, np.bincount(at, learned[text], minlength=len(keys)).astype(np.int64), shards[1])

    @staticmethod
    def _dealt(level: int, keys: np.ndarray, counts: np.ndarray, shards: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        shard = (mix(keys) % np.uint64(shards)).astype(np.int64)
        order = np.argsort(shard, kind="stable")
        cuts = np.searchsorted(shard[order], np.arange(shards + 1))
        for s in range(shards):
            if cuts[s + 1] > cuts[s]:
                at = order[cuts[s] : cuts[s + 1]]
                yield level, s, keys[at], counts[at]

    def scores(self, answers: dict[tuple[int, int], bytes], shards: tuple[int, int], n: int, v: int, texts: int, strength: float) -> list[np.ndarray]:
        """doc_id, held_out, tokens, known, base, score; n: learned tokens, v: distinct ones, texts: learned texts."""
        told = {1: np.zeros(0), 2: np.zeros(0)}
        for level, shard, keys, _ in self.messages(shards):
            if not len(told[level]):
                told[level] = np.zeros(len(self.words) if level == 1 else len(self.pair_keys))
                place = self.words if level == 1 else self.pair_keys
            value = np.frombuffer(answers[level, shard], np.int64).astype(np.float64) if level == 1 else decoded(np.frombuffer(answers[level, shard], np.uint8))
            told[level][np.searchsorted(place, keys)] = value
        single = np.append(told[1], texts)  # the end is a word that every learned text has once
        number = np.full(len(self.pair_text), len(self.words))
        last = np.cumsum(self.sizes + 1) - 1
        inside = np.ones(len(number), bool)
        inside[last] = False
        number[inside] = self.tokens
        before = np.empty(len(number), np.int64)
        before[1:] = number[:-1]
        before[np.concatenate([[0], last[:-1] + 1])] = len(self.words)  # a start for every learned text
        c_word, c_before, c_pair = single[number], single[before], told[2][self.pair_at]
        base = np.log10((c_word + 1) / (n + v + 1))
        seen = c_before > 0
        weight = np.where(seen, 1 / (1 + strength * np.log2(1 + c_before)), 1.0)
        ratio = np.minimum(c_pair / np.maximum(c_before, 1), 1.0)
        score = np.log10((1 - weight) * ratio + weight * (c_word + 1) / (n + v + 1))
        each = lambda x: np.bincount(self.pair_text, x, minlength=len(self.sizes))
        return [self.ids, self.held, self.sizes.astype(np.int64) + 1, each(c_word > 0).astype(np.int64), each(base), each(score)]


CHUNK_SCHEMA = "chunk long, learned long, texts long, distinct_words long, all_words long, ids binary, held binary, sizes binary, words binary, tokens binary"
_CHUNK_NAMES = [x.split()[0] for x in CHUNK_SCHEMA.split(", ")]


def chunks(docs: DataFrame, chunk: int = CHUNK) -> DataFrame:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held, number = [], 0, TaskContext.get().partitionId() << 24

        def packed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([x]) for x in Chunk.of(parts).row(number)], _CHUNK_NAMES)

        for part in text_slices(batches):
            words = Words(part.column("text"))
            ids = part.column("doc_id").fill_null(NO_ID).to_numpy()
            if parts and held + len(words) > chunk:
                yield packed()
                parts, held, number = [], 0, number + 1
            parts.append((ids, part.column("held").to_numpy(zero_copy_only=False), np.diff(words.first).astype(np.int32), words.hash))
            held += len(words) + len(ids)
        if parts:
            yield packed()

    rows_in = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id"), FOLDS).alias("held"), "text")
    return settle(rows_in.mapInArrow(rows, CHUNK_SCHEMA), "lm-chunks")


def _chunk_rows(table: pa.Table | pa.RecordBatch) -> Iterator[dict]:
    for i in range(table.num_rows):
        yield table.slice(i, 1).to_pylist()[0]


def _answered(level: int, table: pa.Table) -> tuple[list, int]:
    """A shard's work: adds up the counts, builds the trie, answers every chunk; and the number of learned keys."""
    sent = [pressed_out(x.as_py(), np.uint64) for x in table.column("keys")]
    counted = [pressed_out(x.as_py(), np.int32) for x in table.column("counts")]
    every, count = np.concatenate(sent), np.concatenate(counted)
    order = np.argsort(every, kind="stable")
    every, count = every[order], count[order]
    first = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]]))
    total = np.add.reduceat(count.astype(np.int64), first)
    known = total > 0
    keys, total = every[first][known], total[known]
    handle, file = tempfile.mkstemp(suffix=".trie")
    os.close(handle)
    try:
        trie = Trie(file, keys, total if level == 1 else codes(total))
        answers = [trie.value(x).tobytes() for x in sent]
        del trie
    finally:
        os.unlink(file)
    return answers, len(keys)


def answers(told: DataFrame, shards: tuple[int, int]) -> DataFrame:
    """(chunk, level, shard, answer, known): a row per message; known is set in one row per shard."""

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _chunk_rows(batch):
                found = [(row["chunk"], level, s, pressed(k), pressed(c.astype(np.int32))) for level, s, k, c in Chunk.read(row).messages(shards)]
                if found:
                    columns = [pa.array(x, t) for x, t in zip(zip(*found, strict=True), (pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary()), strict=True)]
                    yield pa.RecordBatch.from_arrays(columns, ["chunk", "level", "shard", "keys", "counts"])

    def answered(table: pa.Table) -> pa.Table:
        found, known = _answered(table.column("level")[0].as_py(), table)
        first = [known] + [0] * (len(found) - 1)
        return pa.table({"chunk": table.column("chunk"), "level": table.column("level"), "shard": table.column("shard"), "answer": pa.array(found, pa.binary()), "known": pa.array(first, pa.int64())})

    messages = told.mapInArrow(sent, "chunk long, level int, shard long, keys binary, counts binary")
    replies = messages.groupBy("level", "shard").applyInArrow(answered, "chunk long, level int, shard long, answer binary, known long")
    return settle(replies, "lm-answers")


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def score(docs: DataFrame, strength: float = 0.05, chunk: int = CHUNK, shard: int = SHARD) -> DataFrame:
    """For each row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    ship(docs.sparkSession)
    told = chunks(docs, chunk)
    learned, texts, distinct, every = told.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("learned", "texts", "distinct_words", "all_words")]).first()
    shards = (max(1, -(-distinct // shard)), max(1, -(-every // shard)))
    replies = answers(told, shards)
    n = learned + texts
    v = replies.where("level = 1").agg(F.coalesce(F.sum("known"), F.lit(0))).first()[0] + (texts > 0)

    def scored(chunk_rows: pa.Table, reply: pa.Table) -> pa.Table:
        found = {(level, s): a for level, s, a in zip(*(reply.column(c).to_pylist() for c in ("level", "shard", "answer")), strict=True)}
        names = [x.split()[0] for x in SCORES.split(", ")]
        parts = [pa.table(dict(zip(names, Chunk.read(row).scores(found, shards, n, v, texts, strength), strict=True))) for row in _chunk_rows(chunk_rows)]
        return pa.concat_tables(parts)

    both = told.groupBy("chunk").cogroup(replies.select("chunk", "level", "shard", "answer").groupBy("chunk")).applyInArrow(scored, SCORES)
    doc = F.when(F.col("doc_id") != NO_ID, F.col("doc_id")).alias("doc_id")
    return both.select(doc, "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score")

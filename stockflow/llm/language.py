"""Language identification by cross-parsing entropy.

For each language a suffix automaton of labelled text accepts every substring of it. A text is parsed from left to right into
the longest phrases that the automaton accepts; a language's bits per character are phrases * log2(labelled length) / length, and the
language with the fewest wins (the first by name in a tie). Parsing walks all automata over all texts of a slice at once, a
character a step, by look-up of (state, character) in a hash table.

Texts are parsed whole, in blocks of `BLOCK` characters that phrases do not cross. Case is folded, characters other
than letters are one separator, letters that no language has seen end a phrase.

Bound (documented parameter): `chars`, the labelled characters taken from a language: documents of the learning folds in a seeded
order, whatever their length; of the one that exceeds what is left, a seeded stretch with a letter in it.

Defined results: `und` with score 0 for a null text, a text without a letter, or without any labelled language; rows with null or
empty lang or text teach nothing; a null doc_id belongs to a learning fold; repeated rows get the same result; further columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockflow.llm.common import held_out, ship, text_slices
from stockflow.session import settle

FOLDS = 4
SEED = 31
BLOCK = 1024
#: Bits of difference per character that make a language e times as likely, inverted; shapes the score only.
SHARPNESS = 6.0

_letters: list[np.ndarray] = []


def letters() -> np.ndarray:
    """Whether each code point is a letter."""
    if not _letters:
        _letters.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _letters[0]


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def automaton(symbols: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """The suffix automaton of a sequence: its ways as states, symbols and the states they lead to, and the number of states. 0 is the start."""
    step: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for s in symbols:
        new = len(step)
        step.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and s not in step[p]:
            step[p][s] = new
            p = link[p]
        if p >= 0:
            q = step[p][s]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                copy = len(step)
                step.append(dict(step[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                link[q] = link[new] = copy
                while p >= 0 and step[p].get(s) == q:
                    step[p][s] = copy
                    p = link[p]
        last = new
    ways = np.array([(state, s, to) for state, ways in enumerate(step) for s, to in ways.items()], np.int64).reshape(-1, 3)
    return ways[:, 0], ways[:, 1], ways[:, 2], len(step)


class Ways:
    """(state, symbol) to state, as a hash table with open addressing: memory goes with the ways, not with states times letters."""

    def __init__(self, keys: np.ndarray, states: np.ndarray):
        size = 1 << max(4, int(2 * len(keys)).bit_length())
        self.last = np.int64(size - 1)
        self.shift = np.uint64(64 - (size.bit_length() - 1))
        self.keys, self.states = np.full(size, -1, np.int64), np.full(size, -1, np.int32)
        at, left = self._place(keys), np.arange(len(keys))
        while len(left):
            # Of those that want a free place the first one gets it; the others try the next place.
            free = left[self.keys[at[left]] < 0]
            _, first = np.unique(at[free], return_index=True)
            won = free[first]
            self.keys[at[won]], self.states[at[won]] = keys[won], states[won]
            left = np.setdiff1d(left, won, assume_unique=True)
            at[left] = (at[left] + 1) & self.last

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The states that the ways lead to; -1: there is no such way."""
        at = self._place(keys)
        there = self.keys[at]
        found = np.where(there == keys, self.states[at], np.int32(-1))
        left = np.flatnonzero((there != keys) & (there >= 0))
        at = at[left]
        while len(left):
            at = (at + 1) & self.last
            there = self.keys[at]
            hit = there == keys[left]
            found[left[hit]] = self.states[at[hit]]
            on = ~hit & (there >= 0)
            left, at = left[on], at[on]
        return found


class Parser:
    """Automata of all languages in one table. Symbol 0 is the separator, 1 a letter that no language has seen.

    Memory: some 30 bytes for each way, of which a language's automaton has three per labelled character at most; so it grows with the number of languages (at
    most 4 MB each with the default bound), not with their letters.
    """

    def __init__(self, samples: dict[str, str]):
        self.names = sorted(samples)
        folded = {name: samples[name].lower() for name in self.names}
        seen = sorted({c for text in folded.values() for c in text if c.isalpha()})
        self.symbol = np.where(letters(), 1, 0).astype(np.int32)
        for i, c in enumerate(seen):
            self.symbol[ord(c)] = i + 2
            if len(c.upper()) == 1 and c.upper().lower() == c:
                self.symbol[ord(c.upper())] = i + 2
        self.alphabet = len(seen) + 2
        keys, states, self.roots, self.bits, base = [], [], [], [], 0
        for name in self.names:
            symbols, _ = self.symbols([folded[name]])
            state, symbol, to, n = automaton(symbols.tolist())
            keys.append((state + base) * self.alphabet + symbol)
            states.append(to + base)
            self.roots.append(base)
            self.bits.append(np.log2(max(len(symbols), 2)))
            base += n
        self.ways = Ways(np.concatenate(keys), np.concatenate(states)) if keys else None
        # All ways from the roots, which are asked for after every phrase.
        self.first = np.full((len(self.names), self.alphabet), -1, np.int64)
        for k, root in enumerate(self.roots):
            self.first[k] = self.ways.find(root * self.alphabet + np.arange(self.alphabet, dtype=np.int64))

    def symbols(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of all texts, runs of separators as one, and the n + 1 offsets."""
        points = code_points("".join(texts))
        symbols = self.symbol[points]
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        first = np.zeros(len(points), bool)
        first[offsets[:-1][offsets[:-1] < len(points)]] = True
        keep = symbols != 0
        keep[1:] |= symbols[:-1] != 0
        keep |= first
        upto = np.concatenate([[0], np.cumsum(keep)])
        return symbols[keep], upto[offsets]

    def phrases(self, symbols: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Phrases of each text in each language."""
        texts, langs = len(offsets) - 1, len(self.names)
        blocks = -(-np.diff(offsets) // BLOCK)
        text = np.repeat(np.arange(texts), blocks)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        begin = offsets[text] + nth * BLOCK
        size = np.minimum(BLOCK, offsets[text + 1] - begin)
        order = np.argsort(-size, kind="stable")
        begin, size, text = begin[order], size[order], text[order]
        # Blocks in order of length: those still going on are always the first ones.
        going = np.searchsorted(-size, -np.arange(BLOCK), side="left")
        root = np.array(self.roots, np.int64)
        state = np.tile(root, (len(text), 1))
        count = np.zeros((len(text), langs), np.int32)
        fresh = np.ones((len(text), langs), bool)  # the next character begins a phrase
        width = self.alphabet
        for t in range(int(size[0]) if len(size) else 0):
            n = int(going[t])
            s = symbols[begin[:n] + t].astype(np.int64)[:, None]
            following = self.ways.find((state[:n] * width + s).ravel()).astype(np.int64).reshape(n, langs)
            stuck = following < 0
            count[:n] += stuck | fresh[:n]
            if stuck.any():
                following = np.where(stuck, self.first[:, s[:, 0]].T, following)
            # A character that the language does not have is a phrase by itself.
            fresh[:n] = following < 0
            state[:n] = np.where(following < 0, root, following)
        total = np.zeros((texts, langs), np.int64)
        np.add.at(total, text, count)
        return total

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        given = [t or "" for t in texts]
        points = code_points("".join(given))
        upto = np.concatenate([[0], np.cumsum(letters()[points])])
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in given])]).astype(np.int64)
        spoken = upto[offsets[1:]] > upto[offsets[:-1]]
        if not self.names:
            return ["und"] * len(texts), np.zeros(len(texts))
        symbols, cuts = self.symbols(given)
        bits = self.phrases(symbols, cuts) * np.array(self.bits) / np.maximum(np.diff(cuts), 1)[:, None]
        best = bits.argmin(axis=1)
        share = np.exp(-SHARPNESS * (bits - bits.min(axis=1, keepdims=True)))
        score = np.where(spoken, 1 / share.sum(axis=1), 0.0)
        return [self.names[b] if s else "und" for b, s in zip(best, spoken, strict=True)], score


_parsers: dict[tuple, Parser] = {}


def parser(samples: dict[str, str]) -> Parser:
    """One parser per Python worker; building it from the bounded samples takes about a second."""
    key = tuple(sorted(samples.items()))
    if key not in _parsers:
        _parsers.clear()
        _parsers[key] = Parser(samples) if samples else None
    return _parsers[key]


def stretch(text: Column, n: Column, draw: Column, take: Column) -> Column:
    """`take` characters of a text of n from a seeded place on, or from its first letter on if there is none in them."""
    some = F.substring(text, (F.pmod(draw, n - take + 1) + 1).cast("int"), take)
    return F.when(some.rlike(r"\p{L}"), some).otherwise(F.substring(F.regexp_extract(text, r"(?s)\p{L}.*", 0), F.lit(1), take))


def learn(docs: DataFrame, chars: int = 40_000, drawn: int = 400) -> dict[str, str]:
    """Labelled text of each language: about `drawn` documents per language are looked at, `chars` characters kept."""
    draw = F.xxhash64("doc_id", "text", F.lit(SEED))
    taught = docs.where(~held_out(F.col("doc_id"), FOLDS) & F.col("lang").isNotNull() & (F.col("lang") != "") & F.col("text").rlike(r"\p{L}"))
    taught = settle(taught.select(F.col("lang").alias("name"), F.length("text").alias("n"), draw.alias("draw")), "language-candidates")
    counts = settle(taught.groupBy(F.col("name").alias("of")).agg(F.count("*").alias("docs"), F.min("draw").alias("least")), "language-counts")
    chance = F.pmod("draw", F.lit(1 << 30)) / float(1 << 30)
    # About `drawn` rows of each language come to the driver, and their ids go out again; the first one always, as copies are drawn together.
    few = taught.join(counts, F.col("name") == F.col("of")).where((chance < F.lit(float(drawn)) / F.col("docs")) | (F.col("draw") == F.col("least")))
    room: dict[str, int] = {}
    wanted = []
    for r in few.select("name", "draw", "n").distinct().orderBy("name", "draw").collect():
        take = min(room.setdefault(r.name, chars), r.n)
        if take:
            room[r.name] -= take
            wanted.append((r.name, r.draw, take))
    if not wanted:
        return {}
    ids = F.broadcast(docs.sparkSession.createDataFrame(wanted, "name string, key long, take int"))
    told = docs.select("lang", "text", "doc_id").withColumn("draw", draw)
    told = told.join(ids, (F.col("lang") == F.col("name")) & (F.col("draw") == F.col("key")))
    texts = told.select("name", stretch(F.col("text"), F.length("text"), F.col("draw"), F.col("take")).alias("text")).distinct()
    found: dict[str, list[str]] = {}
    for r in sorted(map(tuple, texts.collect())):
        found.setdefault(r[0], []).append(r[1])
    return {name: " ".join(t) for name, t in found.items()}


def identify(docs: DataFrame, samples: dict[str, str]) -> DataFrame:
    """For each row: doc_id, held_out, lang_pred, score."""
    ship(docs.sparkSession)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = parser(samples)
        for part in text_slices(batches):
            texts = part.column("text").to_pylist()
            name, score = known.predict(texts) if known else (["und"] * len(texts), np.zeros(len(texts)))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(name, pa.string()), pa.array(score, pa.float64())], ["doc_id", "lang_pred", "score"])

    told = docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(rows, "doc_id long, lang_pred string, score double")
    return told.select("doc_id", held_out(F.col("doc_id"), FOLDS).alias("held_out"), "lang_pred", "score")

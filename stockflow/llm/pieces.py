"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies, by an agenda of adjacent symbol pairs.

A text's spaces become marks (U+2581) with one in front; each character is a symbol. Every pair of neighbours that together are a
piece stands on an agenda, best score first, the leftmost of equals. The best pair becomes one symbol, its new neighbours join the
agenda, and entries whose symbols have changed since are passed over, until none is left. Symbols that are no piece become the byte
pieces of their UTF-8.

A pair of characters that lies next to each other in no piece can never be merged across, so the text is cut at such pairs and each stretch has an
agenda of its own; that gives the same symbols as one agenda for the whole text. Answers for short stretches are kept, since words
come back: at most `KEPT` of them in a worker.

In each Arrow batch the answers for stretches that are new are compared with the sentencepiece library's, for each stretch as a text of its own; a
difference ends the job with an error (`check=False`: not). All ids are made of such answers.

Vocabularies with unused or user-defined pieces, and those whose library changes texts otherwise than by marks (a normaliser), are
refused: the first by name, the second by the comparison.

Defined results: null and empty texts have no ids and decode to an empty text; a text that holds U+2581 decodes with a space there, as the library
has it; control strings (`<s>`, `<0x41>`) are ordinary text; repeated rows, rows without doc_id and ties stay rows of their own; an empty table gives
an empty result; further columns are not looked at. Memory: of one slice of texts, or of one longer text.
"""

from __future__ import annotations

import codecs
import gc
import re
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from heapq import heapify, heappop, heappush
from itertools import chain, groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from sentencepiece import SentencePieceProcessor

from stockflow.llm.common import ship, text_slices

MARK = "▁"
#: Stretches of at most so many characters are kept, at most so many of them.
SHORT, KEPT = 32, 400_000
#: An entry of the agenda is a pair's rank and, in so many bits, its place in the stretch.
PLACE, NONE = 40, -1
PLACES = (1 << PLACE) - 1
#: The rank of a pair that is no piece, and rows that are worked on together.
LAST, ROWS = np.iinfo(np.int32).max, 1 << 14
#: What a decoder writes for the unknown piece, and for a byte that is no UTF-8.
UNKNOWN, BAD = " ⁇ ".encode(), "�"

codecs.register_error("piece-bytes", lambda e: (BAD * (e.end - e.start), e.end))


class Vocabulary(dict):
    """Stretch of text -> its ids; what is not there yet is worked out by its agenda."""

    def __init__(self, model: str):
        super().__init__()
        self.library = sp = SentencePieceProcessor(model_file=model)
        every = range(sp.get_piece_size())
        if any(sp.is_unused(i) for i in every):
            raise ValueError(f"{model}: vocabularies with unused pieces are not supported")
        plain = [i for i in every if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))]
        self.ids = {sp.id_to_piece(i): i for i in plain}
        scores = {sp.id_to_piece(i): sp.get_score(i) for i in plain}
        place = {score: k for k, score in enumerate(sorted(set(scores.values()), reverse=True))}
        #: 0: the best score; equal scores have equal ranks.
        self.ranks = {piece: place[score] for piece, score in scores.items()}
        self._pair_table()
        self.bytes = {int(sp.id_to_piece(i)[1:-1], 16): i for i in every if sp.is_byte(i)}
        self.unknown = sp.unk_id()
        self.near = {p[k : k + 2] for p in self.ids for k in range(len(p) - 1)}
        # Where marks only begin pieces, a word with the marks before it is a stretch.
        inside = any(pair[1] == MARK != pair[0] for pair in self.near)
        self.stretch = re.compile("(?s).+" if inside else f"{MARK}+[^{MARK}]*|[^{MARK}]+")
        of_byte = {i: bytes([b]) for b, i in self.bytes.items()}
        self.surface = [of_byte.get(i, b"" if sp.is_control(i) else UNKNOWN if sp.is_unknown(i) else sp.id_to_piece(i).replace(MARK, " ").encode()) for i in every]
        self.spaced = {i for i in plain if sp.id_to_piece(i).startswith(MARK)}
        self.silent = {i for i in every if sp.is_control(i)}

    def _pair_table(self) -> None:
        """Every pair of symbols that together are a piece, by their codes: a piece's id, or the vocabulary's size and the code point of a character that is none."""
        size = self.size = self.library.get_piece_size()
        self.code = np.arange(size, size + 0x110000, dtype=np.int32)
        for piece, i in self.ids.items():
            if len(piece) == 1:
                self.code[ord(piece)] = i
        found = {}
        for piece, i in self.ids.items():
            for k in range(1, len(piece)):
                pair = [self.ids.get(x, size + ord(x) if len(x) == 1 else NONE) for x in (piece[:k], piece[k:])]
                if min(pair) >= 0:
                    found[pair[0] << 32 | pair[1]] = (self.ranks[piece], i)
        keys = sorted(found)
        self.pairs = np.array([*keys, np.iinfo(np.int64).max], np.int64)
        self.pair_rank, self.pair_piece = np.array([*map(found.get, keys), (LAST, NONE)], np.int32).T.copy()

    def _find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranks (`LAST`: no piece) and pieces of pairs of codes."""
        keys = left.astype(np.int64) << 32 | right
        at = np.searchsorted(self.pairs, keys)
        return np.where(self.pairs[at] == keys, self.pair_rank[at], LAST), self.pair_piece[at]

    def learn(self, stretches: set[str]) -> None:
        """Works out short stretches together: those of one length have an agenda in a row each, and every round merges the best pair of each row."""
        by_length: dict[int, list[str]] = {}
        for s in stretches:
            by_length.setdefault(len(s), []).append(s)
        for n, every in by_length.items():
            for start in range(0, len(every), ROWS):
                some = every[start : start + ROWS]
                points = np.frombuffer("".join(some).encode("utf-32-le"), np.uint32).reshape(-1, n)
                for row, codes in self._merged_rows(self.code[points]):
                    strange = (codes >= self.size).any(axis=1)  # a character that is no piece
                    plain = ~strange
                    self.update(zip(map(some.__getitem__, row[plain].tolist()), map(tuple, codes[plain].tolist()), strict=True))
                    for k, ids in zip(row[strange].tolist(), codes[strange].tolist(), strict=True):
                        self[some[k]] = tuple(chain.from_iterable((i,) if i < self.size else self._of_symbol(chr(i - self.size)) for i in ids))

    def _merged_rows(self, codes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(rows, their codes) as they come to an end."""
        row = np.arange(len(codes))
        ranks, pieces = self._find(codes[:, :-1], codes[:, 1:])
        while ranks.shape[1]:
            best = ranks.argmin(axis=1)  # the leftmost of equals
            live = ranks[np.arange(len(row)), best] < LAST
            if not live.all():
                yield row[~live], codes[~live]
                row, codes, ranks, pieces, best = row[live], codes[live], ranks[live], pieces[live], best[live]
            if not len(row):
                return
            every, columns = np.arange(len(row)), np.arange(codes.shape[1] - 1)
            whole = pieces[every, best]
            codes = np.take_along_axis(codes, columns + (columns > best[:, None]), axis=1)
            codes[every, best] = whole
            shift = columns[:-1] + (columns[:-1] >= best[:, None])
            ranks, pieces = np.take_along_axis(ranks, shift, axis=1), np.take_along_axis(pieces, shift, axis=1)
            for at, there in ((best - 1, best > 0), (best, best < codes.shape[1] - 1)):
                r, a = every[there], at[there]
                ranks[r, a], pieces[r, a] = self._find(codes[r, a], codes[r, a + 1])
        if len(row):
            yield row, codes

    def __missing__(self, stretch: str) -> tuple[int, ...]:
        short = len(stretch) <= SHORT
        near = self.near
        cuts = [] if short else [k for k in range(1, len(stretch)) if stretch[k - 1 : k + 1] not in near]
        if cuts:
            found = tuple(chain.from_iterable(self[stretch[a:b]] for a, b in zip([0, *cuts], [*cuts, len(stretch)], strict=True)))
        else:
            ids, symbols = self.ids, merged(stretch, self.ranks)
            try:
                found = tuple([ids[s] for s in symbols])
            except KeyError:
                found = tuple(chain.from_iterable(map(self._of_symbol, symbols)))
        if short:
            if len(self) >= KEPT:
                self.clear()
            self[stretch] = found
        return found

    def _of_symbol(self, symbol: str) -> Iterable[int]:
        if (i := self.ids.get(symbol)) is not None:
            return (i,)
        return [self.bytes[b] for b in symbol.encode()] if self.bytes else (self.unknown,)

    def encode(self, texts: list[str | None], check: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, and where each text's begin (n + 1 places); `check`: new answers are held against the library's."""
        split = [self.stretch.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        places = np.cumsum([0, *map(len, split)])
        coded = pa.array(list(chain.from_iterable(split)), pa.large_string()).dictionary_encode()
        every = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        new = [s for s in every if s not in self]
        if len(self) + len(new) > KEPT:
            self.clear()
            new = every
        self.learn({s for s in new if len(s) <= SHORT})
        if check:
            self.compare([s for s in new if s != MARK])  # the mark alone is no text's
        # Each different stretch is looked up once; its ids are laid out by places.
        answers = list(map(self.__getitem__, every))
        size = np.fromiter(map(len, answers), np.int64, len(every))
        flat = np.fromiter(chain.from_iterable(answers), np.int32, int(size.sum()))
        which = coded.indices.to_numpy()
        many = size[which]
        ends = np.concatenate([[0], np.cumsum(many)])
        ids = flat[np.repeat((np.cumsum(size) - size)[which] - ends[:-1], many) + np.arange(ends[-1])]
        return ids, ends[places]

    def compare(self, stretches: list[str]) -> None:
        """A stretch begins with a mark, which the library puts before every text."""
        theirs = self.library.encode([s[1:].replace(MARK, " ") for s in stretches], num_threads=1)
        for s, ids in zip(stretches, theirs, strict=True):
            if self[s] != tuple(ids):
                raise ValueError(f"the ids of {s!r} are not those of the library")

    def decode(self, ids: list[int] | None) -> str:
        if not ids:
            return ""
        surface = self.surface
        if not all(0 <= i < len(surface) for i in (min(ids), max(ids))):
            raise ValueError("an id is not in the vocabulary")
        if self.silent.isdisjoint(ids):
            return b"".join(map(surface.__getitem__, ids))[ids[0] in self.spaced :].decode(errors="piece-bytes")
        # A control piece writes nothing, but bytes around it are not one character.
        spoken = [i for i in ids if i not in self.silent]
        parts = [b"".join(map(surface.__getitem__, run)).decode(errors="piece-bytes") for quiet, run in groupby(ids, self.silent.__contains__) if not quiet]
        return "".join(parts)[bool(spoken) and spoken[0] in self.spaced :]


    def decode_all(self, ids: list[int], places: list[int]) -> pa.Array:
        with no_collection():
            return pa.array([self.decode(ids[a:b]) for a, b in zip(places[:-1], places[1:], strict=True)], pa.string())


def merged(stretch: str, ranks: dict[str, int]) -> list[str]:
    """The symbols left when no pair of neighbours is a piece any more."""
    symbols: list[str] = list(stretch)
    last = len(symbols) - 1
    # The rank of each symbol with the next one, if that is a piece; an entry of the agenda holds while it is the same.
    rank = [ranks.get(a + b, NONE) for a, b in zip(symbols, symbols[1:], strict=False)]
    agenda = [r << PLACE | k for k, r in enumerate(rank) if r >= 0]
    if not agenda:
        return symbols
    heapify(agenda)
    rank.append(NONE)
    before, after = list(range(-1, last)), list(range(1, last + 2))
    while agenda:
        entry = heappop(agenda)
        left = entry & PLACES
        if rank[left] != entry >> PLACE:
            continue
        right = after[left]
        symbols[left] += symbols[right]
        symbols[right], rank[right] = "", NONE
        beyond, ahead = after[right], before[left]
        after[left] = beyond
        if beyond <= last:
            before[beyond] = left
            rank[left] = r = ranks.get(symbols[left] + symbols[beyond], NONE)
            if r >= 0:
                heappush(agenda, r << PLACE | left)
        else:
            rank[left] = NONE
        if ahead >= 0:
            rank[ahead] = r = ranks.get(symbols[ahead] + symbols[left], NONE)
            if r >= 0:
                heappush(agenda, r << PLACE | ahead)
    return list(filter(None, symbols))


_vocabularies: dict[str, Vocabulary] = {}


def vocabulary(model: str) -> Vocabulary:
    """One for each worker."""
    if model not in _vocabularies:
        _vocabularies[model] = Vocabulary(model)
    return _vocabularies[model]


@contextmanager
def no_collection() -> Iterator[None]:
    """Python looks for cycles after so many new objects; here there are many and no cycle."""
    gc.disable()
    try:
        yield
    finally:
        gc.enable()


def _encoded(part: pa.RecordBatch, words: Vocabulary, check: bool) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """The ids of a slice of documents, where each one's begin, and both as a column."""
    with no_collection():
        ids, places = words.encode(part.column("text").to_pylist(), check)
    return ids, places, pa.ListArray.from_arrays(pa.array(places.astype(np.int32)), pa.array(ids))


def encode(docs: DataFrame, model: str, check: bool = True) -> DataFrame:
    """(doc_id, ids) of every row; `model`: a vocabulary file that every executor has."""
    ship(docs.sparkSession)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), _encoded(part, vocabulary(model), check)[2]], ["doc_id", "ids"])

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(rows, "doc_id long, ids array<int>")


def round_trip(docs: DataFrame, model: str, check: bool = True) -> DataFrame:
    """(doc_id, ids, text) of every row: encoded, and decoded from those ids, in one pass."""
    ship(docs.sparkSession)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(model)
        for part in text_slices(batches):
            ids, places, column = _encoded(part, words, check)
            texts = words.decode_all(ids.tolist(), places.tolist())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), column, texts], ["doc_id", "ids", "text"])

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(rows, "doc_id long, ids array<int>, text string")


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """(doc_id, ids, text) of rows with ids; null ids: an empty text; an id outside the vocabulary is an error."""
    ship(encoded.sparkSession)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(model)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                ids = part.column("ids").fill_null([])
                flat, places = ids.flatten().to_numpy(zero_copy_only=False).tolist(), np.cumsum([0, *pc.list_value_length(ids).to_pylist()]).tolist()
                texts = words.decode_all(flat, places)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("doc_id", "ids")), texts], ["doc_id", "ids", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(rows, "doc_id long, ids array<int>, text string")

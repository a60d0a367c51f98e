import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from edges import ROWS, edge_docs, no_docs
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from stockflow.llm import hard_negatives, pieces, queries, runs
from stockflow.llm.common import read

MODEL = public_tokenizers.path("piece_bpe_32k.model")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ---- runs


def brute_runs(words, least=6, times=4):
    found = {}
    for q in range(1, len(words) + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, times * q):
                found.setdefault((i, j + q - i), q)
            i = j + 1
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def brute_collapsed(words, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def random_words(rng):
    words = [rng.choice("ab c d e"[: rng.choice([1, 2, 4, 8])].split() or ["a"]) for _ in range(rng.randint(0, 40))]
    if rng.random() < 0.7:
        unit = [rng.choice("abc") for _ in range(rng.randint(1, 6))]
        at = rng.randint(0, len(words))
        words[at:at] = (unit * 9)[: rng.randint(0, 45)]
    return words


@pytest.mark.parametrize(("least", "times"), [(6, 4), (1, 2), (5, 3)])
def test_runs_equal_brute_force(least, times):
    rng = random.Random(7)
    for _ in range(300):
        texts = [random_words(rng) for _ in range(rng.randint(1, 5))]
        symbols, first, _ = runs.word_numbers(pa.array([" ".join(t) for t in texts]))
        start, end, period = runs.find_runs(symbols, first, least, times)
        got = [[] for _ in texts]
        for s, e, q in zip(start, end, period, strict=True):
            d = int(np.searchsorted(first, s, side="right")) - 1
            got[d].append((int(s - first[d]), int(e - s), int(q)))
        assert got == [brute_runs(t, least, times) for t in texts]


def test_suffix_array_and_its_lcp():
    rng = random.Random(3)
    for _ in range(100):
        s = [rng.randrange(3) for _ in range(rng.randint(1, 60))]
        order, isa, lcp = runs.suffix_array(np.array(s))
        assert order.tolist() == sorted(range(len(s)), key=lambda i: s[i:])
        assert isa[order].tolist() == list(range(len(s)))
        for k in range(1, len(s)):
            a, b = s[order[k - 1] :], s[order[k] :]
            n = 0
            while n < min(len(a), len(b)) and a[n] == b[n]:
                n += 1
            assert lcp[k] == n


def test_long_repetitive_texts_take_no_square_of_time():
    for words in (["a"] * 100_000, ["a", "b"] * 60_000, ["a"] * 50_000 + ["b"] * 50_000):
        symbols, first, _ = runs.word_numbers(pa.array([" ".join(words)]))
        start, end, period = runs.find_runs(symbols, first)
        assert sorted((end - start).tolist()) == ([50_000, 50_000] if words[-1] == "b" == words[-2] else [len(words)])


def test_run_edges(spark):
    rows = runs.find(edge_docs(spark)).collect()
    assert len(rows) == len(ROWS)
    want = sorted((str(d), brute_collapsed(w, brute_runs(w) if len(w) < 1000 else [])) for d, t, *_ in ROWS for w in [WORD.findall(t or "")])
    assert sorted((str(r.doc_id), r.collapsed) for r in rows) == want
    assert runs.find(no_docs(spark)).collect() == []
    odd = spark.createDataFrame([(1, "a a a a a\ta a a"), (2, "A a " * 4), (3, "ß " * 6)], "doc_id long, text string")
    got = {r.doc_id: [tuple(x) for x in r.runs] for r in runs.find(odd).collect()}
    assert got == {1: [(1, 6, 1)], 2: [(0, 8, 2)], 3: [(0, 6, 1)]}


def test_run_query(spark, sf_dir):
    rows = {r.doc_id: r for r in queries.op11_runs(spark, sf_dir).collect()}
    docs = read(spark, sf_dir, "documents").select("doc_id", "text").collect()
    assert len(rows) == len(docs)
    repeated = 0
    for doc_id, text in docs:
        words = WORD.findall(text or "")
        n, h = len(words), zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        if n > 3000:
            continue  # the plain way takes a square of the words
        found = brute_runs(words)
        repeated += bool(found)
        best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
        r = rows[doc_id]
        assert r.n_runs == len(found)
        assert (r.start, r.length, r.period) == (best or (None,) * 3)
        assert r.exponent_milli == (1000 * best[1] // best[2] if best else None)
        assert r.runs_sha256 == sha("".join(f"{s},{n},{q}\n" for s, n, q in found))
        assert r.collapsed_sha256 == sha(brute_collapsed(words, found))
    assert repeated > 5


# ---- SentencePiece


@pytest.fixture(scope="module")
def library():
    return SentencePieceProcessor(model_file=MODEL)


def ids_of(vocabulary, texts, check=False):
    ids, places = vocabulary.encode(texts, check)
    return [ids[a:b].tolist() for a, b in zip(places[:-1], places[1:], strict=True)]


def test_pieces_equal_the_library(library):
    rng = random.Random(5)
    vocabulary = pieces.Vocabulary(MODEL)
    letters = "ab c  d\n\t▁é中文字😀the and\x00<>s/0x41ﬁ가나ЖЯ"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    texts += ["", " ", "   ", "a" * 5000, "中" * 3000, "<s></s><0x41>", "\u0000", " a", "a ", "aé" * 40, "x" * 32, "x" * 33]
    ids = library.encode(texts)
    assert ids_of(vocabulary, texts, check=True) == ids
    vocabulary.clear()
    assert [ids_of(vocabulary, [t])[0] for t in texts] == ids
    assert [vocabulary.decode(i) for i in ids] == library.decode(ids)


def test_agenda_of_one_stretch_equals_that_of_rows():
    rng = random.Random(6)
    vocabulary = pieces.Vocabulary(MODEL)
    stretches = {"▁" * rng.randint(0, 3) + "".join(rng.choice("theinga日本é😀") for _ in range(rng.randint(1, 30))) for _ in range(2000)}
    alone = {s: vocabulary[s] for s in stretches}
    vocabulary.clear()
    vocabulary.learn({s for s in stretches if len(s) <= pieces.SHORT})
    assert all(vocabulary[s] == alone[s] for s in stretches)


def test_an_answer_unlike_the_library_s_is_an_error():
    vocabulary = pieces.Vocabulary(MODEL)
    vocabulary.compare(["▁there", "▁▁a"])
    vocabulary["▁there"] = (5,)
    with pytest.raises(ValueError, match="library"):
        vocabulary.compare(["▁there"])


def test_kept_answers_are_bounded(library, monkeypatch):
    monkeypatch.setattr(pieces, "KEPT", 50)
    vocabulary = pieces.Vocabulary(MODEL)
    rng = random.Random(8)
    for _ in range(40):
        texts = [" ".join("".join(rng.choice("abcde") for _ in range(5)) for _ in range(8)) for _ in range(5)]
        assert ids_of(vocabulary, texts) == library.encode(texts)
        assert len(vocabulary) <= 50


def test_decoding_any_ids(library):
    rng = random.Random(9)
    vocabulary = pieces.Vocabulary(MODEL)
    for _ in range(3000):
        ids = [rng.choice([rng.randrange(32000), rng.randrange(260), 28705, rng.randrange(3)]) for _ in range(rng.randint(0, 8))]
        assert vocabulary.decode(ids) == library.decode(ids), ids
    with pytest.raises(ValueError, match="vocabulary"):
        vocabulary.decode([32000])


def test_piece_edges(spark, library):
    rows = pieces.decode(pieces.encode(edge_docs(spark), MODEL), MODEL).collect()
    assert sorted((str(r.doc_id), r.ids, r.text) for r in rows) == sorted((str(d), library.encode(t or ""), t or "") for d, t, *_ in ROWS)
    assert sorted((str(r.doc_id), r.ids, r.text) for r in pieces.round_trip(edge_docs(spark), MODEL).collect()) == sorted((str(r.doc_id), r.ids, r.text) for r in rows)
    assert pieces.encode(no_docs(spark), MODEL).collect() == [] == pieces.round_trip(no_docs(spark), MODEL).collect()
    none = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert {(r.doc_id, r.ids is None, r.text) for r in pieces.decode(none, MODEL).collect()} == {(1, True, ""), (2, False, "")}


def test_piece_query(spark, sf_dir, library):
    want = {}
    for doc_id, text in read(spark, sf_dir, "documents").select("doc_id", "text").collect():
        ids = library.encode(text or "")
        want[doc_id] = (len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids)))
    assert {r[0]: tuple(r[1:]) for r in queries.op12_pieces(spark, sf_dir).collect()} == want


# ---- hard negatives


def brute_negatives(rows, anchors, positives=5, negatives=10, low=30, high=90):
    """rows: (vec_id, label, whole vector)."""
    rows = sorted(rows, key=lambda r: (r[0], r[1], r[2]))
    ids, labels = [r[0] for r in rows], [r[1] for r in rows]
    v = np.array([r[2] for r in rows], np.int64)
    found, seen = [], set()
    for a, i in enumerate(ids):
        if i not in anchors or i in seen:
            continue
        seen.add(i)
        scores = (v @ v[a]).tolist()
        order = sorted(range(len(rows)), key=lambda k: (-scores[k], ids[k]))
        for p in [k for k in order if labels[k] == labels[a] and ids[k] != i][:positives]:
            own = [k for k in order if labels[k] != labels[a] and low * scores[p] <= 100 * scores[k] <= high * scores[p] and ids[k] != i]
            found += [(i, ids[p], r, ids[k], scores[p], scores[k]) for r, k in enumerate(own[:negatives], 1)]
    return sorted(found)


def mined(frame):
    return sorted(tuple(r) for r in frame.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


def test_negative_query(spark, sf_dir):
    rows = []
    for i, v, label in read(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label").collect():
        if label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            whole = np.floor(256 * np.array(v, np.float64)).astype(int).tolist()
            rows.append((i, (label + 1) % 10 if i % 7 == 0 else label, whole))
    want = brute_negatives(rows, {r[0] for r in rows if r[0] % 100 == 0})
    assert mined(queries.op13_hard_negatives(spark, sf_dir)) == want != []


@pytest.mark.parametrize("quota", [1, 40])
def test_negatives_stop_by_certificate_in_several_rounds(spark, quota):
    """Clusters, ties, a label with most rows: the search stops early and is whole."""
    rng = np.random.default_rng(4)
    middle = rng.integers(-40, 40, (12, 6))
    rows = [(i, int(i % 5 if i % 3 else 0), (middle[i % 12] + rng.integers(-4, 5, 6)).tolist()) for i in range(1500)]
    rows += [(2000 + i, 1, rows[0][2]) for i in range(5)] + [(3000, 2, [0] * 6)]
    frame = hard_negatives.whole_vectors(spark.createDataFrame(rows, "vec_id long, label long, v array<long>"), F.col("v"), F.col("label"))
    index = hard_negatives.build(frame, words=8, pack=64)
    assert index.packs.count() > 20 and index.counts.sum() == len(rows)
    anchors = frame.where("vec_id % 100 = 0").selectExpr("vec_id anchor", "label", "v", f"array(struct(0L AS tag, {-hard_negatives.ALL}L AS low, {hard_negatives.ALL}L AS high)) windows")
    best = defaultdict(list)
    for r in hard_negatives.search(index, anchors, True, 5, quota).collect():
        best[r.anchor].append((-r.score, r.vec_id))
    v = np.array([r[2] for r in rows])
    for a in (r for r in rows if r[0] % 100 == 0):
        scores = v @ np.array(a[2])
        want = sorted((-int(s), r[0]) for s, r in zip(scores, rows, strict=True) if r[1] == a[1] and r[0] != a[0])[:5]
        assert sorted(best[a[0]]) == want
    assert mined(hard_negatives.mine(frame, F.col("vec_id") % 100 == 0, words=8, pack=64)) == brute_negatives(rows, {r[0] for r in rows if r[0] % 100 == 0})


def test_visits_go_by_falling_bounds():
    rng = np.random.default_rng(2)
    upper, counts = (rng.normal(size=5), rng.normal(size=7)), rng.integers(0, 2, 35)
    lower = tuple(u - 1 for u in upper)
    got = list(hard_negatives.visits(upper, lower, counts, 0.5))
    want = [(upper[0][c // 7] + upper[1][c % 7], c) for c in range(35) if counts[c] and lower[0][c // 7] + lower[1][c % 7] <= 0.5]
    assert [c for _, c in got] == [c for _, c in sorted(want, reverse=True)] and [b for b, _ in got] == pytest.approx([b for b, _ in sorted(want, reverse=True)])


def test_negative_edges(spark):
    kind = "vec_id long, label int, embedding array<float>, v string, cell string, pack string, anchor string, score string, tag string"
    some = [(0, 1, [1.0, 0.5]), (0, 1, [1.0, 0.5]), (1, 1, [0.9, 0.5]), (2, 1, [0.9, 0.5]), (3, 2, [0.5, 0.3]), (4, 2, [0.5, 0.3]), (4, 2, [0.5, 0.3])]
    bad = [(None, 1, [1.0, 0.0]), (100, None, [1.0, 0.0]), (200, 1, None), (300, 1, []), (400, 1, [1.0, None]), (500, 1, [float("nan"), 1.0]), (600, 2, [1.0, 1.0, 1.0])]
    frame = spark.createDataFrame([(*r, *["x"] * 6) for r in some + bad], kind)
    usable = frame.where("not exists(embedding, x -> x is null or isnan(x))")
    whole = F.transform("embedding", lambda x: F.floor(256 * x.cast("double")))
    taken = hard_negatives.whole_vectors(usable, whole, F.col("label"))
    got = mined(hard_negatives.mine(taken, F.col("vec_id") % 100 == 0))
    want = brute_negatives([(i, label, np.floor(256 * np.array(v)).astype(int).tolist()) for i, label, v in some], {0})
    assert got == want and len(want) == 6
    assert mined(hard_negatives.mine(taken.where("false"), F.lit(True))) == []
    assert mined(hard_negatives.mine(taken, F.lit(False))) == []

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from edges import LONG, ROWS, edge_docs, no_docs
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stockflow.llm import html_text, language, packing, queries, tokens, toxicity
from stockflow.llm.common import read
from stockflow.llm.words import Words

FILE = public_tokenizers.path("word_bpe_49k.json")


def held(doc_id, folds):
    return zlib.crc32(str(doc_id).encode()) % folds == 2


def test_words_are_those_of_the_pattern():
    import re

    texts = ["", None, "Ab  c\td\x0be", "x", " lead", "trail ", "ÄB c d", "a\nB"]
    w = Words(pa.array(texts))
    want = [re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) for t in texts]
    got = [[w.bytes[w.begin[i] : w.end[i]].tobytes().decode() for i in range(w.first[d], w.first[d + 1])] for d in range(len(texts))]
    assert got == want
    again = Words(pa.array(["zz e c", "ab"]))
    assert again.hash[2] == w.hash[1] and again.hash[3] == w.hash[0] and len(set(w.hash.tolist())) == len({x for t in want for x in t})


# ---- packing


def check_pieces(pieces, texts):
    """Every id of every text lies in exactly one piece, pieces lie gapless in sequences of at most 2048."""
    tokenizer = Tokenizer.from_file(FILE)
    left = Counter()
    for key, text in texts:
        left[key, tuple(tokenizer.encode(text or "", add_special_tokens=False).ids + [1])] += 1
    sequences, parts, found = {}, {}, Counter()
    for p in pieces:
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
        assert p.length == len(p.ids) // 4 > 0
        parts.setdefault(p.doc_id, []).append((p.start, p.doc_tokens, tuple(np.frombuffer(bytes(p.ids), "<u4").tolist())))
    for rows in sequences.values():
        at = 0
        for offset, length in sorted(rows):
            assert offset == at
            at += length
        assert at <= 2048
    for key, rows in parts.items():
        copies = Counter(r[0] for r in rows)[0]
        ids = [x for r in sorted(rows) for x in r[2]]
        if copies == 1:
            assert sum(len(r[2]) for r in rows) == rows[0][1]
            found[key, tuple(ids)] += 1
    return left, found, sequences


def test_packing_keeps_every_id_once(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    pieces = packing.pack(docs, FILE).collect()
    left, found, sequences = check_pieces(pieces, [(r.doc_id, r.text) for r in docs.collect()])
    assert left == found
    lengths = [sum(x for _, x in rows) for rows in sequences.values()]
    padding = sum(2048 - n for n in lengths if n & (n - 1))
    assert padding <= 0.005 * sum(lengths)
    digest = {(r.doc_id, r.start): r.ids_crc32 for r in queries.QUERIES["op1_packing"](spark, sf_dir).collect()}
    assert digest == {(p.doc_id, p.start): zlib.crc32(bytes(p.ids)) for p in pieces}


def test_packing_edges(spark):
    pieces = packing.pack(edge_docs(spark), FILE, run=4096).collect()
    left, found, _ = check_pieces(pieces, [(r[0], r[1]) for r in ROWS])
    assert {k: v for k, v in left.items() if k[0] != 4} == {k: v for k, v in found.items() if k[0] != 4}
    assert sum(p.length for p in pieces) == sum(len(k[1]) * v for k, v in left.items())
    assert [p.length for p in pieces if p.doc_id in (2, 3)] == [1, 1]
    assert packing.pack(no_docs(spark), FILE).count() == 0


def brute_cost(spots, inner, size, cut, short, runs):
    cost = [0] + [10**9] * (len(spots) - 1)
    for j in range(1, len(spots)):
        for i in range(j):
            gap = int(spots[j] - spots[i])
            m = -(-gap // size)
            if m <= runs:
                cost[j] = min(cost[j], cost[i] + m * size - gap + (m - 1) * cut)
            if gap < size and not gap & (gap - 1):
                cost[j] = min(cost[j], cost[i] + short)
        cost[j] += cut if inner[j] else 0
    return cost


@pytest.mark.parametrize("seed", range(8))
def test_monotone_queues_find_the_cheapest_cuts(seed):
    rng = np.random.default_rng(seed)
    ends = np.cumsum(rng.integers(1, 30 if seed % 2 else 90, 60))
    spots, inner = packing.places(ends, int(ends[-1]) + 3, 8)
    cost, _, _ = packing.cheapest(spots, inner, 64, 5, 2)
    assert cost == brute_cost(spots, inner, 64, 5, 2, 2)
    cuts = packing.windows(ends, int(ends[-1]) + 3, 64, 5, 2, True)
    assert cuts[0][0] == 0 and cuts[-1][1] == int(ends[-1]) + 3 and all(a[1] == b[0] for a, b in zip(cuts, cuts[1:]))
    assert all(0 < b - a <= 64 for a, b in cuts)


def test_tokens_are_the_tokenizers():
    texts = ["", None, "Hello, WORLD. It's <|endoftext|>x I'm. y", "É, é. é, É. İ, ß! ×, a×, <|STARTOFTEXT|> <|startoftext|>,", "日本語。 テスト, 4.5.", "a b c. x" * 50, "x" * 5000, "?. ' 's 't. don't, rock'n'roll. 'll “q,” d”."]
    encoder = tokens.Encoder(FILE)
    for _ in range(2):  # the second time from what is kept
        ids, offsets, ends = encoder.encode(pa.array(texts), 1)
        for i, t in enumerate(texts):
            assert ids[offsets[i] : offsets[i + 1]].tolist() == [*encoder.tokenizer.encode(t or "", add_special_tokens=False).ids, 1]
    assert set(offsets[1:].tolist()) <= set(ends.tolist())


# ---- toxicity


def test_toxicity_on_held_out_labels(spark):
    rows = {r.doc_id: r for r in queries.QUERIES["op2_toxicity"](spark, "/root/testdata/sf0.1").collect()}
    assert all(r.held_out == held(i, 4) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for i, r in rows.items())
    labels = [(r.toxic, rows[r.doc_id].predicted) for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect() if rows[r.doc_id].held_out]
    caught, toxic, called = sum(a and b for a, b in labels), sum(a for a, _ in labels), sum(b for _, b in labels)
    assert caught >= 0.85 * toxic and caught >= 0.85 * called


def test_toxicity_edges(spark):
    labels = spark.createDataFrame([(1, 0), (4, 1), (4, 0), (None, 1), (5, None), (99, 1)], "doc_id long, toxic int")
    model = toxicity.learn(edge_docs(spark), labels)
    rows = toxicity.scored(edge_docs(spark), model).collect()
    assert len(rows) == len(ROWS) and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.without_toxic(edge_docs(spark), model).columns == edge_docs(spark).columns
    nothing = toxicity.learn(no_docs(spark), labels.limit(0))
    assert toxicity.scored(no_docs(spark), nothing).count() == 0
    assert {round(r.score, 6) for r in toxicity.scored(edge_docs(spark), nothing).collect()} == {0}


def test_risk_correction_finds_the_hidden_positives():
    """Unlabelled rows hold positives: with the class prior they are told apart, and the mean score is the prior."""
    rng = np.random.default_rng(2)

    def row(positive):
        return np.array([0, 2] if positive else [1, 2]), np.array([1.0, rng.random()])

    rows = [(True, *row(True)) for _ in range(200)] + [(False, *row(rng.random() < 0.2)) for _ in range(1000)]
    w, bias = toxicity.train(rows, 3, 0.2)
    assert w[0] + bias > 1 and w[1] + bias < -1


# ---- language


def longest_match_phrases(text, sample):
    n, at = 0, 0
    while at < len(text):
        size = 1
        while at + size <= len(text) and text[at : at + size] in sample:
            size += 1
        at += max(size - 1, 1)
        n += 1
    return n


def test_phrases_equal_greedy_parsing():
    samples = {"x": "the cat sat on the mat and the rat ran", "y": "der hund und die katze sind im haus"}
    parser = language.Parser(samples)
    texts = ["the cat and the hund", "", "qqq the", "katze", "The  CAT!! ran", "ran " * 400]
    symbols, offsets = parser.symbols(texts)
    got = parser.phrases(symbols, offsets)
    known = {c for s in samples.values() for c in s if c.isalpha()}
    for i, t in enumerate(texts):
        plain = "".join(c if c in known else "?" if c.isalpha() else " " for c in t.lower())
        plain = " ".join(plain.split(" ")) if "  " not in plain else __import__("re").sub(" +", " ", plain)
        for j, name in enumerate(parser.names):
            want = sum(longest_match_phrases(plain[k : k + language.BLOCK], samples[name]) for k in range(0, len(plain), language.BLOCK))
            assert got[i, j] == want, (t, name)


def test_a_script_of_many_letters_takes_little_memory():
    rng = np.random.default_rng(3)
    han = [chr(c) for c in range(0x4E00, 0x4E00 + 10_000)]
    samples = {"zh": "".join(han) + "".join(rng.choice(han, 30_000)), "en": "the quick brown fox jumps over the lazy dog " * 20, "xx": "".join(rng.choice(han, 20_000))}
    parser = language.Parser(samples)
    size = parser.ways.keys.nbytes + parser.ways.states.nbytes + parser.first.nbytes + parser.symbol.nbytes
    assert parser.alphabet > 10_000 and size < 30 << 20
    texts = ["".join(rng.choice(han, 300)), "the lazy fox", "".join(han[500:700]), "日本 quick"]
    symbols, cuts = parser.symbols(texts)
    got = parser.phrases(symbols, cuts)
    for t, text in enumerate(texts):
        for k, name in enumerate(parser.names):
            assert got[t, k] == longest_match_phrases(text, samples[name].lower()), (t, name)


def test_language_on_held_out_rows(spark, sf_dir):
    rows = {r.doc_id: r for r in queries.QUERIES["op5_language"](spark, sf_dir).collect()}
    told = [(r.lang, rows[r.doc_id]) for r in read(spark, sf_dir, "documents").collect()]
    assert all(r.held_out == held(i, 4) and 0 <= r.score <= 1 for i, r in rows.items())
    assert sum(lang == r.lang_pred for lang, r in told if r.held_out) >= 0.95 * sum(r.held_out for _, r in told)


def test_language_edges(spark):
    samples = language.learn(edge_docs(spark))
    rows = language.identify(edge_docs(spark), samples).collect()
    assert len(rows) == len(ROWS)
    assert all(r.lang_pred == "und" and r.score == 0 for r in rows if r.doc_id in (2, 3, 7, 8))
    assert all(r.lang_pred in samples for r in rows if r.doc_id in (1, 4, 5, 9))
    assert {r.lang_pred for r in language.identify(edge_docs(spark), {}).collect()} == {"und"}
    assert language.learn(no_docs(spark)) == {} and language.identify(no_docs(spark), {}).count() == 0


def test_languages_of_long_documents_are_learned(spark):
    words = {name: [f"{a}{b}{c}" for a in x for b in x for c in x] for name, x in (("long", "abcde"), ("both", "fghij"), ("short", "klmno"), ("late", "pqrst"), ("copied", "uvwxy"))}
    prose = {name: " ".join(w * 100) for name, w in words.items()}
    assert len(prose["long"]) == 49_999
    rows = [(i, prose["long"], "long") for i in range(4)] + [(10 + i, prose["both"], "both") for i in range(8)] + [(20 + i, "fgh", "both") for i in range(4)]
    rows += [(30 + i, prose["short"][:900], "short") for i in range(8)] + [(40 + i, "1 " * 300_000 + prose["late"][:900], "late") for i in range(4)]
    rows += [(50 + k, prose["copied"][:900], "copied") for k in (0, 1) for _ in range(1000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    samples = language.learn(docs, drawn=20)
    assert set(samples) == set(words)
    assert 30_000 < len(samples["long"]) <= 40_000 and len(samples["both"]) > 30_000 and any(c in samples["late"] for c in "pqrst")
    new = spark.createDataFrame([(i, " ".join(w[::-1]), name) for i, (name, w) in enumerate(words.items())], docs.schema)
    told = {r.doc_id: r.lang_pred for r in language.identify(new, samples).collect()}
    assert [told[i] for i in range(5)] == list(words)


# ---- pages

LONG_TEXT = "This paragraph is long enough to count as text of the article, as it goes on for more than eighty characters."


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (None, ""),
        ("", ""),
        ("plain text", "plain text"),
        ("a < b and c", "a < b and c"),
        (f"<p>{LONG_TEXT}</p><p>Short.</p>", f"{LONG_TEXT} Short."),
        (f"<nav><a href=x>Home</a></nav><article><h1>T&eacute;t</h1><p>a<b>b</b>c<br>d &amp;lt;\n e</article><footer>{LONG_TEXT}</footer>", "Tét abc d &lt; e"),
        (f'<script>var t="</p>";</script><style>p{{}}</style><div class="sidebar">{LONG_TEXT}</div><div id="main">{LONG_TEXT}</div><div id="comments"><p>{LONG_TEXT}</p></div>', LONG_TEXT),
        (f'<ul class="menu"><li><a href=a>One</a></li></ul><div><p>{LONG_TEXT}</p><p><a href=b>a link</a> in text</p></div><form>{LONG_TEXT}<input></form>', f"{LONG_TEXT} a link in text"),
        (f'<!-- {LONG_TEXT} --><div class="cookie-notice">{LONG_TEXT}</div><div style="display:none">{LONG_TEXT}</div><p>x</p>', "x"),
        (f"<article><p>{LONG_TEXT}</p><aside>{LONG_TEXT}</aside><p>End.", f"{LONG_TEXT} End."),
        ('<p>cut <a href="x', "cut"),
    ],
)
def test_main_text(html, text):
    assert html_text.main_text(html) == text


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("<article><p>one</p><svg-icon></svg-icon><p>two</p></article>", "one two"),
        ("<article><p>one</p><video-player>three</video-player><button-bar></button-bar><p>two</p></article>", "one three two"),
        ('<article><p>one <svg viewBox="0 0 1 1"/> and <math/> on</p><p>two</p></article>', "one and on two"),
        ("<article><p>one</p><svg><g><svg><text>x</text></svg></g><text>y</text></svg><p>two</p></article>", "one two"),
        ("<article><p>one</p><button>Buy<p>two</p><p>three</p></article>", "one two three"),
        ("<article><p>one</p><select><option>a<option>b</select> and <video><source src=v>old</video> two</article>", "one and two"),
        ("<article><p>one</p><script>var x = '<p>';</script ><p>two</p><textarea>never closed<p>three</p></article>", "one two"),
    ],
)
def test_left_out_elements_end_where_they_end(html, text):
    assert html_text.main_text(html) == text


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (f"<div><p>{LONG_TEXT}</p><p>Short.</p></div><article><h2>Card</h2><p>A linked story.</p></article>", f"{LONG_TEXT} Short. Card A linked story."),
        (f"<div>Menu</div><article><p>{LONG_TEXT}</p><p><a href=a>all of it a link</a></p><p>End.</p></article><div>Imprint</div>", f"{LONG_TEXT} all of it a link End."),
        (f"<article><ul><li><a href=a>One</a><li><a href=b>Two</a></ul><hr><aside>x</aside><p>{LONG_TEXT}</p></article>", LONG_TEXT),
    ],
)
def test_line_blocks_choose_on_marked_pages_too(html, text):
    assert html_text.main_text(html) == text


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ('<p class="ad">Buy<p>Real text</p><p>More</p>', "Real text More"),
        ('<ul><li class="promo">Buy<li>Real</ul><p>More</p>', "Real More"),
        ('<dl><dt class="ad">Buy<dd>Real</dl><table><tr><td class="ad">Buy<td>two<tr><td>three</table>', "Real two three"),
        ('<section><div class="ad">Buy <b>now</section><p>Real text</p>', "Real text"),
        ('<div id="page"><div class="ad">Buy<p>Real text</p><p>More</p></div>', "Real text More"),
        ('<div class="ad">Buy<p>Real text</p><p>More</p>', "Real text More"),
        (f'<div id="page"><div class="ad">Buy<article><p>{LONG_TEXT}</p></article></div>', LONG_TEXT),
        (f'<div class="sidebar"><div>a</div><article>Card</article></div><article><p>{LONG_TEXT}</p></article>', LONG_TEXT),
        (f'<article class="post-commentary"><h2 class="section-header">Title</h2><p class="teaser">In short.</p><p>{LONG_TEXT}</p></article>', f"Title In short. {LONG_TEXT}"),
        (f'<article><p>{LONG_TEXT}</p></article><section class="post-comments"><article>First!</article></section>', LONG_TEXT),
    ],
)
def test_what_is_marked_alone_is_left_out(html, text):
    assert html_text.main_text(html) == text


def test_pages_query(spark, sf_dir):
    rows = queries.QUERIES["op7_html_text"](spark, sf_dir).collect()
    pages = {r.page_id: r.html for r in read(spark, sf_dir, "pages").collect()}
    assert {r.page_id for r in rows} == set(pages) and all(r.n_chars == len(r.text) > 0 for r in rows)
    assert not any(x in r.text for r in rows for x in ("<p>", "track(", "margin:0", "\n"))
    odd = spark.createDataFrame([(None, None, None), (1, "u", "<p>a</p>"), (1, "u", "<p>a</p>"), (2, None, LONG)], "page_id long, url string, html string").selectExpr("*", "'x' AS text", "1 AS n_chars")
    assert sorted((r.page_id or 0, r.n_chars) for r in html_text.extract(odd).collect()) == [(0, 0), (1, 1), (1, 1), (2, len(LONG))]
    assert html_text.extract(odd.limit(0)).count() == 0

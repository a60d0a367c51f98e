import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from compare import oracle, oracle_rows, spark_rows
from edges import LONG, ROWS, edge_docs, no_docs
from pyspark.sql import functions as F

from stockflow.llm import bloom, embedding_dedup, exact_dedup, lattice, ngram_join, queries
from stockflow.llm.common import read
from stockflow.llm.components import components


def union(pairs, nodes):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        up[b] = a
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_oracle(spark, sf_dir, name):
    assert spark_rows(queries.QUERIES[name](spark, sf_dir)) == oracle_rows(oracle(sf_dir), queries.ORACLES[name])


def test_bloom_never_misses_and_rarely_alarms(spark):
    keys = spark.range(20_000).select(F.col("id").alias("k"))
    filt = bloom.build(keys, F.col("k"), 20_000)
    probed = bloom.probe(spark.range(40_000), F.col("id"), filt, "maybe")
    inside, outside = probed.where("id < 20000 and maybe").count(), probed.where("id >= 20000 and maybe").count()
    assert inside == 20_000 and outside < 400
    tiny = bloom.build(keys, F.col("k"), 20_000, max_bytes=1)
    assert tiny.blocks == 1
    assert bloom.probe(keys, F.col("k"), tiny, "maybe").where("maybe").count() == 20_000


def test_exact_dedup_edges(spark):
    rows = exact_dedup.groups(edge_docs(spark)).collect()
    assert len(rows) == len(ROWS)
    of = defaultdict(list)
    for r in rows:
        of[r.text_sha256].append(r)
    for group in of.values():
        assert sum(r.kept for r in group) == 1 and {r.group_size for r in group} == {len(group)}
    same = next(g for g in of.values() if any(r.doc_id == 1 for r in g))
    assert len(same) == 4 and {r.keep_id for r in same} == {4}
    assert sorted(r.doc_id for r in next(g for g in of.values() if any(r.doc_id == 3 for r in g))) == [2, 3]
    kept = exact_dedup.dedup(edge_docs(spark))
    assert kept.columns == edge_docs(spark).columns
    assert sorted(r.doc_id for r in kept.collect()) == [3, 4, 5, 6, 7, 8, 9]
    assert exact_dedup.groups(no_docs(spark)).count() == 0 and exact_dedup.dedup(no_docs(spark)).count() == 0


def test_exact_dedup_with_a_full_filter(spark, sf_dir):
    """A filter far too small lets every row through to the exact step; the result is the same."""
    docs = read(spark, sf_dir, "documents")
    small = exact_dedup.groups(docs, bits_per_key=1, max_filter_bytes=1)
    assert sorted(map(tuple, small.collect())) == sorted(map(tuple, exact_dedup.groups(docs).collect()))


def shingles(text, gram):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[k : k + gram]) for k in range(len(w) - gram + 1)) if len(w) >= gram else frozenset([tuple(w)] if w else [])


def brute_join(rows, gram, percent):
    sets = {i: shingles(t, gram) for i, t in rows}
    often, index, pairs = Counter(s for r in sets.values() for s in r), defaultdict(list), []
    for i, r in sets.items():
        first = sorted(r, key=lambda s: (often[s], s))[: len(r) - math.ceil(percent * len(r) / 100) + 1] if r else []
        for j in {j for s in first for j in index[s]}:
            both = len(r & sets[j])
            if 100 * both >= percent * (len(r) + len(sets[j]) - both):
                pairs.append((i, j))
        for s in first:
            index[s].append(i)
    return {i: (len(sets[i]), c) for i, c in union(pairs, sets).items()}


@pytest.mark.parametrize(("gram", "percent"), [(3, 90), (5, 80)])
def test_join_equals_brute_force(spark, sf_dir, gram, percent):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text").limit(200)
    # Chains of near copies: each word changed moves a text a little further from the first.
    words = [f"v{i}" for i in range(60)]
    chain = [(10_000 + k, " ".join(words[:k] + [f"z{k}"] + words[k + 1 :])) for k in range(0, 60, 3)] + [(11_000, " ".join(words))]
    chain += [(12_000 + k, " ".join(f"q{i}" if i >= k else f"p{i}" for i in range(40))) for k in range(41)]
    every = docs.union(spark.createDataFrame(chain, docs.schema)).persist()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.join(every, gram, percent).collect()}
    assert got == brute_join([tuple(r) for r in every.collect()], gram, percent)


def test_join_of_many_short_texts_in_one_partition(spark):
    """More short texts in a row than a slice has places for."""
    rows = [(i, f"m{i % 9000} a{i} b{i} c{i} d{i} e{i}" if i % 3 else f"u{i // 6} v{i // 6} w{i // 6} x{i // 6} y{i % 2}") for i in range(10_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).persist()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.join(docs, 1, 60).collect()}
    want = brute_join(rows, 1, 60)
    assert got == want and len({c for _, c in want.values()}) < 9_000


def test_tiles_never_part_a_link():
    rng = np.random.default_rng(3)
    import pyarrow as pa

    for percent in (80, 90):
        bands = ngram_join.Bands(percent)
        for n in (1, 2, 5, 9, 20, 57, 200, 1000):
            base = [f"b{n}_{i}" for i in range(n)]
            for _ in range(6):
                cut = int(rng.integers(0, n // 5 + 1))
                other = base[cut:] + [f"x{rng.integers(1e9)}" for _ in range(int(rng.integers(0, n // 8 + 1)))]
                elements, offsets = ngram_join.sets(pa.array([" ".join(base), " ".join(other)]), 1)
                a, b = (set(elements[offsets[k] : offsets[k + 1]].tolist()) for k in (0, 1))
                if a and b and 100 * len(a & b) >= percent * len(a | b):
                    text, tile = ngram_join.tiles(elements, offsets, bands)
                    assert set(tile[text == 0].tolist()) & set(tile[text == 1].tolist()), (percent, n)


def test_bitmaps_bound_the_overlap():
    a, b = np.arange(100, dtype=np.uint64), np.arange(50, 160, dtype=np.uint64)
    bands = ngram_join.Bands(10)
    x, y = (np.frombuffer(ngram_join.bitmaps(s, np.array([0, len(s)]), bands)[0], np.uint8) for s in (a, b))
    size = min(len(x), len(y))
    x, y = ngram_join._folded(x, size), ngram_join._folded(y, size)
    lost = np.bitwise_count(x & ~y).sum()
    assert 0 < lost <= 50
    assert ngram_join.may_link(100, 110, 50, 60, 30) and not ngram_join.may_link(100, 110, 80, 90, 30)


def test_join_edges(spark):
    got = sorted((r.doc_id or -1, r.n_shingles, r.component_id) for r in ngram_join.join(edge_docs(spark)).collect())
    of = {d: (n, c) for d, n, c in got}
    assert len(got) == len(ROWS)
    assert of[1] == (5, 1) and of[4] == (5, 1) and of[-1] == (5, None)
    assert of[2] == (0, 2) and of[3] == (0, 3) and of[8] == (0, 8)
    assert of[5][1] == of[6][1] == 5 and of[5][0] == len(LONG.split()) - 2
    kept = ngram_join.representatives(edge_docs(spark))
    assert kept.columns == edge_docs(spark).columns
    assert sorted(r.doc_id or -1 for r in kept.collect()) == [-1, 1, 2, 3, 5, 7, 8, 9]
    assert ngram_join.join(no_docs(spark)).count() == 0 and ngram_join.representatives(no_docs(spark)).count() == 0


def test_join_hands_few_rows_to_python_at_once(spark, monkeypatch):
    key, held, settle = "spark.sql.execution.arrow.maxRecordsPerBatch", [], ngram_join.settle
    monkeypatch.setattr(ngram_join, "ARROW_ROWS", 7, raising=False)
    monkeypatch.setattr(ngram_join, "settle", lambda df, name: held.append((name, spark.conf.get(key, None))) or settle(df, name))
    words = [f"w{i}" for i in range(60)]
    texts = [(d, " ".join(words[: 40 + d % 3])) for d in range(20)]
    got = ngram_join.join(spark.createDataFrame(texts, "doc_id long, text string").coalesce(1)).collect()
    assert {r.component_id for r in got} == {0} and len(got) == 20
    assert {"ngram-sketch", "ngram-tile-members", "ngram-near", "ngram-bound", "ngram-links"} <= {name for name, _ in held}
    assert {rows for _, rows in held} == {"7"} and spark.conf.get(key, None) is None


def test_components(spark):
    rng = np.random.default_rng(5)
    pairs = [(i, i + 1) for i in range(100, 180)] + [(1, int(x)) for x in range(500, 700)] + [(int(a), int(b)) for a, b in rng.integers(1000, 1400, (150, 2))]
    want = union([p for p in pairs if p[0] != p[1]], {x for p in pairs if p[0] != p[1] for x in p})
    got = components(spark.createDataFrame(pairs, "a long, b long")).collect()
    assert {r.node: r.component for r in got} == want and len(got) == len(want)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_lattice_points_are_nearest():
    rng = np.random.default_rng(7)
    x = rng.normal(size=(300, 8)) * 2
    home = lattice.nearest(x)
    assert np.all(np.isclose((2 * home) % 2, (2 * home[:, :1]) % 2)) and np.all(home.sum(axis=1) % 2 == 0)
    own = ((x - home) ** 2).sum(axis=1)
    others = ((x[:, None] - (home[:, None] + lattice.ROOTS)) ** 2).sum(axis=2)
    assert len(lattice.ROOTS) == 240 and np.all(own <= others.min(axis=1) + 1e-9) and own.max() <= 1 + 1e-9


def vectors_near(rng, n, cosine, size=64):
    a = rng.normal(size=(n, size))
    a /= np.linalg.norm(a, axis=1)[:, None]
    b = rng.normal(size=(n, size))
    b -= (b * a).sum(1)[:, None] * a
    b /= np.linalg.norm(b, axis=1)[:, None]
    return np.concatenate([a, cosine * a + math.sqrt(1 - cosine * cosine) * b])


def test_embedding_recall_and_precision(spark):
    rng = np.random.default_rng(11)
    x = np.concatenate([vectors_near(rng, 150, c) for c in (0.905, 0.95, 0.99, 0.89)] + [np.repeat(rng.normal(size=(1, 64)), 300, 0) + rng.normal(size=(300, 64)) * 0.01])
    x = x.astype(np.float32).astype(np.float64)
    frame = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = {r.vec_id: r for r in embedding_dedup.near_duplicates(frame).collect()}
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    linked = unit @ unit.T >= 0.9
    np.fill_diagonal(linked, False)
    found = sum(r.n_links for r in got.values())
    assert all(got[i].n_links <= linked[i].sum() for i in range(len(x)))
    assert found >= 0.97 * linked.sum()
    assert {got[i].component_id for i in range(1200, 1500)} == {1200} and all(got[i].n_links == 299 for i in range(1200, 1500))
    assert sum(r.kept for r in got.values()) == len({r.component_id for r in got.values()})


def test_embedding_query_equals_brute_force(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in read(spark, sf_dir, "embeddings").collect()]
    x = np.array([v for _, v in rows], np.float64)
    x /= np.linalg.norm(x, axis=1)[:, None]
    linked = x @ x.T >= 0.9
    np.fill_diagonal(linked, False)
    got = {r.vec_id: r.n_links for r in queries.QUERIES["op6_embedding_dedup"](spark, sf_dir).collect()}
    assert [got[i] for i, _ in rows] == linked.sum(axis=1).tolist()


def test_embedding_edges(spark):
    one, nan = [1.0] + [0.0] * 7, float("nan")
    rows = [(1, one), (2, one), (2, one), (3, None), (4, []), (5, [0.0] * 8), (6, [nan] * 8), (7, [None, 1.0]), (8, [float("inf")] * 8), (None, one), (9, [2.0] + [0.0] * 7), (10, [1.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "'x' AS label", "'x' AS node", "'x' AS n_links")
    got = sorted((r.vec_id or -1, r.n_links, r.component_id, r.kept) for r in embedding_dedup.near_duplicates(frame).collect())
    alone = [(i, 0, i, True) for i in (3, 4, 5, 6, 7, 8, 10)]
    assert got == sorted([(-1, 0, None, True), (1, 3, 1, True), (2, 3, 1, False), (2, 3, 1, False), (9, 3, 1, False), *alone])
    assert embedding_dedup.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_very_many_repeated_rows_are_one_node(spark):
    """Two near texts, each 10,000 times with its doc_id and some times with another; and a text alone."""
    words = [f"w{i}" for i in range(120)]
    texts = {1: " ".join(words), 2: " ".join([*words[:60], "other", *words[60:]]), 3: " ".join(words[::-1])}
    times = spark.range(10_000).drop("id")
    rows = spark.createDataFrame([*texts.items(), (7, texts[2]), (8, texts[1])], "doc_id long, text string")
    got = ngram_join.join(times.crossJoin(rows)).groupBy("doc_id", "n_shingles", "component_id").count().collect()
    assert {tuple(r) for r in got} == {(1, 118, 1, 10_000), (2, 119, 1, 10_000), (3, 118, 3, 10_000), (7, 119, 1, 10_000), (8, 118, 1, 10_000)}


def test_one_row_per_near_node_and_pair(spark):
    words = [f"w{i}" for i in range(60)]
    rows = [(i % 2, " ".join(words if i % 2 else [*words[:30], *words[31:], "x"])) for i in range(480)]
    join = ngram_join.Join(spark.createDataFrame(rows, "doc_id long, text string"), 3, 80)
    assert join.near.count() == join.nodes.count() == 2
    assert join.members.groupBy("tile", "node").count().where("count > 1").count() == 0
    assert join.node_links().distinct().count() == 1


def test_tiles_that_occur_once_send_one_entry(spark):
    """What reaches the second step are the tiles of several sets only; a hot tile's sets beyond the first go there directly."""
    words = [f"w{i}" for i in range(40)]
    alike = [(i, " ".join([*words[: i % 35], f"own{i}", *words[i % 35 + 1 :]])) for i in range(300)]
    alone = [(1000 + i, " ".join(f"z{i}_{k}" for k in range(40))) for i in range(300)]
    messages = spark.createDataFrame(alike + alone, "doc_id long, text string").coalesce(1).mapInArrow(
        ngram_join._tile_messages(ngram_join.Bands(80), 3, 4), "range long, shared boolean, tiles binary, nodes binary"
    ).collect()
    assert all(len(m.tiles) * (1 if m.shared else 2) == len(m.nodes) for m in messages)
    own = [(m.range, t) for m in messages if not m.shared for t in np.frombuffer(bytes(m.tiles), np.uint32).tolist()]
    assert len(own) == len(set(own))  # a tile once, however many sets have it
    join = ngram_join.Join(spark.createDataFrame(alike + alone, "doc_id long, text string"), 3, 80)
    ids = {r.node: r.doc_id for r in join.nodes.collect()}
    assert {ids[r.node] for r in join.members.select("node").distinct().collect()} <= set(range(300))


def test_released_steps_leave_nothing_behind(spark):
    from pathlib import Path

    from stockflow.session import work_dir

    def tables():
        return {p.name for p in Path(work_dir(spark)).iterdir()}

    before = tables()
    rows = [(i, " ".join(f"w{k + i % 3}" for k in range(50))) for i in range(40)]
    ngram_join.join(spark.createDataFrame(rows, "doc_id long, text string"), 3, 80).count()
    left = sorted(n.rsplit("-", 1)[0] for n in tables() - before)
    assert len(left) <= 12 and not {"ngram-near", "ngram-members", "ngram-tile-members", "ngram-bound", "ngram-around", "star-least"} & set(left), left


def test_wide_bitmaps_take_a_byte_an_element_at_most():
    bands = ngram_join.Bands(80)
    for n in (40, 300, 2000, 20_000):
        largest = bands.edges[bands.of(np.array([n]))[0] + 1]
        assert len(ngram_join.bitmaps(np.arange(n, dtype=np.uint64), np.array([0, n]), bands, ngram_join.WIDE)[0]) <= largest

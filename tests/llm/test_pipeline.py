import sys
from collections import Counter
from pathlib import Path

import public_tokenizers
import pyarrow as pa
import pytest
from edges import edge_docs, no_docs
from test_dedup import brute_join

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline as pipeline

from stockflow.llm import common, mixing, tokens, toxicity
from stockflow.llm.common import read

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def planted(spark, sf_dir, tmp_path_factory):
    """The driver's documents with planted copies and near copies."""
    root = str(tmp_path_factory.mktemp("planted"))
    docs = read(spark, sf_dir, "documents")
    words = [f"plant{i}" for i in range(400)]
    near = [" ".join(words[:k] + ["other"] + words[k + 1 :]) for k in range(0, 400, 40)]
    rows = [(900_000 + i, t) for i, t in enumerate([" ".join(words), *near, "just one copy of this", "just one copy of this", "quite another text"])]
    extra = spark.createDataFrame([(i, t, "en", "planted", len(t)) for i, t in rows], docs.schema)
    docs.unionByName(extra).write.parquet(f"{root}/documents.parquet")
    read(spark, sf_dir, "labels").write.parquet(f"{root}/labels.parquet")
    return root


def test_stages_against_brute_force(spark, planted):
    docs = read(spark, planted, "documents").persist()
    after = {}
    for name, stage in pipeline.STAGES:
        docs = stage(spark, docs, planted).persist()
        after[name] = docs
        if name != "packing":
            assert docs.columns == COLUMNS
    texts = {n: {r.doc_id: r.text for r in d.collect()} for n, d in after.items() if n in ("toxicity", "exact_dedup", "ngram_join")}
    start = read(spark, planted, "documents")
    model = toxicity.learn(start, read(spark, planted, "labels"))
    assert set(texts["toxicity"]) == {r.doc_id for r in toxicity.scored(start, model).collect() if not r.predicted}
    newest = {}
    for i, t in sorted(texts["toxicity"].items()):
        newest[t] = i
    assert set(texts["exact_dedup"]) == set(newest.values())
    groups = brute_join(list(texts["exact_dedup"].items()), pipeline.NEAR_GRAM, pipeline.NEAR_PERCENT)
    assert set(texts["ngram_join"]) == {i for i, (_, c) in groups.items() if i == c}
    assert [i for i in texts["ngram_join"] if i >= 900_000] == [900_000, 900_012, 900_013] or sorted(i for i in texts["ngram_join"] if i >= 900_000) == [900_000, 900_012, 900_013]
    copies = Counter(r.doc_id for r in after["mixing"].select("doc_id").collect())
    want = {r.doc_id: r.taken // r.size for r in mixing.mix(after["ngram_join"]).collect() if r.size}
    assert {i: n for i, n in copies.items() if i in want} == {i: n for i, n in want.items() if n}
    pieces = after["packing"].collect()
    tokens = {p.doc_id: p.doc_tokens for p in pieces}
    assert set(tokens) == set(copies)
    assert sum(p.length for p in pieces) == sum(tokens[i] * n for i, n in copies.items())


def test_run_is_the_stages(spark, sf_dir):
    rows = pipeline.run(spark, sf_dir)
    assert rows.columns == ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"] and rows.count() > 0
    assert pipeline.ORACLE_SQL is None


@pytest.mark.parametrize("make", [edge_docs, no_docs])
def test_stages_take_edge_rows(spark, sf_dir, make):
    docs = make(spark)
    for _, stage in pipeline.STAGES:
        docs = stage(spark, docs, sf_dir).persist()
        docs.count()


def test_workers_give_memory_back_after_each_batch(monkeypatch):
    given = []
    monkeypatch.setattr(common, "give_back", lambda: given.append(1), raising=False)
    batches = [pa.RecordBatch.from_pydict({"text": ["a b", None, "c" * 50] * 4}) for _ in range(3)]
    slices = [s.num_rows for s in common.text_slices(iter(batches), most=100)]
    assert sum(slices) == 36 and len(slices) > 3
    assert len(given) == 3


def test_new_words_are_encoded_in_parts(monkeypatch):
    texts = pa.array([" ".join(f"{a}{b}{c} word{a}." for b in "aeiou") for a in "bcdfg" for c in "klmn"])
    whole = tokens.Encoder(public_tokenizers.path(pipeline.TOKENIZER)).encode(texts, 1)
    parts, encoder = [], tokens.Encoder(public_tokenizers.path(pipeline.TOKENIZER))
    monkeypatch.setattr(tokens, "AT_ONCE", 7, raising=False)
    encode = encoder._encode
    monkeypatch.setattr(encoder, "_encode", lambda units, plain: parts.append(len(units)) or encode(units, plain))
    for one, other in zip(whole, encoder.encode(texts, 1), strict=True):
        assert one.tolist() == other.tolist()
    assert len(parts) > 1 and max(parts) == 7

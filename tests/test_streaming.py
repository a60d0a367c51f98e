"""Streams drained file by file equal the batch result."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame

from stockflow.plans.feed import order_lines
from stockflow.sources.landed_json import read_corrupt, read_landed
from stockflow.streaming import orders as orders_module
from stockflow.streaming.orders import LINES, ingest_orders, newest, read_lines, read_versions, superseded_lines, touched_lines
from stockflow.streaming.revenue import compact_days, daily_revenue, keep_daily_revenue, monthly_from_daily, read_days

JULY = 1751587200000  # 2025-07-04
DAY = 86_400_000


def order(oid, created, *lines):
    doc = {"id": oid, "createdTime": created}
    if lines:
        doc["lineItems"] = {"elements": [dict(zip(("id", "price", "unitQty", "item"), l)) for l in lines]}
    return doc


def land_docs(root, pull, store, name, docs):
    folder = root / "orders" / f"pull_date={pull}" / f"location={store}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(d) for d in docs))


A = ("a", 1000, 2000, {"id": "P1"})
B = ("b", 500, None, {"id": "P2"})
C = ("c", 700, 1500, None)


@pytest.fixture()
def landed(tmp_path):
    land_docs(tmp_path, "2025-08-01", "s1", "1.json", [order("o1", JULY, A, B), order("o2", JULY + DAY)])
    land_docs(tmp_path, "2025-08-01", "s1", "2.json", [order("o1", JULY, A, B)] * 50)
    land_docs(tmp_path, "2025-08-01", "s2", "3.json", [order("o3", JULY + 40 * DAY, C)])
    return tmp_path


def keys(df):
    return sorted((r.sale_id, str(r.sale_date), r.location, r.product_id, float(r.quantity)) for r in df.collect())


def drain(spark, landed, sink):
    ingest_orders(spark, str(landed), sink, files_per_batch=1).awaitTermination()
    return read_lines(spark, sink)


def test_copies_inside_and_across_batches_are_taken_once(spark, landed, tmp_path):
    lines = drain(spark, landed, f"{tmp_path}/sink")
    batch = order_lines(read_landed(spark, str(landed), "orders")).distinct()
    assert keys(lines) == keys(batch) and lines.count() == 3
    assert lines.select("batch_id").distinct().count() >= 2


def test_a_restart_goes_on_and_the_newest_pull_wins(spark, landed, tmp_path):
    sink = f"{tmp_path}/sink"
    drain(spark, landed, sink)
    # A later pull brings an old line with another price, one unchanged, and an older new order.
    changed = ("a", 900, 2000, {"id": "P1"})
    land_docs(landed, "2026-08-01", "s1", "4.json", [order("o1", JULY, changed, B), order("o0", JULY - 300 * DAY, ("z", 1, 0, None))])
    lines = drain(spark, landed, sink)
    assert sorted((r.sale_id, float(r.unit_price)) for r in lines.collect()) == [("a", 9.0), ("b", 5.0), ("c", 7.0), ("z", 0.01)]
    assert [(r.sale_id, float(r.unit_price)) for r in superseded_lines(spark, sink).collect()] == [("a", 10.0)]
    # An older pull that lands late changes nothing.
    land_docs(landed, "2025-07-15", "s1", "5.json", [order("o1", JULY, ("a", 100, 2000, {"id": "P1"}))])
    assert keys(drain(spark, landed, sink)) == keys(lines)


def test_lines_without_a_date_are_taken_once(spark, tmp_path):
    sink = f"{tmp_path}/sink"
    for i, pull in enumerate(("2025-08-01", "2025-09-01", "2025-10-01")):
        land_docs(tmp_path, pull, "s1", f"{i}.json", [order("o1", None, A), order("o2", JULY, B)])
        assert keys(drain(spark, tmp_path, sink)) == keys(order_lines(read_landed(spark, str(tmp_path), "orders")).distinct())
    assert read_versions(spark, sink).count() == 2


def revenue(spark, sink):
    return {r.month: (float(r.revenue), float(r.units)) for r in monthly_from_daily(read_days(spark, sink)).collect()}


def test_daily_revenue_follows_the_lines(spark, landed, tmp_path):
    sink = f"{tmp_path}/sink"
    keep_daily_revenue(spark, str(landed), sink, files_per_batch=1).awaitTermination()
    assert revenue(spark, sink) == {"2025-07": (25.0, 3.0), "2025-08": (10.5, 1.5)}
    land_docs(landed, "2026-08-01", "s1", "4.json", [order("o1", JULY, ("a", 900, 2000, {"id": "P1"}))])
    keep_daily_revenue(spark, str(landed), sink, files_per_batch=1).awaitTermination()
    assert revenue(spark, sink) == {"2025-07": (23.0, 3.0), "2025-08": (10.5, 1.5)}


def forget_last_commit(sink):
    """The last batch's output is there, its commit is not: as after a crash between the two."""
    commits = sorted((Path(sink) / "checkpoint" / "commits").glob("[0-9]*"), key=lambda f: int(f.name))
    for file in (commits[-1], commits[-1].with_name(f".{commits[-1].name}.crc")):
        file.unlink(missing_ok=True)
    return int(commits[-1].name)


def test_a_batch_that_runs_again_counts_once(spark, landed, tmp_path):
    sink = f"{tmp_path}/sink"
    for docs in (None, [order("o1", JULY, ("a", 900, 2000, {"id": "P1"}))]):
        if docs:
            land_docs(landed, "2026-08-01", "s1", "4.json", docs)
        keep_daily_revenue(spark, str(landed), sink, files_per_batch=1).awaitTermination()
        want, versions = revenue(spark, sink), keys(read_versions(spark, sink))
        last = forget_last_commit(sink)
        query = keep_daily_revenue(spark, str(landed), sink, files_per_batch=1)
        query.awaitTermination()
        assert query.lastProgress["batchId"] == last
        assert revenue(spark, sink) == want and keys(read_versions(spark, sink)) == versions
    assert want == {"2025-07": (23.0, 3.0), "2025-08": (10.5, 1.5)} and len(versions) == 4


def test_a_batch_does_not_read_the_sink(spark, tmp_path, monkeypatch):
    """Ten pulls of the same lines and a new one each: the state alone tells what is known. Only a changed line is looked up, in its own months."""
    from stockflow.streaming import revenue as module

    asked = []
    monkeypatch.setattr(module, "read_versions", lambda spark, sink: asked.append(1) or read_versions(spark, sink))
    sink = f"{tmp_path}/sink"
    for i in range(10):
        land_docs(tmp_path, f"2025-{i // 2 + 1:02}-{i + 1:02}", "s1", f"{i}.json", [order("o1", JULY, A, B), order(f"n{i}", JULY + i * 30 * DAY, (f"x{i}", 100, 1000, None))])
    # The first pull lands once more, at the end.
    land_docs(tmp_path, "2025-01-01", "s1", "late.json", [order("o1", JULY, A, B)])
    keep_daily_revenue(spark, str(tmp_path), sink, files_per_batch=1).awaitTermination()
    assert not asked and read_versions(spark, sink).count() == 12
    per_batch = {r.batch_id: r["count"] for r in read_versions(spark, sink).groupBy("batch_id").count().collect()}
    assert sorted(per_batch.values()) == [1] * 9 + [3]
    land_docs(tmp_path, "2025-12-01", "s1", "changed.json", [order("o1", JULY, ("a", 900, 2000, {"id": "P1"}))])
    keep_daily_revenue(spark, str(tmp_path), sink, files_per_batch=1).awaitTermination()
    assert len(asked) == 1
    touched = spark.read.parquet(f"{sink}/days").filter("batch_id = 11").collect()
    assert [(str(r.sale_date), float(r.revenue), float(r.units), r.n_lines) for r in touched] == [("2025-07-04", -2.0, 0.0, 0)]


def test_days_are_compacted(spark, landed, tmp_path):
    sink = f"{tmp_path}/sink"
    for i in range(3):
        keep_daily_revenue(spark, str(landed), sink, files_per_batch=1).awaitTermination()
        want = revenue(spark, sink)
        compact_days(spark, sink)
        compact_days(spark, sink)
        assert revenue(spark, sink) == want
        land_docs(landed, f"2026-08-0{i + 1}", "s1", f"c{i}.json", [order("o1", JULY + i * 40 * DAY, ("a", 800 - i, 2000, {"id": "P1"}))])
    assert want == {"2025-07": (5.0, 1.0), "2025-08": (10.5 + 15.98, 3.5)}
    assert len([d for d in (tmp_path / "sink" / "days-compacted").iterdir() if d.name.startswith("upto=")]) >= 2


def test_a_line_whose_date_moves_counts_once(spark, tmp_path):
    """A date that is changed, filled in, taken back; a month that loses all its lines; a late older pull."""
    sink = f"{tmp_path}/sink"
    pulls = [
        ("2025-08-01", [order("o1", JULY, A), order("o2", None, B), order("o4", JULY, ("d", 300, 1000, {"id": "P3"}))], {"2025-07": 23.0, None: 5.0}),
        ("2025-09-01", [order("o1", JULY + 40 * DAY, A), order("o2", JULY, B)], {"2025-07": 8.0, "2025-08": 20.0}),
        ("2025-10-01", [order("o1", JULY, A)], {"2025-07": 28.0}),
        ("2025-08-15", [order("o1", JULY + 70 * DAY, A)], {"2025-07": 28.0}),
        ("2025-11-01", [order("o4", JULY + 1 * DAY, ("d", 400, 1000, {"id": "P3"})), order("o3", JULY + 40 * DAY, C)], {"2025-07": 29.0, "2025-08": 10.5}),
    ]
    for i, (pull, docs, want) in enumerate(pulls):
        land_docs(tmp_path, pull, "s1", f"{i}.json", docs)
        keep_daily_revenue(spark, str(tmp_path), sink, files_per_batch=1).awaitTermination()
        assert {m: x for m, (x, _) in revenue(spark, sink).items()} == want, pull
        lines = daily_revenue(read_lines(spark, sink))
        assert {r.month: float(r.revenue) for r in monthly_from_daily(lines).collect()} == want, pull


def test_line_schema(spark, landed):
    assert order_lines(read_landed(spark, str(landed), "orders")).dtypes == [(f.name, f.dataType.simpleString()) for f in LINES.fields]


def test_corrupt_lines_are_shown_and_wrong_types_read_as_null(spark, tmp_path):
    land_docs(tmp_path, "2025-08-01", "s1", "1.json", [order("o1", JULY, A), order("o2", JULY, ("b", "abc", None, None))])
    folder = tmp_path / "orders" / "pull_date=2025-08-01" / "location=s1"
    (folder / "2.json").write_text('{"id": "o3", "createdTime"\n')
    lines = order_lines(read_landed(spark, str(tmp_path), "orders"))
    assert {r.sale_id for r in lines.collect()} >= {"a"}
    bad = [r.corrupt_line for r in read_corrupt(spark, str(tmp_path), "orders").collect()]
    assert any("o3" in b for b in bad) and not any('"o1"' in b for b in bad)


def test_state_of_a_line_is_plain(spark, landed):
    """Lists in the state would make each of the four groupings of a batch keep objects for its groups."""
    plan = touched_lines(read_landed(spark, str(landed), "orders"))._jdf.queryExecution().executedPlan().toString()
    assert "ObjectHashAggregate" not in plan and "collect_set" not in plan


def versions_of_lines(spark, tmp_path, sink):
    """A line of three values, one that goes back to its first, one without an id, one that stays."""
    for i, (pull, a, d) in enumerate((("2025-08-01", 1000, 300), ("2025-09-01", 900, 400), ("2025-10-01", 800, 300))):
        docs = [order("o1", JULY + i * 40 * DAY, ("a", a, 2000, {"id": "P1"}), B), order("o2", JULY, ("d", d, 1000, None), (None, 100, 1000, {"id": "P9"}))]
        land_docs(tmp_path, pull, "s1", f"{i}.json", docs)
        keep_daily_revenue(spark, str(tmp_path), sink, files_per_batch=1).awaitTermination()


def test_lines_of_one_version_are_read_without_grouping(spark, tmp_path, monkeypatch):
    sink = f"{tmp_path}/sink"
    versions_of_lines(spark, tmp_path, sink)
    want = [("None", 1.0, "2025-07"), ("a", 8.0, "2025-09"), ("b", 5.0, "2025-09"), ("d", 3.0, "2025-07")]

    def read():
        return sorted((str(r.sale_id), float(r.unit_price), r.sale_month) for r in read_lines(spark, sink).collect())

    grouped = []
    monkeypatch.setattr(orders_module, "newest", lambda versions: grouped.append({r.line for r in versions.collect()}) or newest(versions))
    assert read() == want and grouped == [{"a", "b", "d"}]
    assert read_versions(spark, sink).filter("is_new").count() == 4
    # More lines of several versions than are looked up, and a sink that was written before it was kept which rows are new.
    monkeypatch.setattr(orders_module, "FEW", 0)
    assert read() == want and len(grouped[-1]) == 4
    monkeypatch.undo()
    monkeypatch.setattr(orders_module, "read_versions", lambda spark, sink: read_versions(spark, sink).withColumn("is_new", F.lit(None).cast("boolean")))
    assert read() == want


def test_the_state_is_gone_through_once_and_nothing_is_kept_in_memory(spark, tmp_path, monkeypatch):
    def kept(*args):
        raise AssertionError("persisted")

    monkeypatch.setattr(DataFrame, "persist", kept)
    sink = f"{tmp_path}/sink"
    versions_of_lines(spark, tmp_path, sink)
    assert revenue(spark, sink) == {"2025-07": (4.0, 2.0), "2025-09": (21.0, 3.0)}
    lines = daily_revenue(read_lines(spark, sink))
    assert {r.month: float(r.revenue) for r in monthly_from_daily(lines).collect()} == {"2025-07": 4.0, "2025-09": 21.0}

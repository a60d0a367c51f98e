"""A pull checked against the keys of all pulls before it equals the check of all rows."""

import pytest
from pyspark.sql import functions as F

from stockflow.operators.integrity import duplicate_keys
from stockflow.operators.key_history import KeyHistory
from stockflow.sources import manifest


class Unread:
    """A history that must not be looked at."""

    def __getattr__(self, name):
        raise AssertionError(name)


def test_pulls_with_nothing_known_do_not_read_the_history(spark, tmp_path):
    known = KeyHistory(spark, str(tmp_path), "sales", ("sale_id",))
    for i in range(3):
        pull = spark.range(i * 1000, i * 1000 + 1000).select(F.concat(F.lit("s"), "id").alias("sale_id"))
        assert known.check(pull, Unread()).count() == 0
        known.add(pull, str(i))
    filters = known._filters(None)
    # Two bytes a key at most, however many pulls.
    assert filters.agg(F.sum(F.length("bits"))).first()[0] == 64 * 4096
    alarms = known.suspects(spark.range(10_000, 20_000).select(F.concat(F.lit("s"), "id").alias("sale_id"))).count()
    assert alarms < 20


@pytest.mark.parametrize("keys", [("a",), ("a", "b")])
def test_all_pulls_together_find_what_the_full_check_finds(spark, tmp_path, keys):
    rows = spark.range(3000).select(
        F.when(F.col("id") % 97 != 0, (F.xxhash64("id") % 2000).cast("string")).alias("a"), F.when(F.col("id") % 89 != 0, F.col("id") % 3).alias("b"), (F.col("id") % 4).alias("pull")
    )
    known = KeyHistory(spark, str(tmp_path), "t", keys, blocks=2)
    newest = {}
    for i in range(4):
        pull = rows.filter(F.col("pull") == i)
        for r in known.check(pull, rows.filter(F.col("pull") < i)).collect():
            newest[tuple(r)[:-1]] = r.n_rows
        known.add(pull, str(i))
    assert newest == {tuple(r)[:-1]: r.n_rows for r in duplicate_keys(rows, list(keys)).collect()} and len(newest) > 200
    assert any(None in key for key in newest)


def test_a_pull_that_is_added_again_is_not_its_own_duplicate(spark, tmp_path):
    known = KeyHistory(spark, str(tmp_path), "t", ("a",))
    pull = spark.range(50).select(F.col("id").alias("a"))
    for _ in range(2):
        assert known.check(pull, pull.limit(0), name="p").count() == 0
        known.add(pull, "p")
    assert len(manifest.current(spark, str(tmp_path), "t-keys").directories) == 1
    assert known.check(spark.range(49, 51).select(F.col("id").alias("a")), pull, name="q").collect() == [(49, 2)]

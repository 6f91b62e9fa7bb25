"""Versions that switch together and buckets that split."""

import os

import pytest
from pyspark.sql import functions as F

from granary.operators.versions import FILES, Change, Versions


def rows(spark, low, high, value):
    return spark.range(low, high).select(F.col("id").alias("k"), F.lit(value).alias("v"))


def content(store, name):
    return sorted(tuple(r) for r in store.read(name).collect())


def grown(spark, folder, low, high, limit, value=0):
    change = Change(spark, folder, limit)
    fresh = rows(spark, low, high, value)
    change.table("t", fresh.schema, ["k"])
    change.append("t", fresh)
    change.commit(high=high)
    return change


def test_buckets_split_and_stay_whole(spark, tmp_path):
    folder = str(tmp_path / "t")
    for step in range(6):
        grown(spark, folder, 300 * step, 300 * step + 300, 100)
    store = Versions(spark, folder)
    assert content(store, "t") == [(k, 0) for k in range(1800)] and store.facts == {"high": 1800}
    buckets = store.tables["t"].buckets.values()
    assert len(buckets) >= 16 and store.tables["t"].rows == 1800 and max(b.rows for b in buckets) <= 300
    # Every hash has one bucket.
    assert sum(2.0**-b.depth for b in buckets) == 1
    placed = store.placed("t", rows(spark, 0, 1800, 0))
    assert placed.count() == 1800


def test_a_key_of_its_own_is_not_split(spark, tmp_path):
    folder = str(tmp_path / "t")
    change = Change(spark, folder, 10)
    one = spark.range(500).select(F.lit(7).cast("bigint").alias("k"), F.lit(1).alias("v"))
    change.table("t", one.schema, ["k"])
    change.append("t", one)
    change.commit()
    assert [b.rows for b in Versions(spark, folder).tables["t"].buckets.values()] == [500]


def test_what_a_change_rewrites_stays_flat(spark, tmp_path):
    """The same small change on a table of 1,000 and of 16,000 rows."""
    written = []
    for size in (1000, 16000):
        folder = str(tmp_path / f"t{size}")
        grown(spark, folder, 0, size, 200)
        grown(spark, folder, size, size + 1, 200)  # splits are done
        change = Change(spark, folder, 200)
        fresh = rows(spark, 5, 8, 1)
        change.replace_groups("t", fresh, lambda old, fresh=fresh: old.join(fresh.select("k"), "k", "left_anti"))
        cost = change.cost()
        change.commit()
        assert content(Versions(spark, folder), "t") == [(k, int(5 <= k < 8)) for k in range(size + 1)]
        written.append(cost)
    assert written[1]["read"] < 2 * written[0]["read"] and written[1]["written"] < 2 * written[0]["written"]
    whole = Versions(spark, folder)
    assert written[1]["read"] < 0.2 * whole.size_of([p for b in whole.tables["t"].buckets.values() for p in b.paths])


def test_a_run_broken_off_leaves_all_tables(spark, tmp_path):
    folder = str(tmp_path / "t")
    change = Change(spark, folder)
    change.whole("a", rows(spark, 0, 3, 0))
    change.whole("b", rows(spark, 0, 3, 0))
    change.commit()
    broken = Change(spark, folder)
    broken.whole("a", rows(spark, 0, 3, 1))  # and then the run is lost
    seen = Versions(spark, folder)
    assert content(seen, "a") == content(seen, "b") == [(k, 0) for k in range(3)]
    again = Change(spark, folder)
    assert not again._listed("data/v000000002-*")
    again.whole("a", rows(spark, 0, 3, 2))
    again.whole("b", rows(spark, 0, 3, 2))
    again.commit()
    assert content(Versions(spark, folder), "a") == content(Versions(spark, folder), "b") == [(k, 2) for k in range(3)]
    # A reader of the version before still finds its files.
    assert content(seen, "b") == [(k, 0) for k in range(3)]


def test_of_two_writers_one_fails(spark, tmp_path):
    folder = str(tmp_path / "t")
    first = Change(spark, folder)
    first.whole("a", rows(spark, 0, 3, 0))
    second = Change(spark, folder)
    second.whole("a", rows(spark, 0, 3, 1))
    second.commit()
    with pytest.raises(RuntimeError):
        first.commit()


def test_empty_changes_and_null_keys(spark, tmp_path):
    folder = str(tmp_path / "t")
    change = Change(spark, folder, 5)
    fresh = spark.createDataFrame([(None, k) for k in range(8)] + [(k, k) for k in range(8)], "k bigint, v int")
    change.table("t", fresh.schema, ["k"])
    assert change.append("t", fresh.limit(0)) == 0
    assert change.append("t", fresh) == 16
    change.rewrite("t", [], fresh.limit(0))
    change.commit()
    store = Versions(spark, folder)
    assert store.read("t").count() == 16 and store.read("t").where("k IS NULL").count() == 8


def folders(change):
    return {os.path.dirname(path) for path in change.written}


def test_rows_of_buckets_that_split_are_written_once(spark, tmp_path):
    """buckets split before their rows are written, all of them in one write."""
    folder = str(tmp_path / "t")
    change = grown(spark, folder, 0, 2000, 100)
    assert len(change.written) > 16 and len(folders(change)) == 1
    change = Change(spark, folder, 100)
    fresh = rows(spark, 1000, 6000, 1)
    change.replace_groups("t", fresh, lambda old: old.join(fresh.select("k"), "k", "left_anti"))
    assert len(folders(change)) == 1 and len(change.written) >= 60
    change.commit()
    store = Versions(spark, folder)
    assert content(store, "t") == [(k, int(k >= 1000)) for k in range(6000)]
    buckets = store.tables["t"].buckets.values()
    assert sum(2.0**-b.depth for b in buckets) == 1 and max(b.rows for b in buckets) <= 200 and store.tables["t"].rows == 6000
    # Full and other buckets get new rows in one write too.
    change = grown(spark, folder, 6000, 6050, 100, 2)
    assert len(folders(change)) == 1
    assert content(Versions(spark, folder), "t") == [(k, int(k >= 1000) + int(k >= 6000)) for k in range(6050)]


def test_a_bucket_written_anew_merges_its_rows(spark, tmp_path):
    folder = str(tmp_path / "t")
    for step in range(20):
        change = Change(spark, folder)
        fresh = rows(spark, 0, 10, 1)
        change.table("t", fresh.schema, ["k"])
        assert change.append("t", fresh, lambda both: both.groupBy("k").agg(F.sum("v").cast("int").alias("v"))) == 10
        change.commit()
    store = Versions(spark, folder)
    assert store.tables["t"].rows <= 10 * FILES
    assert [tuple(r) for r in store.read("t").groupBy("k").agg(F.sum("v")).orderBy("k").collect()] == [(k, 20) for k in range(10)]

"""The chain store against the row-by-row rules: load after load, folds, reused numbers, replayed batches, cost."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from granary.plans import chain_store, chains
from granary.plans.chain_store import ChainStore, chain_batches, read_chains
from tests.test_chains import BEFORE, NOW, as_table, frame, random_log, simulate

DAY = dt.date(2024, 1, 1)


def stamps(k):
    return BEFORE + dt.timedelta(days=k)


@pytest.mark.parametrize(("seed", "few"), [(2, 1000), (3, 3)])
def test_loads_in_turn(spark, tmp_path, monkeypatch, seed, few):
    """With a small ``FEW`` the moves are folded in; buckets of 60 rows split again and again."""
    monkeypatch.setattr(chain_store, "FEW", few)
    monkeypatch.setattr(chain_store, "SHARE", 4 if few == 1000 else 1000)
    store, expected, folds = ChainStore(spark, str(tmp_path / "chains"), 60), {}, 0
    for k in range(4):
        rows = random_log(seed + 10 * k, 120, 150)
        expected = simulate(expected, rows, stamps(k))
        report = store.load(frame(spark, rows), stamps(k))
        folds += report.folded
        got = as_table(read_chains(spark, store.folder))
        assert got == expected
        assert store.facts()["top"] == max(v[2] for v in expected.values())
    assert (folds > 0) == (few == 3)


def test_a_number_is_used_again(spark, tmp_path):
    """The largest chain goes into another one, so the next load opens a chain with its number; older items keep out of it."""
    store, expected = ChainStore(spark, str(tmp_path / "chains")), {}
    loads = [
        [(DAY, "01", 1, 1, 2, 1), (DAY, "02", 3, 1, 4, 1)],
        [(DAY, "03", 2, 1, 3, 1)],  # chain 2 goes into 1
        [(DAY, "04", 5, 1, 6, 1)],  # opens chain 2 anew
        [(DAY, "05", 7, 1, 8, 1), (DAY, "06", 6, 1, 7, 1)],  # chain 3 goes into the new chain 2 at once
        [(DAY, "07", 5, 1, 4, 1), (DAY, "08", 4, 1, 0, 0)],  # the new chain 2 goes into 1
    ]
    for k, rows in enumerate(loads):
        expected = simulate(expected, rows, stamps(k))
        store.load(frame(spark, rows), stamps(k))
        assert as_table(read_chains(spark, store.folder)) == expected
    assert {v[2] for v in expected.values()} == {1}


def test_a_plain_table_is_adopted(spark, tmp_path):
    first, second = random_log(4, 100, 60), random_log(5, 100, 60)
    expected = simulate({}, first, BEFORE)
    table = spark.createDataFrame([(*k, *v) for k, v in expected.items()], chains.CHAIN_SCHEMA)
    store = ChainStore(spark, str(tmp_path / "chains"))
    assert read_chains(spark, store.folder).count() == 0
    store.adopt(table)
    assert as_table(read_chains(spark, store.folder)) == expected
    store.load(frame(spark, second), NOW)
    assert as_table(read_chains(spark, store.folder)) == simulate(expected, second, NOW)


def test_a_broken_and_a_repeated_batch_change_nothing_twice(spark, tmp_path, monkeypatch):
    loads = {f"L{k}": random_log(20 + k, 60, 40) for k in range(4)}
    day = {f"L{k}": stamps(k) for k in range(4)}
    first = frame(spark, loads["L0"], "L0").unionByName(frame(spark, loads["L1"], "L1"))
    second = frame(spark, loads["L2"], "L2").unionByName(frame(spark, loads["L3"], "L3"))
    folder = str(tmp_path / "chains")
    handle = chain_batches(folder, day.get, 60)
    handle(first, 0)
    # The second batch is lost after its first load has been committed.
    real = ChainStore.load
    calls = []

    def lost(self, *args, **facts):
        if calls:
            raise RuntimeError("lost")
        calls.append(1)
        return real(self, *args, **facts)

    monkeypatch.setattr(ChainStore, "load", lost)
    with pytest.raises(RuntimeError):
        handle(second, 1)
    monkeypatch.setattr(ChainStore, "load", real)
    handle(second, 1)
    expected = {}
    for name, rows in loads.items():
        expected = simulate(expected, rows, day[name])
    assert as_table(read_chains(spark, folder)) == expected
    for batch, number in ((second, 1), (first, 0)):
        handle(batch, number)
    assert as_table(read_chains(spark, folder)) == expected


def test_a_load_costs_what_it_is(spark, tmp_path):
    """The same ten rows on a history of 500 and of 8,000 items: bytes opened and written stay, the history does not enter."""
    costs = []
    for size in (500, 8000):
        store = ChainStore(spark, str(tmp_path / f"c{size}"), 100)
        items = spark.range(size).select(
            (F.col("id") + 10).alias("plc_rsnum"), F.lit(1).alias("plc_rspos"), F.lit(DAY).alias("plc_udate"), F.lit("01").alias("plc_utime"),
            (F.col("id") + 1).alias("chain_id"), F.lit(BEFORE).alias("plc_lchg_date_time"),
        )
        store.adopt(items)
        report = store.load(frame(spark, [(DAY, "02", 10 + k, 1, 5, k + 1) for k in range(3)] + [(DAY, "03", 10, 1, 11, 1)]), NOW)
        assert (report.items, report.moves, report.folded) == (3, 1, False)
        costs.append(report)
    assert costs[1].read < 2 * costs[0].read and costs[1].written < 2 * costs[0].written

"""Late rows at the mark, keys over refills, folded journal, indexed pages, categories from what changed."""

import datetime as dt
import random

from pyspark.sql import functions as F

from granary.functions.dates import trailing_months
from granary.operators import journal as log
from granary.operators.keys import registered
from granary.operators.versions import Change, Versions
from granary.plans import headcount, marks, stock, stock_store
from granary.plans.journal_store import JournalStore
from granary.sources import pages

EVENT = "id bigint, part string, at timestamp, load int"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_rows_with_the_stamp_of_the_mark_are_taken_once(spark, tmp_path):
    folder = str(tmp_path / "marked")
    day = [dt.datetime(2024, 1, d) for d in (1, 2, 3)]

    def load(rows, number):
        source = spark.createDataFrame([(*r, number) for r in rows], EVENT)
        return marks.load_from_mark(source, "at", ["id", "part"], folder)[0]

    first = [(1, "a", day[0]), (2, None, day[1]), (3, "a", None)]
    assert load(first, 1) == 2
    late = [*first, (2, "b", day[1]), (None, "b", day[1])]
    assert load(late, 2) == 2
    assert load(late, 3) == 0
    # Before the mark: not taken. Both rows at the mark stay known when more arrive there.
    last = [*late, (9, "z", day[0]), (4, "a", day[1]), (5, "a", day[2])]
    assert load(last, 4) == 2
    assert load(last, 5) == 0 and load([], 6) == 0
    found = {(r["id"], r["part"]): r["load"] for r in marks.read_loaded(spark, folder).collect()}
    assert found == {(1, "a"): 1, (2, None): 1, (2, "b"): 2, (None, "b"): 2, (4, "a"): 4, (5, "a"): 4}


def test_a_marked_load_that_breaks_off_is_run_again(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "marked")
    source = spark.createDataFrame([(k, "a", dt.datetime(2024, 1, 1), 1) for k in range(5)], EVENT)

    def lost(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(Change, "whole", lost)
        try:
            marks.load_from_mark(source, "at", ["id"], folder)
        except RuntimeError:
            pass
    assert not Versions(spark, folder).tables
    assert marks.load_from_mark(source, "at", ["id"], folder)[0] == 5
    assert marks.read_loaded(spark, folder).count() == 5


def test_keys_survive_refills(spark, tmp_path):
    folder = str(tmp_path / "registry")
    kind = "name string, code int"

    def fill(*values):
        # Buckets of a few values, so that the registry splits.
        keyed = registered(spark.createDataFrame(list(values), kind), folder, 4)
        return {(r["name"], r["code"]): r["KEY"] for r in keyed.collect()}

    first = fill(("b", 1), ("a", 1), ("a", 1), (None, 2), ("", None))
    assert sorted(first.values()) == [1, 2, 3, 4]
    second = fill(("a", 1), ("a", 2), (None, None), ("z", 1))
    assert second[("a", 1)] == first[("a", 1)] and sorted(second.values())[1:] == [5, 6, 7]
    many = fill(*[(f"n{k}", k) for k in range(40)], ("b", 1))
    assert len(set(many.values())) == 41 and many[("b", 1)] == first[("b", 1)]
    again = fill(*first, *second, *[(f"n{k}", k) for k in range(40)])
    assert again == {**first, **second, **many} and len(set(again.values())) == len(again)
    assert fill() == {}
    assert len(Versions(spark, folder).tables["keys"].buckets) > 4


def test_order_of_a_refilled_dictionary_is_that_of_its_values(spark, tmp_path):
    folder = str(tmp_path / "registry")
    fill = lambda *names: rows_of(headcount.kept_dictionary(spark.createDataFrame([(n,) for n in names], "the_name string"), "the_name", folder))
    assert fill("b", "d") == [(1, "b", 1), (2, "d", 2)]
    assert fill("d", "c", "a") == [(2, "d", 3), (3, "a", 1), (4, "c", 2)]


def test_folded_state_equals_the_scan_of_all_events(spark, tmp_path):
    dice = random.Random(3)
    start = dt.datetime(2024, 1, 1)
    store = JournalStore(spark, str(tmp_path / "journal"), rows=40, length=4)
    assert store.state().count() == 0 and store.pending("A", "X").count() == 0
    kind = "flow_id string, target_lvl string, load_id string, stg_status string, row_count bigint, crea_datetime timestamp, last_delta_ts timestamp"
    every = []
    for step in range(10):
        part = [
            (dice.choice("AB"), dice.choice(["X", None]), f"L{dice.randrange(60)}", dice.choice("NIS"), dice.choice([None, 1, 2]), start + dt.timedelta(hours=dice.randrange(200)), None)
            for _ in range(50)
        ]
        every += part
        assert store.append(spark.createDataFrame(part, kind)) == step + 1
    whole = spark.createDataFrame(every, kind)
    created = whole.groupBy(*log.LOAD).agg(F.min("crea_datetime").alias("created"))
    state = store.state()
    assert rows_of(state.drop("created").select(*whole.columns)) == rows_of(log.current_state(whole).select(*whole.columns))
    assert rows_of(state.select(*log.LOAD, "created")) == rows_of(created.select(*log.LOAD, "created"))
    assert rows_of(store.pending("A", "X", ("N", "I"))) == rows_of(log.pending_loads(whole, "A", "X", ("N", "I")))
    assert store.events().count() == len(every)
    # Both folds and tail are there, and a fold without a tail does nothing.
    version = Versions(spark, store.folder)
    assert len(version.tables["tail"].buckets) == 2 and version.tables["history"].rows == 400
    assert store.fold()["written"] > 0 and store.fold()["written"] == 0
    assert rows_of(store.state()) == rows_of(state)


def test_state_reads_less_than_the_log(spark, tmp_path):
    store = JournalStore(spark, str(tmp_path / "journal"), length=2)
    events = spark.range(3000).select(
        F.lit("A").alias("flow_id"), F.lit("X").alias("target_lvl"), (F.col("id") % 20).cast("string").alias("load_id"), F.lit("I").alias("stg_status"),
        F.col("id").alias("row_count"), F.timestamp_seconds(F.col("id")).alias("crea_datetime"),
    )
    for _ in range(4):
        store.append(events)
    sizes = store.bytes_of_state()
    assert store.state().count() == 20 and sizes["read"] * 4 < sizes["log"]


def test_pages_by_the_fence_index(spark, tmp_path):
    path = str(tmp_path / "pages")
    keys = list(range(0, 997, 3))
    random.Random(1).shuffle(keys)
    df = spark.createDataFrame([(k, f"v{k % 7}") for k in keys], "k int, v string").repartition(5)
    pages.write_ranges(df, ["k"], path, 50)
    assert pages.indexed_size(spark, path) == len(keys)
    whole = [r["k"] for r in df.orderBy("k").collect()]
    for skip, top in ((0, 10), (45, 20), (30, 200), (len(keys) - 3, 10), (len(keys), 5), (0, 1000)):
        assert [r["k"] for r in pages.indexed_page(spark, path, ["k"], skip, top).collect()] == whole[skip : skip + top]
    assert len(pages.ranges_of_page(spark, path, len(keys) - 1, 1)) == 1
    # The plan names the files of the ranges it needs and no others.
    assert len(pages.indexed_page(spark, path, ["k"], len(keys) - 1, 1).inputFiles()) == 1


def test_pages_of_an_empty_extract_and_of_one_key(spark, tmp_path):
    df = spark.createDataFrame([], "k int, v string")
    pages.write_ranges(df, ["k"], str(tmp_path / "none"), 5)
    assert pages.indexed_size(spark, str(tmp_path / "none")) == 0
    empty = pages.indexed_page(spark, str(tmp_path / "none"), ["k"], 0, 3)
    assert empty.count() == 0 and empty.columns == ["k", "v"]
    one = spark.createDataFrame([(1, f"v{k:02d}") for k in range(40)], "k int, v string")
    pages.write_ranges(one, ["k", "v"], str(tmp_path / "one"), 10)
    assert [r["v"] for r in pages.indexed_page(spark, str(tmp_path / "one"), ["k", "v"], 18, 4).collect()] == ["v18", "v19", "v20", "v21"]


AS_OF = dt.date(2000, 6, 1)
MONTHS = trailing_months(AS_OF, 3)
STOCK = "st_werks string, st_o_divis string, st_r_divis string, st_matnr string, st_date date, st_qty decimal(18,2), st_amt decimal(18,2), st_bwtar string"
NEED = "rs_ppm_area string, rs_load_date timestamp, rs_matnr string, rs_qty_avlb decimal(18,2), rs_tech_data_type int, rs_ppm_elem string, rs_prof_load int"


def made_up(spark, dice, materials, count):
    from decimal import Decimal

    def date():
        return dt.date(1999, 1, 1) + dt.timedelta(days=30 * dice.randrange(19))

    first = [date().replace(day=dice.choice([1, 1, 1, 15])) for _ in range(count)]
    held = [
        (dice.choice(["W1", "W2", None]), dice.choice(["A", None]), "O", dice.choice(materials), d, Decimal(dice.randrange(-2, 40)), Decimal(dice.randrange(1, 90)), dice.choice(["OWN", "BUY", None]))
        for d in first
    ]
    needed = [
        (dice.choice(["A1", "A2", "A9"]), dt.datetime.combine(date(), dt.time(3)), dice.choice(materials), Decimal(dice.randrange(5)), dice.choice([1, 3, 2]), dice.choice(["1S", "2S"]), dice.choice([1, 2, 3]))
        for _ in range(count)
    ]
    return held, needed


def test_categories_from_what_changed(spark, tmp_path):
    dice = random.Random(8)
    folder = str(tmp_path / "stock")
    areas = spark.createDataFrame([("A1", "A", "O", "W1"), ("A2", "", "O", "W2"), ("", "A", "O", "W2")], "wm_oblast_ppm string, wm_o_divis string, wm_r_divis string, wm_werks string")
    calendar = spark.createDataFrame([(dt.date(1999 + m // 12, m % 12 + 1, 1),) for m in range(18)], "date date")
    every = [f"M{k}" for k in range(400)] + [None]
    held, needed = made_up(spark, dice, every, 4000)
    reports = []
    steps = [(held, needed, AS_OF), (*made_up(spark, dice, ["M7", "M9", "new"], 40), AS_OF), ([], [], AS_OF), (*made_up(spark, dice, [None], 5), AS_OF), ([], [], dt.date(2000, 5, 1))]
    all_held, all_needed = [], []
    for new_held, new_needed, as_of in steps:
        all_held, all_needed = all_held + new_held, all_needed + new_needed
        months = trailing_months(as_of, 3)
        new = spark.createDataFrame(new_held, STOCK), spark.createDataFrame(new_needed, NEED)
        reports.append(stock_store.load(*new, areas, calendar, months, as_of, folder, rows=100))
        whole = spark.createDataFrame(all_held, STOCK), spark.createDataFrame(all_needed, NEED)
        expected = stock.categorised(*whole, areas, calendar, months, as_of)
        found = stock_store.read_categories(spark, folder)
        assert rows_of(found.select(*expected.columns)) == rows_of(expected)
    assert [r.whole for r in reports] == [True, False, False, False, True]
    assert [r.materials for r in reports[1:4]] == [3, 0, 1]
    # A hundredth of the rows, on three materials: a small part of the buckets is opened and written.
    store = Versions(spark, folder)
    size = store.size_of([p for t in store.tables.values() for b in t.buckets.values() for p in b.paths])
    assert reports[1].read + reports[1].written < size / 4


def test_sums_of_earlier_loads_are_not_written_again(spark, tmp_path):
    """a load puts its sums beside those before."""
    dice = random.Random(5)
    folder = str(tmp_path / "stock")
    areas = spark.createDataFrame([("A1", "A", "O", "W1"), ("A2", "", "O", "W2")], "wm_oblast_ppm string, wm_o_divis string, wm_r_divis string, wm_werks string")
    calendar = spark.createDataFrame([(dt.date(1999 + m // 12, m % 12 + 1, 1),) for m in range(18)], "date date")
    materials = [f"M{k}" for k in range(40)] + [None]
    all_held, all_needed, before = [], [], {"held": set(), "needed": set()}
    for step in range(10):
        held, needed = made_up(spark, dice, materials, 60)
        all_held, all_needed = all_held + held, all_needed + needed
        stock_store.load(spark.createDataFrame(held, STOCK), spark.createDataFrame(needed, NEED), areas, calendar, MONTHS, AS_OF, folder)
        tables = Versions(spark, folder).tables
        now = {name: {p for b in tables[name].buckets.values() for p in b.paths} for name in before}
        if step < 8:  # a bucket of more files is written anew
            assert all(before[name] < now[name] for name in before)
        before = now
    assert len(before["held"]) < 8
    expected = stock.categorised(spark.createDataFrame(all_held, STOCK), spark.createDataFrame(all_needed, NEED), areas, calendar, MONTHS, AS_OF)
    assert rows_of(stock_store.read_categories(spark, folder).select(*expected.columns)) == rows_of(expected)

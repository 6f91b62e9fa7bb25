"""Row-set, join, replacement and journal operators on small tables."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from granary.functions.numbers import ratio, whole
from granary.functions.text import class_by_prefix, joined, joined_present
from granary.operators import journal as log
from granary.operators.components import component_roots
from granary.operators.joins import grid_product, left_join_many, salts_per_key, update_from
from granary.operators.replace import overwrite_partitions, read_partitions, replace_groups, without_batch
from granary.operators.rows import distinct_union, numbered, one_row_per_key
from granary.session import materialise, materialise_counted
from granary.sources import pages, tables
from workload import fixtures as fx


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_numbers_are_dense_and_ordered_over_partitions(spark):
    values = list(range(5000))
    random.Random(1).shuffle(values)
    df = spark.createDataFrame([(v % 50, v) for v in values], "a int, b int").repartition(7)
    got = numbered(df, ["a", "b"], "n", start=11).orderBy("n").collect()
    assert [r["n"] for r in got] == list(range(11, 5011))
    assert [(r["a"], r["b"]) for r in got] == sorted((v % 50, v) for v in values)


def test_one_row_per_key_keeps_null_keys(spark):
    df = spark.createDataFrame([(1, 5), (1, 3), (None, 9), (None, 9), (2, 1)], "k int, v int")
    assert rows(one_row_per_key(df, ["k"])) == rows(spark.createDataFrame([(1, 3), (2, 1), (None, 9), (None, 9)], df.schema))
    assert rows(one_row_per_key(df, ["k"], keep="last"))[0] == (1, 5)
    keys = spark.createDataFrame([(1,), (1,), (None,), (None,)], "k int")
    assert rows(one_row_per_key(keys, ["k"])) == [(1,), (None,), (None,)]


def test_distinct_union_also_within_one_input(spark):
    a = spark.createDataFrame([(1,), (1,)], "x int")
    assert rows(distinct_union(a, spark.createDataFrame([(1,), (2,)], "x int"))) == [(1,), (2,)]


def test_hot_keys_give_the_same_join(spark):
    rng = random.Random(2)
    keys = [1] * 300 + [None] * 40 + [rng.randint(2, 90) for _ in range(500)]
    left = materialise(spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k int, i int"), "left")
    many = left.select("k", F.col("i").alias("j"))
    few = spark.createDataFrame([(k, k) for k in [*range(1, 70), None, 1]], "k int, l int")
    for per_salt in (1, 20, 1000):
        assert rows(left_join_many(few, many, ["k"], per_salt)) == rows(few.join(many, "k", "left"))
    assert rows(salts_per_key(many.dropna(), ["k"], 20).where("_salts > 1")) == [(1, 15)]
    assert rows(left_join_many(few, many.limit(0), ["k"])) == rows(few.join(many.limit(0), "k", "left"))


def test_hot_keys_of_the_driver_s_tables_are_salted(spark):
    names = fx.table(spark, "/root/testdata/sf0.01", "lineitem").select((F.col("l_orderkey") % 3 * F.col("l_orderkey")).alias("k"))
    spread = {r["_salts"] for r in salts_per_key(names, ["k"]).collect()}
    assert spread >= {1} and max(spread) > 15  # a third of all rows has one key


def test_update_takes_the_least_partner_and_keeps_the_rest(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, v string")
    source = spark.createDataFrame([(1, "z"), (1, "y"), (None, "n"), (3, "q")], "sk int, sv string")
    assert rows(update_from(target, source, {"k": "sk"}, {"v": "sv"})) == [(1, "y"), (2, "b"), (None, "c")]
    # A partner that holds NULL overwrites with NULL.
    empty = spark.createDataFrame([(2, None)], "sk int, sv string")
    assert rows(update_from(target, empty, {"k": "sk"}, {"v": "sv"})) == [(1, "a"), (2, None), (None, "c")]


def test_components_of_paths_stars_and_cliques(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 60)] + [(200 + i, 200 + rng.randint(0, 30)) for i in range(90)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for u, v in edges:
        a, b = sorted((find(u), find(v)))
        parent[b] = a
    for u, v in edges:
        a, b = sorted((find(u), find(v)))
        parent[b] = a
    expected = {n: min(m for m in parent if find(m) == find(n)) for n in parent}
    got = dict(rows(component_roots(spark.createDataFrame(edges, "u bigint, v bigint"))))
    loops = {n for n in expected if all(u == v for u, v in edges if n in (u, v))}
    assert got == {n: r for n, r in expected.items() if n not in loops}


def test_replaced_groups_leave_null_keys(spark):
    table = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, v int")
    fresh = spark.createDataFrame([("a", 7), ("a", 8), (None, 9)], table.schema)
    expected = [("a", 7), ("a", 8), ("b", 2), (None, 3), (None, 9)]
    assert rows(replace_groups(table, fresh, ["k"])) == expected
    assert rows(without_batch(table, "k", "a")) == [("b", 2), (None, 3)]


def test_partitions_are_replaced_and_emptied(spark, tmp_path):
    path = str(tmp_path / "months")
    schema = "v int, m date"
    jan, feb, mar = (dt.date(2024, m, 1) for m in (1, 2, 3))
    overwrite_partitions(spark.createDataFrame([(1, jan), (2, feb), (3, mar)], schema), path, "m")
    fresh = spark.createDataFrame([(7, feb)], schema)
    for _ in range(2):
        overwrite_partitions(fresh, path, "m", [feb, mar])
        assert rows(read_partitions(spark, path, schema)) == [(1, jan), (7, feb)]


def test_interrupted_load_is_still_pending(spark):
    t = [dt.datetime(2024, 1, d) for d in range(1, 6)]
    events = [
        ("F", "EDW", "x", "N", None, t[0]), ("F", "EDW", "x", "I", 5, t[2]), ("F", "EDW", "y", "N", None, t[1]),
        ("F", "EDW", "y", "I", 5, t[3]), ("F", "EDW", "y", "S", 5, t[3]), ("F", "EDW", "z", "N", None, t[4]),
    ]
    journal = spark.createDataFrame(events, "flow_id string, target_lvl string, load_id string, stg_status string, row_count bigint, crea_datetime timestamp")
    assert [r["load_id"] for r in log.pending_loads(journal, "F", "EDW").collect()] == ["z"]
    retry = log.pending_loads(journal, "F", "EDW", ("N", "I")).orderBy("created")
    assert [r["load_id"] for r in retry.collect()] == ["x", "z"]
    assert log.oldest_pending(journal, "F", "EDW").first()["load_id"] == "z"


def test_gate_is_misled_by_rows_but_not_by_flows(spark):
    schema = "flow_id string, target_lvl string, load_id string, stg_status string, row_count bigint, crea_datetime timestamp"
    at = dt.datetime(2024, 1, 9, 23)
    flows = [f"INT_{n:02d}" for n in range(1, 9)]
    twice = [(f, "EDW", f, "S", 1, at) for f in [*flows, flows[0]]]
    got = log.readiness(spark.createDataFrame(twice, schema), "2024-01-10").first()
    assert (got["by_rows"], got["by_flows"]) == (True, False)
    edge = [("INT_09", "EDW", "q", "S", 1, dt.datetime(2024, 1, 10, 8)), ("INT_01", "EDW", "r", "S", 1, dt.datetime(2024, 1, 10, 8, 0, 1))]
    got = log.readiness(spark.createDataFrame(twice[:8] + edge, schema), "2024-01-10").first()
    assert (got["by_rows"], got["by_flows"], got["rows"]) == (True, True, 9)


def test_watermark_of_an_empty_journal(spark):
    empty = spark.createDataFrame([], "end_ts timestamp")
    row = log.watermark(empty, "end_ts", "1900-01-01 12:00:00").first()
    assert (row["last_end"], row["next_id"]) == (dt.datetime(1900, 1, 1, 12), 1)


def test_pages_cover_the_filtered_rows_and_may_be_empty(spark):
    df = spark.createDataFrame([(i, i % 2) for i in range(10)], "k int, p int")
    assert rows(pages.page(df, "k", 9, 3)) == [(9, 1)]
    assert rows(pages.page(df, "k", 12, 3)) == []
    kept = pages.extract(df, F.col("p") == 1, ["k"])
    assert pages.extract_size(df, F.col("p") == 1).first()["row_count"] == 5
    got = pages.paged(kept, "k", 2).orderBy("k").collect()
    assert [(r["k"], r["page_no"]) for r in got] == [(1, 0), (3, 0), (5, 1), (7, 1), (9, 2)]


def test_insert_needs_exactly_the_target_columns(spark):
    target = spark.createDataFrame([], "a int, b string").schema
    df = spark.createDataFrame([("x", 1)], "b string, a bigint")
    assert tables.matching(df, target).schema.simpleString() == "struct<a:int,b:string>"
    for wrong in (df.drop("a"), df.withColumn("c", F.lit(1))):
        try:
            tables.matching(wrong, target)
        except ValueError:
            continue
        raise AssertionError("a differing column list was accepted")


def test_scalar_rules(spark):
    df = spark.createDataFrame([("2.5", None, 0), ("-2.5", "x", 4)], "t string, s string, d int")
    got = df.select(
        whole(F.col("t").cast("decimal(10,2)")), joined(F.col("t"), F.col("s")), joined_present(F.col("t"), F.col("s")), ratio(F.lit(8), F.col("d")),
        class_by_prefix(F.col("s"), {"x": "ex"}, "other"),
    )
    assert [tuple(r) for r in got.collect()] == [(3, None, "2.5", None, "other"), (-3, "-2.5x", "-2.5x", 2.0, "ex")]


def test_rows_are_counted_while_writing(spark):
    table, count = materialise_counted(spark.range(1234).toDF("x"), "counted")
    assert count == table.count() == 1234
    assert materialise_counted(spark.range(0).toDF("x"), "none")[1] == 0


def test_literal_rows(spark):
    assert rows(tables.literal(spark, [[1, "a"], (2, None)], "x int, y string")) == [(1, "a"), (2, None)]


@pytest.mark.parametrize("rows_per_block", [2, 1000])
def test_grid_product_against_left_joins(spark, rows_per_block):
    """Hot keys, keys without partners on one side or all, null keys and null cells, repeated rows."""
    pick = random.Random(5)
    key = lambda: pick.choice([None, "hot", "hot", "a", "b", "c", str(pick.randrange(20))])
    sides = [[(key(), pick.choice([None, k % 7])) for k in range(n)] for n in (40, 60, 50)]
    base, left, right = (spark.createDataFrame(rows, f"k string, {c} int") for rows, c in zip(sides, "xyz", strict=True))
    base, left, right = (materialise(df, "side") for df in (base, left, right))
    want = base.join(left, "k", "left").join(right, "k", "left").select("k", "x", "y", "z")
    got = grid_product(base, [left, right], "k", rows_per_block)
    assert got.columns == ["k", "x", "y", "z"]
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_grid_product_shuffles_its_input_only(spark):
    """A key with 300 rows on each of three sides gives 27 million rows; its 27 cells hold blocks of about a hundred."""
    side = lambda c: materialise(spark.range(300).select(F.lit("hot").alias("k"), F.col("id").alias(c)), "side")
    got = grid_product(side("x"), [side("y"), side("z")], "k", 100)
    assert got.count() == 300**3


def test_components_name_the_root_of_a_vertex_once(spark, monkeypatch):
    """A round does not unfold every edge in two: the root of the larger end comes from the vertex, and only then other ends follow."""
    from granary.operators import components

    plans, write = [], components.materialise

    def noted(df, label):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return write(df, label)

    monkeypatch.setattr(components, "materialise", noted)
    edges = [(i, j) for i in range(12) for j in range(i)] + [(20 + i, 21 + i) for i in range(6)]
    got = dict(rows(components.component_roots(spark.createDataFrame(edges, "u bigint, v bigint"))))
    assert got == {i: 0 for i in range(12)} | {20 + i: 20 for i in range(7)}
    assert len(plans) > 2 and not any("Generate" in p for p in plans)

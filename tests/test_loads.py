"""Snapshot, watermark and streaming loads."""

import datetime as dt
import random

from pyspark.sql import functions as F

from granary.operators import journal as log
from granary.plans import demand, loads as plan
from granary.streaming.loads import into_batches, run_available

NOW = dt.datetime(2024, 3, 1)
JOURNAL = "flow_id string, target_lvl string, load_id string, stg_status string, row_count bigint, crea_datetime timestamp"


def landing(spark, rows):
    """``rows`` of (snapshot, load, order number); all other columns are filled."""
    df = spark.createDataFrame(rows, "source_snap_id string, load_id string, aufnr string")
    fill = {c: F.lit(c) for c in plan.SNAPSHOT_COLUMNS if c not in df.columns}
    return df.withColumns(fill).withColumn("source_crea_date_time", F.lit(NOW)).select(*plan.SNAPSHOT_COLUMNS)


def core_of(spark, rows):
    staged = plan.staged(landing(spark, rows))
    return staged.withColumns({"dataflow_id": F.lit("INT_10"), "load_dttm": F.lit(NOW).cast("timestamp")})


def content(df):
    return sorted(((r["source_snap_id"], r["load_id"], r["aufnr"]) for r in df.collect()), key=str)


def test_all_pending_loads_as_if_loaded_in_turn(spark):
    rng = random.Random(4)
    snaps = ["hot"] * 6 + ["a", "b", "c", None]
    rows = [(rng.choice(snaps), f"L{rng.randint(1, 5)}", str(i)) for i in range(400)]
    created = {"L3": 1, "L1": 2, "L2": 2, "L4": 3}  # L5 is done already
    events = [("INT_10", "ODSP", n, "N", None, dt.datetime(2024, 1, d)) for n, d in created.items()]
    events += [("INT_10", "ODSP", "L5", s, 1, dt.datetime(2024, 1, 1)) for s in ("N", "S")] + [("INT_10", "EDW", "L1", "N", None, NOW)]
    journal = spark.createDataFrame(events, JOURNAL)
    before = [("hot", "L0", "x"), ("z", "L0", "y"), (None, "L0", "w")]
    expected = list(before)
    for load in sorted(created, key=lambda n: (created[n], n)):
        batch = [r for r in rows if r[1] == load]
        brought = {r[0] for r in batch if r[0] is not None}
        expected = [r for r in expected if r[0] not in brought] + batch
    done = plan.snapshot_load(landing(spark, rows), core_of(spark, before), journal, NOW)
    assert content(done.core) == sorted(expected, key=str)
    # After its events are appended no load is pending, and a second run changes nothing.
    logged = journal.unionByName(done.events, allowMissingColumns=True)
    assert log.pending_loads(logged, "INT_10", "ODSP").count() == 0
    again = plan.snapshot_load(landing(spark, rows), core_of(spark, before), logged, NOW)
    assert content(again.core) == sorted(before, key=str)
    counts = {(r["load_id"], r["target_lvl"], r["stg_status"]): r["row_count"] for r in done.events.collect()}
    assert counts[("L3", "EDW", "S")] == sum(r[1] == "L3" for r in rows)
    assert len(counts) == 4 * len(created)


def test_source_label_is_null_with_a_null_part(spark):
    rows = plan.staged(landing(spark, [("s", "L", "1"), (None, "L", "2")])).orderBy("aufnr").collect()
    assert rows[0]["source_cd"] == "s source_author_name 2024-03-01 00:00:00 source_snap_type"
    assert rows[1]["source_cd"] is None


def test_watermark_slices_meet_without_gap_or_overlap(spark):
    start = dt.datetime(2024, 1, 1)
    stamps = [start + dt.timedelta(hours=h) for h in range(48)]
    source = spark.createDataFrame([(i, s) for i, s in enumerate(stamps)], "id int, ts timestamp")
    cut = stamps[20]
    first, second = plan.slice_load(source, "ts", start, cut), plan.slice_load(source, "ts", cut, stamps[-1])
    ids = [r["id"] for r in first.collect()] + [r["id"] for r in second.collect()]
    assert sorted(ids) == list(range(47))
    # The strict form skips a row stamped exactly at the mark.
    assert plan.newer_rows(source, "ts", cut).count() == 27
    row = plan.journal_row(first, 3, "D", "shop", "t", start, cut).first()
    assert (row["id"], row["row_count"], row["start_ts"], row["end_ts"]) == (3, 20, start, cut)


def test_files_are_processed_once(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "check"))
    for start in (0, 10):
        spark.range(start, start + 10).write.mode("append").parquet(source)
        run_available(spark, source, "id bigint", checkpoint, into_batches(target))
    run_available(spark, source, "id bigint", checkpoint, into_batches(target))
    assert sorted(r["id"] for r in spark.read.parquet(target).collect()) == list(range(20))


def test_demand_amount_is_null_without_reserved_quantity(spark):
    rows = [(8, "10", "4", "5.00", "0"), (9, "10", "10", "5.00", "10"), (9, "10", "4", "5.00", "10"), (None, "1", "1", "1", "1")]
    df = spark.createDataFrame(rows, "potr_stad int, pt_qty_open string, rs_qty_avlb string, pt_fp01 string, pt_qty_res string")
    df = df.withColumns({c: F.col(c).cast("decimal(18,2)") for c in df.columns[1:]}).withColumn("q", demand.missing_quantity())
    got = df.select("q", F.try_divide(F.col("q") * F.col("pt_fp01"), F.col("pt_qty_res")).alias("a")).collect()
    assert [(r["q"], r["a"]) for r in got] == [(6, None), (0, 0), (6, 3), (None, None)]

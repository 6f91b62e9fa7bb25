"""The jobs on a folder of tables, run twice."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from granary.operators.journal import current_state
from granary.operators.versions import Change
from granary.plans import chains, daily, loads
from workload import fixtures as fx

SF = "/root/testdata/sf0.001"
NOW = dt.datetime.combine(fx.AS_OF, dt.time(9))
JOURNAL = "flow_id string, target_lvl string, load_id string, stg_status string, row_count bigint, crea_datetime timestamp"


def content(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def test_daily_run_is_repeatable(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "warehouse")

    def put(name, df):
        df.write.mode("overwrite").parquet(f"{folder}/{daily.TABLES.get(name, name)}")

    sources = {
        "stock": fx.stock, "required": fx.reqstock, "warehouses": fx.warehouses, "calendar": fx.calendar, "materials": fx.materials,
        "material_groups": fx.groups, "divisions": fx.divisions, "v_divis": fx.pairs,
    }
    for name, build in sources.items():
        put(name, build(spark, SF))
    log = fx.log(spark, SF).where(F.col("pl_rsnum") < 20).withColumn("load_id", F.lit("D1"))
    put("demand_log", log)
    put("chains", chains.no_chains(spark))
    for view, columns in (("v_budget_stock", loads.BUDGET_STOCK), ("v_budget_movem", loads.BUDGET_MOVEMENT)):
        put(view, spark.range(3).select(*[F.col("id").alias(c) for c in columns]))
    early = dt.datetime.combine(fx.AS_OF - dt.timedelta(days=1), dt.time(20))
    events = [(f"INT_{n:02d}", "EDW", f"X{n}", "S", 1, early) for n in range(1, 9)] + [("CALC_17", "IM", "D1", "N", None, early)]
    put("journal", spark.createDataFrame(events, JOURNAL))

    assert not daily.run_daily(spark, folder, NOW)
    ninth = spark.createDataFrame([("INT_09", "EDW", "X9", "S", 1, early)], JOURNAL)
    ninth.write.mode("append").parquet(f"{folder}/etl_delta_log")
    assert daily.run_daily(spark, folder, NOW)
    marts = ["categories", "enriched", "mt_budget_stock", "mt_budget_movem", "divis"]

    def everything():
        return {m: content(daily.read_mart(spark, folder, m)) for m in marts} | {"chains": content(daily.read_chains(spark, folder))}

    first = everything()
    assert all(first.values())
    state = current_state(spark.read.parquet(f"{folder}/etl_delta_log")).where("flow_id = 'CALC_17'").first()
    assert (state["stg_status"], state["row_count"]) == ("S", log.count())

    # A second run finds no pending load and rewrites the same months.
    assert daily.run_daily(spark, folder, NOW)
    assert everything() == first

    # A run that breaks off between the two category tables, or between two marts, leaves all as they were.
    whole, slices = Change.whole, Change.slices
    with monkeypatch.context() as broken:
        broken.setattr(Change, "slices", lambda self, name, *rest: slices(self, name, *rest) if name == daily.TABLES["categories"] else 1 / 0)
        with pytest.raises(ZeroDivisionError):
            daily.run_stock(spark, folder, NOW.date().replace(day=1), 2)
        broken.setattr(Change, "whole", lambda self, name, rows: whole(self, name, rows.limit(0)) if name == "divis" else 1 / 0)
        with pytest.raises(ZeroDivisionError):
            daily.run_marts(spark, folder)
    assert everything() == first


def test_snapshot_run_replaces_its_groups_only(spark, tmp_path):
    folder = str(tmp_path / "warehouse")
    landing, journal = fx.landing(spark, SF), fx.snap_journal(spark, SF)
    old = loads.core_form(landing.where(F.col("load_id") < "L1998"), NOW)
    expected = loads.snapshot_load(landing, old, journal, fx.NOW).core
    landing.write.parquet(f"{folder}/ods_toro_snap_b")
    journal.write.parquet(f"{folder}/etl_delta_log")
    loads.write_snapshot(old, f"{folder}/toro_snap_b")

    def core():
        return sorted(map(str, loads.read_snapshots(old, f"{folder}/toro_snap_b").select(*old.columns).collect()))

    daily.run_snapshot(spark, folder, fx.NOW)
    assert core() == sorted(map(str, expected.select(*old.columns).collect()))
    first = core()
    # Nothing is pending any more.
    daily.run_snapshot(spark, folder, fx.NOW)
    assert core() == first

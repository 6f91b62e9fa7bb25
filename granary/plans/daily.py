"""The jobs end to end: read the tables of a folder, run a plan, write its results and journal.

Tables are parquet folders named as in :data:`TABLES`. A table that a job both reads and replaces is first
written to the shared folder, as Spark cannot overwrite files it is still reading.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from granary.functions.dates import month_start, stamp as stamp_of, trailing_months
from granary.operators.journal import IN_WORK, NEW, SUCCESS, load_counts, pending_loads, readiness, status_events
from granary.operators.versions import Change, Versions
from granary.plans import chain_store, chains, loads, stock
from granary.session import discard, materialise
from granary.sources import sinks

# Table names of the warehouse.
TABLES = {
    "stock": "mt_stock",
    "required": "reqstock",
    "warehouses": "dim_wh_map",
    "calendar": "tech_unique_date",
    "materials": "dim_mat_txt",
    "material_groups": "dim_mat_gr_txt",
    "divisions": "v_dim_divis",
    "division_pairs": "divis",
    "journal": "etl_delta_log",
    "demand_log": "potr_log",
    "chains": "potr_log_chain",
    "categories": "mt_stock_categ_calc",
    "enriched": "mt_stock_categ_calc_enrich",
}
CHAIN_FLOW, CHAIN_LEVEL = "CALC_17", "IM"
DIVISION_PAIR = ["o_div_id", "r_div_id", "or_div_txt"]


def _path(folder: str, name: str) -> str:
    return f"{folder}/{TABLES.get(name, name)}"


def _read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    # The journal has grown a column; older files lack it.
    return spark.read.option("mergeSchema", name == "journal").parquet(_path(folder, name))


def _marts(folder: str) -> str:
    return f"{folder}/marts_versions"


def read_mart(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A mart in the newest version of the marts; before the first run, the plain table that the folder began with."""
    store = Versions(spark, _marts(folder))
    table = TABLES.get(name, name)
    return store.read(table) if table in store.tables else _read(spark, folder, name)


def _log(events: DataFrame, folder: str) -> None:
    sinks.append(events, _path(folder, "journal"))


def run_stock(spark: SparkSession, folder: str, as_of: dt.date, count: int = 12) -> None:
    """Recalculate the category tables of ``count`` months; a second run gives the same tables.

    Both tables switch to the new months with one version, so a run that breaks off leaves both as they were.
    """
    names = ["stock", "required", "warehouses", "calendar", "materials", "material_groups", "divisions"]
    tables = [*[_read(spark, folder, n) for n in names], read_mart(spark, folder, "division_pairs")]
    months = trailing_months(as_of, count)
    period = month_start("sca_date")
    categories = materialise(stock.categorised(*tables[:4], months, as_of).withColumn("sca_period", period), "categories")
    enriched = stock.enriched(categories, tables[2], *tables[4:])
    change = Change(spark, _marts(folder))
    change.slices(TABLES["categories"], categories.drop("sca_bwtar"), "sca_period", months)
    change.slices(TABLES["enriched"], enriched, "sca_period", months)
    change.commit()
    discard(categories)


def _chain_store(spark: SparkSession, folder: str) -> chain_store.ChainStore:
    return chain_store.ChainStore(spark, f"{_path(folder, 'chains')}_versions")


def read_chains(spark: SparkSession, folder: str) -> DataFrame:
    """The chain table in its newest version; before the first load, the plain table that the folder began with."""
    store = _chain_store(spark, folder)
    if store.facts():
        return chain_store.read_chains(spark, store.folder)
    return spark.read.schema(chains.CHAIN_SCHEMA).parquet(_path(folder, "chains"))


def run_chains(spark: SparkSession, folder: str, now: dt.datetime) -> list[str]:
    """Run the pending demand-log loads in the order of their creation; returns their ids.

    A load is logged as in work before and as done after its version of the chains is there, so an interrupted load
    is taken up again; the version names its load, so one that was done but not logged is not run twice.
    """
    journal = _read(spark, folder, "journal")
    todo = pending_loads(journal, CHAIN_FLOW, CHAIN_LEVEL, (NEW, IN_WORK)).orderBy("created", "load_id")
    stamp = stamp_of(now)
    store, done = _chain_store(spark, folder), []
    for load in [row["load_id"] for row in todo.collect()]:
        log = _read(spark, folder, "demand_log").where(F.col("load_id") == load)
        one = spark.createDataFrame([(load,)], "load_id string")
        counts = load_counts(log)
        _log(status_events(one, CHAIN_FLOW, CHAIN_LEVEL, IN_WORK, stamp, counts), folder)
        if not store.facts():
            store.adopt(read_chains(spark, folder))
        if store.facts().get("load") != load:
            store.load(log, now, load=load)
        _log(status_events(one, CHAIN_FLOW, CHAIN_LEVEL, SUCCESS, stamp, counts), folder)
        done.append(load)
    return done


def run_snapshot(spark: SparkSession, folder: str, now: dt.datetime) -> None:
    """Load all pending snapshot loads from ``ods_toro_snap_b`` into ``toro_snap_b``; a broken-off run is taken up again."""
    landing, path = _read(spark, folder, "ods_toro_snap_b"), _path(folder, "toro_snap_b")
    core = loads.core_form(landing, now).where(F.lit(False))
    outcome = loads.snapshot_load(landing, core, _read(spark, folder, "journal"), now, (NEW, IN_WORK))
    events = materialise(outcome.events, "events")
    fresh = materialise(outcome.fresh, "fresh")
    _log(events.where(F.col("stg_status") == IN_WORK), folder)
    loads.write_snapshot(fresh, path)
    _log(events.where(F.col("stg_status") == SUCCESS), folder)


def run_marts(spark: SparkSession, folder: str) -> None:
    """Refill the division pairs and the two budget marts from their views; all three switch with one version."""
    views = {
        "divis": ("v_divis", DIVISION_PAIR),
        "mt_budget_stock": ("v_budget_stock", loads.BUDGET_STOCK),
        "mt_budget_movem": ("v_budget_movem", loads.BUDGET_MOVEMENT),
    }
    change = Change(spark, _marts(folder))
    for mart, (view, columns) in views.items():
        change.whole(mart, _read(spark, folder, view).select(*columns))
    change.commit()


def run_daily(spark: SparkSession, folder: str, now: dt.datetime) -> bool:
    """The daily order: gate, marts, stock categories, chains. False when the gate is still closed."""
    if not readiness(_read(spark, folder, "journal"), now.date()).first()["by_flows"]:
        return False
    run_marts(spark, folder)
    run_stock(spark, folder, now.date().replace(day=1))
    run_chains(spark, folder, now)
    return True

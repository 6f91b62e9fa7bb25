"""Snapshot, watermark and full loads with a journal, and the refresh of marts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from granary.functions.dates import stamp as stamp_of
from granary.functions.text import joined
from granary.operators.journal import IN_WORK, SUCCESS, load_counts, pending_loads, status_events
from granary.operators.replace import without_keys
from granary.operators.rows import numbered
from granary.operators.versions import ROWS, Change, Versions
from granary.session import discard, materialise
from granary.sources import sinks

# Columns of the snapshot, in the order of the target.
SNAPSHOT_COLUMNS = [
    "source_snap_id", "source_author_name", "source_crea_date_time", "source_snap_type", "excep", "werks",
    "start_month", "tech_divis", "tech_divis_text", "work_divis", "work_divis_text", "pspel", "tplnr", "pltxt",
    "kostl", "kostv", "vaplz", "ekgrp", "srvpos", "asktx", "arbpl", "arbpl_ktext", "auart", "ingpr", "ktext",
    "aufnr", "user4", "cat12_3", "cat11_3", "cat11_1", "cat11_2", "cat12_1", "cat12_2", "cat13_3", "cat13_1",
    "cat13_2", "cat21", "cat22", "cat32", "cat42", "cat41", "arbei", "arbpl_werks", "steus", "kstar", "ilart",
    "zpost1", "load_id",
]
SNAPSHOT_KEY = "source_snap_id"
SNAPSHOT_FLOW = "INT_10"
STAGE, CORE = "ODSP", "EDW"

# Columns of the two budget marts.
BUDGET_STOCK = [
    "bs_werks", "bs_o_divis", "bs_r_divis", "bs_year", "bs_month", "bs_month_year", "bs_bwtar", "bs_amt",
    "bs_proizv", "bs_or_divis_txt", "bs_o_divis_txt", "bs_r_divis_txt",
]
BUDGET_MOVEMENT = [
    "bm_werks", "bm_o_divis", "bm_r_divis", "bm_year", "bm_month", "bm_month_year", "bm_bwtar", "bm_section",
    "bm_amt", "bm_proizv", "bm_or_divis_txt", "bm_o_divis_txt", "bm_r_divis_txt",
]


def source_label() -> Column:
    """Snapshot id, author, creation time and type in one text; NULL when one of them is."""
    created = F.date_format("source_crea_date_time", "yyyy-MM-dd HH:mm:ss")
    space = F.lit(" ")
    return joined(
        F.col("source_snap_id").cast("string"), space, F.col("source_author_name"), space, created, space, F.col("source_snap_type")
    )


def staged(landing: DataFrame, columns: Sequence[str] = SNAPSHOT_COLUMNS) -> DataFrame:
    """Landing rows in staging form: a stated column list and the derived source label."""
    return landing.select(*columns, source_label().alias("source_cd"))


def core_form(landing: DataFrame, now: dt.datetime) -> DataFrame:
    """Staged rows with the flow and the load time, the columns of the core table."""
    return staged(landing).withColumns({"dataflow_id": F.lit(SNAPSHOT_FLOW), "load_dttm": stamp_of(now)})


@dataclass
class SnapshotLoad:
    """Outcome of one run: the rows that replace their groups, the whole new core, the journal events to append."""

    fresh: DataFrame
    core: DataFrame
    events: DataFrame


def last_load_wins(placed: DataFrame, key: str = SNAPSHOT_KEY) -> DataFrame:
    """Rows of all loads as if loaded one by one in the order of ``place``, each replacing the groups it brings.

    Only the last load of a group survives. Rows without a group key replace nothing and all survive.
    The winner of a group is found with a grouped maximum, so a group of any size is no single task. Winners are written, so
    their size is known, and where they are few the rows stay where they are. ``placed`` is read more than once: pass a written table.
    """
    winner = materialise(placed.where(F.col(key).isNotNull()).groupBy(key).agg(F.max("place").alias("_last")), "winners")
    kept = placed.join(winner, key, "left")
    return kept.where(F.col("_last").isNull() | (F.col("place") == F.col("_last"))).select(*placed.columns)


def snapshot_load(
    landing: DataFrame, core: DataFrame, journal: DataFrame, now: dt.datetime, states: Sequence[str] = ("N",)
) -> SnapshotLoad:
    """Load every pending snapshot load in one job: staging, replacement by snapshot id, journal.

    ``core`` has the columns of the staged rows plus ``dataflow_id`` and ``load_dttm``. Rows without a snapshot id
    replace only those of their own load, so a load that was broken off can be run again.
    """
    todo = numbered(pending_loads(journal, SNAPSHOT_FLOW, STAGE, states), ["created", "load_id"], "place")
    todo = materialise(todo.select("load_id", "place"), "pending")
    batch = materialise(staged(landing).join(todo, "load_id"), "staged")
    stamp = stamp_of(now)
    fresh = last_load_wins(batch)
    fresh = fresh.withColumns({"dataflow_id": F.lit(SNAPSHOT_FLOW), "load_dttm": stamp}).select(*core.columns)
    # Every group of the batch is replaced, also where its rows come from an earlier load of the run.
    new_core = _without_loads(without_keys(core, batch, [SNAPSHOT_KEY]), batch).unionByName(fresh)
    counts = load_counts(batch)
    steps = [(STAGE, IN_WORK), (STAGE, SUCCESS), (CORE, IN_WORK), (CORE, SUCCESS)]
    events = [status_events(todo, SNAPSHOT_FLOW, level, state, stamp, counts) for level, state in steps]
    return SnapshotLoad(fresh, new_core, reduce(DataFrame.unionByName, events))


def _without_loads(core: DataFrame, batch: DataFrame) -> DataFrame:
    """Drop the rows without a snapshot id that an earlier, broken-off run of the same loads has left."""
    again = batch.select(F.col("load_id").alias("_load")).distinct()
    return core.join(again, core[SNAPSHOT_KEY].isNull() & (core["load_id"] == again["_load"]), "left_anti")


#: Where a row of the core lies: by snapshot id, without one by load. The id itself stays a column, empty or not.
CORE_PLACE = f"coalesce({SNAPSHOT_KEY}, concat('load ', load_id))"
CORE_TABLE = "core"


def read_snapshots(like: DataFrame, path: str) -> DataFrame:
    """The core table at ``path``, with the columns of ``like``; no rows where there is no table yet."""
    store = Versions(like.sparkSession, path)
    return store.read(CORE_TABLE).select(*like.columns) if CORE_TABLE in store.tables else like.where(F.lit(False))


def write_snapshot(fresh: DataFrame, path: str, rows: int = ROWS) -> dict[str, int]:
    """Put the fresh rows into the core table at ``path``; bytes opened and written.

    A snapshot id of ``fresh`` replaces the rows of that id, also the empty text, which is an id like others. Rows without
    an id replace those of their load. Only the buckets that the fresh rows fall into are opened and written anew, and one that
    has more than ``rows`` rows afterwards is split, so a load costs the same however large the core has grown. The new version
    is seen as a whole or not at all; writing the same rows again changes nothing.
    """
    fresh = materialise(fresh, "fresh")
    # Written by themselves, the ids and loads have a known size; where they are few the old rows are not shuffled to be compared.
    ids = materialise(fresh.select(SNAPSHOT_KEY).distinct(), "ids")
    unnamed = materialise(fresh.where(F.col(SNAPSHOT_KEY).isNull()).select(SNAPSHOT_KEY, "load_id").distinct(), "unnamed")
    change = Change(fresh.sparkSession, path, rows)
    change.table(CORE_TABLE, fresh.schema, [CORE_PLACE])
    change.replace_groups(CORE_TABLE, fresh, lambda old: _without_loads(without_keys(old, ids, [SNAPSHOT_KEY]), unnamed))
    cost = change.cost()
    change.commit()
    for table in (fresh, ids, unnamed):
        discard(table)
    return cost


def newer_rows(source: DataFrame, stamp: str, after: dt.datetime | str) -> DataFrame:
    """Rows strictly after the watermark; the comparison is on wall-clock values and reaches the scan."""
    return source.where(F.col(stamp) > stamp_of(after, source.schema[stamp].dataType))


def slice_rows(source: DataFrame, stamp: str, start: dt.datetime | str, end: dt.datetime | str) -> DataFrame:
    """Rows from ``start`` up to but without ``end``; ``end`` is fixed before reading, so no row is skipped."""
    kind = source.schema[stamp].dataType
    return source.where((F.col(stamp) >= stamp_of(start, kind)) & (F.col(stamp) < stamp_of(end, kind)))


def slice_load(source: DataFrame, stamp: str, start: dt.datetime | str, end: dt.datetime | str) -> DataFrame:
    """Half-open slice with its load date."""
    return slice_rows(source, stamp, start, end).withColumn("load_date", stamp_of(end))


JOURNAL_ROW = (
    "id bigint, operation_type string, logged_at timestamp, source_system string, source_table string, "
    "start_ts timestamp, end_ts timestamp, row_count bigint"
)


def journal_row(loaded: DataFrame, number: int, kind: str, system: str, table: str, start: dt.datetime | str, end: dt.datetime | str) -> DataFrame:
    """One journal row for a load; the rows are counted by Spark and stay where they are."""
    stamp = stamp_of(end)
    return loaded.agg(F.count("*").alias("row_count")).select(
        F.lit(number).cast("bigint").alias("id"),
        F.lit(kind).alias("operation_type"),
        stamp.alias("logged_at"),
        F.lit(system).alias("source_system"),
        F.lit(table).alias("source_table"),
        stamp_of(start).alias("start_ts"),
        stamp.alias("end_ts"),
        "row_count",
    )


DELTA_ROW = "delta_id bigint, start_ts timestamp, end_ts timestamp, delta_object string, ts timestamp"


def delta_row(spark, number: int, subject: str, start: dt.datetime | str, end: dt.datetime | str, now: dt.datetime | str) -> DataFrame:
    """The second layout of a journal row: which object was loaded from when to when, and when that was logged."""
    return spark.range(1).select(
        F.lit(number).cast("bigint").alias("delta_id"),
        stamp_of(start).alias("start_ts"),
        stamp_of(end).alias("end_ts"),
        F.lit(subject).alias("delta_object"),
        stamp_of(now).alias("ts"),
    )


def refresh_marts(views: dict[str, tuple[DataFrame, Sequence[str]]], folder: str) -> None:
    """Refill each mart from its view with a stated column list."""
    for name, (view, columns) in views.items():
        sinks.refresh(view, f"{folder}/{name}", columns)

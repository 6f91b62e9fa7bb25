"""Load journal: an append-only table of status events.

A load moves N (new) → I (in work) → S (success). Each move is one appended event; the state of a load
is its last event. An interrupted load stays visible in I and can be taken up again.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from granary.functions.dates import as_date

NEW, IN_WORK, SUCCESS = "N", "I", "S"
LOAD = ["flow_id", "target_lvl", "load_id"]

# The flows that must have succeeded before the marts are refreshed, and the hours.
GATE_FLOWS = [f"INT_{n:02d}" for n in range(1, 10)]
GATE_FROM_HOUR, GATE_TO_HOUR = 18, 8


def current_state(journal: DataFrame) -> DataFrame:
    """Last event of every load; equal stamps are ordered N, I, S."""
    rank = F.array_position(F.array(F.lit(NEW), F.lit(IN_WORK), F.lit(SUCCESS)), F.col("stg_status"))
    rest = [c for c in journal.columns if c not in LOAD]
    last = F.max(F.struct(F.col("crea_datetime").alias("_at"), rank.alias("_rank"), *rest)).alias("_last")
    return journal.groupBy(*LOAD).agg(last).select(*LOAD, *[F.col(f"_last.{c}") for c in rest])


def pending_loads(journal: DataFrame, flow: str, level: str, states: Sequence[str] = (NEW,)) -> DataFrame:
    """Loads not finished yet, in the order they were created (``created`` = first event)."""
    first = journal.groupBy(*LOAD).agg(F.min("crea_datetime").alias("created"))
    wanted = (F.col("flow_id") == flow) & (F.col("target_lvl") == level)
    state = current_state(journal.where(wanted)).where(F.col("stg_status").isin(*states))
    return state.join(first.where(wanted), LOAD).select("load_id", "stg_status", "created")


def oldest_pending(journal: DataFrame, flow: str, level: str) -> DataFrame:
    """The one load that waits longest."""
    return pending_loads(journal, flow, level).orderBy("created", "load_id").limit(1)


def status_events(loads: DataFrame, flow: str, level: str, status: str, at: Column, counts: DataFrame | None = None) -> DataFrame:
    """Events that move every row of ``loads(load_id)`` to ``status``; ``counts(load_id, row_count)``.

    ``last_delta_ts`` is set where a load succeeds.
    """
    if counts is None:
        rows = loads.withColumn("row_count", F.lit(None).cast("bigint"))
    else:
        rows = loads.join(counts, "load_id", "left").withColumn("row_count", F.coalesce("row_count", F.lit(0).cast("bigint")))
    return rows.select(
        F.lit(flow).alias("flow_id"),
        F.lit(level).alias("target_lvl"),
        "load_id",
        F.lit(status).alias("stg_status"),
        "row_count",
        at.cast("timestamp").alias("crea_datetime"),
        (at if status == SUCCESS else F.lit(None)).cast("timestamp").alias("last_delta_ts"),
    )


def load_counts(rows: DataFrame) -> DataFrame:
    """Rows of every load."""
    return rows.groupBy("load_id").agg(F.count("*").alias("row_count"))


def reconciled(journal: DataFrame, rows: DataFrame, flow: str, level: str) -> DataFrame:
    """Journal row counts against the counted rows of the level."""
    logged = journal.where((F.col("flow_id") == flow) & (F.col("target_lvl") == level))
    logged = current_state(logged).select("load_id", F.col("row_count").alias("logged_rows"))
    found = load_counts(rows).withColumnRenamed("row_count", "found_rows")
    both = logged.join(found, "load_id", "full")
    return both.select(
        "load_id",
        F.coalesce("logged_rows", F.lit(0)).alias("logged_rows"),
        F.coalesce("found_rows", F.lit(0)).alias("found_rows"),
    ).withColumn("agrees", F.col("logged_rows") == F.col("found_rows"))


def readiness(journal: DataFrame, day: dt.date | str, flows: Sequence[str] = GATE_FLOWS, level: str = "EDW") -> DataFrame:
    """Gate for the mart refresh: all flows succeeded between 18:00 of the day before and 08:00.

    ``by_rows`` counts events and is misled by a flow logged twice; ``by_flows`` counts distinct flows
    and is the form to use.
    """
    midnight = as_date(day).cast("timestamp")
    opens = midnight - F.expr(f"INTERVAL {24 - GATE_FROM_HOUR} HOURS")
    closes = midnight + F.expr(f"INTERVAL {GATE_TO_HOUR} HOURS")
    done = journal.where(
        F.col("flow_id").isin(*flows)
        & (F.col("target_lvl") == level)
        & (F.col("stg_status") == SUCCESS)
        & F.col("crea_datetime").between(opens, closes)
    )
    counted = done.agg(F.count("*").alias("rows"), F.countDistinct("flow_id").alias("flows"))
    return counted.select(
        "rows", "flows", (F.col("rows") == len(flows)).alias("by_rows"), (F.col("flows") == len(flows)).alias("by_flows")
    )


def watermark(journal: DataFrame, end: str, default: str) -> DataFrame:
    """One row: the last end stamp (or ``default``) and the next free load number."""
    return journal.agg(
        F.coalesce(F.max(end), F.lit(default).cast("timestamp")).alias("last_end"),
        (F.count("*") + 1).alias("next_id"),
    )

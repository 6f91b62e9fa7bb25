"""Journal, snapshot and watermark loads, sources, sinks and the streaming load."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from granary.functions.dates import stamp, timestamp_or_null, without_zone
from granary.functions.numbers import number_or_null
from granary.operators import journal as log
from granary.operators.replace import replace_groups, without_batch, without_keys
from granary.plans import daily, loads as plan, marks
from granary.plans.journal_store import JournalStore
from granary.session import materialise, new_path
from granary.sources import pages, sinks, tables
from granary.streaming.loads import into_batches, run_available, snapshot_batches
from workload import fixtures as fx
from workload.registry import query

NOW = fx.NOW
DAY = dt.date(2024, 1, 20)
_STATE = "CASE stg_status WHEN 'N' THEN 1 WHEN 'I' THEN 2 ELSE 3 END"
fx.SQL["snap_state"] = f"""
  SELECT * FROM fx_snap_journal QUALIFY row_number() OVER (PARTITION BY flow_id, target_lvl, load_id ORDER BY crea_datetime DESC, {_STATE} DESC) = 1"""
fx.SQL["pending"] = """
  SELECT s.load_id, row_number() OVER (ORDER BY f.created, s.load_id) AS place FROM fx_snap_state s
  JOIN (SELECT load_id, min(crea_datetime) AS created FROM fx_snap_journal GROUP BY 1) f USING (load_id) WHERE stg_status = 'N'"""
fx.SQL["staged"] = """
  SELECT *, source_snap_id || ' ' || source_author_name || ' ' || strftime(source_crea_date_time, '%Y-%m-%d %H:%M:%S') || ' ' || source_snap_type AS source_cd
  FROM fx_landing"""
# All columns of the core; stamps as text, a form both engines write alike.
_KEPT = [c for c in plan.SNAPSHOT_COLUMNS if c != "source_crea_date_time"] + ["source_cd"]
_CREATED = "strftime(source_crea_date_time, '%Y-%m-%d %H:%M:%S') AS source_crea_date_time"
_SELECTED = f"{', '.join(_KEPT)}, {_CREATED}"


def _stamped(df, *names):
    return df.withColumns({n: F.date_format(n, "yyyy-MM-dd HH:mm:ss") for n in names})


def _whole(core):
    """Every column of a core table; the flow and the load time are the same in all rows."""
    return _stamped(core, "source_crea_date_time", "load_dttm").select(*_KEPT, "source_crea_date_time", "dataflow_id", "load_dttm")


_CORE_SQL = f"SELECT *, 'INT_10' AS dataflow_id, '{NOW:%Y-%m-%d %H:%M:%S}' AS load_dttm FROM fx_new_core"
# The core before the run: everything loaded before 1998.
fx.SQL["core"] = "SELECT * FROM fx_staged WHERE load_id < 'L1998'"
fx.SQL["batch"] = "SELECT * FROM fx_staged JOIN fx_pending USING (load_id)"
fx.SQL["new_core"] = f"""
  SELECT {_SELECTED} FROM fx_core WHERE source_snap_id IS NULL OR source_snap_id NOT IN (SELECT source_snap_id FROM fx_batch WHERE source_snap_id IS NOT NULL)
  UNION ALL
  SELECT {_SELECTED} FROM fx_batch QUALIFY source_snap_id IS NULL OR rank() OVER (PARTITION BY source_snap_id ORDER BY place DESC) = 1"""


def _core(spark, sf):
    return plan.core_form(fx.landing(spark, sf), NOW).where(F.col("load_id") < "L1998")


def _snapshot_load(spark, sf):
    return plan.snapshot_load(fx.landing(spark, sf), _core(spark, sf), fx.snap_journal(spark, sf), NOW)


@query("D7 J14 S13", _CORE_SQL)
def snapshot_load(spark, sf):
    return _whole(_snapshot_load(spark, sf).core)


@query("D7 M2 (written by folder)", _CORE_SQL)
def snapshot_load_by_partition(spark, sf):
    path, core = new_path(spark, "core"), _core(spark, sf)
    plan.write_snapshot(core, path)
    plan.write_snapshot(_snapshot_load(spark, sf).fresh, path)
    return _whole(plan.read_snapshots(core, path))


@query("D7 M2 J14 (a core of small buckets that split, load after load)", _CORE_SQL)
def snapshot_core_in_buckets(spark, sf):
    # Each part is written by its load, so the core is not written before.
    path, core = new_path(spark, "core"), _core(spark, sf)
    # About thirty buckets at the end, whatever the size of the table; the core comes in two parts before the load.
    rows = max(20, core.count() // 20)
    early = F.col("load_id") < "L1996"
    for part in (core.where(early), core.where(~early), _snapshot_load(spark, sf).fresh):
        plan.write_snapshot(part, path, rows)
    return _whole(plan.read_snapshots(core, path))


@query("D7 M2 (broken off after the write, run again)", _CORE_SQL)
def snapshot_load_retried(spark, sf):
    path, core = new_path(spark, "core"), _core(spark, sf)
    landing, journal = fx.landing(spark, sf), fx.snap_journal(spark, sf)
    plan.write_snapshot(core, path)
    first = plan.snapshot_load(landing, core, journal, NOW)
    broken = materialise(journal.unionByName(first.events.where(F.col("stg_status") == "I"), allowMissingColumns=True), "journal")
    plan.write_snapshot(first.fresh, path)
    again = plan.snapshot_load(landing, core, broken, NOW, ("N", "I"))
    plan.write_snapshot(again.fresh, path)
    return _whole(plan.read_snapshots(core, path))


_EVENTS_SQL = """
  SELECT 'INT_10' AS flow_id, target_lvl, load_id, stg_status, row_count, '""" + f"{NOW:%Y-%m-%d %H:%M:%S}" + """' AS crea_datetime,
    CASE WHEN stg_status = 'S' THEN '""" + f"{NOW:%Y-%m-%d %H:%M:%S}" + """' END AS last_delta_ts
  FROM (SELECT load_id, count(*) AS row_count FROM fx_batch GROUP BY 1), (VALUES ('ODSP'), ('EDW')) l(target_lvl), (VALUES ('I'), ('S')) s(stg_status)"""


@query("D6", _EVENTS_SQL)
def snapshot_load_events(spark, sf):
    return _stamped(_snapshot_load(spark, sf).events, "crea_datetime", "last_delta_ts")


@query("D6 (state after the run)", """
  SELECT load_id, 'S' AS stg_status FROM fx_snap_state""")
def state_after_the_run(spark, sf):
    journal = fx.snap_journal(spark, sf).unionByName(_snapshot_load(spark, sf).events, allowMissingColumns=True)
    return log.current_state(journal).where(F.col("target_lvl") == plan.STAGE).select("load_id", "stg_status")


@query("D5 S5 O1", "SELECT load_id, place FROM fx_pending")
def pending_loads_in_order(spark, sf):
    todo = log.pending_loads(fx.snap_journal(spark, sf), plan.SNAPSHOT_FLOW, plan.STAGE)
    return plan.numbered(todo, ["created", "load_id"], "place").select("load_id", "place")


@query("O2 D5", "SELECT load_id FROM fx_pending WHERE place = 1")
def oldest_pending_load(spark, sf):
    return log.oldest_pending(fx.snap_journal(spark, sf), plan.SNAPSHOT_FLOW, plan.STAGE).select("load_id")


@query("D6 (last event of a load)", f"""
  SELECT flow_id, target_lvl, load_id, stg_status, row_count, strftime(crea_datetime, '%Y-%m-%d %H:%M:%S') AS crea_datetime FROM fx_flow_journal
  QUALIFY row_number() OVER (PARTITION BY flow_id, target_lvl, load_id ORDER BY crea_datetime DESC, {_STATE} DESC, row_count DESC) = 1""")
def current_state_of_loads(spark, sf):
    return _stamped(log.current_state(fx.flow_journal(spark, sf)), "crea_datetime")


@query("D5 D6 D10 (from folded state and a tail of events)", f"""
  SELECT flow_id, target_lvl, load_id, stg_status, row_count, strftime(crea_datetime, '%Y-%m-%d %H:%M:%S') AS crea_datetime,
    strftime(created, '%Y-%m-%d %H:%M:%S') AS created FROM (SELECT *, min(crea_datetime) OVER (PARTITION BY flow_id, target_lvl, load_id) AS created FROM fx_flow_journal)
  QUALIFY row_number() OVER (PARTITION BY flow_id, target_lvl, load_id ORDER BY crea_datetime DESC, {_STATE} DESC, row_count DESC) = 1""")
def state_from_fold_and_tail(spark, sf):
    events = materialise(fx.flow_journal(spark, sf), "events")
    store = JournalStore(spark, new_path(spark, "journal"), length=3)
    # Every load has events in several arrivals; the fourth one stays in the tail.
    for kind in range(4):
        store.append(events.where(F.pmod(F.xxhash64("row_count"), F.lit(4)) == kind))
    return _stamped(store.state().drop("last_delta_ts"), "crea_datetime", "created")


@query("D8", "SELECT aufnr, source_cd FROM fx_staged")
def source_label(spark, sf):
    return plan.staged(fx.landing(spark, sf)).select("aufnr", "source_cd")


@query("D9 A8 P7", f"""
  SELECT count(*) AS rows, count(DISTINCT flow_id) AS flows, count(*) = 9 AS by_rows, count(DISTINCT flow_id) = 9 AS by_flows FROM fx_flow_journal
  WHERE target_lvl = 'EDW' AND stg_status = 'S' AND crea_datetime BETWEEN TIMESTAMP '{DAY}' - INTERVAL 6 HOUR AND TIMESTAMP '{DAY}' + INTERVAL 8 HOUR""")
def readiness_gate(spark, sf):
    return log.readiness(fx.flow_journal(spark, sf), DAY)


@query("D9 (every day)", """
  SELECT CAST(crea_datetime + INTERVAL 6 HOUR AS DATE) AS day, count(*) AS rows, count(DISTINCT flow_id) AS flows FROM fx_flow_journal
  WHERE target_lvl = 'EDW' AND stg_status = 'S' AND hour(crea_datetime + INTERVAL 6 HOUR) < 14 GROUP BY 1""")
def readiness_of_every_day(spark, sf):
    shifted = F.col("crea_datetime") + F.expr("INTERVAL 6 HOURS")
    rows = fx.flow_journal(spark, sf).where((F.col("target_lvl") == "EDW") & (F.col("stg_status") == "S") & (F.hour(shifted) < 14))
    return rows.groupBy(F.to_date(shifted).alias("day")).agg(F.count("*").alias("rows"), F.countDistinct("flow_id").alias("flows"))


@query("P7", "SELECT event_id, user_id FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-19 18:00:00' AND TIMESTAMP '2024-01-20 08:00:00'")
def closed_time_range(spark, sf):
    lo, hi = dt.datetime(2024, 1, 19, 18), dt.datetime(2024, 1, 20, 8)
    return fx.table(spark, sf, "events").where(F.col("ts").between(stamp(lo), stamp(hi))).select("event_id", "user_id")


@query("D10", """
  SELECT load_id, coalesce(j.row_count, 0) AS logged_rows, coalesce(n, 0) AS found_rows, coalesce(j.row_count, 0) = coalesce(n, 0) AS agrees
  FROM fx_snap_state j FULL JOIN (SELECT load_id, count(*) AS n FROM fx_landing GROUP BY 1) USING (load_id)""")
def reconciled_row_counts(spark, sf):
    return log.reconciled(fx.snap_journal(spark, sf), fx.landing(spark, sf), plan.SNAPSHOT_FLOW, plan.STAGE)


@query("M2 J14 J15", f"""
  SELECT {_SELECTED} FROM fx_core WHERE source_snap_id IS NULL OR source_snap_id NOT IN (SELECT source_snap_id FROM fx_staged WHERE load_id = 'L1999' AND source_snap_id IS NOT NULL)
  UNION ALL SELECT {_SELECTED} FROM fx_staged WHERE load_id = 'L1999'""")
def groups_replaced(spark, sf):
    rows = _stamped(plan.staged(fx.landing(spark, sf)), "source_crea_date_time")
    return replace_groups(rows.where(F.col("load_id") < "L1998"), rows.where(F.col("load_id") == "L1999"), ["source_snap_id"])


@query("J14", """
  SELECT source_snap_id, aufnr FROM fx_landing WHERE source_snap_id IS NULL
    OR source_snap_id NOT IN (SELECT source_snap_id FROM fx_landing WHERE load_id = 'L2000' AND o_status = 'P' AND source_snap_id IS NOT NULL)""".replace("o_status", "source_snap_type"))
def keyed_delete(spark, sf):
    rows = fx.landing(spark, sf)
    gone = rows.where((F.col("load_id") == "L2000") & (F.col("source_snap_type") == "P"))
    return without_keys(rows, gone, ["source_snap_id"]).select("source_snap_id", "aufnr")


@query("M3", "SELECT aufnr, load_id FROM fx_landing WHERE load_id <> 'L1999'")
def consumed_batch_deleted(spark, sf):
    return without_batch(fx.landing(spark, sf), "load_id", "L1999").select("aufnr", "load_id")


@query("D1 A9", """
  SELECT strftime(coalesce(max(end_ts), TIMESTAMP '1900-01-01 12:00:00'), '%Y-%m-%d %H:%M:%S') AS last_end, count(*) + 1 AS next_id FROM fx_delta_journal""")
def watermark(spark, sf):
    mark = log.watermark(fx.delta_journal(spark, sf), "end_ts", "1900-01-01 12:00:00")
    return mark.select(F.date_format("last_end", "yyyy-MM-dd HH:mm:ss").alias("last_end"), "next_id")


@query("A9 (empty journal)", "SELECT '2000-01-01 00:00:00' AS last_end, count(*) + 1 AS next_id FROM fx_delta_journal WHERE id < 0")
def watermark_of_an_empty_journal(spark, sf):
    mark = log.watermark(fx.delta_journal(spark, sf).where(F.col("id") < 0), "end_ts", "2000-01-01 00:00:00")
    return mark.select(F.date_format("last_end", "yyyy-MM-dd HH:mm:ss").alias("last_end"), "next_id")


def _last_end(spark, sf) -> tuple[str, int]:
    """The mark leaves Spark as text, so that no zone of the driver's process touches it."""
    mark = log.watermark(fx.delta_journal(spark, sf), "end_ts", "1900-01-01 12:00:00")
    row = mark.select(F.col("last_end").cast("string").alias("last_end"), "next_id").first()
    return row["last_end"], row["next_id"]


_LAST = "(SELECT max(end_ts) FROM fx_delta_journal)"


@query("D2 P13 X2 S10", f"SELECT event_id, value FROM events WHERE ts > {_LAST}")
def newer_rows_appended(spark, sf):
    after, _ = _last_end(spark, sf)
    path = new_path(spark, "delta")
    newer = plan.newer_rows(fx.table(spark, sf, "events"), "ts", after).select("event_id", "value")
    sinks.append(newer, path)
    return spark.read.parquet(path)


# Events arrive in three parts. Their stamps are cut to the hour; the errors of the hour at which a load ends arrive after it.
_ENDS = ["2024-01-08 06:00:00", "2024-01-20 18:00:00"]
_ARRIVAL = " ".join(f"WHEN hour < TIMESTAMP '{end}' OR (hour = TIMESTAMP '{end}' AND event_type <> 'error') THEN {k}" for k, end in enumerate(_ENDS, 1))


@query("D1 D2 P13 (rows that arrive late with the stamp of the mark)", f"""
  SELECT event_id, event_type, strftime(hour, '%Y-%m-%d %H:%M:%S') AS hour, CAST(CASE {_ARRIVAL} ELSE 3 END AS INTEGER) AS load
  FROM (SELECT *, date_trunc('hour', ts) AS hour FROM events)""")
def late_rows_at_the_mark(spark, sf):
    events = fx.table(spark, sf, "events").select("event_id", "event_type", F.date_trunc("hour", "ts").alias("hour"))
    events = materialise(events.withColumn("arrival", F.expr(f"CASE {_ARRIVAL} ELSE 3 END").cast("int")), "events")
    path = new_path(spark, "marked")
    for load in (1, 2, 3, 3):  # the last one finds nothing new
        there = events.where(F.col("arrival") <= load).drop("arrival").withColumn("load", F.lit(load))
        marks.load_from_mark(there, "hour", ["event_id"], path)
    return _stamped(marks.read_loaded(spark, path), "hour")


@query("D3 P14 P3 S11", f"SELECT event_id, '2024-01-25' AS load_date FROM events WHERE ts >= {_LAST} AND ts < TIMESTAMP '2024-01-25'")
def slice_loaded(spark, sf):
    start, _ = _last_end(spark, sf)
    path = new_path(spark, "slice")
    sinks.replace(plan.slice_load(fx.table(spark, sf, "events"), "ts", start, dt.datetime(2024, 1, 25)), path)
    return spark.read.parquet(path).select("event_id", F.date_format("load_date", "yyyy-MM-dd").alias("load_date"))


@query("D4 S9", f"""
  SELECT (SELECT count(*) + 1 FROM fx_delta_journal) AS id, 'D' AS operation_type, '2024-01-25 00:00:00' AS logged_at, 'shop' AS source_system, 'events' AS source_table,
    strftime({_LAST}, '%Y-%m-%d %H:%M:%S') AS start_ts, '2024-01-25 00:00:00' AS end_ts, count(*) AS row_count
  FROM events WHERE ts >= {_LAST} AND ts < TIMESTAMP '2024-01-25'""")
def journal_row_of_a_load(spark, sf):
    start, number = _last_end(spark, sf)
    end = dt.datetime(2024, 1, 25)
    loaded = plan.slice_rows(fx.table(spark, sf, "events"), "ts", start, end)
    row = plan.journal_row(loaded, number, "D", "shop", "events", start, end)
    return _stamped(row, "logged_at", "start_ts", "end_ts")


@query("D4 (second layout)", f"""
  SELECT (SELECT count(*) + 1 FROM fx_delta_journal) AS delta_id, strftime({_LAST}, '%Y-%m-%d %H:%M:%S') AS start_ts, '2024-01-25 00:00:00' AS end_ts,
    CAST(NULL AS VARCHAR) AS delta_object, '2024-01-25 00:00:00' AS ts""")
def journal_row_of_a_delta(spark, sf):
    start, number = _last_end(spark, sf)
    end = dt.datetime(2024, 1, 25)
    return _stamped(plan.delta_row(spark, number, None, start, end, end), "start_ts", "end_ts", "ts")


@query("P13", "SELECT o_orderkey FROM orders WHERE o_orderdate > TIMESTAMP '2001-01-01'")
def strictly_newer(spark, sf):
    return plan.newer_rows(fx.table(spark, sf, "orders"), "o_orderdate", dt.datetime(2001, 1, 1)).select("o_orderkey")


@query("P14", "SELECT o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '2001-01-01' AND o_orderdate < TIMESTAMP '2001-02-01'")
def half_open_slice(spark, sf):
    return plan.slice_rows(fx.table(spark, sf, "orders"), "o_orderdate", dt.datetime(2001, 1, 1), dt.datetime(2001, 2, 1)).select("o_orderkey")


# Sources.
@query("S1", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate, o_orderpriority FROM orders")
def scan_base_table(spark, sf):
    return _stamped(tables.table(spark, sf, "orders"), "o_orderdate")


@query("S2 F9 F20 X1", """
  SELECT event_id AS id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS modi_date, event_type, value,
    CASE WHEN event_type <> 'error' THEN user_id END AS user_id FROM events""")
def scan_delimited_file(spark, sf):
    path = new_path(spark, "delimited")
    stamp = F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("modi_date")
    user = F.when(F.col("event_type") == "error", "unknown").otherwise(F.col("user_id").cast("string")).alias("user_id")
    fx.table(spark, sf, "events").select(F.col("event_id").alias("id"), stamp, "event_type", "value", user).write.csv(path, sep=";", header=True)
    read = tables.delimited(spark, path, "id STRING, modi_date STRING, event_type STRING, value DOUBLE, user_id STRING")
    read = read.withColumns({"id": number_or_null(F.col("id"), "bigint"), "user_id": number_or_null(F.col("user_id"), "bigint")})
    return read.withColumn("modi_date", F.date_format(timestamp_or_null(F.col("modi_date")), "yyyy-MM-dd HH:mm:ss"))


@query("S3", "SELECT o_orderkey || ';' || o_orderpriority || ';' || o_orderstatus AS str FROM orders")
def scan_raw_lines(spark, sf):
    path = new_path(spark, "lines")
    fx.table(spark, sf, "orders").select(F.concat_ws(";", F.col("o_orderkey").cast("string"), "o_orderpriority", "o_orderstatus").alias("value")).write.text(path)
    return tables.lines(spark, path)


@query("S4", "SELECT CAST(c_custkey AS VARCHAR) AS key, c_name || '; \"' || c_mktsegment || '\"' AS name FROM customer")
def scan_quoted_file(spark, sf):
    path = new_path(spark, "quoted")
    name = F.concat("c_name", F.lit('; "'), "c_mktsegment", F.lit('"')).alias("name")
    fx.table(spark, sf, "customer").select("c_custkey", name).write.csv(path, sep=";", quote='"', escape='"')
    return tables.quoted_file(spark, path, ["key", "name"])


@query("S5", "SELECT load_id FROM fx_snap_journal WHERE stg_status = 'N' AND flow_id = 'INT_10' AND target_lvl = 'ODSP'")
def scan_query_result(spark, sf):
    fx.snap_journal(spark, sf).createOrReplaceTempView("etl_delta_log")
    return spark.sql("SELECT load_id FROM etl_delta_log WHERE stg_status = 'N' AND flow_id = 'INT_10' AND target_lvl = 'ODSP'")


_STAFF = ["c_custkey", "c_name", "c_mktsegment", "c_acctbal"]


@query("S6 O5", f"SELECT {', '.join(_STAFF)} FROM customer ORDER BY c_custkey LIMIT 3 OFFSET 60")
def page_of_a_source(spark, sf):
    return pages.page(fx.table(spark, sf, "customer").select(*_STAFF), "c_custkey", 60, 3)


@query("S7 A8", "SELECT count(*) AS row_count FROM customer WHERE c_mktsegment = 'BUILDING'")
def source_row_count(spark, sf):
    return pages.extract_size(fx.table(spark, sf, "customer"), F.col("c_mktsegment") == "BUILDING")


@query("S8 P17", "SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'BUILDING'")
def source_columns_and_filter(spark, sf):
    return pages.extract(fx.table(spark, sf, "customer"), F.col("c_mktsegment") == "BUILDING", ["c_custkey", "c_name"])


@query("B25 S6 S7 P17 S10", """
  SELECT c_custkey, c_name, (row_number() OVER (ORDER BY c_custkey) - 1) // 3 AS page_no FROM customer WHERE c_mktsegment = 'BUILDING'""")
def paged_full_load(spark, sf):
    path = new_path(spark, "paged")
    rows = pages.extract(fx.table(spark, sf, "customer"), F.col("c_mktsegment") == "BUILDING", ["c_custkey", "c_name"])
    sinks.append(pages.paged(rows, "c_custkey", 3), path)
    return spark.read.parquet(path)


@query("S6 O5 B25 (the last page, by the fence index)", f"""
  SELECT {', '.join(_STAFF)}, 1 AS ranges_read FROM customer ORDER BY c_custkey LIMIT 7 OFFSET (SELECT (count(*) - 1) // 7 * 7 FROM customer)""")
def last_page_by_index(spark, sf):
    path = new_path(spark, "indexed")
    customer = fx.table(spark, sf, "customer").select(*_STAFF)
    pages.write_ranges(customer, ["c_custkey"], path, 100)
    skip = (pages.indexed_size(spark, path) - 1) // 7 * 7
    # The page's last row lies in the last range; the page may begin in the one before.
    read = len(pages.ranges_of_page(spark, path, pages.indexed_size(spark, path) - 1, 1))
    return pages.indexed_page(spark, path, ["c_custkey"], skip, 7).withColumn("ranges_read", F.lit(read))


@query("S6 O5 B25 (three pages put together)", f"SELECT {', '.join(_STAFF)} FROM customer ORDER BY c_custkey LIMIT 300 OFFSET 150")
def neighbouring_pages_by_index(spark, sf):
    path = new_path(spark, "indexed")
    pages.write_ranges(fx.table(spark, sf, "customer").select(*_STAFF), ["c_custkey"], path, 100)
    first, *others = [pages.indexed_page(spark, path, ["c_custkey"], skip, 100) for skip in (150, 250, 350)]
    return first.unionAll(others[0]).unionAll(others[1])


# Sinks.
@query("S10", "SELECT o_orderkey, o_orderstatus FROM orders")
def appended_in_parts(spark, sf):
    path = new_path(spark, "append")
    orders = fx.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    sinks.append(orders.where(F.col("o_orderstatus") == "O"), path)
    sinks.append(orders.where(F.col("o_orderstatus") != "O"), path)
    return spark.read.parquet(path)


@query("S11", "SELECT c_custkey, c_name FROM customer")
def replaced_table(spark, sf):
    path = new_path(spark, "replace")
    sinks.replace(fx.table(spark, sf, "orders"), path)
    sinks.replace(fx.table(spark, sf, "customer").select("c_custkey", "c_name"), path)
    return spark.read.parquet(path)


def _budget(spark, sf, mark, columns):
    """A budget view over the stock rows, every column with values."""
    o, r = F.col("st_o_divis"), F.col("st_r_divis")
    cells = {
        "werks": F.col("st_werks"), "o_divis": o, "r_divis": r, "year": F.year("st_date"), "month": F.month("st_date"),
        "month_year": F.date_format("st_date", "MM.yyyy"), "bwtar": F.col("st_bwtar"), "section": F.when(F.col("st_qty") < 0, "out").otherwise("in"),
        "amt": F.col("st_amt"), "proizv": F.col("st_matnr"), "or_divis_txt": F.concat(o, F.lit("/"), r),
        "o_divis_txt": F.concat(F.lit("owner "), o), "r_divis_txt": F.concat(F.lit("receiver "), r),
    }
    return tables.mapped(fx.stock(spark, sf), {c: cells[c.removeprefix(mark)] for c in columns})


def _budget_sql(mark, columns):
    cells = {
        "werks": "st_werks", "o_divis": "st_o_divis", "r_divis": "st_r_divis", "year": "CAST(year(st_date) AS INTEGER)", "month": "CAST(month(st_date) AS INTEGER)",
        "month_year": "strftime(st_date, '%m.%Y')", "bwtar": "st_bwtar", "section": "CASE WHEN st_qty < 0 THEN 'out' ELSE 'in' END", "amt": "CAST(st_amt AS DOUBLE)",
        "proizv": "st_matnr", "or_divis_txt": "st_o_divis || '/' || st_r_divis", "o_divis_txt": "'owner ' || st_o_divis", "r_divis_txt": "'receiver ' || st_r_divis",
    }
    return "SELECT " + ", ".join(f"{cells[c.removeprefix(mark)]} AS {c}" for c in columns) + " FROM fx_stock"


def _refreshed(spark, name, view, columns):
    """A mart that was refilled twice from its view."""
    folder = new_path(spark, "marts")
    for _ in range(2):
        plan.refresh_marts({name: (view, columns)}, folder)
    return spark.read.parquet(f"{folder}/{name}")


@query("B23 S12", _budget_sql("bs_", plan.BUDGET_STOCK))
def mart_refreshed_from_a_view(spark, sf):
    return _refreshed(spark, "mt_budget_stock", _budget(spark, sf, "bs_", plan.BUDGET_STOCK), plan.BUDGET_STOCK)


@query("B23 (budget movements)", _budget_sql("bm_", plan.BUDGET_MOVEMENT))
def budget_movement_refreshed(spark, sf):
    return _refreshed(spark, "mt_budget_movem", _budget(spark, sf, "bm_", plan.BUDGET_MOVEMENT), plan.BUDGET_MOVEMENT)


@query("B23 (division pairs)", f"SELECT {', '.join(daily.DIVISION_PAIR)} FROM fx_pairs")
def division_pairs_refreshed(spark, sf):
    return _refreshed(spark, "divis", fx.pairs(spark, sf), daily.DIVISION_PAIR)


@query("S13", """
  SELECT o_orderkey AS id, upper(o_orderstatus) AS status, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS amount FROM orders""")
def insert_by_column_name(spark, sf):
    mapping = {"amount": fx.money(F.col("o_totalprice")), "id": "o_orderkey", "status": F.upper("o_orderstatus")}
    target = spark.createDataFrame([], "id bigint, status string, amount decimal(18,2)").schema
    return tables.matching(tables.mapped(fx.table(spark, sf, "orders"), mapping), target)


@query("S14", "SELECT o_custkey, count(*) AS orders FROM orders GROUP BY 1")
def table_made_by_query(spark, sf):
    counts = fx.table(spark, sf, "orders").groupBy("o_custkey").agg(F.count("*").alias("orders"))
    sinks.create_as(counts, "orders_per_customer", new_path(spark, "created"))
    return spark.table("orders_per_customer")


@query("S16 F18", "SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders")
def columns_retyped(spark, sf):
    orders = fx.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return tables.retyped(orders, {"o_custkey": "string", "o_orderdate": "date"})


@query("R6", "SELECT s_suppkey, n_name AS region_name, s_nationkey AS region_code FROM supplier JOIN nation ON s_nationkey = n_nationkey")
def nested_record_flattened(spark, sf):
    region = F.struct(F.col("s_nationkey").alias("code"), F.col("n_name").alias("name"))
    nested = fx.table(spark, sf, "supplier").join(fx.table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    nested = nested.select("s_suppkey", F.struct(region.alias("region")).alias("address"))
    return tables.flattened(nested, {"s_suppkey": "s_suppkey", "region_name": "address.region.name", "region_code": "address.region.code"})


@query("F10", "SELECT event_id FROM events WHERE ts > TIMESTAMP '2024-01-15 12:00:00'")
def zone_stripped_comparison(spark, sf):
    mark = without_zone(F.lit("2024-01-15 12:00:00").cast("timestamp"))
    return fx.table(spark, sf, "events").where(without_zone(F.col("ts")) > mark).select("event_id")


@query("T1", "SELECT o_orderkey, o_orderstatus, CAST(year(o_orderdate) AS INTEGER) AS y FROM orders")
def load_files_processed_once(spark, sf):
    orders = fx.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", F.year("o_orderdate").alias("y"))
    source, target, checkpoint = (new_path(spark, n) for n in ("landing", "stream", "stream-checkpoint"))
    first, second = F.col("o_orderstatus") == "F", F.col("o_orderstatus") != "F"
    for part in (first, second):
        # The second run sees the files of both parts and takes only the new ones.
        orders.where(part).write.mode("append").parquet(source)
        run_available(spark, source, orders.schema, checkpoint, into_batches(target))
    return spark.read.parquet(target).drop("batch")


def _streamed(spark, sf):
    """Core and journal after the pending loads have arrived in two parts that touch the same snapshots."""
    landing, core = materialise(fx.landing(spark, sf), "landing"), _core(spark, sf)
    source, checkpoint, target, events = (new_path(spark, n) for n in ("landing-files", "stream-checkpoint", "core", "events"))
    plan.write_snapshot(core, target)
    handle = snapshot_batches(core, fx.snap_journal(spark, sf), target, events, NOW)
    early = F.col("load_id").between("L1998", "L1999")
    for part in (early, ~early):
        landing.where(part).write.mode("append").parquet(source)
        run_available(spark, source, landing.schema, checkpoint, handle)
    # Batches that are handed out once more change nothing.
    handle(landing.where(~early), 1)
    handle(landing.where(early), 0)
    return plan.read_snapshots(core, target), spark.read.parquet(events)


@query("T1 D7", _CORE_SQL)
def snapshot_load_from_a_stream(spark, sf):
    return _whole(_streamed(spark, sf)[0])


@query("T1 D6", _EVENTS_SQL)
def streamed_load_events(spark, sf):
    return _stamped(_streamed(spark, sf)[1].drop("batch"), "crea_datetime", "last_delta_ts")

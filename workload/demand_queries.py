"""Demand view, its joins and classifications, and the demand chains."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from granary.functions.dates import stamp
from granary.functions.numbers import ratio
from granary.operators.joins import left_join_many
from granary.operators.versions import Versions
from granary.plans import chain_store, chains, daily, demand as plan
from granary.session import materialise, new_path
from granary.sources.sinks import named_view
from granary.streaming.loads import run_available
from workload import fixtures as fx
from workload.registry import query
from workload.stock_queries import half_up

_SDP = """CASE potr_stad WHEN 8 THEN lacking WHEN 9 THEN CASE WHEN have >= pt_qty_res THEN 0 ELSE lacking END END"""
fx.SQL["have"] = """
  SELECT rs_rsnum, rs_rspos, sum(rs_qty_avlb) AS rs_qty_avlb FROM fx_reqstock WHERE rs_tech_data_type = 1 GROUP BY 1, 2"""
fx.SQL["stages"] = f"""
  SELECT d.*, h.rs_qty_avlb, coalesce(h.rs_qty_avlb, 0) AS have, pt_qty_open - coalesce(h.rs_qty_avlb, 0) AS lacking,
    CAST(CASE WHEN pt_bwtar <> '{plan.OWN}' THEN NULL WHEN coalesce(pt_pp_aufnr, '') IN ('', '0') THEN 8 ELSE 9 END AS SMALLINT) AS potr_stad
  FROM fx_demand d LEFT JOIN fx_have h ON rs_rsnum = pt_rsnum AND rs_rspos = pt_rspos
  WHERE pt_tech_data_type = 1 AND pt_bwtar IN ('{plan.BOUGHT}', '{plan.OWN}')"""
fx.SQL["sections"] = f"""
  SELECT *, CAST({_SDP} AS DECIMAL(18,2)) AS sdp_qty,
    CASE WHEN pt_bwtar = '{plan.OWN}' THEN '{plan.OWN_SECTION}' WHEN pt_modul = 2 THEN '{plan.REPAIR}'
      WHEN pt_modul IN (1, 3) AND pt_saknr = {plan.OILS_ACCOUNT} THEN '{plan.OILS}'
      WHEN pt_modul = 1 THEN '{plan.UPKEEP}' WHEN pt_modul = 3 THEN '{plan.TECHNOLOGY}' END AS pt_section
  FROM fx_stages"""

_MICRO = half_up("(CAST(sdp_qty * 100 AS HUGEINT) * CAST(pt_fp01 * 100 AS HUGEINT) * 10000)", "CAST(pt_qty_res * 100 AS HUGEINT)")
_VALUES = {
    "rs_qty_avlb": "CAST(rs_qty_avlb AS DOUBLE)",
    "pt_fp01": "CAST(pt_fp01 AS DOUBLE)",
    "pt_qty_res": "CAST(pt_qty_res AS DOUBLE)",
    "sdp_qty": "CAST(sdp_qty AS DOUBLE)",
    "sdp_amt": f"CASE WHEN pt_qty_res <> 0 THEN CAST({_MICRO} AS DOUBLE) / 1000000 END",
    "sat_flag": "false",
    "pla_flag": "false",
    "o_divis_txt": "coalesce(o.div_id_full_txt, o.div_id)",
    "r_divis_txt": "coalesce(r.div_id_full_txt, r.div_id)",
    "pt_qty_otpu": "CAST(pt_enmng AS DOUBLE)",
    "pt_amt_otpu": "CAST(pt_amt_otpu AS DOUBLE)",
    "pt_qty_open": "CAST(pt_qty_open AS DOUBLE)",
    "pt_amt_open": "CAST(pt_amt_open AS DOUBLE)",
}
fx.SQL["potr"] = "SELECT " + ", ".join(f"{_VALUES.get(c, plan.RENAMED.get(c, c))} AS {c}" for c in plan.COLUMNS) + """
  FROM fx_sections JOIN fx_materials ON pt_matnr = mt_matnr AND pt_werks = mt_werks
  LEFT JOIN fx_warehouses ON pt_lgort = wm_lgort AND pt_werks = wm_werks
  LEFT JOIN fx_divisions o ON wm_o_divis = o.div_id
  LEFT JOIN fx_divisions r ON wm_r_divis = r.div_id
  LEFT JOIN fx_groups ON mt_matkl = mtg_matkl
  LEFT JOIN fx_pairs ON wm_o_divis = o_div_id AND wm_r_divis = r_div_id"""


def _view(spark, sf):
    sources = (fx.demand, fx.materials, fx.warehouses, fx.divisions, fx.groups, fx.pairs, fx.reqstock)
    return plan.demand_view(*[f(spark, sf) for f in sources])


@query("B8 J5 F3", "SELECT * FROM fx_potr")
def demand_view(spark, sf):
    return _view(spark, sf)


@query("S15", "SELECT potr_stad, pt_section, count(*) AS items FROM fx_potr GROUP BY ALL")
def named_view_read_back(spark, sf):
    named_view(_view(spark, sf), "v_potr", plan.COLUMNS)
    return spark.sql("SELECT potr_stad, pt_section, count(*) AS items FROM v_potr GROUP BY ALL")


@query("J1", "SELECT pt_rsnum, pt_rspos, pt_matnr, mt_matkl FROM fx_demand JOIN fx_materials ON pt_matnr = mt_matnr AND pt_werks = mt_werks")
def inner_join_two_keys(spark, sf):
    goods = fx.materials(spark, sf).select(F.col("mt_matnr").alias("pt_matnr"), F.col("mt_werks").alias("pt_werks"), "mt_matkl")
    return fx.demand(spark, sf).join(goods, ["pt_matnr", "pt_werks"]).select("pt_rsnum", "pt_rspos", "pt_matnr", "mt_matkl")


@query("J5", """
  SELECT pt_rsnum, pt_rspos, wm_proizv, or_div_txt FROM fx_demand
  LEFT JOIN fx_warehouses ON pt_lgort = wm_lgort AND pt_werks = wm_werks
  LEFT JOIN fx_pairs ON wm_o_divis = o_div_id AND wm_r_divis = r_div_id""")
def left_joins_to_dimensions(spark, sf):
    rows, places, pairs = fx.demand(spark, sf), fx.warehouses(spark, sf), fx.pairs(spark, sf)
    rows = rows.join(places, (rows.pt_lgort == places.wm_lgort) & (rows.pt_werks == places.wm_werks), "left")
    rows = rows.join(pairs, (F.col("wm_o_divis") == F.col("o_div_id")) & (F.col("wm_r_divis") == F.col("r_div_id")), "left")
    return rows.select("pt_rsnum", "pt_rspos", "wm_proizv", "or_div_txt")


@query("J6", """
  SELECT wm_lgort, o.div_id_full_txt AS o_txt, r.div_id_full_txt AS r_txt FROM fx_warehouses
  LEFT JOIN fx_divisions o ON wm_o_divis = o.div_id LEFT JOIN fx_divisions r ON wm_r_divis = r.div_id""")
def dimension_joined_twice(spark, sf):
    places, divisions = fx.warehouses(spark, sf), fx.divisions(spark, sf)
    outer, inner = divisions.alias("o"), divisions.alias("r")
    rows = places.join(outer, F.col("wm_o_divis") == F.col("o.div_id"), "left").join(inner, F.col("wm_r_divis") == F.col("r.div_id"), "left")
    return rows.select("wm_lgort", F.col("o.div_id_full_txt").alias("o_txt"), F.col("r.div_id_full_txt").alias("r_txt"))


@query("J7", """
  SELECT pt_rsnum, pt_rspos, pt_werks, CAST(rs_qty_avlb AS DOUBLE) AS rs_qty_avlb
  FROM fx_demand LEFT JOIN fx_have ON rs_rsnum = pt_rsnum AND rs_rspos = pt_rspos""")
def left_join_to_aggregate(spark, sf):
    have = plan.available(fx.reqstock(spark, sf)).withColumnsRenamed({"rs_rsnum": "pt_rsnum", "rs_rspos": "pt_rspos"})
    return fx.demand(spark, sf).join(have, ["pt_rsnum", "pt_rspos"], "left").select("pt_rsnum", "pt_rspos", "pt_werks", "rs_qty_avlb")


@query("A3", "SELECT rs_rsnum, rs_rspos, CAST(rs_qty_avlb AS DOUBLE) AS rs_qty_avlb FROM fx_have")
def filtered_sum(spark, sf):
    return plan.available(fx.reqstock(spark, sf))


@query("P16 P8 P9", """
  SELECT pt_rsnum, pt_rspos, potr_stad, pt_section, count(*) AS items FROM fx_sections GROUP BY ALL""")
def nested_classification(spark, sf):
    wanted = fx.demand(spark, sf).where((F.col("pt_tech_data_type") == 1) & F.col("pt_bwtar").isin(plan.BOUGHT, plan.OWN))
    rows = wanted.select("pt_rsnum", "pt_rspos", plan.stage().alias("potr_stad"), plan.section().alias("pt_section"))
    return rows.groupBy("pt_rsnum", "pt_rspos", "potr_stad", "pt_section").agg(F.count("*").alias("items"))


@query("P15", """
  SELECT pt_rsnum, pt_rspos, pt_lgort, CAST(sdp_qty AS DOUBLE) AS sdp_qty FROM fx_sections""")
def simple_case_by_stage(spark, sf):
    have = plan.available(fx.reqstock(spark, sf)).withColumnsRenamed({"rs_rsnum": "pt_rsnum", "rs_rspos": "pt_rspos"})
    rows = fx.demand(spark, sf).where((F.col("pt_tech_data_type") == 1) & F.col("pt_bwtar").isin(plan.BOUGHT, plan.OWN))
    rows = rows.join(have, ["pt_rsnum", "pt_rspos"], "left").withColumn("potr_stad", plan.stage())
    return rows.select("pt_rsnum", "pt_rspos", "pt_lgort", plan.missing_quantity().alias("sdp_qty"))


@query("P8", "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '5-LOW')")
def membership(spark, sf):
    orders = fx.table(spark, sf, "orders").where(F.col("o_orderpriority").isin("1-URGENT", "5-LOW"))
    return orders.select("o_orderkey", "o_orderpriority")


@query("P9", "SELECT pt_rsnum, pt_rspos, pt_pp_aufnr FROM fx_demand WHERE pt_pp_aufnr NOT IN ('', '0')")
def non_membership(spark, sf):
    order = F.col("pt_pp_aufnr")
    return fx.demand(spark, sf).where(order.isNotNull() & ~order.isin("", "0")).select("pt_rsnum", "pt_rspos", "pt_pp_aufnr")


@query("F3", """
  SELECT pt_rsnum, pt_rspos, pt_lgort, CASE WHEN pt_qty_res <> 0 THEN CAST(pt_fp01 AS DOUBLE) / CAST(pt_qty_res AS DOUBLE) END AS unit_price
  FROM fx_demand""")
def guarded_ratio(spark, sf):
    price = ratio(F.col("pt_fp01").cast("double"), F.col("pt_qty_res").cast("double"))
    return fx.demand(spark, sf).select("pt_rsnum", "pt_rspos", "pt_lgort", price.alias("unit_price"))


@query("J1 J4 (right side repeated)", """
  SELECT c_custkey, o_orderkey, o_orderstatus FROM customer LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus = 'P') ON c_custkey = o_custkey""")
def left_join_repeated_right(spark, sf):
    orders = fx.table(spark, sf, "orders").where(F.col("o_orderstatus") == "P")
    orders = orders.select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_orderstatus")
    return left_join_many(fx.table(spark, sf, "customer").select("c_custkey"), orders, ["c_custkey"])


# Chains. A row is named by its full order key; the closure of the links gives the components.
fx.SQL["rows"] = """
  SELECT DISTINCT pl_udate, pl_utime, pl_rsnum, pl_rspos, pl_rsnum_new, pl_rspos_new,
    dense_rank() OVER (ORDER BY pl_udate, pl_utime, pl_rsnum, pl_rspos, pl_rsnum_new, pl_rspos_new) AS seq,
    pl_rsnum_new = 0 AND pl_rspos_new = 0 AS ends, (pl_rsnum, pl_rspos) = (pl_rsnum_new, pl_rspos_new) AS itself
  FROM fx_log"""
fx.SQL["items"] = """
  SELECT a, b, min(seq) AS seq FROM (
    SELECT pl_rsnum AS a, pl_rspos AS b, seq FROM fx_rows UNION ALL SELECT pl_rsnum_new, pl_rspos_new, seq FROM fx_rows WHERE NOT ends)
  GROUP BY 1, 2"""
fx.SQL["opened"] = """
  SELECT seq, row_number() OVER (ORDER BY seq) AS chain_id
  FROM (SELECT seq, count(*) AS n FROM fx_items GROUP BY 1) JOIN fx_rows USING (seq) WHERE n = CASE WHEN ends OR itself THEN 1 ELSE 2 END"""
fx.SQL["links"] = """
  SELECT DISTINCT pl_rsnum AS a, pl_rspos AS b, pl_rsnum_new AS c, pl_rspos_new AS d FROM fx_rows WHERE NOT ends AND NOT itself
  UNION SELECT pl_rsnum_new, pl_rspos_new, pl_rsnum, pl_rspos FROM fx_rows WHERE NOT ends AND NOT itself"""
_CLOSURE = """WITH RECURSIVE reach AS (
    SELECT a, b, a AS c, b AS d FROM fx_items
    UNION SELECT r.a, r.b, l.c, l.d FROM reach r JOIN fx_links l ON l.a = r.c AND l.b = r.d),
  chain AS (SELECT r.a, r.b, min(o.chain_id) AS chain_id, min(r.c * 100 + r.d) AS least_item, count(*) AS items
    FROM reach r JOIN fx_items i ON i.a = r.c AND i.b = r.d LEFT JOIN fx_opened o USING (seq) GROUP BY 1, 2)
"""


_NOW = f"{fx.NOW:%Y-%m-%d %H:%M:%S}"


def _text(stamp):
    return F.date_format(stamp, "yyyy-MM-dd HH:mm:ss")


def _one_load(spark, sf):
    return chains.extended_chains(chains.no_chains(spark), fx.log(spark, sf), fx.NOW)


@query("G1 G4 X3 F2 A7", _CLOSURE + """
  SELECT c.a AS plc_rsnum, c.b AS plc_rspos, pl_udate AS plc_udate, pl_utime AS plc_utime, chain_id, '""" + _NOW + """' AS plc_lchg_date_time
  FROM chain c JOIN fx_items i ON i.a = c.a AND i.b = c.b JOIN fx_rows USING (seq)""")
def demand_chains(spark, sf):
    return _one_load(spark, sf).withColumn("plc_lchg_date_time", _text("plc_lchg_date_time"))


@query("G1 M10", _CLOSURE + "SELECT chain_id, max(items) AS items FROM chain GROUP BY 1")
def chain_sizes(spark, sf):
    return _one_load(spark, sf).groupBy("chain_id").agg(F.count("*").alias("items"))


@query("B9 G5 (loads in turn; chains named by their least item)", _CLOSURE + "SELECT a AS plc_rsnum, b AS plc_rspos, least_item FROM chain")
def demand_chains_by_load(spark, sf):
    log = materialise(fx.log(spark, sf), "log")
    loads = [r["load_id"] for r in log.select("load_id").distinct().orderBy("load_id").collect()]
    done = materialise(chains.chains_of_loads(chains.no_chains(spark), log, loads, fx.NOW), "chains")
    least = done.groupBy("chain_id").agg(F.min(F.col("plc_rsnum") * 100 + F.col("plc_rspos")).alias("least_item"))
    return done.join(least, "chain_id").select("plc_rsnum", "plc_rspos", "least_item")


def _run_by_journal(spark, sf):
    """Folder with the chains and the journal after all pending loads were run one by one."""
    folder = new_path(spark, "warehouse")
    log = fx.log(spark, sf)
    log.write.parquet(f"{folder}/potr_log")
    chains.no_chains(spark).write.parquet(f"{folder}/potr_log_chain")
    names = [F.lit(daily.CHAIN_FLOW).alias("flow_id"), F.lit(daily.CHAIN_LEVEL).alias("target_lvl"), "load_id", F.lit("N").alias("stg_status")]
    new = log.select("load_id").distinct().select(*names, F.lit(None).cast("bigint").alias("row_count"), stamp("2024-01-01 00:00:00").alias("crea_datetime"))
    new.write.parquet(f"{folder}/etl_delta_log")
    daily.run_chains(spark, folder, fx.NOW)
    return folder


@query("B9 G5 (run by the journal, load by load)", _CLOSURE + f"""
  SELECT a AS plc_rsnum, b AS plc_rspos, least_item, '{_NOW}' AS plc_lchg_date_time FROM chain""")
def chains_run_by_journal(spark, sf):
    done = daily.read_chains(spark, _run_by_journal(spark, sf))
    least = done.groupBy("chain_id").agg(F.min(F.col("plc_rsnum") * 100 + F.col("plc_rspos")).alias("least_item"))
    return done.join(least, "chain_id").select("plc_rsnum", "plc_rspos", "least_item", _text("plc_lchg_date_time").alias("plc_lchg_date_time"))


@query("B9 D6 (journal of the chain run)", f"""
  SELECT 'CALC_17' AS flow_id, 'IM' AS target_lvl, load_id, stg_status, CASE WHEN stg_status <> 'N' THEN n END AS row_count,
    CASE WHEN stg_status = 'N' THEN '2024-01-01 00:00:00' ELSE '{_NOW}' END AS crea_datetime, CASE WHEN stg_status = 'S' THEN '{_NOW}' END AS last_delta_ts
  FROM (SELECT load_id, count(*) AS n FROM fx_log GROUP BY 1), (VALUES ('N'), ('I'), ('S')) s(stg_status)""")
def journal_of_the_chain_run(spark, sf):
    journal = spark.read.option("mergeSchema", True).parquet(f"{_run_by_journal(spark, sf)}/etl_delta_log")
    return journal.withColumns({c: _text(c) for c in ("crea_datetime", "last_delta_ts")})


# Four loads at four times: orders of two years each, the rest, and the last two days.
_CUTS = ["1995-01-01", "1997-01-01", "1999-01-01", "2001-07-31", "2100-01-01"]
_LOADS = [f"Q{k}" for k in range(4)]


def _load_time(load):
    return fx.NOW + dt.timedelta(days=int(load[1:]))


def _log_of_four(spark, sf):
    date = F.col("pl_udate")
    named = F.coalesce(*[F.when((date >= a) & (date < b), F.lit(load)) for load, a, b in zip(_LOADS, _CUTS, _CUTS[1:], strict=False)])
    return fx.log(spark, sf).withColumn("load_id", named)


def _four_loads_sql():
    """The rules load by load: items of a load that are known stand for their chain, the others for themselves."""
    steps = ["chain_0 AS (SELECT NULL::BIGINT AS a, NULL::BIGINT AS b, NULL::DATE AS d, NULL::VARCHAR AS t, NULL::BIGINT AS chain_id, NULL::VARCHAR AS stamp WHERE false)"]
    for k, load in enumerate(_LOADS, 1):
        stamp = f"'{_load_time(load):%Y-%m-%d %H:%M:%S}'"
        steps.append(f"""
  rows_{k} AS MATERIALIZED (SELECT DISTINCT pl_udate, pl_utime, pl_rsnum, pl_rspos, pl_rsnum_new, pl_rspos_new,
      dense_rank() OVER (ORDER BY pl_udate, pl_utime, pl_rsnum, pl_rspos, pl_rsnum_new, pl_rspos_new) AS seq,
      pl_rsnum_new = 0 AND pl_rspos_new = 0 AS ends, (pl_rsnum, pl_rspos) = (pl_rsnum_new, pl_rspos_new) AS itself
    FROM fx_log WHERE pl_udate >= DATE '{_CUTS[k - 1]}' AND pl_udate < DATE '{_CUTS[k]}'),
  node_{k} AS MATERIALIZED (SELECT i.a, i.b, i.seq, c.chain_id AS old_id FROM (
      SELECT a, b, min(seq) AS seq FROM (SELECT pl_rsnum AS a, pl_rspos AS b, seq FROM rows_{k} UNION ALL
        SELECT pl_rsnum_new, pl_rspos_new, seq FROM rows_{k} WHERE NOT ends) GROUP BY 1, 2) i
    LEFT JOIN chain_{k - 1} c ON c.a = i.a AND c.b = i.b),
  opened_{k} AS MATERIALIZED (SELECT seq, (SELECT coalesce(max(chain_id), 0) FROM chain_{k - 1}) + row_number() OVER (ORDER BY seq) AS chain_id
    FROM (SELECT seq, count(*) AS n FROM node_{k} WHERE old_id IS NULL GROUP BY 1) JOIN rows_{k} USING (seq) WHERE n = CASE WHEN ends OR itself THEN 1 ELSE 2 END),
  label_{k} AS MATERIALIZED (SELECT a, b, seq, old_id, CASE WHEN old_id IS NOT NULL THEN 'c' || old_id ELSE a || '/' || b END AS l,
      coalesce(old_id, o.chain_id) AS v FROM node_{k} LEFT JOIN opened_{k} o USING (seq)),
  edge_{k} AS MATERIALIZED (SELECT x.l AS u, y.l AS v FROM rows_{k} JOIN label_{k} x ON x.a = pl_rsnum AND x.b = pl_rspos
      JOIN label_{k} y ON y.a = pl_rsnum_new AND y.b = pl_rspos_new WHERE NOT ends AND NOT itself
    UNION SELECT y.l, x.l FROM rows_{k} JOIN label_{k} x ON x.a = pl_rsnum AND x.b = pl_rspos
      JOIN label_{k} y ON y.a = pl_rsnum_new AND y.b = pl_rspos_new WHERE NOT ends AND NOT itself),
  reach_{k} AS (SELECT l, l AS m FROM label_{k} UNION SELECT r.l, e.v FROM reach_{k} r JOIN edge_{k} e ON e.u = r.m),
  root_{k} AS MATERIALIZED (SELECT r.l, min(x.v) AS chain_id FROM reach_{k} r JOIN label_{k} x ON x.l = r.m GROUP BY 1),
  chain_{k} AS MATERIALIZED (SELECT c.a, c.b, c.d, c.t, coalesce(r.chain_id, c.chain_id) AS chain_id,
      CASE WHEN r.chain_id < c.chain_id THEN {stamp} ELSE c.stamp END AS stamp
    FROM chain_{k - 1} c LEFT JOIN root_{k} r ON r.l = 'c' || c.chain_id
    UNION ALL SELECT x.a, x.b, pl_udate, pl_utime, r.chain_id, {stamp} FROM label_{k} x JOIN rows_{k} USING (seq) JOIN root_{k} r ON r.l = x.l WHERE old_id IS NULL)""")
    return "WITH RECURSIVE " + ",\n".join(steps)


_FOUR_LOADS = _four_loads_sql()
_FOUR_CHAINS = _FOUR_LOADS + """
  SELECT a AS plc_rsnum, b AS plc_rspos, d AS plc_udate, t AS plc_utime, chain_id, stamp AS plc_lchg_date_time FROM chain_4"""


@query("G1 G5 B9 (four loads at four times: numbers and stamps)", _FOUR_CHAINS)
def chain_numbers_and_stamps_by_load(spark, sf):
    folder = new_path(spark, "warehouse")
    log = materialise(_log_of_four(spark, sf), "log")
    log.write.parquet(f"{folder}/{daily.TABLES['demand_log']}")
    chains.no_chains(spark).write.parquet(f"{folder}/{daily.TABLES['chains']}")
    for load in _LOADS:
        event = [F.lit(v).alias(n) for n, v in (("flow_id", daily.CHAIN_FLOW), ("target_lvl", daily.CHAIN_LEVEL), ("load_id", load), ("stg_status", "N"))]
        new = spark.range(1).select(*event, F.lit(None).cast("bigint").alias("row_count"), F.lit(_load_time(load)).alias("crea_datetime"))
        new.write.mode("append").parquet(f"{folder}/{daily.TABLES['journal']}")
        daily.run_chains(spark, folder, _load_time(load))
    done = daily.read_chains(spark, folder)
    return done.withColumn("plc_lchg_date_time", _text("plc_lchg_date_time"))


@query("T1 G1 (two arrivals, both handed out again)", _FOUR_CHAINS)
def chains_from_a_stream(spark, sf):
    log = materialise(_log_of_four(spark, sf), "log")
    source, target, checkpoint = (new_path(spark, n) for n in ("log-files", "chain-store", "stream-checkpoint"))
    handle = chain_store.chain_batches(target, _load_time)
    early = F.col("load_id") <= "Q1"
    for part in (early, ~early):
        log.where(part).write.mode("append").parquet(source)
        run_available(spark, source, log.schema, checkpoint, handle)
    handle(log.where(~early), 1)
    handle(log.where(early), 0)
    return chain_store.read_chains(spark, target).withColumn("plc_lchg_date_time", _text("plc_lchg_date_time"))


@query("G1 M10 B9 (rows that each of four loads writes; the last one opens a part of the store)", _FOUR_LOADS + " " + " UNION ALL ".join(f"""
  SELECT '{load}' AS load_id, (SELECT count(*) FROM label_{k} WHERE old_id IS NULL) AS new_items,
    (SELECT count(*) FROM (SELECT l, chain_id FROM root_{k} WHERE starts_with(l, 'c')) WHERE chain_id < CAST(substr(l, 2) AS BIGINT)) AS chains_moved,
    {'true' if k == 4 else 'NULL::BOOLEAN'} AS opens_a_part""" for k, load in enumerate(_LOADS, 1)))
def rows_written_by_chain_loads(spark, sf):
    log = materialise(_log_of_four(spark, sf), "log")
    # Buckets that suit the size of the table: about a hundred of them before the last load.
    items = log.select("pl_rsnum", "pl_rspos").distinct().count()
    store = chain_store.ChainStore(spark, new_path(spark, "chain-store"), max(10, items // 60))
    rows = []
    for load in _LOADS:
        before = Versions(spark, store.folder)
        held = before.size_of([p for t in before.tables.values() for b in t.buckets.values() for p in b.paths])
        report = store.load(log.where(F.col("load_id") == load), _load_time(load))
        # A folded load reads and writes all items; that is told by its report and not counted as this load's own rows.
        part = report.folded or report.read + report.written < held / 2
        rows.append((load, report.items, report.moves, part if load == _LOADS[-1] else None))
    return spark.createDataFrame(rows, "load_id string, new_items bigint, chains_moved bigint, opens_a_part boolean")


@query("G2 G3 J15", """
  SELECT a, b, bool_or(ends) AS ends, bool_or(itself) AS itself FROM fx_items i JOIN fx_rows r ON r.pl_rsnum = i.a AND r.pl_rspos = i.b GROUP BY 1, 2""")
def terminal_and_self_rows(spark, sf):
    log = fx.log(spark, sf)
    return log.groupBy(F.col("pl_rsnum").alias("a"), F.col("pl_rspos").alias("b")).agg(
        F.bool_or(chains.is_terminal()).alias("ends"), F.bool_or(chains.is_self()).alias("itself")
    )


@query("G4", "SELECT a, b, pl_udate, pl_utime FROM fx_items JOIN fx_rows USING (seq)")
def first_row_of_each_item(spark, sf):
    log = chains.numbered_log(fx.log(spark, sf))
    return chains.first_rows(log).join(log, "seq").select("a", "b", "pl_udate", "pl_utime")


@query("J15", """
  SELECT i.a, i.b FROM fx_items i WHERE NOT EXISTS (
    SELECT 1 FROM fx_rows r WHERE NOT ends AND NOT itself AND r.pl_rsnum_new = i.a AND r.pl_rspos_new = i.b)""")
def items_without_predecessor(spark, sf):
    log = fx.log(spark, sf)
    targets = log.where(~chains.is_terminal() & ~chains.is_self())
    targets = targets.select(F.col("pl_rsnum_new").alias("a"), F.col("pl_rspos_new").alias("b"))
    sources = log.select(F.col("pl_rsnum").alias("a"), F.col("pl_rspos").alias("b"))
    return sources.unionByName(targets).distinct().join(targets, ["a", "b"], "left_anti")


@query("J15", "SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')")
def exists_semi_join(spark, sf):
    open_orders = fx.table(spark, sf, "orders").where(F.col("o_orderstatus") == "P").select(F.col("o_custkey").alias("c_custkey"))
    return fx.table(spark, sf, "customer").select("c_custkey").join(open_orders, "c_custkey", "left_semi")

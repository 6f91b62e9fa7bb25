"""Stock categorisation and its parts."""

from __future__ import annotations

from pyspark.sql import functions as F

from granary.functions.dates import in_month, in_trailing_year, month_start, trailing_months
from granary.operators.joins import update_from
from granary.operators.versions import Change, Versions
from granary.operators.replace import overwrite_partitions, read_partitions, replace_slice
from granary.operators.rows import distinct_union
from granary.plans import stock as plan, stock_store
from granary.session import materialise, new_path
from workload import fixtures as fx
from workload.registry import query

AS_OF = fx.AS_OF
MONTHS = trailing_months(AS_OF)


def half_up(numerator: str, denominator: str) -> str:
    """SQL for an integer quotient rounded half away from zero."""
    return f"(sign({numerator}) * ((2 * abs({numerator}) + {denominator}) // (2 * {denominator})))"


def priced(qty: str, base_qty: str, base_amt: str) -> str:
    """SQL for ``base_amt * qty / base_qty`` with six decimals, as a double."""
    q, bq, ba = (f"CAST({c} * 100 AS HUGEINT)" for c in (qty, base_qty, base_amt))
    return f"CAST({half_up(f'({ba} * {q} * 10000)', bq)} AS DOUBLE) / 1000000"


fx.SQL["months"] = f"SELECT CAST(DATE '{AS_OF}' - to_months(CAST(i AS INTEGER)) AS DATE) AS m FROM range(12) t(i)"
fx.SQL["total"] = """
  SELECT st_werks AS werks, coalesce(st_o_divis, '') AS o_divis, coalesce(st_r_divis, '') AS r_divis, st_matnr AS matnr,
    st_date AS date, CAST(date_trunc('month', st_date) AS DATE) AS m, coalesce(sum(st_qty), 0) AS qty, coalesce(sum(st_amt), 0) AS amt
  FROM fx_stock WHERE st_qty > 0 AND st_amt > 0 AND date_trunc('month', st_date) IN (SELECT m FROM fx_months) GROUP BY ALL"""
fx.SQL["areas"] = """
  SELECT wm_oblast_ppm AS area, max(wm_o_divis) AS o_divis, max(wm_r_divis) AS r_divis, max(wm_werks) AS werks
  FROM fx_warehouses WHERE wm_oblast_ppm <> '' GROUP BY 1"""
fx.SQL["required"] = f"""
  SELECT rs_ppm_area AS area, CAST(date_trunc('month', rs_load_date) AS DATE) AS date, rs_matnr AS matnr, rs_qty_avlb AS qty
  FROM fx_reqstock WHERE rs_tech_data_type = 1 AND rs_ppm_elem = '1S' AND rs_prof_load IN (1, 2)
    AND rs_load_date >= DATE '{AS_OF}' AND rs_load_date < DATE '{AS_OF}' + INTERVAL 1 MONTH
  UNION
  SELECT rs_ppm_area, CAST(date_trunc('month', rs_load_date) AS DATE), rs_matnr, rs_qty_avlb
  FROM fx_reqstock WHERE rs_tech_data_type = 3 AND rs_ppm_elem = '1S' AND rs_prof_load IN (1, 2) AND rs_load_date < DATE '{AS_OF}'"""
fx.SQL["need"] = """
  SELECT werks, date, o_divis, r_divis, matnr, sum(qty) AS qty FROM fx_required JOIN fx_areas USING (area) GROUP BY ALL"""
fx.SQL["safety"] = """
  SELECT t.* EXCLUDE (qty, amt), least(n.qty, t.qty) AS qty
  FROM fx_total t JOIN fx_need n USING (werks, date, o_divis, r_divis, matnr)"""
fx.SQL["held"] = """
  SELECT st_werks AS werks, coalesce(st_o_divis, '') AS o_divis, coalesce(st_r_divis, '') AS r_divis, st_matnr AS matnr,
    st_date AS date, sum(st_qty) AS qty FROM fx_stock GROUP BY ALL"""
fx.SQL["grid"] = """
  SELECT t.werks, t.o_divis, t.r_divis, t.matnr, t.m, c.date, coalesce(h.qty, 0) - coalesce(n.qty, 0) AS balance
  FROM fx_total t JOIN (SELECT DISTINCT date FROM fx_calendar) c ON c.date > t.m - INTERVAL 12 MONTH AND c.date <= t.m
  LEFT JOIN fx_held h ON h.werks = t.werks AND h.o_divis = t.o_divis AND h.r_divis = t.r_divis AND h.matnr = t.matnr AND h.date = c.date
  LEFT JOIN fx_need n ON n.werks = t.werks AND n.o_divis = t.o_divis AND n.r_divis = t.r_divis AND n.matnr = t.matnr AND n.date = c.date"""


def long_sql(partition: str) -> str:
    return f"""
  SELECT werks, o_divis, r_divis, matnr, date, m, low AS qty
  FROM (SELECT *, min(balance) OVER (PARTITION BY {partition}, m) AS low FROM fx_grid) WHERE date = m AND low > 0"""


fx.SQL["long"] = long_sql("o_divis, r_divis, matnr")
fx.SQL["fast"] = """
  SELECT t.* EXCLUDE (qty, amt), t.qty - coalesce(s.qty, 0) - coalesce(l.qty, 0) AS qty
  FROM fx_total t
  LEFT JOIN fx_safety s USING (werks, date, o_divis, r_divis, matnr)
  LEFT JOIN fx_long l USING (werks, date, o_divis, r_divis, matnr)"""
fx.SQL["parts"] = """
  SELECT 1 AS kat, werks, o_divis, r_divis, matnr, date, qty FROM fx_safety
  UNION ALL SELECT 2, werks, o_divis, r_divis, matnr, date, qty FROM fx_long
  UNION ALL SELECT 3, werks, o_divis, r_divis, matnr, date, qty FROM fx_fast"""
fx.SQL["categories"] = f"""
  SELECT p.werks AS sca_werks, p.o_divis AS sca_o_divis, p.r_divis AS sca_r_divis, p.matnr AS sca_matnr, p.date AS sca_date,
    CAST(p.qty AS DOUBLE) AS sca_qty, {priced('p.qty', 't.qty', 't.amt')} AS sca_amt, CAST(p.kat AS SMALLINT) AS sca_kat
  FROM fx_parts p LEFT JOIN fx_total t USING (werks, o_divis, r_divis, matnr, date)
  UNION ALL
  SELECT werks, o_divis, r_divis, matnr, date, CAST(qty AS DOUBLE), CAST(amt AS DOUBLE), CAST(4 AS SMALLINT) FROM fx_total"""
fx.SQL["valuation"] = """
  SELECT st_werks, st_o_divis, st_r_divis, st_matnr, st_date, max(st_bwtar) AS bwtar FROM fx_stock
  WHERE day(st_date) = 1 GROUP BY ALL"""
fx.SQL["enriched"] = """
  SELECT c.*, CAST(year(sca_date) AS INTEGER) AS sca_year, CAST(month(sca_date) AS INTEGER) AS sca_month, w.proizv AS sca_proizv,
    m.mt_matkl AS sca_matkl, m.mt_cc_idtext AS sca_matnr_txt, m.mt_ekgrp AS sca_ekgrp, v.bwtar AS sca_bwtar,
    g.mtg_cc_idtext AS sca_matkl_txt, coalesce(o.div_id_full_txt, o.div_id) AS sca_o_divis_txt,
    coalesce(r.div_id_full_txt, r.div_id) AS sca_r_divis_txt, p.or_div_txt AS sca_or_divis_txt
  FROM fx_categories c
  LEFT JOIN (SELECT wm_werks, wm_o_divis, wm_r_divis, min(wm_proizv) AS proizv FROM fx_warehouses GROUP BY ALL) w
    ON sca_werks = wm_werks AND sca_o_divis = wm_o_divis AND sca_r_divis = wm_r_divis
  LEFT JOIN fx_materials m ON sca_matnr = mt_matnr AND sca_werks = mt_werks
  LEFT JOIN fx_valuation v ON sca_werks = st_werks AND sca_o_divis = st_o_divis AND sca_r_divis = st_r_divis
    AND sca_matnr = st_matnr AND sca_date = st_date
  LEFT JOIN fx_groups g ON m.mt_matkl = g.mtg_matkl
  LEFT JOIN fx_divisions o ON sca_o_divis = o.div_id
  LEFT JOIN fx_divisions r ON sca_r_divis = r.div_id
  LEFT JOIN fx_pairs p ON sca_o_divis = o_div_id AND sca_r_divis = r_div_id
  WHERE sca_kat < 4"""

PLACE = ["werks", "o_divis", "r_divis", "matnr", "date"]
SCA = "sca_werks, sca_o_divis, sca_r_divis, sca_matnr, sca_date, sca_qty"


def _categories(spark, sf, months=MONTHS, per_plant=False):
    sources = fx.stock(spark, sf), fx.reqstock(spark, sf), fx.warehouses(spark, sf), fx.calendar(spark, sf)
    return plan.categorised(*sources, months, AS_OF, per_plant)


def _slim(df):
    return df.select("sca_werks", "sca_o_divis", "sca_r_divis", "sca_matnr", "sca_date", "sca_qty")


@query("B1 A1 P4 P5 F1 S13", """
  SELECT werks AS sca_werks, o_divis AS sca_o_divis, r_divis AS sca_r_divis, matnr AS sca_matnr, date AS sca_date,
    CAST(qty AS DOUBLE) AS sca_qty, CAST(amt AS DOUBLE) AS sca_amt, CAST(4 AS SMALLINT) AS sca_kat FROM fx_total""")
def total_stock_by_month(spark, sf):
    return plan.total_stock(fx.stock(spark, sf), MONTHS)


@query("B2 F2 J2", f"SELECT {SCA} FROM fx_categories WHERE sca_kat = 1")
def safety_stock(spark, sf):
    return _slim(plan.of_kind(_categories(spark, sf), plan.SAFETY))


@query("B3 J10 W1", f"SELECT {SCA} FROM fx_categories WHERE sca_kat = 2")
def long_lying_stock(spark, sf):
    return _slim(plan.of_kind(_categories(spark, sf), plan.LONG_LYING))


@query("B3 W1 (option: plants kept apart)", f"""
  SELECT werks AS sca_werks, o_divis AS sca_o_divis, r_divis AS sca_r_divis, matnr AS sca_matnr, date AS sca_date,
    CAST(qty AS DOUBLE) AS sca_qty FROM ({long_sql('werks, o_divis, r_divis, matnr')})""")
def long_lying_stock_per_plant(spark, sf):
    return _slim(plan.of_kind(_categories(spark, sf, per_plant=True), plan.LONG_LYING))


@query("B4 F3 J4", f"SELECT {SCA} FROM fx_categories WHERE sca_kat = 3")
def fast_moving_stock(spark, sf):
    return _slim(plan.of_kind(_categories(spark, sf), plan.FAST_MOVING))


@query("B5 B7", f"SELECT {SCA}, sca_amt, sca_kat FROM fx_categories")
def stock_categories(spark, sf):
    return _categories(spark, sf).drop("sca_bwtar")


@query("B1 B3 W1 P6 B7 (from what has changed: rows of a hundredth of the materials arrive later)", f"SELECT {SCA}, sca_amt, sca_kat FROM fx_categories")
def stock_categories_by_increment(spark, sf):
    stock, reqstock, path = fx.stock(spark, sf), fx.reqstock(spark, sf), new_path(spark, "stock-store")
    later, later_needed = (F.coalesce(F.endswith(c, F.lit("77")), F.lit(False)) for c in (F.col("st_matnr"), F.col("rs_matnr")))
    # A third of the late materials' stock is there before.
    later &= F.col("st_werks") != "W0"
    for new, needed in ((stock.where(~later), reqstock.where(~later_needed)), (stock.where(later), reqstock.where(later_needed))):
        stock_store.load(new, needed, fx.warehouses(spark, sf), fx.calendar(spark, sf), MONTHS, AS_OF, path)
    return stock_store.read_categories(spark, path).drop("sca_bwtar")


@query("M7", f"SELECT {SCA}, sca_amt, sca_kat FROM fx_categories")
def repriced_from_total(spark, sf):
    blank = F.when(F.col("sca_kat") == plan.TOTAL, F.col("sca_amt"))
    unpriced = materialise(_categories(spark, sf).drop("sca_bwtar").withColumn("sca_amt", blank), "unpriced")
    return plan.repriced(unpriced)


@query("B6 M4 M5 M6 M8 F5", "SELECT * FROM fx_enriched")
def stock_enriched(spark, sf):
    dims = (f(spark, sf) for f in (fx.warehouses, fx.materials, fx.groups, fx.divisions, fx.pairs))
    return plan.enriched(_categories(spark, sf), *dims)


@query("U1 F4", "SELECT area, date, matnr, CAST(qty AS DOUBLE) AS qty FROM fx_required")
def required_rows_distinct_union(spark, sf):
    return plan.required_rows(fx.reqstock(spark, sf), AS_OF)


@query("U1", """
  SELECT pt_matnr AS matnr, pt_werks AS werks FROM fx_demand WHERE pt_modul = 1
  UNION SELECT st_matnr, st_werks FROM fx_stock WHERE st_qty < 0""")
def distinct_union_of_two(spark, sf):
    demand = fx.demand(spark, sf).where(F.col("pt_modul") == 1)
    stock = fx.stock(spark, sf).where(F.col("st_qty") < 0)
    return distinct_union(
        demand.select(F.col("pt_matnr").alias("matnr"), F.col("pt_werks").alias("werks")),
        stock.select(F.col("st_matnr").alias("matnr"), F.col("st_werks").alias("werks")),
    )


@query("A4", "SELECT * FROM fx_areas")
def area_maxima(spark, sf):
    return plan.area_map(fx.warehouses(spark, sf))


@query("J3 A2", "SELECT werks, date, o_divis, r_divis, matnr, CAST(qty AS DOUBLE) AS qty FROM fx_need")
def required_by_place(spark, sf):
    return plan.required_by_place(fx.reqstock(spark, sf), fx.warehouses(spark, sf), AS_OF)


@query("J2", """
  SELECT werks, date, o_divis, r_divis, matnr, CAST(t.qty AS DOUBLE) AS total_qty, CAST(n.qty AS DOUBLE) AS need_qty
  FROM fx_total t JOIN fx_need n USING (werks, date, o_divis, r_divis, matnr)""")
def inner_join_five_keys(spark, sf):
    total = plan.total_stock(fx.stock(spark, sf), MONTHS).select(*[F.col(f"sca_{c}").alias(c) for c in PLACE], F.col("sca_qty").alias("total_qty"))
    need = plan.required_by_place(fx.reqstock(spark, sf), fx.warehouses(spark, sf), AS_OF).withColumnRenamed("qty", "need_qty")
    return total.join(need, PLACE)


@query("J4", """
  SELECT werks, date, o_divis, r_divis, matnr, CAST(t.qty - coalesce(n.qty, 0) AS DOUBLE) AS free_qty
  FROM fx_total t LEFT JOIN fx_need n USING (werks, date, o_divis, r_divis, matnr)""")
def left_join_five_keys(spark, sf):
    total = plan.total_stock(fx.stock(spark, sf), MONTHS).select(*[F.col(f"sca_{c}").alias(c) for c in PLACE], F.col("sca_qty").alias("total_qty"))
    need = plan.required_by_place(fx.reqstock(spark, sf), fx.warehouses(spark, sf), AS_OF)
    free = (F.col("total_qty") - F.coalesce("qty", F.lit(0))).alias("free_qty")
    return total.join(need, PLACE, "left").select(*PLACE, free)


@query("P6 A2", f"""
  SELECT st_werks AS werks, coalesce(st_o_divis, '') AS o_divis, coalesce(st_r_divis, '') AS r_divis, st_matnr AS matnr,
    st_date AS date, CAST(sum(st_qty) AS DOUBLE) AS qty
  FROM fx_stock WHERE st_date > DATE '{AS_OF}' - INTERVAL 12 MONTH AND st_date <= DATE '{AS_OF}' GROUP BY ALL""")
def trailing_year_balances(spark, sf):
    return plan.month_balances(fx.stock(spark, sf), AS_OF)


@query("P5", f"""
  SELECT l_orderkey, l_linenumber, l_shipdate::DATE AS day FROM lineitem
  WHERE l_shipdate >= DATE '{AS_OF}' AND l_shipdate < DATE '{AS_OF}' + INTERVAL 1 MONTH""")
def rows_of_a_month(spark, sf):
    lineitem = fx.table(spark, sf, "lineitem").where(in_month(F.col("l_shipdate"), AS_OF))
    return lineitem.select("l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("day"))


@query("P6", f"""
  SELECT o_custkey, count(*) AS orders FROM orders
  WHERE o_orderdate > DATE '{AS_OF}' - INTERVAL 12 MONTH AND o_orderdate <= DATE '{AS_OF}' GROUP BY 1""")
def rows_of_the_trailing_year(spark, sf):
    orders = fx.table(spark, sf, "orders").where(in_trailing_year(F.col("o_orderdate"), AS_OF))
    return orders.groupBy("o_custkey").agg(F.count("*").alias("orders"))


@query("A6", "SELECT DISTINCT date FROM fx_calendar")
def distinct_by_grouping(spark, sf):
    return fx.calendar(spark, sf)


@query("A5", f"""
  SELECT st_werks, st_o_divis, st_r_divis, st_matnr, max(st_bwtar) AS st_bwtar FROM fx_stock
  WHERE st_date = DATE '{AS_OF}' GROUP BY ALL""")
def greatest_valuation(spark, sf):
    return plan.latest_valuation(fx.stock(spark, sf), AS_OF)


@query("W1", """
  SELECT * FROM (SELECT werks, o_divis, r_divis, matnr, date, CAST(min(qty) OVER (PARTITION BY o_divis, r_divis, matnr) AS DOUBLE) AS least
    FROM fx_total) WHERE date = DATE '2000-06-01' AND least > 5""")
def partition_minimum_then_filter(spark, sf):
    total = plan.total_stock(fx.stock(spark, sf), MONTHS).toDF("werks", "o_divis", "r_divis", "matnr", "date", "qty", "amt", "kat")
    lowest = total.groupBy("o_divis", "r_divis", "matnr").agg(F.min("qty").alias("least")).where(F.col("least") > 5)
    return total.where(F.col("date") == F.lit(AS_OF)).join(lowest, ["o_divis", "r_divis", "matnr"]).select(*PLACE, "least")


@query("M4", """
  SELECT l_orderkey, l_linenumber, l_partkey, coalesce(p_name, l_returnflag) AS label
  FROM lineitem LEFT JOIN part ON l_partkey = p_partkey""")
def update_from_dimension(spark, sf):
    rows = fx.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_returnflag").alias("label"))
    return update_from(rows, fx.table(spark, sf, "part"), {"l_partkey": "p_partkey"}, {"label": "p_name"})


@query("M5", """
  SELECT c_custkey, coalesce(least_status, 'none') AS status
  FROM customer LEFT JOIN (SELECT o_custkey, min(o_orderstatus) AS least_status FROM orders GROUP BY 1) ON c_custkey = o_custkey""")
def update_from_repeated_dimension(spark, sf):
    rows = fx.table(spark, sf, "customer").select("c_custkey", F.lit("none").alias("status"))
    return update_from(rows, fx.table(spark, sf, "orders"), {"c_custkey": "o_custkey"}, {"status": "o_orderstatus"})


@query("M6", """
  SELECT c_custkey, coalesce(top, 'none') AS priority
  FROM customer LEFT JOIN (SELECT o_custkey, max(o_orderpriority) AS top FROM orders GROUP BY 1) ON c_custkey = o_custkey""")
def update_from_aggregate(spark, sf):
    top = fx.table(spark, sf, "orders").groupBy("o_custkey").agg(F.max("o_orderpriority").alias("top"))
    rows = fx.table(spark, sf, "customer").select("c_custkey", F.lit("none").alias("priority"))
    return update_from(rows, top, {"c_custkey": "o_custkey"}, {"priority": "top"})


@query("M8 F5", """
  SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS order_year, CAST(month(o_orderdate) AS INTEGER) AS order_month FROM orders""")
def update_computed_fields(spark, sf):
    orders = fx.table(spark, sf, "orders")
    return orders.select("o_orderkey", F.year("o_orderdate").alias("order_year"), F.month("o_orderdate").alias("order_month"))


@query("M1 B7 (written twice)", f"SELECT {SCA}, sca_amt, sca_kat FROM fx_categories")
def months_replaced_in_a_table(spark, sf):
    rows = materialise(_categories(spark, sf).drop("sca_bwtar").withColumn("sca_period", month_start("sca_date")), "months")
    path = new_path(spark, "categories")
    stale = rows.withColumn("sca_qty", F.col("sca_qty") + 1).where(F.col("sca_kat") != 3)
    overwrite_partitions(stale, path, "sca_period", MONTHS)
    overwrite_partitions(rows, path, "sca_period", MONTHS)
    overwrite_partitions(rows, path, "sca_period", MONTHS)
    return read_partitions(spark, path, rows.schema).drop("sca_period")


@query("M1 B7 S12 (a run broken off between two tables, then whole)", """
  WITH old AS (SELECT sca_date, sca_qty + 1 AS q FROM fx_categories WHERE sca_kat <> 3), new AS (SELECT sca_date, sca_qty AS q FROM fx_categories),
  seen AS (SELECT 'broken' AS state, * FROM old UNION ALL SELECT 'whole', * FROM new)
  SELECT state, name, count(*) AS "rows", CAST(sum(q) AS DOUBLE) AS qty FROM seen, (VALUES ('categories'), ('copies')) t(name) GROUP BY ALL""")
def category_tables_switch_together(spark, sf):
    rows = materialise(_categories(spark, sf).drop("sca_bwtar").withColumn("sca_period", month_start("sca_date")), "months")
    folder, names = new_path(spark, "marts"), ("categories", "copies")
    stale = rows.withColumn("sca_qty", F.col("sca_qty") + 1).where(F.col("sca_kat") != 3)

    def run(fresh, tables):
        change = Change(spark, folder)
        for name in tables:
            change.slices(name, fresh, "sca_period", MONTHS)
        return change

    def seen(state):
        store = Versions(spark, folder)
        parts = [store.read(n).select(F.lit(state).alias("state"), F.lit(n).alias("name"), "sca_qty") for n in names]
        return materialise(parts[0].unionAll(parts[1]), "seen")

    run(stale, names).commit()
    run(rows, names[:1])  # broken off before the second table
    broken = seen("broken")
    run(rows, names).commit()
    return broken.unionAll(seen("whole")).groupBy("state", "name").agg(F.count("*").alias("rows"), F.sum("sca_qty").cast("double").alias("qty"))


@query("M1", f"""
  SELECT o_orderkey, CAST(CAST(CASE WHEN o_orderdate >= DATE '{AS_OF}' AND o_orderdate < DATE '{AS_OF}' + INTERVAL 1 MONTH
    THEN -o_totalprice ELSE o_totalprice END AS DECIMAL(18,2)) AS DOUBLE) AS price FROM orders""")
def month_slice_replaced(spark, sf):
    orders = fx.table(spark, sf, "orders").select("o_orderkey", "o_orderdate", fx.money(F.col("o_totalprice")).alias("price"))
    month = in_month(F.col("o_orderdate"), AS_OF)
    fresh = orders.where(month).withColumn("price", (-F.col("price")).cast("decimal(18,2)"))
    return replace_slice(orders, fresh, month).select("o_orderkey", "price")

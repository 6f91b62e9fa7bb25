"""Warehouse tables derived from the driver's tables: a DataFrame for Spark, a SELECT for the SQL twin.

Every table is made from whole driver tables. A third of the stock falls on two materials and a third of
the snapshot rows on one snapshot, so that hot keys are part of every run.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from granary.functions.numbers import money
from granary.plans.demand import BOUGHT, OILS_ACCOUNT, OWN
from granary.plans.loads import SNAPSHOT_COLUMNS
from granary.sources.tables import table

AS_OF = dt.date(2000, 6, 1)
NOW = dt.datetime(2024, 3, 1, 12, 0, 0)
SQL: dict[str, str] = {}


def _text(column: str) -> Column:
    return F.col(column).cast("string")


def _material(key: str) -> Column:
    hot = F.concat(F.lit("H"), (F.col(key) % 2).cast("string"))
    return F.when(F.col(key) % 3 == 0, hot).otherwise(F.concat(F.lit("P"), _text(key)))


def _material_sql(key: str) -> str:
    return f"CASE WHEN {key} % 3 = 0 THEN 'H' || ({key} % 2) ELSE 'P' || {key} END"


def _plant(key: str, of: int = 3) -> Column:
    return F.concat(F.lit("W"), (F.col(key) % of).cast("string"))


SQL["stock"] = f"""
  SELECT 'W' || (l_suppkey % 3) AS st_werks, CASE WHEN l_returnflag <> 'N' THEN l_returnflag END AS st_o_divis,
    l_linestatus AS st_r_divis, {_material_sql('l_partkey')} AS st_matnr,
    CAST(date_trunc('month', l_shipdate) AS DATE) + CASE WHEN l_linenumber = 7 THEN 14 ELSE 0 END AS st_date,
    CAST(CASE WHEN l_linenumber = 6 THEN -l_quantity ELSE l_quantity END AS DECIMAL(18,2)) AS st_qty,
    CAST(l_extendedprice AS DECIMAL(18,2)) AS st_amt, CASE WHEN l_tax > 0.04 THEN 'OWN' ELSE 'BUY' END AS st_bwtar
  FROM lineitem"""


def stock(spark: SparkSession, sf: str) -> DataFrame:
    sign = F.when(F.col("l_linenumber") == 6, -F.col("l_quantity")).otherwise(F.col("l_quantity"))
    middle = F.when(F.col("l_linenumber") == 7, 14).otherwise(0)
    return table(spark, sf, "lineitem").select(
        _plant("l_suppkey").alias("st_werks"),
        F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("st_o_divis"),
        F.col("l_linestatus").alias("st_r_divis"),
        _material("l_partkey").alias("st_matnr"),
        F.date_add(F.trunc("l_shipdate", "MM"), middle).alias("st_date"),
        money(sign).alias("st_qty"),
        money(F.col("l_extendedprice")).alias("st_amt"),
        F.when(F.col("l_tax") > 0.04, "OWN").otherwise("BUY").alias("st_bwtar"),
    )


SQL["reqstock"] = f"""
  SELECT 'A' || (l_suppkey % 12) AS rs_ppm_area, l_shipdate AS rs_load_date, {_material_sql('l_partkey')} AS rs_matnr,
    CAST(CASE WHEN l_partkey % 5 = 0 THEN l_quantity * 4 ELSE l_quantity / 4 END AS DECIMAL(18,2)) AS rs_qty_avlb,
    CASE WHEN l_linenumber <= 2 THEN 1 WHEN l_linenumber <= 5 THEN 3 ELSE 2 END AS rs_tech_data_type,
    CASE WHEN l_discount >= 0.08 THEN '1S' ELSE '2S' END AS rs_ppm_elem, l_linenumber % 4 AS rs_prof_load,
    l_orderkey AS rs_rsnum, CAST(l_linenumber AS BIGINT) AS rs_rspos
  FROM lineitem"""


def reqstock(spark: SparkSession, sf: str) -> DataFrame:
    line = F.col("l_linenumber")
    qty = F.when(F.col("l_partkey") % 5 == 0, F.col("l_quantity") * 4).otherwise(F.col("l_quantity") / 4)
    return table(spark, sf, "lineitem").select(
        F.concat(F.lit("A"), (F.col("l_suppkey") % 12).cast("string")).alias("rs_ppm_area"),
        F.col("l_shipdate").alias("rs_load_date"),
        _material("l_partkey").alias("rs_matnr"),
        money(qty).alias("rs_qty_avlb"),
        F.when(line <= 2, 1).when(line <= 5, 3).otherwise(2).alias("rs_tech_data_type"),
        F.when(F.col("l_discount") >= 0.08, "1S").otherwise("2S").alias("rs_ppm_elem"),
        (line % 4).alias("rs_prof_load"),
        F.col("l_orderkey").alias("rs_rsnum"),
        line.cast("bigint").alias("rs_rspos"),
    )


SQL["warehouses"] = """
  SELECT CASE WHEN s_acctbal < -900 THEN '' ELSE 'A' || (s_suppkey % 12) END AS wm_oblast_ppm,
    CASE s_suppkey % 4 WHEN 0 THEN 'A' WHEN 1 THEN 'R' ELSE '' END AS wm_o_divis,
    CASE s_suppkey % 2 WHEN 0 THEN 'O' ELSE 'F' END AS wm_r_divis, 'W' || (s_suppkey % 3) AS wm_werks,
    'L' || s_suppkey AS wm_lgort, 'Z' || s_nationkey AS wm_proizv
  FROM supplier"""


def warehouses(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("s_suppkey")
    area = F.concat(F.lit("A"), (key % 12).cast("string"))
    return table(spark, sf, "supplier").select(
        F.when(F.col("s_acctbal") < -900, "").otherwise(area).alias("wm_oblast_ppm"),
        F.when(key % 4 == 0, "A").when(key % 4 == 1, "R").otherwise("").alias("wm_o_divis"),
        F.when(key % 2 == 0, "O").otherwise("F").alias("wm_r_divis"),
        _plant("s_suppkey").alias("wm_werks"),
        F.concat(F.lit("L"), _text("s_suppkey")).alias("wm_lgort"),
        F.concat(F.lit("Z"), _text("s_nationkey")).alias("wm_proizv"),
    )


SQL["calendar"] = "SELECT DISTINCT CAST(date_trunc('month', l_shipdate) AS DATE) AS date FROM lineitem"


def calendar(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(F.trunc("l_shipdate", "MM").alias("date")).distinct()


SQL["divisions"] = """
  SELECT substr('AROF', 1 + n_nationkey % 4, 1) AS div_id,
    min(CASE WHEN n_nationkey % 4 < 3 THEN n_name END) AS div_id_full_txt
  FROM nation GROUP BY 1"""


def divisions(spark: SparkSession, sf: str) -> DataFrame:
    four = F.col("n_nationkey") % 4
    div = F.when(four == 0, "A").when(four == 1, "R").when(four == 2, "O").otherwise("F")
    return table(spark, sf, "nation").groupBy(div.alias("div_id")).agg(
        F.min(F.when(four < 3, F.col("n_name"))).alias("div_id_full_txt")
    )


SQL["pairs"] = """
  SELECT substr('AR', 1 + n_nationkey % 2, 1) AS o_div_id, substr('OF', 1 + (n_nationkey // 2) % 2, 1) AS r_div_id,
    min(n_name) AS or_div_txt
  FROM nation GROUP BY 1, 2"""


def pairs(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("n_nationkey")
    outer = F.when(key % 2 == 0, "A").otherwise("R")
    inner = F.when(F.floor(key / 2) % 2 == 0, "O").otherwise("F")
    nation = table(spark, sf, "nation")
    return nation.groupBy(outer.alias("o_div_id"), inner.alias("r_div_id")).agg(F.min("n_name").alias("or_div_txt"))


SQL["materials"] = f"""
  SELECT {_material_sql('p_partkey')} AS mt_matnr, 'W' || (p_size % 3) AS mt_werks, min(p_type) AS mt_matkl,
    min(p_name) AS mt_cc_idtext, min(p_brand) AS mt_ekgrp, min('M' || (p_size % 5)) AS mt_moni_gr
  FROM part GROUP BY 1, 2"""


def materials(spark: SparkSession, sf: str) -> DataFrame:
    monitor = F.concat(F.lit("M"), (F.col("p_size") % 5).cast("string"))
    key = [_material("p_partkey").alias("mt_matnr"), _plant("p_size").alias("mt_werks")]
    return table(spark, sf, "part").groupBy(*key).agg(
        F.min("p_type").alias("mt_matkl"),
        F.min("p_name").alias("mt_cc_idtext"),
        F.min("p_brand").alias("mt_ekgrp"),
        F.min(monitor).alias("mt_moni_gr"),
    )


SQL["groups"] = "SELECT p_type AS mtg_matkl, min(p_name) AS mtg_cc_idtext FROM part GROUP BY 1"


def groups(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part")
    return part.groupBy(F.col("p_type").alias("mtg_matkl")).agg(F.min("p_name").alias("mtg_cc_idtext"))


SQL["demand"] = f"""
  SELECT l_orderkey AS pt_rsnum, CAST(l_linenumber AS BIGINT) AS pt_rspos, 'L' || l_suppkey AS pt_lgort,
    {_material_sql('l_partkey')} AS pt_matnr, 'W' || (l_suppkey % 3) AS pt_werks,
    CASE l_returnflag WHEN 'A' THEN '{BOUGHT}' WHEN 'R' THEN '{OWN}' ELSE 'OTHER' END AS pt_bwtar,
    CASE o_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN '0' WHEN 2 THEN '' ELSE CAST(o_orderkey AS VARCHAR) END AS pt_pp_aufnr,
    'ST' AS pt_unit_qty, o_orderpriority AS pt_zvd, CAST(l_shipdate AS DATE) AS pt_bdter,
    CAST(o_orderdate AS DATE) AS pt_manu_date, CAST(year(l_shipdate) AS INTEGER) AS pt_year,
    CAST(month(l_shipdate) AS INTEGER) AS pt_month, l_linenumber % 4 AS pt_modul,
    CASE WHEN l_linenumber = 7 THEN 3 ELSE 1 END AS pt_tech_data_type,
    CASE WHEN l_discount >= 0.05 THEN {OILS_ACCOUNT} ELSE {OILS_ACCOUNT + 1} END AS pt_saknr,
    CAST(l_extendedprice AS DECIMAL(18,2)) AS pt_fp01,
    CAST(CASE WHEN l_orderkey % 50 = 0 THEN 0 ELSE l_quantity END AS DECIMAL(18,2)) AS pt_qty_res,
    CAST(l_quantity / 2 AS DECIMAL(18,2)) AS pt_enmng, CAST(o_totalprice AS DECIMAL(18,2)) AS pt_amt_otpu,
    CAST(l_quantity - 1 AS DECIMAL(18,2)) AS pt_qty_open, CAST(l_extendedprice AS DECIMAL(18,2)) AS pt_amt_open
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""


def demand(spark: SparkSession, sf: str) -> DataFrame:
    four = F.col("o_orderkey") % 4
    rows = table(spark, sf, "lineitem").join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    flag = F.col("l_returnflag")
    return rows.select(
        F.col("l_orderkey").alias("pt_rsnum"),
        F.col("l_linenumber").cast("bigint").alias("pt_rspos"),
        F.concat(F.lit("L"), _text("l_suppkey")).alias("pt_lgort"),
        _material("l_partkey").alias("pt_matnr"),
        _plant("l_suppkey").alias("pt_werks"),
        F.when(flag == "A", BOUGHT).when(flag == "R", OWN).otherwise("OTHER").alias("pt_bwtar"),
        F.when(four == 1, "0").when(four == 2, "").when(four == 3, _text("o_orderkey")).alias("pt_pp_aufnr"),
        F.lit("ST").alias("pt_unit_qty"),
        F.col("o_orderpriority").alias("pt_zvd"),
        F.to_date("l_shipdate").alias("pt_bdter"),
        F.to_date("o_orderdate").alias("pt_manu_date"),
        F.year("l_shipdate").alias("pt_year"),
        F.month("l_shipdate").alias("pt_month"),
        (F.col("l_linenumber") % 4).alias("pt_modul"),
        F.when(F.col("l_linenumber") == 7, 3).otherwise(1).alias("pt_tech_data_type"),
        F.when(F.col("l_discount") >= 0.05, OILS_ACCOUNT).otherwise(OILS_ACCOUNT + 1).alias("pt_saknr"),
        money(F.col("l_extendedprice")).alias("pt_fp01"),
        money(F.when(F.col("l_orderkey") % 50 == 0, 0).otherwise(F.col("l_quantity"))).alias("pt_qty_res"),
        money(F.col("l_quantity") / 2).alias("pt_enmng"),
        money(F.col("o_totalprice")).alias("pt_amt_otpu"),
        money(F.col("l_quantity") - 1).alias("pt_qty_open"),
        money(F.col("l_extendedprice")).alias("pt_amt_open"),
    )


# The demand log: item k is (k div 10, k % 10 + 1). The last item of ten ends its chain, some items point to
# themselves, and some to the item at half their number, which ties chains together.
SQL["log"] = """
  SELECT o_orderkey // 10 AS pl_rsnum, o_orderkey % 10 + 1 AS pl_rspos,
    CASE WHEN o_orderkey % 10 = 9 THEN 0 ELSE t // 10 END AS pl_rsnum_new,
    CASE WHEN o_orderkey % 10 = 9 THEN 0 ELSE t % 10 + 1 END AS pl_rspos_new,
    CAST(o_orderdate AS DATE) AS pl_udate, lpad(CAST(o_orderkey % 24 AS VARCHAR), 2, '0') || ':00:00' AS pl_utime,
    'L' || (year(o_orderdate) // 3) AS load_id
  FROM (SELECT *, CASE WHEN o_orderkey % 41 = 0 THEN o_orderkey WHEN o_orderkey % 29 = 0 THEN o_orderkey // 2
                  ELSE o_orderkey + 1 END AS t FROM orders)"""


def log(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("o_orderkey")
    half = F.floor(k / 2).cast("bigint")
    rows = table(spark, sf, "orders").withColumn("t", F.when(k % 41 == 0, k).when(k % 29 == 0, half).otherwise(k + 1))
    ends = k % 10 == 9

    def number(column: Column) -> Column:
        return F.floor(column / 10).cast("bigint")

    return rows.select(
        number(k).alias("pl_rsnum"),
        (k % 10 + 1).alias("pl_rspos"),
        F.when(ends, F.lit(0).cast("bigint")).otherwise(number(F.col("t"))).alias("pl_rsnum_new"),
        F.when(ends, F.lit(0).cast("bigint")).otherwise(F.col("t") % 10 + 1).alias("pl_rspos_new"),
        F.to_date("o_orderdate").alias("pl_udate"),
        F.concat(F.lpad((k % 24).cast("string"), 2, "0"), F.lit(":00:00")).alias("pl_utime"),
        F.concat(F.lit("L"), F.floor(F.year("o_orderdate") / 3).cast("string")).alias("load_id"),
    )


# Open-data registers. INN is the customer key as text; some OGRN are held by two firms.
SQL["meta"] = """
  SELECT 'G' || CASE WHEN c_custkey % 11 = 0 THEN c_custkey // 2 ELSE c_custkey END AS ogrn,
    CAST(c_custkey AS VARCHAR) AS inn, c_nationkey AS region_code,
    (10 + c_nationkey) || '.' || left(c_mktsegment, 1) AS okvad_code, c_mktsegment AS okvad_name, 2014 AS okvad_vers
  FROM customer"""


def meta(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("c_custkey")
    number = F.when(key % 11 == 0, F.floor(key / 2).cast("bigint")).otherwise(key)
    code = F.concat((F.col("c_nationkey") + 10).cast("string"), F.lit("."), F.left("c_mktsegment", F.lit(1)))
    return table(spark, sf, "customer").select(
        F.concat(F.lit("G"), number.cast("string")).alias("ogrn"),
        _text("c_custkey").alias("inn"),
        F.col("c_nationkey").alias("region_code"),
        code.alias("okvad_code"),
        F.col("c_mktsegment").alias("okvad_name"),
        F.lit(2014).alias("okvad_vers"),
    )


SQL["small"] = """
  SELECT CAST(s_suppkey AS VARCHAR) AS inn, s_nationkey AS region_code,
    CASE WHEN s_suppkey % 2 = 0 THEN 'area' ELSE 'land' END AS region_type, n_name AS region_name,
    (10 + s_nationkey) || '.' || left(n_name, 1) AS okvad_code, n_name AS okvad_name, 2001 AS okvad_vers
  FROM supplier JOIN nation ON s_nationkey = n_nationkey"""


def small(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "supplier").join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    return rows.select(
        _text("s_suppkey").alias("inn"),
        F.col("s_nationkey").alias("region_code"),
        F.when(F.col("s_suppkey") % 2 == 0, "area").otherwise("land").alias("region_type"),
        F.col("n_name").alias("region_name"),
        F.concat((F.col("s_nationkey") + 10).cast("string"), F.lit("."), F.left("n_name", F.lit(1))).alias("okvad_code"),
        F.col("n_name").alias("okvad_name"),
        F.lit(2001).alias("okvad_vers"),
    )


PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]

SQL["names"] = " UNION ".join(
    [
        "SELECT c_name AS name_org, CAST(c_custkey AS VARCHAR) AS inn FROM customer",
        "SELECT upper(c_name) AS name_org, CAST(c_custkey AS VARCHAR) AS inn FROM customer",
        "SELECT s_name AS name_org, CAST(s_suppkey AS VARCHAR) AS inn FROM supplier",
        *[
            f"SELECT 'Client ' || o_orderstatus AS name_org, CAST(o_custkey AS VARCHAR) AS inn FROM orders WHERE o_orderpriority = '{p}'"
            for p in PRIORITIES
        ],
    ]
)


def name_sources(spark: SparkSession, sf: str) -> list[DataFrame]:
    customer, supplier, orders = (table(spark, sf, t) for t in ("customer", "supplier", "orders"))
    client = F.concat(F.lit("Client "), "o_orderstatus").alias("name_org")
    return [
        customer.select(F.col("c_name").alias("name_org"), _text("c_custkey").alias("inn")),
        customer.select(F.upper("c_name").alias("name_org"), _text("c_custkey").alias("inn")),
        supplier.select(F.col("s_name").alias("name_org"), _text("s_suppkey").alias("inn")),
        *[orders.where(F.col("o_orderpriority") == p).select(client, _text("o_custkey").alias("inn")) for p in PRIORITIES],
    ]


# Fact tables of the open data: several rows for an organisation in most of them.
SQL["paid_regimes"] = "SELECT CAST(s_suppkey * 2 AS VARCHAR) AS inn FROM supplier"
SQL["special_regimes"] = "SELECT CAST(o_custkey AS VARCHAR) AS inn FROM orders WHERE o_orderpriority = '5-LOW'"
SQL["income"] = """
  SELECT CAST(o_custkey AS VARCHAR) AS inn, CAST(o_totalprice AS DECIMAL(18,2)) AS income_75,
    CASE WHEN o_orderstatus <> 'P' THEN CAST(o_totalprice AS DECIMAL(18,2)) END AS expenses_75
  FROM orders WHERE o_orderpriority = '1-URGENT'"""
SQL["fines"] = """
  SELECT CAST(o_custkey AS VARCHAR) AS inn, CAST(o_totalprice AS DECIMAL(18,2)) AS fine_78
  FROM orders WHERE o_orderpriority = '2-HIGH'"""
SQL["staff"] = "SELECT CAST(c_custkey AS VARCHAR) AS inn, c_custkey % 500 AS employees_85 FROM customer WHERE c_acctbal > 0"
SQL["paid_taxes"] = """
  SELECT CAST(o_custkey AS VARCHAR) AS inn, o_orderpriority AS tax_name, CAST(o_totalprice AS DECIMAL(18,2)) AS sum_nal
  FROM orders WHERE o_orderstatus = 'P'"""
SQL["arrears"] = """
  SELECT CAST(o_custkey AS VARCHAR) AS inn, CASE WHEN o_orderpriority <> '1-URGENT' THEN CAST(o_totalprice AS DECIMAL(18,2)) END AS nedo_nal,
    CAST(o_orderkey % 100 AS DECIMAL(18,2)) AS peni, CAST(o_orderkey % 10 AS DECIMAL(18,2)) AS shtraf,
    CAST(o_totalprice AS DECIMAL(18,2)) AS sum_nedo
  FROM orders WHERE o_orderstatus = 'F'"""
SQL["org_dim"] = "SELECT c_custkey + 1 AS \"KEY\", CAST(c_custkey AS VARCHAR) AS inn FROM customer"
SQL["region_dim"] = """
  SELECT n_nationkey + 100 AS "KEY", CAST(n_nationkey AS VARCHAR) AS name FROM nation
  UNION ALL SELECT r_regionkey + 900, r_name FROM region"""
SQL["industry_dim"] = """
  SELECT CAST(n_nationkey AS BIGINT) * 100 + ascii(seg) AS "KEY", (10 + n_nationkey) || '.' || seg AS code
  FROM nation JOIN (SELECT DISTINCT c_nationkey, left(c_mktsegment, 1) AS seg FROM customer) ON n_nationkey = c_nationkey"""
SQL["tax_dim"] = "SELECT DISTINCT CAST(left(o_orderpriority, 1) AS INTEGER) AS \"KEY\", o_orderpriority AS name FROM orders"


def open_data(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    customer, supplier, orders, nation, region = (
        table(spark, sf, t) for t in ("customer", "supplier", "orders", "nation", "region")
    )
    inn = _text("o_custkey").alias("inn")
    price = money(F.col("o_totalprice"))
    initial = F.left("c_mktsegment", F.lit(1)).alias("seg")
    segments = customer.select(F.col("c_nationkey").alias("n_nationkey"), initial).distinct()
    codes = nation.join(segments, "n_nationkey")
    return {
        "paid_regimes": supplier.select((F.col("s_suppkey") * 2).cast("string").alias("inn")),
        "special_regimes": orders.where(F.col("o_orderpriority") == "5-LOW").select(inn),
        "income": orders.where(F.col("o_orderpriority") == "1-URGENT").select(
            inn,
            price.alias("income_75"),
            F.when(F.col("o_orderstatus") != "P", price).alias("expenses_75"),
        ),
        "fines": orders.where(F.col("o_orderpriority") == "2-HIGH").select(inn, price.alias("fine_78")),
        "staff": customer.where(F.col("c_acctbal") > 0).select(
            _text("c_custkey").alias("inn"), (F.col("c_custkey") % 500).alias("employees_85")
        ),
        "paid_taxes": orders.where(F.col("o_orderstatus") == "P").select(
            inn, F.col("o_orderpriority").alias("tax_name"), price.alias("sum_nal")
        ),
        "arrears": orders.where(F.col("o_orderstatus") == "F").select(
            inn,
            F.when(F.col("o_orderpriority") != "1-URGENT", price).alias("nedo_nal"),
            money(F.col("o_orderkey") % 100).alias("peni"),
            money(F.col("o_orderkey") % 10).alias("shtraf"),
            price.alias("sum_nedo"),
        ),
        "org_dim": customer.select((F.col("c_custkey") + 1).alias("KEY"), _text("c_custkey").alias("inn")),
        "region_dim": nation.select((F.col("n_nationkey") + 100).alias("KEY"), _text("n_nationkey").alias("name")).unionAll(
            region.select((F.col("r_regionkey") + 900).alias("KEY"), F.col("r_name").alias("name"))
        ),
        "industry_dim": codes.select(
            (F.col("n_nationkey").cast("bigint") * 100 + F.ascii("seg")).alias("KEY"),
            F.concat((F.col("n_nationkey") + 10).cast("string"), F.lit("."), "seg").alias("code"),
        ),
        "tax_dim": orders.select(
            F.left("o_orderpriority", F.lit(1)).cast("int").alias("KEY"), F.col("o_orderpriority").alias("name")
        ).distinct(),
    }


# Snapshot landing table: loads by year of the order, a third of the rows in one snapshot, some without one.
_SNAPSHOT_SQL = {
    "source_snap_id": "CASE WHEN o_orderkey % 50 = 0 THEN NULL WHEN o_orderkey % 50 = 1 THEN '' WHEN o_custkey % 3 = 0 THEN 'S0' ELSE 'S' || (o_custkey % 97) END",
    "source_author_name": "CASE WHEN o_orderkey % 60 <> 7 THEN 'author ' || (o_custkey % 5) END",
    "source_crea_date_time": "o_orderdate",
    "source_snap_type": "o_orderstatus",
    "werks": "'W' || (o_custkey % 3)",
    "start_month": "strftime(o_orderdate, '%Y-%m')",
    "aufnr": "CAST(o_orderkey AS VARCHAR)",
    "load_id": "'L' || year(o_orderdate)",
}
SQL["landing"] = "SELECT " + ", ".join(
    f"{_SNAPSHOT_SQL.get(c, repr(c + ' ') + ' || o_orderpriority')} AS {c}" for c in SNAPSHOT_COLUMNS
) + " FROM orders"


def landing(spark: SparkSession, sf: str) -> DataFrame:
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    bucket = F.concat(F.lit("S"), (cust % 97).cast("string"))
    special = {
        "source_snap_id": F.when(key % 50 == 0, None).when(key % 50 == 1, "").when(cust % 3 == 0, "S0").otherwise(bucket),
        "source_author_name": F.when(key % 60 != 7, F.concat(F.lit("author "), (cust % 5).cast("string"))),
        "source_crea_date_time": F.col("o_orderdate"),
        "source_snap_type": F.col("o_orderstatus"),
        "werks": _plant("o_custkey"),
        "start_month": F.date_format("o_orderdate", "yyyy-MM"),
        "aufnr": _text("o_orderkey"),
        "load_id": F.concat(F.lit("L"), F.year("o_orderdate").cast("string")),
    }
    return table(spark, sf, "orders").select(
        *[special.get(c, F.concat(F.lit(c + " "), "o_orderpriority")).alias(c) for c in SNAPSHOT_COLUMNS]
    )


# Journal of the snapshot flow: one N event per load at its last order date; the loads before 1998 are done.
SQL["snap_journal"] = """
  SELECT 'INT_10' AS flow_id, 'ODSP' AS target_lvl, 'L' || year(o_orderdate) AS load_id, 'N' AS stg_status,
    CAST(NULL AS BIGINT) AS row_count, max(o_orderdate) AS crea_datetime
  FROM orders GROUP BY 3
  UNION ALL
  SELECT 'INT_10', 'ODSP', 'L' || year(o_orderdate), 'S', count(*), max(o_orderdate) + INTERVAL 1 DAY
  FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01' GROUP BY 3"""


def snap_journal(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    load = F.concat(F.lit("L"), F.year("o_orderdate").cast("string")).alias("load_id")
    names = [F.lit("INT_10").alias("flow_id"), F.lit("ODSP").alias("target_lvl"), "load_id"]
    stamp = F.max("o_orderdate").cast("timestamp")
    new = orders.groupBy(load).agg(stamp.alias("crea_datetime"))
    new = new.select(*names, F.lit("N").alias("stg_status"), F.lit(None).cast("bigint").alias("row_count"), "crea_datetime")
    done = orders.where(F.col("o_orderdate") < "1998-01-01").groupBy(load).agg(
        F.count("*").alias("row_count"), (stamp + F.expr("INTERVAL 1 DAY")).alias("crea_datetime")
    )
    return new.unionAll(done.select(*names, F.lit("S").alias("stg_status"), "row_count", "crea_datetime"))


# Journal of nine flows, one event row each.
SQL["flow_journal"] = """
  SELECT 'INT_' || lpad(CAST(1 + user_id % 9 AS VARCHAR), 2, '0') AS flow_id,
    CASE WHEN event_id % 2 = 0 THEN 'EDW' ELSE 'ODSP' END AS target_lvl, 'E' || (event_id // 3) AS load_id,
    CASE event_type WHEN 'error' THEN 'I' WHEN 'signup' THEN 'N' ELSE 'S' END AS stg_status, event_id AS row_count,
    ts AS crea_datetime
  FROM events"""


def flow_journal(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("event_type")
    return table(spark, sf, "events").select(
        F.concat(F.lit("INT_"), F.lpad((F.col("user_id") % 9 + 1).cast("string"), 2, "0")).alias("flow_id"),
        F.when(F.col("event_id") % 2 == 0, "EDW").otherwise("ODSP").alias("target_lvl"),
        F.concat(F.lit("E"), F.floor(F.col("event_id") / 3).cast("string")).alias("load_id"),
        F.when(kind == "error", "I").when(kind == "signup", "N").otherwise("S").alias("stg_status"),
        F.col("event_id").alias("row_count"),
        F.col("ts").cast("timestamp").alias("crea_datetime"),
    )


# Journal of a watermark load: one row per day of events up to the middle of January.
SQL["delta_journal"] = """
  SELECT row_number() OVER (ORDER BY CAST(ts AS DATE)) AS id, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS start_ts,
    CAST(CAST(ts AS DATE) + 1 AS TIMESTAMP) AS end_ts, count(*) AS row_count
  FROM events WHERE ts < TIMESTAMP '2024-01-16' GROUP BY CAST(ts AS DATE)"""


def delta_journal(spark: SparkSession, sf: str) -> DataFrame:
    day = F.to_date("ts").alias("day")
    days = table(spark, sf, "events").where(F.col("ts") < "2024-01-16").groupBy(day).agg(F.count("*").alias("row_count"))
    return days.select(
        F.datediff("day", F.lit("2023-12-31")).cast("bigint").alias("id"),
        F.col("day").cast("timestamp").alias("start_ts"),
        F.date_add("day", 1).cast("timestamp").alias("end_ts"),
        "row_count",
    )

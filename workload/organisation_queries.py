"""Organisation dimensions, maps and facts, and the operators they are made of."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from granary.functions.numbers import number_or_null
from granary.operators.joins import left_join_many
from granary.operators.rows import any_present, distinct_union, numbered, one_row_per_key
from granary.plans import organisations as plan
from workload import fixtures as fx
from workload.registry import query

fx.SQL["named_orgs"] = """
  SELECT *, row_number() OVER (ORDER BY ogrn, inn, name_org NULLS FIRST) AS row_num FROM (
    SELECT DISTINCT ogrn, inn, name_org FROM (SELECT DISTINCT ogrn, inn FROM fx_meta) LEFT JOIN (SELECT * FROM fx_names) USING (inn))"""
_REGION_NAMES = "(SELECT DISTINCT region_code, region_type, region_name FROM fx_small)"
fx.SQL["org_regions"] = f"""
  SELECT *, row_number() OVER (ORDER BY inn, region_code, region_type NULLS FIRST, region_name NULLS FIRST) AS row_num FROM (
    SELECT inn, region_code, region_type, region_name
    FROM (SELECT inn, region_code FROM fx_small UNION SELECT inn, region_code FROM fx_meta) LEFT JOIN {_REGION_NAMES} USING (region_code))"""
fx.SQL["region_map"] = "SELECT * FROM fx_org_regions QUALIFY row_number() OVER (PARTITION BY inn ORDER BY row_num DESC) = 1"
fx.SQL["industry_map"] = "SELECT inn, max(okvad_code) AS okvad FROM fx_meta GROUP BY 1"
_PLACES = """
  LEFT JOIN fx_region_map rm USING (inn) LEFT JOIN fx_industry_map im USING (inn)
  LEFT JOIN fx_region_dim rd ON TRY_CAST(rd.name AS INTEGER) = rm.region_code
  LEFT JOIN fx_industry_dim idm ON idm.code = im.okvad"""


@query("B16 U2 J11 J17 M11 W4", "SELECT * FROM fx_named_orgs QUALIFY row_number() OVER (PARTITION BY ogrn ORDER BY row_num) = 1")
def organisation_dimension(spark, sf):
    return plan.organisations(fx.meta(spark, sf), fx.name_sources(spark, sf))


@query("U2 A6", "SELECT name_org, inn FROM fx_names")
def distinct_union_of_eight(spark, sf):
    return plan.organisation_names(fx.name_sources(spark, sf))


@query("B17 U1 F18 W4", """
  SELECT *, row_number() OVER (ORDER BY okvad_code, okvad_name, okvad_vers) AS row_num FROM (
    SELECT okvad_code, okvad_name, CAST(okvad_vers AS VARCHAR) AS okvad_vers FROM fx_meta
    UNION SELECT okvad_code, okvad_name, CAST(okvad_vers AS VARCHAR) FROM fx_small)""")
def industry_dimension(spark, sf):
    return plan.industries(fx.meta(spark, sf), fx.small(spark, sf))


@query("B18 J11 J17 M11", f"""
  SELECT * FROM (
    SELECT *, row_number() OVER (ORDER BY region_code, region_type NULLS FIRST, region_name NULLS FIRST) AS row_num FROM (
      SELECT region_code, region_type, region_name
      FROM (SELECT region_code FROM fx_small UNION SELECT region_code FROM fx_meta) LEFT JOIN {_REGION_NAMES} USING (region_code)))
  QUALIFY row_number() OVER (PARTITION BY region_code ORDER BY row_num DESC) = 1""")
def region_dimension(spark, sf):
    return plan.regions(fx.meta(spark, sf), fx.small(spark, sf))


@query("B19 J11 J17", "SELECT * FROM fx_region_map")
def region_by_organisation(spark, sf):
    return plan.region_by_organisation(fx.meta(spark, sf), fx.small(spark, sf))


@query("B19 J17", "SELECT * FROM fx_industry_map")
def industry_by_organisation(spark, sf):
    return plan.industry_by_organisation(fx.meta(spark, sf))


@query("B20 J8 J9 P10", f"""
  SELECT o."KEY" AS ogrn_id, rd."KEY" AS region_id, idm."KEY" AS okvad_id, CAST(income_75 AS DOUBLE) AS income_75,
    CAST(expenses_75 AS DOUBLE) AS expenses_75, CAST(fine_78 AS DOUBLE) AS fine_78, employees_85
  FROM fx_org_dim o LEFT JOIN fx_paid_regimes USING (inn) LEFT JOIN fx_special_regimes USING (inn) LEFT JOIN fx_income USING (inn)
  LEFT JOIN fx_fines USING (inn) LEFT JOIN fx_staff USING (inn) {_PLACES}
  WHERE coalesce(income_75, expenses_75, fine_78) IS NOT NULL OR employees_85 IS NOT NULL""")
def company_facts(spark, sf):
    data, meta = fx.open_data(spark, sf), fx.meta(spark, sf)
    return plan.company_facts(
        data["org_dim"], data["paid_regimes"], data["special_regimes"], data["income"], data["fines"], data["staff"],
        plan.region_by_organisation(meta, fx.small(spark, sf)), plan.industry_by_organisation(meta),
        data["region_dim"], data["industry_dim"],
    )


@query("B21 J8 J9 P10", f"""
  SELECT rd."KEY" AS region_id, o."KEY" AS ogrn_id, td."KEY" AS nalog_id, idm."KEY" AS okvad_id,
    CAST(sum_nal AS DOUBLE) AS sum_nal, CAST(nedo_nal AS DOUBLE) AS nedo_nal, CAST(peni AS DOUBLE) AS peni,
    CAST(shtraf AS DOUBLE) AS shtraf, CAST(sum_nedo AS DOUBLE) AS sum_nedo
  FROM fx_org_dim o LEFT JOIN fx_paid_taxes pt USING (inn) LEFT JOIN fx_arrears USING (inn) {_PLACES}
  LEFT JOIN fx_tax_dim td ON td.name = pt.tax_name
  WHERE coalesce(sum_nal, nedo_nal, peni, shtraf, sum_nedo) IS NOT NULL""")
def tax_facts(spark, sf):
    data, meta = fx.open_data(spark, sf), fx.meta(spark, sf)
    return plan.tax_facts(
        data["org_dim"], data["paid_taxes"], data["arrears"], plan.region_by_organisation(meta, fx.small(spark, sf)),
        plan.industry_by_organisation(meta), data["region_dim"], data["industry_dim"], data["tax_dim"],
    )


@query("B22 P1 P2", """
  SELECT p_type AS otrasl, p_brand AS country, p_retailprice AS "investingSum", p_retailprice AS investing2021,
    p_size AS investing2022, p_retailprice AS "restInvesting", p_partkey AS num, CAST(1 AS INTEGER) AS sluzhb FROM part""")
def investment_projection(spark, sf):
    source = {
        "Отрасль": "p_type", "Страна": "p_brand", "ОбщиеИнвестиции": "p_retailprice", "ВложенныеИнвестицииДо2021": "p_retailprice",
        "ЗапланированныеВ2022Инвестиции": "p_size", "ОстатокИнвестиций": "p_retailprice", "Номер": "p_partkey",
    }
    part = fx.table(spark, sf, "part")
    return plan.investments(part.select(*[F.col(c).alias(n) for n, c in source.items()]))


@query("J8", """
  SELECT c_custkey, o_orderkey, l_linenumber, n_name, r_name FROM customer LEFT JOIN orders ON o_custkey = c_custkey
  LEFT JOIN lineitem ON l_orderkey = o_orderkey LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = n_regionkey""")
def snowflake_of_left_joins(spark, sf):
    customer, orders, lineitem, nation, region = (fx.table(spark, sf, t) for t in ("customer", "orders", "lineitem", "nation", "region"))
    rows = left_join_many(customer.select("c_custkey", "c_nationkey"), orders.select(F.col("o_custkey").alias("c_custkey"), "o_orderkey"), ["c_custkey"])
    rows = left_join_many(rows, lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber"), ["o_orderkey"])
    rows = rows.join(nation, rows.c_nationkey == nation.n_nationkey, "left").join(region, nation.n_regionkey == region.r_regionkey, "left")
    return rows.select("c_custkey", "o_orderkey", "l_linenumber", "n_name", "r_name")


@query("J9 F20", """
  SELECT c_custkey, d."KEY" AS region_id FROM customer LEFT JOIN fx_region_dim d ON TRY_CAST(d.name AS INTEGER) = c_nationkey""")
def join_on_a_cast(spark, sf):
    regions = fx.open_data(spark, sf)["region_dim"].select(F.col("KEY").alias("region_id"), number_or_null(F.col("name")).alias("c_nationkey"))
    return fx.table(spark, sf, "customer").join(regions, "c_nationkey", "left").select("c_custkey", "region_id")


@query("J11", """
  SELECT region_code, region_type, region_name FROM (SELECT DISTINCT region_code FROM fx_meta)
  LEFT JOIN (SELECT DISTINCT region_code, region_type, region_name FROM fx_small) USING (region_code)""")
def left_join_of_two_selects(spark, sf):
    codes = fx.meta(spark, sf).select("region_code").distinct()
    return codes.join(fx.small(spark, sf).select("region_code", "region_type", "region_name").distinct(), "region_code", "left")


@query("J17 M11 (first kept)", """
  SELECT o_custkey, o_orderkey, o_orderstatus FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) = 1""")
def first_row_per_key(spark, sf):
    return one_row_per_key(fx.table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderstatus"), ["o_custkey"], ["o_orderkey"])


@query("J17 M11 (last kept, NULL keys all kept)", """
  SELECT snap, o_orderkey FROM (SELECT source_snap_id AS snap, CAST(aufnr AS BIGINT) AS o_orderkey FROM fx_landing)
  QUALIFY snap IS NULL OR row_number() OVER (PARTITION BY snap ORDER BY o_orderkey DESC) = 1""")
def last_row_per_key(spark, sf):
    rows = fx.landing(spark, sf).select(F.col("source_snap_id").alias("snap"), F.col("aufnr").cast("bigint").alias("o_orderkey"))
    return one_row_per_key(rows, ["snap"], ["o_orderkey"], keep="last")


@query("W4", "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS row_num FROM orders")
def surrogate_numbers(spark, sf):
    return numbered(fx.table(spark, sf, "orders").select("o_orderdate", "o_orderkey"), ["o_orderdate", "o_orderkey"], "row_num").drop("o_orderdate")


@query("P10", """
  SELECT inn, CAST(nedo_nal AS DOUBLE) AS nedo_nal, CAST(peni AS DOUBLE) AS peni FROM fx_arrears WHERE nedo_nal IS NOT NULL OR nullif(peni, 0) IS NOT NULL""")
def any_measure_present(spark, sf):
    rows = fx.open_data(spark, sf)["arrears"]
    return rows.where(any_present(F.col("nedo_nal"), F.nullif(F.col("peni"), F.lit(0)))).select("inn", "nedo_nal", "peni")


@query("U1 A6 (several tables)", """
  SELECT c_nationkey AS nation FROM customer UNION SELECT s_nationkey FROM supplier UNION SELECT n_nationkey FROM nation""")
def distinct_union_of_tables(spark, sf):
    named = [("customer", "c_nationkey"), ("supplier", "s_nationkey"), ("nation", "n_nationkey")]
    return reduce(distinct_union, [fx.table(spark, sf, t).select(F.col(c).alias("nation")) for t, c in named])


@query("J3", """
  SELECT o_orderkey, o_custkey, orders AS customer_orders FROM orders JOIN (SELECT o_custkey, count(*) AS orders FROM orders GROUP BY 1) USING (o_custkey)""")
def join_to_aggregated_map(spark, sf):
    orders = fx.table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    sizes = orders.groupBy("o_custkey").agg(F.count("*").alias("customer_orders"))
    return orders.join(sizes, "o_custkey")

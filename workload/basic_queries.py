"""Predicates, aggregates, scalar functions, sorts and limits on whole tables."""

from __future__ import annotations



from pyspark.sql import functions as F

from granary.functions.dates import dotted_date, formatted, month_start, timestamp_or_null, trailing_months
from granary.functions.numbers import number_or_null, whole
from granary.functions.text import blank_if, joined, joined_present, renamed_phrases
from granary.plans import headcount
from workload import fixtures as fx
from workload.registry import query

AS_OF = fx.AS_OF


def _orders(spark, sf):
    return fx.table(spark, sf, "orders")


@query("P1 P2", "SELECT o_orderkey AS id, o_orderstatus AS state, CAST(1 AS INTEGER) AS service, false AS flag FROM orders")
def renamed_with_constants(spark, sf):
    return _orders(spark, sf).select(
        F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("state"), F.lit(1).alias("service"), F.lit(False).alias("flag")
    )


@query("P3", "SELECT o_orderkey, o_orderstatus, o_orderkey * 2 AS doubled FROM orders")
def computed_column_added(spark, sf):
    return _orders(spark, sf).select("o_orderkey", "o_orderstatus").withColumn("doubled", F.col("o_orderkey") * 2)


@query("P4", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity > 10 AND l_discount > 0.05")
def both_positive(spark, sf):
    rows = fx.table(spark, sf, "lineitem").where((F.col("l_quantity") > 10) & (F.col("l_discount") > 0.05))
    return rows.select("l_orderkey", "l_linenumber", "l_quantity")


@query("P11", "SELECT p_partkey, p_name FROM part WHERE p_name LIKE '%ring' OR p_name NOT LIKE '%o%'")
def pattern_tests(spark, sf):
    name = F.col("p_name")
    return fx.table(spark, sf, "part").where(name.like("%ring") | ~name.like("%o%")).select("p_partkey", "p_name")


@query("P12", "SELECT wm_lgort, wm_oblast_ppm FROM fx_warehouses WHERE wm_oblast_ppm <> ''")
def not_empty(spark, sf):
    return fx.warehouses(spark, sf).where(F.col("wm_oblast_ppm") != "").select("wm_lgort", "wm_oblast_ppm")


@query("P15", """
  SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'open' WHEN 'F' THEN 'filled' END AS state FROM orders""")
def simple_case(spark, sf):
    status = F.col("o_orderstatus")
    return _orders(spark, sf).select("o_orderkey", F.when(status == "O", "open").when(status == "F", "filled").alias("state"))


@query("A8", "SELECT count(*) AS n FROM lineitem")
def global_count(spark, sf):
    return fx.table(spark, sf, "lineitem").agg(F.count("*").alias("n"))


@query("A9", "SELECT coalesce(max(o_orderkey) + 1, 1) AS next_key FROM orders")
def global_maximum(spark, sf):
    return _orders(spark, sf).agg(F.coalesce(F.max("o_orderkey") + 1, F.lit(1)).alias("next_key"))


@query("A10", "SELECT l_returnflag, count(CASE WHEN l_discount > 0.05 THEN 1 END) AS discounted FROM lineitem GROUP BY 1")
def conditional_count(spark, sf):
    return fx.table(spark, sf, "lineitem").groupBy("l_returnflag").agg(F.count(F.when(F.col("l_discount") > 0.05, 1)).alias("discounted"))


@query("A12 B24", """
  SELECT CAST(ts AS DATE) AS date, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS value_total, count(*) FILTER (event_type = 'signup') AS value_in,
    count(*) FILTER (event_type = 'error') AS value_out FROM events GROUP BY 1 ORDER BY 1""")
def daily_totals_report(spark, sf):
    kind = F.col("event_type")
    rows = fx.table(spark, sf, "events").select(
        F.to_date("ts").alias("date"), fx.money(F.col("value")).alias("value_total"),
        F.when(kind == "signup", 1).otherwise(0).alias("value_in"), F.when(kind == "error", 1).otherwise(0).alias("value_out"),
    )
    return headcount.daily_totals(rows)


@query("A7", "SELECT DISTINCT o_orderpriority FROM orders")
def distinct_scalar(spark, sf):
    return _orders(spark, sf).select("o_orderpriority").distinct()


@query("A1", "SELECT o_custkey, CAST(coalesce(sum(CASE WHEN o_orderstatus = 'P' THEN CAST(o_totalprice AS DECIMAL(18,2)) END), 0) AS DOUBLE) AS price FROM orders GROUP BY 1")
def sum_or_zero(spark, sf):
    price = F.when(F.col("o_orderstatus") == "P", fx.money(F.col("o_totalprice")))
    return _orders(spark, sf).groupBy("o_custkey").agg(F.coalesce(F.sum(price), F.lit(0)).alias("price"))


@query("F1", "SELECT st_matnr, count(*) AS n, coalesce(st_o_divis, '') AS divis FROM fx_stock GROUP BY ALL")
def first_not_null(spark, sf):
    return fx.stock(spark, sf).groupBy("st_matnr", F.coalesce("st_o_divis", F.lit("")).alias("divis")).agg(F.count("*").alias("n"))


@query("F2", """
  SELECT pl_rsnum, pl_rspos, least(pl_rsnum, nullif(pl_rsnum_new, 0)) AS low, greatest(pl_rsnum, nullif(pl_rsnum_new, 0)) AS high FROM fx_log""")
def least_and_greatest(spark, sf):
    target = F.nullif(F.col("pl_rsnum_new"), F.lit(0))
    return fx.log(spark, sf).select("pl_rsnum", "pl_rspos", F.least("pl_rsnum", target).alias("low"), F.greatest("pl_rsnum", target).alias("high"))


@query("F4", "SELECT event_id, CAST(date_trunc('month', ts) AS DATE) AS month, CAST(ts AS DATE) AS day FROM events")
def month_and_day_of_stamp(spark, sf):
    return fx.table(spark, sf, "events").select("event_id", month_start("ts").alias("month"), F.to_date("ts").alias("day"))


@query("F5", "SELECT l_orderkey, l_linenumber, CAST(date_part('year', l_shipdate) AS INTEGER) AS y, CAST(date_part('month', l_shipdate) AS INTEGER) AS m FROM lineitem")
def date_parts(spark, sf):
    return fx.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.year("l_shipdate").alias("y"), F.month("l_shipdate").alias("m"))


@query("F6", """
  SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) + INTERVAL 1 MONTH AS DATE) AS next_month, CAST(CAST(o_orderdate AS DATE) - INTERVAL 12 MONTH AS DATE) AS year_ago,
    strftime(o_orderdate + INTERVAL 18 HOUR, '%Y-%m-%d %H:%M') AS evening FROM orders""")
def interval_arithmetic(spark, sf):
    day = F.to_date("o_orderdate")
    evening = F.col("o_orderdate") + F.expr("INTERVAL 18 HOURS")
    return _orders(spark, sf).select(
        "o_orderkey", F.add_months(day, 1).alias("next_month"), F.add_months(day, -12).alias("year_ago"),
        F.date_format(evening, "yyyy-MM-dd HH:mm").alias("evening"),
    )


@query("F7 B7", f"""
  SELECT m, count(*) AS orders FROM (SELECT CAST(DATE '{AS_OF}' - to_months(CAST(i AS INTEGER)) AS DATE) AS m FROM range(12) t(i))
  JOIN orders ON date_trunc('month', o_orderdate) = m GROUP BY 1""")
def twelve_month_list(spark, sf):
    month = month_start("o_orderdate")
    rows = _orders(spark, sf).where(month.isin(*[F.lit(m) for m in trailing_months(AS_OF)]))
    return rows.groupBy(month.alias("m")).agg(F.count("*").alias("orders"))


@query("F8", "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders")
def dotted_dates_parsed(spark, sf):
    return _orders(spark, sf).select("o_orderkey", dotted_date(F.date_format("o_orderdate", "dd.MM.yyyy")).alias("day"))


@query("F9", """
  SELECT event_id, CASE WHEN event_type <> 'error' THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS stamp FROM events""")
def stamps_parsed_or_null(spark, sf):
    written = F.when(F.col("event_type") == "error", "no stamp").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    stamp = F.date_format(timestamp_or_null(written), "yyyy-MM-dd HH:mm:ss")
    return fx.table(spark, sf, "events").select("event_id", stamp.alias("stamp"))


@query("F11", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS iso, strftime(o_orderdate, '%Y-%d-%m %H:%M:%S') AS swapped FROM orders")
def formatted_dates(spark, sf):
    stamp = F.col("o_orderdate")
    return _orders(spark, sf).select("o_orderkey", formatted(stamp).alias("iso"), formatted(stamp, "yyyy-dd-MM HH:mm:ss").alias("swapped"))


@query("F12", "SELECT conv_id, turn, length(trim(text, ' ')) AS size FROM conversations")
def trimmed_texts(spark, sf):
    return fx.table(spark, sf, "conversations").select("conv_id", "turn", F.length(F.trim("text")).cast("bigint").alias("size"))


@query("F13", "SELECT doc_id, len(string_split(text, ';')) AS cells, string_split(text, ';')[1] AS first_cell FROM documents")
def texts_split(spark, sf):
    cells = F.split("text", ";")
    return fx.table(spark, sf, "documents").select("doc_id", F.size(cells).cast("bigint").alias("cells"), F.get(cells, F.lit(0)).alias("first_cell"))


@query("F14", "SELECT page_id, left(url, 12) AS start FROM pages")
def left_part(spark, sf):
    return fx.table(spark, sf, "pages").select("page_id", F.left("url", F.lit(12)).alias("start"))


@query("F15", "SELECT page_id, position('title' IN html) AS place FROM pages")
def position_of_text(spark, sf):
    return fx.table(spark, sf, "pages").select("page_id", F.position(F.lit("title"), F.col("html")).cast("bigint").alias("place"))


@query("F16", """
  SELECT pt_rsnum, pt_rspos, pt_lgort, pt_pp_aufnr || '/' || pt_zvd AS strict, concat(pt_pp_aufnr, '/', pt_zvd) AS lenient FROM fx_demand""")
def joined_texts(spark, sf):
    order, kind = F.col("pt_pp_aufnr"), F.col("pt_zvd")
    slash = F.lit("/")
    return fx.demand(spark, sf).select("pt_rsnum", "pt_rspos", "pt_lgort", joined(order, slash, kind).alias("strict"), joined_present(order, slash, kind).alias("lenient"))


@query("F17", "SELECT c_custkey, replace(replace(c_mktsegment, 'AUTOMOBILE', 'CAR'), 'MACHINERY', 'TOOL') AS segment FROM customer")
def phrases_renamed(spark, sf):
    names = {"AUTOMOBILE": "CAR", "MACHINERY": "TOOL"}
    return fx.table(spark, sf, "customer").select("c_custkey", renamed_phrases(F.col("c_mktsegment"), names).alias("segment"))


@query("F18", """
  SELECT o_orderkey, CAST(left(o_orderpriority, 1) AS INTEGER) AS rank, CAST(left(o_orderpriority, 1) AS SMALLINT) AS small_rank, CAST(o_orderkey AS VARCHAR) AS key FROM orders""")
def casts(spark, sf):
    first = F.left("o_orderpriority", F.lit(1))
    return _orders(spark, sf).select("o_orderkey", first.cast("int").alias("rank"), first.cast("smallint").alias("small_rank"), F.col("o_orderkey").cast("string").alias("key"))


@query("F19", "SELECT l_orderkey, l_linenumber, CAST(round(CAST(l_quantity / 2 AS DECIMAL(18,2)), 0) AS INTEGER) AS half FROM lineitem")
def rounded_to_int(spark, sf):
    half = whole(fx.money(F.col("l_quantity") / 2))
    return fx.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", half.alias("half"))


@query("F20 X1", "SELECT c_custkey, TRY_CAST(CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment ELSE CAST(c_custkey AS VARCHAR) END AS INTEGER) AS number FROM customer")
def number_or_missing(spark, sf):
    mixed = F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment")).otherwise(F.col("c_custkey").cast("string"))
    return fx.table(spark, sf, "customer").select("c_custkey", number_or_null(mixed).alias("number"))


@query("F21", "SELECT c_custkey, CASE WHEN c_mktsegment IN ('BUILDING', 'FURNITURE') THEN '' ELSE c_mktsegment END AS segment FROM customer")
def constants_blanked(spark, sf):
    return fx.table(spark, sf, "customer").select("c_custkey", blank_if(F.col("c_mktsegment"), ["BUILDING", "FURNITURE"]).alias("segment"))


@query("O1", "SELECT o_orderkey, o_orderdate::DATE AS day FROM orders ORDER BY o_orderdate, o_orderkey")
def ordered_scan(spark, sf):
    return _orders(spark, sf).orderBy("o_orderdate", "o_orderkey").select("o_orderkey", F.to_date("o_orderdate").alias("day"))


@query("O2", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 1")
def oldest_row(spark, sf):
    return _orders(spark, sf).orderBy("o_orderdate", "o_orderkey").limit(1).select("o_orderkey", "o_totalprice")


@query("O3", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100")
def top_hundred(spark, sf):
    return _orders(spark, sf).orderBy(F.desc("o_totalprice"), "o_orderkey").limit(100).select("o_orderkey", "o_totalprice")


@query("O4", "SELECT o_orderkey || ';' || o_orderstatus AS line FROM orders ORDER BY o_orderkey LIMIT 1 OFFSET 1")
def nth_line(spark, sf):
    line = F.concat_ws(";", F.col("o_orderkey").cast("string"), "o_orderstatus")
    return _orders(spark, sf).orderBy("o_orderkey").offset(1).limit(1).select(line.alias("line"))


@query("M9", """
  SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity >= 40 THEN 'large' WHEN l_quantity >= 20 THEN 'medium' ELSE 'small' END AS l_linestatus FROM lineitem""")
def classified_in_place(spark, sf):
    qty = F.col("l_quantity")
    size = F.when(qty >= 40, "large").when(qty >= 20, "medium").otherwise("small")
    return fx.table(spark, sf, "lineitem").withColumn("l_linestatus", size).select("l_orderkey", "l_linenumber", "l_linestatus")


@query("J10 W1 (spine by key without a cross join: months a key was held)", """
  SELECT st_matnr AS matnr, count(DISTINCT st_date) AS dates, (SELECT count(*) FROM fx_calendar) AS spine FROM fx_stock
  WHERE st_date IN (SELECT date FROM fx_calendar) GROUP BY 1""")
def spine_coverage(spark, sf):
    calendar = fx.calendar(spark, sf)
    held = fx.stock(spark, sf).select(F.col("st_matnr").alias("matnr"), F.col("st_date").alias("date")).join(calendar, "date", "left_semi")
    counted = held.distinct().groupBy("matnr").agg(F.count("*").alias("dates"))
    return counted.withColumn("spine", F.lit(calendar.count()).cast("bigint"))


@query("W1", """
  SELECT o_orderkey, CAST(min(CAST(o_totalprice AS DECIMAL(18,2))) OVER (PARTITION BY o_custkey, o_orderstatus) AS DOUBLE) AS least FROM orders""")
def partition_minimum(spark, sf):
    # Joined back from a grouped minimum, which combines on the map side, unlike a window over a hot key.
    price = fx.money(F.col("o_totalprice"))
    lowest = _orders(spark, sf).groupBy("o_custkey", "o_orderstatus").agg(F.min(price).alias("least"))
    return _orders(spark, sf).join(lowest, ["o_custkey", "o_orderstatus"]).select("o_orderkey", "least")

"""Headcount files, headings, wide-to-long and dictionaries.

The files are written by Spark from customers and their orders: one line per customer, one column group per
year of the orders. Headings on whole texts use the documents, one text as the heading line of one file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from granary.operators import reshape
from granary.plans import headcount as plan
from granary.session import materialise, new_path
from granary.sources.tables import retyped
from workload import fixtures as fx
from workload.registry import query

OWNER_TEXTS = ["Россия(0.000%); США(100.000%)", "Россия(100.000%)", "Россия(50.000%); Китай(50.000%)"]
CODES = [*plan.INDUSTRIES, "01."]
# Years whose in or out column, or one of the eight measures, is left out of the files.
NO_IN, NO_OUT, NO_REMOTE = 1996, 1997, 1998

_ID_SQL = {
    "Головная (да нет)": "CASE c_custkey % 2 WHEN 0 THEN 'да' ELSE 'нет' END",
    "ИНН головной организации": "'H' || (c_custkey // 10)",
    "ОКПО": "'K' || c_nationkey",
    "Полное наименование организации": "'ООО \"' || c_name || '\"'",
    "ИНН": "CAST(c_custkey AS VARCHAR)",
    "ОГРН": "'G' || c_custkey",
    "ОКФС": "c_mktsegment",
    "ОКВЭД2": "CASE c_nationkey % 10 " + " ".join(f"WHEN {i} THEN '{c}1'" for i, c in enumerate(CODES)) + " END",
    "Учредители акционеры": "CASE c_custkey % 4 " + " ".join(f"WHEN {i} THEN '{t}'" for i, t in enumerate(OWNER_TEXTS)) + " END",
    "Субъект Российской Федерации": "'R' || c_nationkey",
}
fx.SQL["firms"] = "SELECT c_custkey, " + ", ".join(f'{e} AS "{n}"' for n, e in _ID_SQL.items()) + " FROM customer"
fx.SQL["yearly"] = """
  SELECT o_custkey AS c_custkey, CAST(year(o_orderdate) AS INTEGER) AS y, count(*) AS n, count(*) FILTER (o_orderstatus = 'O') AS n_o,
    count(*) FILTER (o_orderstatus = 'F') AS n_f, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS price
  FROM orders GROUP BY ALL"""
fx.SQL["firm_years"] = """
  SELECT * FROM fx_firms CROSS JOIN (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS y FROM orders) LEFT JOIN fx_yearly USING (c_custkey, y)"""
_ID_NAMES = ", ".join(f'"{n}"' for n in _ID_SQL)
fx.SQL["part1"] = f"""
  SELECT {_ID_NAMES}, make_date(y, 1, 1) AS date, CAST(n AS INTEGER) AS value_total,
    CAST(CASE WHEN y <> {NO_IN} THEN n_o END AS INTEGER) AS value_in,
    CAST(CASE WHEN y NOT IN ({NO_IN}, {NO_OUT}) THEN n_f END AS INTEGER) AS value_out
  FROM fx_firm_years"""
_OWNERSHIP = """CASE WHEN contains("Учредители акционеры", 'Россия(0.000%)') THEN 'Иностранная собственность'
    WHEN contains("Учредители акционеры", 'Россия(100.000%)') THEN 'Российская собственность'
    ELSE 'Совместная российская и иностранная собственность' END"""
_INDUSTRY = 'CASE "ОКВЭД2" ' + " ".join(f"WHEN '{c}1' THEN '{n}'" for c, n in plan.INDUSTRIES.items()) + f" ELSE '{plan.OTHER_INDUSTRY}' END"


def _quoted(column):
    return F.concat(F.lit('"'), F.replace(column, F.lit('"'), F.lit('""')), F.lit('"'))


def _firms(spark, sf) -> DataFrame:
    key, nation = F.col("c_custkey"), F.col("c_nationkey")
    owners = F.array(*[F.lit(t) for t in OWNER_TEXTS])
    codes = F.array(*[F.lit(c + "1") for c in CODES])
    cells = [
        F.when(key % 2 == 0, "да").otherwise("нет"),
        F.concat(F.lit("H"), F.floor(key / 10).cast("string")),
        F.concat(F.lit("K"), nation.cast("string")),
        F.concat(F.lit('ООО "'), "c_name", F.lit('"')),
        key.cast("string"),
        F.concat(F.lit("G"), key.cast("string")),
        F.col("c_mktsegment"),
        F.get(codes, (nation % 10).cast("int")),
        F.get(owners, (key % 4).cast("int")),
        F.concat(F.lit("R"), nation.cast("string")),
    ]
    return fx.table(spark, sf, "customer").select("c_custkey", *[c.alias(n) for c, n in zip(cells, plan.ID_COLUMNS, strict=True)])


def _yearly(spark, sf) -> tuple[DataFrame, list[int]]:
    """Firms with one struct column per year, and the years (as many as the calendar has)."""
    orders = fx.table(spark, sf, "orders").withColumn("y", F.year("o_orderdate"))
    years = [r["y"] for r in orders.select("y").distinct().orderBy("y").collect()]
    sums = orders.groupBy(F.col("o_custkey").alias("c_custkey")).pivot("y", years).agg(
        F.count(F.lit(1)).alias("n"),
        F.count(F.when(F.col("o_orderstatus") == "O", 1)).alias("o"),
        F.count(F.when(F.col("o_orderstatus") == "F", 1)).alias("f"),
        F.sum(fx.money(F.col("o_totalprice"))).alias("price"),
    )
    # A pivoted count is 0 where the firm has no orders in the year; the file leaves such cells empty.
    empty = {f"{y}_{m}": F.when(F.col(f"{y}_price").isNotNull(), F.col(f"{y}_{m}")) for y in years for m in "nof"}
    return _firms(spark, sf).join(sums.withColumns(empty), "c_custkey", "left"), years


def _write(rows: DataFrame, cells: list, heading: list[str]) -> tuple[str, str]:
    """Write data lines and heading lines; returns both paths."""
    spark = rows.sparkSession
    ids = [_quoted(F.col(f"`{c}`")) for c in plan.ID_COLUMNS]
    texts = [F.coalesce(c.cast("string"), F.lit("")) for c in [*ids, *cells]]
    data, head = new_path(spark, "headcount"), new_path(spark, "heading")
    rows.select(F.concat_ws(";", *texts).alias("value")).write.text(data)
    spark.createDataFrame([(line,) for line in heading], "value string").coalesce(1).write.text(head)
    return data, head


def _part1(spark, sf) -> DataFrame:
    rows, years = _yearly(spark, sf)
    names, cells = list(plan.ID_COLUMNS), []
    for y in years:
        names.append(f"01.01.{y}")
        cells.append(F.col(f"{y}_n"))
        if y != NO_IN:
            names.append(reshape.IN_MARK)
            cells.append(F.col(f"{y}_o"))
        if y != NO_OUT:
            names.append(f" {reshape.OUT_MARK} ")
            cells.append(F.col(f"{y}_f"))
    data, head = _write(rows, cells, [";".join(names)])
    return plan.read_one_line(spark, data, head)


def _part2(spark, sf) -> DataFrame:
    rows, years = _yearly(spark, sf)
    upper, lower, cells = ["﻿"] + [""] * 9, list(plan.ID_COLUMNS), []
    for y in years:
        upper += [reshape.EMPTY_CELLS[1] if y == years[0] else "", "", ""]
        lower += [f"01.01.{y} ПФР", f"01.01.{y} РВР", reshape.DIFFERENCE]
        half = F.concat((F.col(f"{y}_n") - F.col(f"{y}_o")).cast("string"), F.lit(".5"))
        cells += [F.col(f"{y}_n"), F.col(f"{y}_o"), half]
    for phrase, source in zip(reshape.SHORT_MEASURES, ["price", "n", "o", "f", "n"], strict=True):
        kept = [y for y in years if not (y == NO_REMOTE and phrase.endswith("удаленной работе, чел"))]
        upper += [phrase] + [""] * (len(kept) - 1)
        lower += [f"{y}-01-01" for y in kept]
        cells += [F.col(f"{y}_{source}") for y in kept]
    units = ["units"] + [str(i) for i in range(1, len(lower))]
    data, head = _write(rows, cells, [";".join(line) for line in (upper, lower, units)])
    return plan.read_two_lines(spark, data, head)


@query("B10 S3 S4 R1 R3 P18 F8 X4 W5 R5", "SELECT * FROM fx_part1")
def headcount_one_line(spark, sf):
    return _part1(spark, sf)


def _spoiled(spark, sf):
    """Folder of one-line files in which some lines are spoiled, one way by each remainder of the key, and a heading text stands far inside."""
    rows, years = _yearly(spark, sf)
    y = years[0]
    names = [*plan.ID_COLUMNS, f"01.01.{y}"]
    key = F.col("c_custkey") % 50
    count = F.when(key == 1, "ten").otherwise(F.coalesce(F.col(f"{y}_n").cast("string"), F.lit("")))
    cells = [F.coalesce(_quoted(F.col(f"`{c}`")), F.lit("")) for c in plan.ID_COLUMNS]
    organisation = plan.ID_COLUMNS.index(plan.ORGANISATION)
    cells[organisation] = F.when(key == 2, F.concat(F.lit('"first'), F.lit("\n"), F.lit('second"'))).otherwise(cells[organisation])
    line = F.concat_ws(";", *cells, count)
    line = F.when(key == 3, F.concat(line, F.lit(";7;8"))).when(key == 4, F.concat_ws(";", *cells)).otherwise(line)
    head = ";".join(names)
    path = new_path(spark, "spoiled")
    spark.createDataFrame([(head,)], "value string").coalesce(1).write.text(path)
    rows.select(line.alias("value")).write.mode("append").text(path)
    return path, head


_SPOILED_SQL = f"""
  SELECT f.* REPLACE (CASE WHEN f.c_custkey % 50 = 2 THEN 'first' || chr(10) || 'second' ELSE f."{plan.ORGANISATION}" END AS "{plan.ORGANISATION}"), n FROM fx_firms f LEFT JOIN fx_yearly o ON o.c_custkey = f.c_custkey AND o.y = (SELECT min(CAST(year(o_orderdate) AS INTEGER)) FROM orders)"""


@query("S4 P18 (files with spoiled lines)", f"""
  SELECT {_ID_NAMES}, make_date((SELECT min(CAST(year(o_orderdate) AS INTEGER)) FROM orders), 1, 1) AS date, CAST(n AS INTEGER) AS value_total,
    CAST(NULL AS INTEGER) AS value_in, CAST(NULL AS INTEGER) AS value_out FROM ({_SPOILED_SQL}) WHERE c_custkey % 50 NOT IN (1, 3, 4)""")
def headcount_of_spoiled_files(spark, sf):
    path, _ = _spoiled(spark, sf)
    return plan.read_one_line(spark, path, _head_file(spark, path))


@query("S4 (lines left out)", """
  SELECT CASE c_custkey % 50 WHEN 1 THEN 'not a number' WHEN 3 THEN 'too many cells' ELSE 'too few cells' END AS reason, count(*) AS lines
  FROM customer WHERE c_custkey % 50 IN (1, 3, 4) GROUP BY 1""")
def headcount_lines_rejected(spark, sf):
    path, _ = _spoiled(spark, sf)
    return plan.rejects_of_one_line(spark, path, _head_file(spark, path)).groupBy("reason").agg(F.count("*").alias("lines"))


@query("S4 S3 B10 (records over line breaks, one file in many splits)", f"""
  SELECT {_ID_NAMES}, make_date((SELECT min(CAST(year(o_orderdate) AS INTEGER)) FROM orders), 1, 1) AS date, CAST(n AS INTEGER) AS value_total,
    CAST(NULL AS INTEGER) AS value_in, CAST(NULL AS INTEGER) AS value_out FROM ({_SPOILED_SQL}) WHERE c_custkey % 50 NOT IN (1, 3, 4)""")
def headcount_of_one_file_in_many_splits(spark, sf):
    path, head = _spoiled(spark, sf)
    whole = new_path(spark, "one-file")
    # The first and second half of a broken record stay together, as each file is read in its own order.
    spark.read.text(path).where(F.col("value") != head).coalesce(1).write.text(whole)
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    size = spark.read.format("binaryFile").load(whole).agg(F.sum("length")).first()[0]
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(max(size // 50, 1000)))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        return materialise(plan.read_one_line(spark, whole, _head_file(spark, path)), "records")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept[0])
        spark.conf.set("spark.sql.files.openCostInBytes", kept[1])


def _head_file(spark, path):
    """The one file of the folder that holds the heading."""
    return spark.read.text(path).where(F.col("value").startswith(plan.ID_COLUMNS[0])).select("_metadata.file_path").first()[0]


@query("B11 R2 R4 P18 F17 F19 F21 S16 W2 W3 J13", f"""
  SELECT {_ID_NAMES}, make_date(y, 1, 1) AS date, CAST(n AS DOUBLE) AS value_total_pfr, CAST(n_o AS DOUBLE) AS value_total_prr,
    CAST(n - n_o + 1 AS INTEGER) AS value_total_diff, CAST(price AS DOUBLE) AS value_firing, CAST(n AS DOUBLE) AS value_vacation,
    CAST(n_o AS DOUBLE) AS value_rest, CAST(n_f AS DOUBLE) AS value_parttime, CAST(n AS DOUBLE) AS value_distant
  FROM fx_firm_years WHERE y <> {NO_REMOTE}""")
def headcount_two_lines(spark, sf):
    return _part2(spark, sf)


@query("B12 B13 M9 F14 F15 P16", f"""
  SELECT "ИНН", date, value_total, {_OWNERSHIP} AS owners, {_INDUSTRY} AS industry FROM fx_part1""")
def headcount_classified(spark, sf):
    rows = plan.classified(_part1(spark, sf))
    return rows.select("ИНН", "date", "value_total", F.col(plan.OWNERS).alias("owners"), F.col(plan.INDUSTRY).alias("industry"))


def _dictionary_sql(column: str) -> str:
    return f"""
  SELECT row_number() OVER (ORDER BY name NULLS FIRST) AS "KEY", name, row_number() OVER (ORDER BY name NULLS FIRST) AS ord
  FROM (SELECT DISTINCT {column} AS name FROM fx_part1)"""


@query("B14 A13 W4 S12", _dictionary_sql('"Субъект Российской Федерации"'))
def region_dictionary(spark, sf):
    return plan.dictionary_of(_part1(spark, sf), "t8657")


@query("A13 W4 B14 B15 (refilled: known values keep their keys, new ones follow)", """
  WITH first AS (SELECT DISTINCT st_matnr AS name FROM fx_stock WHERE st_date < DATE '1992-07-01'),
    second AS (SELECT DISTINCT st_matnr AS name FROM fx_stock WHERE st_date >= DATE '1998-07-01')
  SELECT coalesce(f.key, (SELECT count(*) FROM first) + n.key) AS "KEY", s.name, row_number() OVER (ORDER BY s.name) AS ord FROM second s
  LEFT JOIN (SELECT name, row_number() OVER (ORDER BY name) AS key FROM first) f USING (name)
  LEFT JOIN (SELECT name, row_number() OVER (ORDER BY name) AS key FROM second WHERE name NOT IN (SELECT name FROM first)) n USING (name)""")
def dictionary_refilled(spark, sf):
    folder, stock = new_path(spark, "registry"), fx.stock(spark, sf)
    date = F.col("st_date")
    for part in (stock.where(date < "1992-07-01"), stock.where(date >= "1998-07-01")):
        # The second refill has new values and lacks some of the first.
        filled = plan.kept_dictionary(part, "st_matnr", folder)
    return filled


@query("B14 A13 W4", _dictionary_sql('"Головная (да нет)"'))
def head_office_dictionary(spark, sf):
    return plan.dictionary_of(_part1(spark, sf), "t8646")


@query("B14 A13 W4", _dictionary_sql('"ОКФС"'))
def ownership_code_dictionary(spark, sf):
    return plan.dictionary_of(_part1(spark, sf), "t8655")


@query("B14 A13 W4", _dictionary_sql("date"))
def date_dictionary(spark, sf):
    return plan.dictionary_of(_part1(spark, sf), "t8649")


@query("B14 B13", _dictionary_sql(_INDUSTRY))
def industry_dictionary(spark, sf):
    return plan.dictionary_of(_part1(spark, sf), "t8653")


@query("B14 B12", _dictionary_sql('"Учредители акционеры"'))
def owner_dictionary(spark, sf):
    return plan.dictionary_of(_part1(spark, sf), "t8659")


_ORG = '"Полное наименование организации", "ИНН головной организации", "ОКПО", "ИНН", "ОГРН"'


@query("B15 A13 W4", f"""
  SELECT row_number() OVER w AS "KEY", "Полное наименование организации" AS name, row_number() OVER w AS ord,
    "ИНН головной организации" AS head_inn, "ОКПО" AS okpo, "ИНН" AS inn, "ОГРН" AS ogrn
  FROM (SELECT DISTINCT {_ORG} FROM fx_part1) WINDOW w AS (ORDER BY {_ORG})""")
def organisation_dictionary(spark, sf):
    return plan.dictionary_of(_part1(spark, sf), "t8651")


@query("B24 A12", """
  SELECT date, sum(value_total)::BIGINT AS value_total, sum(value_in)::BIGINT AS value_in, sum(value_out)::BIGINT AS value_out
  FROM fx_part1 GROUP BY 1 ORDER BY 1""")
def headcount_daily_totals(spark, sf):
    return plan.daily_totals(_part1(spark, sf))


@query("A13", """
  SELECT row_number() OVER (ORDER BY lang) AS "KEY", lang AS name, row_number() OVER (ORDER BY lang) AS ord FROM (SELECT DISTINCT lang FROM documents)""")
def grouped_then_numbered(spark, sf):
    return plan.dictionary(fx.table(spark, sf, "documents"), "lang")


# Headings over whole texts: words are the cells, and words of some lengths play the marks.
fx.SQL["words"] = """
  SELECT doc_id, CAST(pos AS INTEGER) AS pos, trim(w, ' ') AS word
  FROM documents, unnest(string_split(text, ' ')) WITH ORDINALITY u(w, pos)"""
fx.SQL["marked"] = f"""
  SELECT doc_id, pos, CASE length(word) WHEN 2 THEN '{reshape.IN_MARK}' WHEN 3 THEN '{reshape.OUT_MARK}' ELSE word END AS cell,
    CASE WHEN length(word) < 6 THEN '' ELSE word END AS above,
    CASE WHEN length(word) = 4 THEN '{reshape.DIFFERENCE}' ELSE word END AS below
  FROM fx_words"""


def _words(spark, sf) -> DataFrame:
    return reshape.heading_cells(fx.table(spark, sf, "documents"), "text", "doc_id", " ")


def _upper(words: DataFrame) -> DataFrame:
    return words.withColumn("cell", F.when(F.length("cell") < 6, "").otherwise(F.col("cell")))


@query("W5 R5 F12 F13", "SELECT doc_id, pos, word AS cell FROM fx_words")
def positions_in_a_line(spark, sf):
    return _words(spark, sf)


@query("R3 J12", f"""
  SELECT doc_id, pos, coalesce(CASE cell WHEN '{reshape.IN_MARK}' THEN lag(cell, 1) OVER w WHEN '{reshape.OUT_MARK}' THEN lag(cell, 2) OVER w END || '_', '')
    || cell AS name FROM fx_marked WINDOW w AS (PARTITION BY doc_id ORDER BY pos)""")
def names_by_neighbour(spark, sf):
    words, size = _words(spark, sf), F.length("cell")
    cells = words.withColumn("cell", F.when(size == 2, reshape.IN_MARK).when(size == 3, reshape.OUT_MARK).otherwise(F.col("cell")))
    return reshape.one_line_names(cells, "doc_id")


@query("W2 A10", """
  SELECT doc_id, pos, count(CASE WHEN above <> '' THEN 1 END) OVER (PARTITION BY doc_id ORDER BY pos) AS block FROM fx_marked""")
def running_block_number(spark, sf):
    return reshape.filled_forward(_upper(_words(spark, sf)), "doc_id").select("doc_id", "pos", "block")


fx.SQL["filled"] = """
  SELECT doc_id, pos, first_value(above) OVER (PARTITION BY doc_id, block ORDER BY pos) AS filled FROM (
    SELECT *, count(CASE WHEN above <> '' THEN 1 END) OVER (PARTITION BY doc_id ORDER BY pos) AS block FROM fx_marked)"""


@query("W3", "SELECT * FROM fx_filled")
def merged_cells_filled(spark, sf):
    return reshape.filled_forward(_upper(_words(spark, sf)), "doc_id").select("doc_id", "pos", "filled")


@query("R4 J13 F16", f"""
  SELECT doc_id, pos, CASE WHEN filled = '' THEN '' ELSE '' END || coalesce(CASE WHEN below = '{reshape.DIFFERENCE}'
      THEN left(lag(below) OVER (PARTITION BY doc_id ORDER BY pos), 10) || '_' END, '') || below
    || CASE WHEN filled = '' THEN '' ELSE ' ' || filled END AS name
  FROM fx_marked JOIN fx_filled USING (doc_id, pos)""")
def names_of_two_lines(spark, sf):
    words = _words(spark, sf)
    lower = words.withColumn("cell", F.when(F.length("cell") == 4, reshape.DIFFERENCE).otherwise(F.col("cell")))
    return reshape.two_line_names(_upper(words), lower, "doc_id")


@query("A11", "SELECT doc_id, string_agg(word, ',' ORDER BY pos) AS names FROM fx_words GROUP BY 1")
def names_joined(spark, sf):
    words = _words(spark, sf).withColumnRenamed("cell", "name")
    return reshape.joined_names(words, "doc_id")


@query("J16 R1", """
  SELECT l_orderkey, l_linenumber, u.measure, u.amount FROM lineitem,
    LATERAL (VALUES ('quantity', l_quantity), ('price', l_extendedprice), ('discount', l_discount)) u(measure, amount)""")
def row_to_several_rows(spark, sf):
    groups = {"quantity": {"amount": "l_quantity"}, "price": {"amount": "l_extendedprice"}, "discount": {"amount": "l_discount"}}
    return reshape.wide_to_long(fx.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], groups, ["amount"], "measure")


@query("R2 (dates without all measures dropped)", """
  SELECT c_custkey, kind, a, b FROM (SELECT c_custkey, c_acctbal, c_nationkey FROM customer),
    LATERAL (VALUES ('01.01.2020', c_acctbal, CAST(c_nationkey AS DOUBLE)), ('01.01.2021', c_acctbal, c_acctbal)) u(kind, a, b)""")
def strict_wide_to_long(spark, sf):
    wide = {"2020": ("c_acctbal", "c_nationkey"), "2021": ("c_acctbal", "c_acctbal"), "2022": ("c_acctbal", None)}
    groups = {f"01.01.{y}": {"a": a, "b": b} for y, (a, b) in wide.items() if a and b}
    rows = retyped(fx.table(spark, sf, "customer"), {"c_nationkey": "double"})
    return reshape.wide_to_long(rows, ["c_custkey"], groups, ["a", "b"], "kind")


@query("B12 F15", """
  SELECT c_custkey, CASE WHEN position('BUILD' IN c_mktsegment) > 0 THEN 'construction' WHEN position('MACH' IN c_mktsegment) > 0 THEN 'plant'
    ELSE 'other' END AS class FROM customer""")
def class_by_phrase(spark, sf):
    label = plan.text.class_by_phrase(F.col("c_mktsegment"), [("BUILD", "construction"), ("MACH", "plant")], "other")
    return fx.table(spark, sf, "customer").select("c_custkey", label.alias("class"))


@query("B13 F14 P15", """
  SELECT p_partkey, CASE left(p_brand, 7) WHEN 'Brand#1' THEN 'one' WHEN 'Brand#2' THEN 'two' ELSE 'other' END AS class FROM part""")
def class_by_prefix(spark, sf):
    label = plan.text.class_by_prefix(F.col("p_brand"), {"Brand#1": "one", "Brand#2": "two"}, "other")
    return fx.table(spark, sf, "part").select("p_partkey", label.alias("class"))

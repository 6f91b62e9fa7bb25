"""Twelve months of stock categories kept up to date from what has changed.

``held`` keeps the sums of the stock per key, date and valuation type, ``needed`` the distinct required rows, ``categories`` the
result; all lie in buckets by material. A run puts its sums and rows beside those of earlier runs; a bucket of several files may
so hold several sums of a key, which become one when the bucket is written anew. No rule looks beyond one material, so a run works
out the categories of the materials its rows belong to, and puts them in place of the old ones. It opens the buckets of these
materials and no other, and reads no stock row it has seen before. When the months, the date of the run, the areas or the calendar
differ from those of the last run, all materials are worked out again, from the sums. The three tables switch together.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from granary.functions.dates import as_date, month_start
from granary.operators.joins import null_safe
from granary.operators.versions import ROWS, Change, Versions
from granary.plans import stock as rules
from granary.session import discard, materialise

HELD, NEEDED, CATEGORIES, TERMS = "held", "needed", "categories", "terms"
_HELD_KEY = [*rules.KEY, "date", "bwtar"]
_NEEDED = ["kind", "area", "date", "matnr", "qty"]


@dataclass
class Report:
    """Materials worked out, whether that was all of them, bytes opened and written."""

    materials: int
    whole: bool
    read: int
    written: int


def _held_sums(rows: DataFrame) -> DataFrame:
    sums = [F.sum(c).cast("decimal(28,2)").alias(c) for c in ("any_qty", "qty", "amt")]
    return rows.groupBy(*_HELD_KEY).agg(*sums, F.max("held").alias("held"))


def _required(reqstock: DataFrame) -> DataFrame:
    """Distinct required rows, those a later date of the run will ask for among them."""
    wanted = (F.col("rs_ppm_elem") == rules.REQUIRED_ELEMENT) & F.col("rs_prof_load").isin(*rules.REQUIRED_PROFILES)
    wanted &= F.col("rs_tech_data_type").isin(rules.CURRENT_DATA, rules.PAST_DATA)
    return reqstock.where(wanted).select(
        F.col("rs_tech_data_type").alias("kind"),
        F.col("rs_ppm_area").alias("area"),
        month_start("rs_load_date").alias("date"),
        F.col("rs_matnr").alias("matnr"),
        F.col("rs_qty_avlb").alias("qty"),
    ).distinct()


def _mark(rows: DataFrame) -> list[int]:
    """Tells two small tables apart, whatever the order of their rows."""
    return list(rows.agg(F.count("*"), F.coalesce(F.bit_xor(F.xxhash64(*rows.columns)), F.lit(0))).first())


def read_categories(spark: SparkSession, folder: str) -> DataFrame:
    return Versions(spark, folder).read(CATEGORIES)


def load(
    stock: DataFrame,
    reqstock: DataFrame,
    warehouses: DataFrame,
    calendar: DataFrame,
    months: Sequence[dt.date],
    as_of: dt.date,
    folder: str,
    rows: int = ROWS,
) -> Report:
    """Add the new rows ``stock`` and ``reqstock`` to the tables in ``folder`` and bring the categories up to date.

    The result equals :func:`granary.plans.stock.categorised` over all rows added so far. Stock rows without a
    material are one material of their own. Either table of new rows may be empty; repeated stock rows add up, repeated
    required rows count once, also across runs.
    """
    spark = stock.sparkSession
    new_held = materialise(_held_sums(rules.held_rows(stock)), "new-held")
    new_needed = materialise(_required(reqstock), "new-needed")
    areas = materialise(rules.area_map(warehouses), "areas")
    change = Change(spark, folder, rows)
    change.table(HELD, new_held.schema, ["matnr"])
    change.table(NEEDED, new_needed.schema, ["matnr"])
    change.append(HELD, new_held, _held_sums)
    change.append(NEEDED, new_needed, lambda both: both.select(*_NEEDED).distinct())
    dates = calendar.select("date").distinct()
    terms = {"as_of": as_of.isoformat(), "months": [m.isoformat() for m in months], "areas": _mark(areas), "dates": _mark(dates)}
    whole = change.facts.get(TERMS) != terms

    changed = materialise(new_held.select("matnr").unionAll(new_needed.select("matnr")).distinct(), "changed")
    aside = changed.withColumnRenamed("matnr", "_changed")

    def of_changed(name: str, material: str) -> DataFrame:
        if whole:
            return change.read(name)
        return change.read(name, change.touched(name, changed, ["matnr"])).join(aside, null_safe({material: "_changed"}), "left_semi")

    since, until = rules.reach_of(months)
    now = month_start(as_date(as_of))
    # The months of the required rows are whole, so the bounds on their stamps are bounds on their months.
    current = (F.col("kind") == rules.CURRENT_DATA) & (F.col("date") == now)
    past = (F.col("kind") == rules.PAST_DATA) & (F.col("date") < now)
    required = of_changed(NEEDED, "matnr").where((current | past) & (F.col("date") >= since) & (F.col("date") < until))
    held = of_changed(HELD, "matnr").where((F.col("date") > since) & (F.col("date") < until))
    needed = rules.needed_rows(required.select("area", "date", "matnr", "qty").distinct(), areas)
    needed = needed.groupBy(*rules.KEY, "date").agg(F.sum("need").alias("need"), F.max("needed").alias("needed"))
    ledger = rules.ledger_of(held, needed, summed=True)
    fresh = materialise(rules.categories_of(ledger, calendar, months), "categories")
    if whole:
        change.tables.pop(CATEGORIES, None)
    change.table(CATEGORIES, fresh.schema, ["sca_matnr"])
    leaves = change.touched(CATEGORIES, changed, ["matnr"])
    if whole:
        change.append(CATEGORIES, fresh)
    elif leaves:
        kept = change.read(CATEGORIES, leaves).join(aside, null_safe({"sca_matnr": "_changed"}), "left_anti")
        change.rewrite(CATEGORIES, leaves, kept.unionByName(fresh))
    cost = change.cost()
    change.commit(**{TERMS: terms})
    materials = (change.read(CATEGORIES).select("sca_matnr").distinct() if whole else changed).count()
    for table in (new_held, new_needed, areas, changed, fresh):
        discard(table)
    return Report(materials, whole, cost["read"], cost["written"])

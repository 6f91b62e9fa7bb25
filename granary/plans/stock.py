"""Monthly stock categorisation: total, safety, long-lying and fast-moving stock.

All months are one plan over one ledger: stock rows and required rows are stacked and summed once per
(plant, divisions, material, date). Everything after that is a window over the ledger, partitioned
by (divisions, material), so the whole run costs one scan of each source and two shuffles of the facts.
The sums combine on the map side. A ledger group holds at most the plants and dates of two years, however
many rows a material has.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from granary.functions.dates import as_date, in_trailing_year, month_number, month_start
from granary.operators.joins import update_from

SAFETY, LONG_LYING, FAST_MOVING, TOTAL = 1, 2, 3, 4

KEY = ["werks", "o_divis", "r_divis", "matnr"]

# The planning element and load profiles that mark required stock.
REQUIRED_ELEMENT = "1S"
REQUIRED_PROFILES = [1, 2]
CURRENT_DATA, PAST_DATA = 1, 3


def area_map(warehouses: DataFrame) -> DataFrame:
    """One row per planning area; each column is its own maximum, so the three may stem from different rows."""
    named = warehouses.where(F.col("wm_oblast_ppm") != "")
    return named.groupBy(F.col("wm_oblast_ppm").alias("area")).agg(
        F.max("wm_o_divis").alias("o_divis"), F.max("wm_r_divis").alias("r_divis"), F.max("wm_werks").alias("werks")
    )


def required_rows(reqstock: DataFrame, as_of: dt.date, since: Column | None = None) -> DataFrame:
    """Distinct required rows ``area, date, matnr, qty``: current data for the month of ``as_of``, past data before.

    The two arms of the union differ only in their filter, so they are one scan with one ``distinct``;
    equal rows count once. The bounds are put on the raw stamp, where the scan can use them.
    """
    now = month_start(as_date(as_of))
    stamp = F.col("rs_load_date")
    arm = ((F.col("rs_tech_data_type") == CURRENT_DATA) & (stamp >= now) & (stamp < F.add_months(now, 1))) | (
        (F.col("rs_tech_data_type") == PAST_DATA) & (stamp < now)
    )
    kept = reqstock.where(
        arm & (F.col("rs_ppm_elem") == REQUIRED_ELEMENT) & F.col("rs_prof_load").isin(*REQUIRED_PROFILES)
    )
    if since is not None:
        kept = kept.where(stamp >= since)
    return kept.select(
        F.col("rs_ppm_area").alias("area"),
        month_start("rs_load_date").alias("date"),
        F.col("rs_matnr").alias("matnr"),
        F.col("rs_qty_avlb").alias("qty"),
    ).distinct()


def required_by_place(reqstock: DataFrame, warehouses: DataFrame, as_of: dt.date) -> DataFrame:
    """Required quantity per plant, divisions, material and month."""
    placed = required_rows(reqstock, as_of).join(area_map(warehouses), "area")
    return placed.groupBy("werks", "date", "o_divis", "r_divis", "matnr").agg(F.sum("qty").alias("qty"))


def _stock_key() -> list[Column]:
    return [
        F.col("st_werks").alias("werks"),
        F.coalesce("st_o_divis", F.lit("")).alias("o_divis"),
        F.coalesce("st_r_divis", F.lit("")).alias("r_divis"),
        F.col("st_matnr").alias("matnr"),
        F.col("st_date").alias("date"),
    ]


def _on_hand() -> Column:
    return (F.col("st_qty") > 0) & (F.col("st_amt") > 0)


def total_stock(stock: DataFrame, months: Sequence[dt.date]) -> DataFrame:
    """Total stock (kind 4) of the given months."""
    span = (F.col("st_date") >= as_date(min(months))) & (F.col("st_date") < F.add_months(as_date(max(months)), 1))
    listed = month_start("st_date").isin(*[as_date(m) for m in months])
    kept = stock.where(_on_hand() & span & listed)
    sums = kept.groupBy(*_stock_key()).agg(
        F.coalesce(F.sum("st_qty"), F.lit(0)).alias("qty"), F.coalesce(F.sum("st_amt"), F.lit(0)).alias("amt")
    )
    return sums.select(
        *[F.col(c).alias(f"sca_{c}") for c in [*KEY, "date", "qty", "amt"]], F.lit(TOTAL).cast("smallint").alias("sca_kat")
    )


def held_rows(stock: DataFrame) -> DataFrame:
    """Stock rows in the form in which they are summed: key, date, valuation type and what counts towards which sum."""
    raw_divisions = F.col("st_o_divis").isNotNull() & F.col("st_r_divis").isNotNull()
    on_hand = _on_hand()
    return stock.select(
        *_stock_key(),
        F.col("st_qty").alias("any_qty"),
        F.when(on_hand, F.col("st_qty")).alias("qty"),
        F.when(on_hand, F.col("st_amt")).alias("amt"),
        F.when(on_hand, 1).alias("held"),
        F.when(raw_divisions, F.col("st_bwtar")).alias("bwtar"),
    )


def needed_rows(required: DataFrame, areas: DataFrame) -> DataFrame:
    """Distinct required rows at the places of their areas, in the form in which they are summed."""
    needed = required.join(areas, "area").dropna(subset=KEY)
    return needed.select(*KEY, "date", F.col("qty").alias("need"), F.lit(1).alias("needed"))


def reach_of(months: Sequence[dt.date]) -> tuple[Column, Column]:
    """The dates that the trailing years of ``months`` need lie strictly between these two."""
    return F.add_months(as_date(min(months)), -12), F.add_months(as_date(max(months)), 1)


def _ledger(stock: DataFrame, reqstock: DataFrame, warehouses: DataFrame, months: Sequence[dt.date], as_of: dt.date) -> DataFrame:
    """Stock and required quantities per key and date, over the trailing year of every month."""
    since, until = reach_of(months)
    held = held_rows(stock.where((F.col("st_date") > since) & (F.col("st_date") < until)))
    required = required_rows(reqstock, as_of, since).where(F.col("date") < until)
    return ledger_of(held, needed_rows(required, area_map(warehouses)))


def ledger_of(held: DataFrame, needed: DataFrame, summed: bool = False) -> DataFrame:
    """One row per key and date of rows or partial sums in the forms of :func:`held_rows` and :func:`needed_rows`.

    Raw rows are summed on the map side and shuffled by their whole key first. Where both are ``summed`` already, up to a few
    sums of a key, there is nothing to combine, and the one shuffle that the windows need serves these sums too.
    """
    stacked = held.unionByName(needed, allowMissingColumns=True)
    by_type = (
        (stacked.repartition("o_divis", "r_divis", "matnr") if summed else stacked)
        .groupBy(*KEY, "date", "bwtar")
        .agg(
            F.sum("any_qty").alias("any_qty"),
            F.sum("qty").alias("qty"),
            F.sum("amt").alias("amt"),
            F.max("held").alias("held"),
            F.sum("need").alias("need"),
            F.max("needed").alias("needed"),
        )
    )
    # The greatest valuation type is a text maximum, which would sort the raw rows; as a key it is hashed,
    # and the few types of a key are folded after the shuffle that the windows need anyway.
    return (
        (by_type if summed else by_type.repartition("o_divis", "r_divis", "matnr"))
        .groupBy(*KEY, "date")
        .agg(
            F.coalesce(F.sum("any_qty"), F.lit(0)).alias("any_qty"),
            F.sum("qty").alias("qty"),
            F.sum("amt").alias("amt"),
            F.max("held").alias("held"),
            F.max("bwtar").alias("bwtar"),
            F.coalesce(F.sum("need"), F.lit(0)).alias("need"),
            F.max("needed").alias("needed"),
        )
    )


def _spine(calendar: DataFrame, months: Sequence[dt.date]) -> tuple[DataFrame, DataFrame]:
    """Calendar dates in reach, and per month the number of dates in its trailing year.

    Both come from the distinct dates of two years, so they are small whatever the size of the calendar.
    """
    first, last = as_date(min(months)), as_date(max(months))
    dates = calendar.where((F.col("date") > F.add_months(first, -12)) & (F.col("date") <= last)).select("date").distinct()
    reach = F.explode(F.sequence(_window_month(), _window_month() + 11)).alias("month")
    per_month = dates.select(reach, "date").groupBy("month").agg(
        F.count("*").alias("days"), F.max(F.when(month_number(F.col("date")) == F.col("month"), F.dayofmonth("date") == 1)).alias("listed")
    )
    return dates, per_month


def _window_month() -> Column:
    """The first month start on or after the date: the first month whose trailing year holds it."""
    return month_number(F.col("date")) + F.when(F.dayofmonth("date") > 1, 1).otherwise(0)


def categorised(
    stock: DataFrame,
    reqstock: DataFrame,
    warehouses: DataFrame,
    calendar: DataFrame,
    months: Sequence[dt.date],
    as_of: dt.date,
    per_plant: bool = False,
) -> DataFrame:
    """All four kinds of all ``months`` with quantity, amount and valuation type.

    Long-lying stock is the least balance (stock less required stock, 0 where a calendar date has
    neither) over the trailing year. As in the original rules the minimum runs over all plants of a
    division and material; ``per_plant`` keeps plants apart. ``as_of`` stands for the current date.
    """
    return categories_of(_ledger(stock, reqstock, warehouses, months, as_of), calendar, months, per_plant)


def categories_of(ledger: DataFrame, calendar: DataFrame, months: Sequence[dt.date], per_plant: bool = False) -> DataFrame:
    """The kinds of :func:`categorised` from a ledger; a material needs no row of another one."""
    dates, per_month = _spine(calendar, months)
    # At most two years of dates and of months: both sides are bounded by the calendar.
    ledger = ledger.join(F.broadcast(dates.withColumn("in_spine", F.lit(True))), "date", "left")
    ledger = ledger.withColumns({"month": month_number(F.col("date")), "reach": _window_month()})
    ledger = ledger.join(F.broadcast(per_month), "month", "left")

    keyed = F.col("werks").isNotNull() & F.col("matnr").isNotNull()
    counts = F.col("in_spine") & keyed
    balance = F.when(counts, F.col("any_qty") - F.col("need"))
    place = Window.partitionBy("o_divis", "r_divis", "matnr", "werks").orderBy("reach")
    opening = F.dayofmonth("date") == 1
    own, earlier = place.rangeBetween(-11, 0), place.rangeBetween(-12, -1)
    lowest = F.when(opening, F.min("balance").over(own)).otherwise(F.min("balance").over(earlier))
    seen = F.when(opening, F.count("balance").over(own)).otherwise(F.count("balance").over(earlier))
    wanted = month_start("date").isin(*[as_date(m) for m in months])
    capped = F.least(F.coalesce("lowest", F.lit(0)), F.lit(0))
    rows = (
        ledger.withColumns({"balance": balance, "is_total": (F.coalesce("held", F.lit(0)) > 0) & wanted})
        .withColumns({"lowest": lowest, "seen": seen})
        .withColumn("lowest", F.when(F.col("seen") < F.col("days"), capped).otherwise(F.col("lowest")))
    )
    group = ["o_divis", "r_divis", "matnr", "month"] + (["werks"] if per_plant else [])
    same_month = Window.partitionBy("o_divis", "r_divis", "matnr", "werks", "month")
    priced = F.col("is_total") & opening & keyed
    rows = rows.withColumns(
        {
            "least": F.min(F.when(F.col("is_total"), F.col("lowest"))).over(Window.partitionBy(*group)),
            "open_qty": F.max(F.when(priced, F.col("qty"))).over(same_month),
            "open_amt": F.max(F.when(priced, F.col("amt"))).over(same_month),
            "open_bwtar": F.max(F.when(opening & keyed, F.col("bwtar"))).over(same_month),
            "copies": F.sum(F.when(F.col("is_total"), 1)).over(same_month),
        }
    ).where("is_total")
    return _kinds(rows, opening, keyed)


def _kinds(rows: DataFrame, opening: Column, keyed: Column) -> DataFrame:
    """Unfold one total row into its kinds; a narrow step."""
    long_lying = F.coalesce(F.col("listed") & (F.col("least") > 0), F.lit(False))
    safety = F.when((F.col("needed") == 1) & keyed, F.least("need", "qty"))
    own_long = F.when(long_lying & opening & keyed, F.col("least"))
    fast = F.col("qty") - F.coalesce(safety, F.lit(0)) - F.coalesce(own_long, F.lit(0))
    decimal = "decimal(38,2)"
    month_open = month_start("date")

    def line(kind: int, when: Column, date: Column, qty: Column, base_qty: Column, base_amt: Column, bwtar: Column, times: Column) -> Column:
        return F.struct(
            F.lit(kind).cast("smallint").alias("kat"),
            date.alias("date"),
            qty.cast(decimal).alias("qty"),
            base_qty.cast("decimal(28,2)").alias("base_qty"),
            base_amt.cast("decimal(28,2)").alias("base_amt"),
            bwtar.alias("bwtar"),
            F.when(F.coalesce(when, F.lit(False)), times).otherwise(F.lit(0)).alias("times"),
        )

    own_qty, own_amt = F.when(keyed, F.col("qty")), F.when(keyed, F.col("amt"))
    one = F.lit(1).cast("bigint")
    # A material with several dates in a month meets the long-lying row of the month start once for each.
    fast_times = F.when(own_long.isNotNull(), F.col("copies")).otherwise(one)
    bwtar = F.when(opening & keyed, F.col("bwtar"))
    kinds = F.array(
        line(TOTAL, F.lit(True), F.col("date"), F.col("qty"), F.col("qty"), F.col("amt"), bwtar, one),
        line(SAFETY, safety.isNotNull(), F.col("date"), safety, own_qty, own_amt, bwtar, one),
        line(LONG_LYING, long_lying, month_open, F.col("least"), F.col("open_qty"), F.col("open_amt"), F.col("open_bwtar"), one),
        line(FAST_MOVING, F.lit(True), F.col("date"), fast, own_qty, own_amt, bwtar, fast_times),
    )
    unfolded = rows.select(*KEY, F.inline(kinds)).where(F.col("times") > 0)
    unfolded = unfolded.select("*", F.explode(F.sequence(F.lit(1).cast("bigint"), "times")).alias("_copy"))
    amount = F.when(F.col("kat") == TOTAL, F.col("base_amt").cast("decimal(38,6)")).otherwise(
        priced_amount(F.col("qty").cast("decimal(28,2)"), F.col("base_qty"), F.col("base_amt"))
    )
    return unfolded.select(
        *[F.col(c).alias(f"sca_{c}") for c in [*KEY, "date", "qty"]],
        amount.alias("sca_amt"),
        F.col("kat").alias("sca_kat"),
        F.col("bwtar").alias("sca_bwtar"),
    )


def priced_amount(qty: Column, base_qty: Column, base_amt: Column) -> Column:
    """Amount of a part of the stock at the price of the whole; one division, six decimals."""
    return F.try_divide(base_amt * qty, base_qty).cast("decimal(38,6)")


def of_kind(categories: DataFrame, *kinds: int) -> DataFrame:
    return categories.where(F.col("sca_kat").isin(*kinds))


def month_balances(stock: DataFrame, month: dt.date) -> DataFrame:
    """Stock per key and date over the trailing year of a month, with no sign filter."""
    return stock.where(in_trailing_year(F.col("st_date"), month)).groupBy(*_stock_key()).agg(F.sum("st_qty").alias("qty"))


def repriced(categories: DataFrame) -> DataFrame:
    """Amounts of kinds 1–3 from the price of kind 4 with the same key and date."""
    whole = ["werks", "o_divis", "r_divis", "matnr", "date"]
    base = of_kind(categories, TOTAL).select(
        *[F.col(f"sca_{c}") for c in whole], F.col("sca_qty").alias("_qty"), F.col("sca_amt").alias("_amt")
    )
    joined = categories.join(base, [f"sca_{c}" for c in whole], "left")
    part = (F.col("sca_kat") != TOTAL) & F.col("_qty").isNotNull()
    qty, base_qty, base_amt = (F.col(c).cast("decimal(28,2)") for c in ("sca_qty", "_qty", "_amt"))
    amount = F.when(part, priced_amount(qty, base_qty, base_amt)).otherwise(F.col("sca_amt"))
    return joined.withColumn("sca_amt", amount).select(*categories.columns)


def latest_valuation(stock: DataFrame, month: dt.date) -> DataFrame:
    """Greatest valuation type per raw stock key on the first of the month; NULL divisions stay NULL."""
    key = ["st_werks", "st_o_divis", "st_r_divis", "st_matnr"]
    return stock.where(F.col("st_date") == as_date(month)).groupBy(*key).agg(F.max("st_bwtar").alias("st_bwtar"))


def enriched(
    categories: DataFrame,
    warehouses: DataFrame,
    materials: DataFrame,
    material_groups: DataFrame,
    divisions: DataFrame,
    division_pairs: DataFrame,
) -> DataFrame:
    """Kinds 1–3 with year, month, production, material, valuation and division texts.

    Every lookup is a left join to one row per key; dimensions under the broadcast threshold are sent to
    the executors by Spark itself, larger ones are shuffled.
    """
    rows = of_kind(categories, SAFETY, LONG_LYING, FAST_MOVING)
    rows = rows.withColumns({"sca_year": F.year("sca_date"), "sca_month": F.month("sca_date")})
    text = divisions.withColumn("_text", F.coalesce("div_id_full_txt", F.col("div_id").cast("string")))
    steps = [
        (warehouses, {"sca_werks": "wm_werks", "sca_o_divis": "wm_o_divis", "sca_r_divis": "wm_r_divis"}, {"sca_proizv": "wm_proizv"}),
        (
            materials,
            {"sca_matnr": "mt_matnr", "sca_werks": "mt_werks"},
            {"sca_matkl": "mt_matkl", "sca_matnr_txt": "mt_cc_idtext", "sca_ekgrp": "mt_ekgrp"},
        ),
        (material_groups, {"sca_matkl": "mtg_matkl"}, {"sca_matkl_txt": "mtg_cc_idtext"}),
        (text, {"sca_o_divis": "div_id"}, {"sca_o_divis_txt": "_text"}),
        (text, {"sca_r_divis": "div_id"}, {"sca_r_divis_txt": "_text"}),
        (division_pairs, {"sca_o_divis": "o_div_id", "sca_r_divis": "r_div_id"}, {"sca_or_divis_txt": "or_div_txt"}),
    ]
    return reduce(lambda df, step: update_from(df, *step), steps, rows)

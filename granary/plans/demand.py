"""Material-demand view: demand with material, place and division texts, stage, section and open amounts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Valuation types, stages, section names and the account of the oils section.
OWN, BOUGHT = "СОБСТВЕН", "ПОКУПНОЙ"
STAGE_WITHOUT_ORDER, STAGE_WITH_ORDER = 8, 9
NO_ORDER = ["", "0"]
OILS_ACCOUNT = 1003000000
OILS, UPKEEP, REPAIR, TECHNOLOGY, OWN_SECTION = "МАСЛА", "СОДЕРЖАНИЕ", "РЕМОНТНЫЙ ФОНД", "ТЕХНОЛОГИЯ", "СОБСТВЕН"

# Output columns of the view.
COLUMNS = (
    "rsnum rspos lgort obj_date obj_year obj_month matnr rs_qty_avlb matkl proizv o_divis r_divis werks moni_gr saknr "
    "bwtar unit zvd ekgrp pt_fp01 pt_qty_res potr_stad o_divis_txt r_divis_txt wm_or_txt sdp_qty sdp_amt sat_flag "
    "pla_flag matnr_txt matkl_txt pt_qty_otpu pt_amt_otpu pt_qty_open pt_amt_open pt_manu_date pt_modul pt_section"
).split()

# Source columns of outputs that pass through under another name.
RENAMED = {
    "rsnum": "pt_rsnum",
    "rspos": "pt_rspos",
    "lgort": "pt_lgort",
    "obj_date": "pt_bdter",
    "obj_year": "pt_year",
    "obj_month": "pt_month",
    "matnr": "pt_matnr",
    "werks": "pt_werks",
    "saknr": "pt_saknr",
    "bwtar": "pt_bwtar",
    "unit": "pt_unit_qty",
    "zvd": "pt_zvd",
    "pt_qty_otpu": "pt_enmng",
    "matkl": "mt_matkl",
    "moni_gr": "mt_moni_gr",
    "ekgrp": "mt_ekgrp",
    "matnr_txt": "mt_cc_idtext",
    "matkl_txt": "mtg_cc_idtext",
    "proizv": "wm_proizv",
    "o_divis": "wm_o_divis",
    "r_divis": "wm_r_divis",
    "wm_or_txt": "or_div_txt",
}


def available(reqstock: DataFrame) -> DataFrame:
    """Available quantity per reservation item, current data only."""
    current = reqstock.where(F.col("rs_tech_data_type") == 1)
    return current.groupBy("rs_rsnum", "rs_rspos").agg(F.sum("rs_qty_avlb").alias("rs_qty_avlb"))


def stage() -> Column:
    own = F.col("pt_bwtar") == OWN
    order = F.col("pt_pp_aufnr")
    return (
        F.when(own & (order.isin(*NO_ORDER) | order.isNull()), STAGE_WITHOUT_ORDER)
        .when(own & ~order.isin(*NO_ORDER), STAGE_WITH_ORDER)
        .cast("smallint")
    )


def section() -> Column:
    oils = F.col("pt_saknr") == OILS_ACCOUNT
    module = F.col("pt_modul")
    bought = (
        F.when(module == 1, F.when(oils, OILS).otherwise(UPKEEP))
        .when(module == 2, REPAIR)
        .when(module == 3, F.when(oils, OILS).otherwise(TECHNOLOGY))
    )
    return F.when(F.col("pt_bwtar") == BOUGHT, bought).when(F.col("pt_bwtar") == OWN, OWN_SECTION)


def missing_quantity(stage_column: str = "potr_stad") -> Column:
    """Quantity still to be provided: open less available, 0 for an ordered item fully covered."""
    zero = F.lit(0).cast("decimal(18,2)")
    have = F.coalesce("rs_qty_avlb", zero)
    lacking = F.coalesce("pt_qty_open", zero) - have
    covered = have >= F.coalesce("pt_qty_res", zero)
    return F.when(F.col(stage_column) == STAGE_WITHOUT_ORDER, lacking).when(
        F.col(stage_column) == STAGE_WITH_ORDER, F.when(covered, zero).otherwise(lacking)
    )


def demand_view(
    demand: DataFrame,
    materials: DataFrame,
    warehouses: DataFrame,
    divisions: DataFrame,
    material_groups: DataFrame,
    division_pairs: DataFrame,
    reqstock: DataFrame,
) -> DataFrame:
    """The 38-column view. Lookups with several partners multiply the demand, as joins do.

    The demand is filtered before any join. The sums of the required stock are unique per reservation
    item, so that join cannot skew; the hot materials of the other joins are split by adaptive execution.
    """
    wanted = demand.where((F.col("pt_tech_data_type") == 1) & F.col("pt_bwtar").isin(BOUGHT, OWN))
    text = divisions.select("div_id", F.coalesce("div_id_full_txt", F.col("div_id").cast("string")).alias("text"))
    outer = text.select(F.col("div_id").alias("wm_o_divis"), F.col("text").alias("o_divis_txt"))
    inner = text.select(F.col("div_id").alias("wm_r_divis"), F.col("text").alias("r_divis_txt"))
    pairs = division_pairs.select(
        F.col("o_div_id").alias("wm_o_divis"), F.col("r_div_id").alias("wm_r_divis"), "or_div_txt"
    )
    places = warehouses.select(
        F.col("wm_lgort").alias("pt_lgort"), F.col("wm_werks").alias("pt_werks"), "wm_proizv", "wm_o_divis", "wm_r_divis"
    )
    goods = materials.select(
        F.col("mt_matnr").alias("pt_matnr"), F.col("mt_werks").alias("pt_werks"), "mt_matkl", "mt_cc_idtext", "mt_ekgrp", "mt_moni_gr"
    )
    groups = material_groups.select(F.col("mtg_matkl").alias("mt_matkl"), "mtg_cc_idtext")
    have = available(reqstock).withColumnsRenamed({"rs_rsnum": "pt_rsnum", "rs_rspos": "pt_rspos"})
    rows = (
        wanted.join(goods, ["pt_matnr", "pt_werks"])
        .join(places, ["pt_lgort", "pt_werks"], "left")
        .join(outer, "wm_o_divis", "left")
        .join(inner, "wm_r_divis", "left")
        .join(groups, "mt_matkl", "left")
        .join(pairs, ["wm_o_divis", "wm_r_divis"], "left")
        .join(have, ["pt_rsnum", "pt_rspos"], "left")
        .withColumn("potr_stad", stage())
        .withColumn("pt_section", section())
    )
    rows = rows.withColumn("sdp_qty", missing_quantity())
    price = F.try_divide(F.col("sdp_qty") * F.col("pt_fp01"), F.col("pt_qty_res")).cast("decimal(38,6)")
    rows = rows.withColumns({"sdp_amt": price, "sat_flag": F.lit(False), "pla_flag": F.lit(False)})
    return rows.select(*[F.col(RENAMED.get(c, c)).alias(c) for c in COLUMNS])

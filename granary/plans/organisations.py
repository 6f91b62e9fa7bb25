"""Organisation dimensions and facts from open-data tables.

Inputs are flat tables with short names: ``meta(ogrn, inn, region_code, okvad_code, okvad_name, okvad_vers)``,
``small(inn, region_code, region_type, region_name, okvad_code, okvad_name, okvad_vers)`` (the register of small
firms), and any number of ``names(name_org, inn)``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from granary.functions.numbers import number_or_null
from granary.operators.joins import grid_product, left_join_many
from granary.operators.rows import any_present, distinct_union, numbered, one_row_per_key
from granary.session import materialise


def organisation_names(sources: Sequence[DataFrame]) -> DataFrame:
    """Distinct ``name_org, inn`` of all name sources."""
    return distinct_union(*[s.select("name_org", "inn") for s in sources])


def _by_number(rows: DataFrame, key: str, pick=F.min) -> DataFrame:
    """The row of each key with the least (or, with ``F.max``, largest) ``row_num``; rows without a key all stay.

    Only numbers are grouped, by hash; the texts are not compared.
    """
    chosen = rows.where(F.col(key).isNotNull()).groupBy(key).agg(pick("row_num").alias("row_num")).select("row_num")
    return rows.join(chosen, "row_num", "left_semi").select(*rows.columns).unionAll(rows.where(F.col(key).isNull()))


def organisations(meta: DataFrame, sources: Sequence[DataFrame]) -> DataFrame:
    """One row per OGRN with INN, one name and a number.

    The rows are numbered before all but the first of an OGRN are dropped, so the numbers have gaps.
    """
    ids = meta.select("ogrn", "inn").distinct()
    names = materialise(organisation_names(sources), "names")
    named = left_join_many(ids, names, ["inn"]).distinct()
    order = ["ogrn", "inn", "name_org"]
    return _by_number(numbered(named.select(*order), order, "row_num"), "ogrn")


def industries(meta: DataFrame, small: DataFrame) -> DataFrame:
    """Distinct industry codes of both registers, numbered; the edition is text."""
    columns = ["okvad_code", "okvad_name", F.col("okvad_vers").cast("string").alias("okvad_vers")]
    rows = distinct_union(meta.select(*columns), small.select(*columns))
    return numbered(rows, ["okvad_code", "okvad_name", "okvad_vers"], "row_num")


def _region_names(small: DataFrame) -> DataFrame:
    return small.select("region_code", "region_type", "region_name").distinct()


def regions(meta: DataFrame, small: DataFrame) -> DataFrame:
    """One row per region code, the last of its names, numbered before the others are dropped."""
    codes = distinct_union(small.select("region_code"), meta.select("region_code"))
    named = codes.join(_region_names(small), "region_code", "left")
    order = ["region_code", "region_type", "region_name"]
    return _by_number(numbered(named.select(*order), order, "row_num"), "region_code", F.max)


def region_by_organisation(meta: DataFrame, small: DataFrame) -> DataFrame:
    """One region per INN, the last by code and name."""
    codes = distinct_union(small.select("region_code", "inn"), meta.select("region_code", "inn"))
    named = codes.join(_region_names(small), "region_code", "left")
    order = ["inn", "region_code", "region_type", "region_name"]
    return _by_number(numbered(named.select(*order), order, "row_num"), "inn", F.max)


def industry_by_organisation(meta: DataFrame) -> DataFrame:
    """One industry code per INN, the last by code."""
    rows = meta.select("inn", F.col("okvad_code").alias("okvad")).distinct()
    return one_row_per_key(rows, ["inn"], keep="last")


def _placed(dim: DataFrame, region_map: DataFrame, industry_map: DataFrame, region_dim: DataFrame, industry_dim: DataFrame) -> DataFrame:
    """Organisations with region and industry keys; the region name of the dimension is a code in text form.

    The maps hold one row per INN, so they are joined before the facts multiply the rows.
    """
    region_keys = region_dim.select(
        F.col("KEY").alias("region_id"), number_or_null(F.col("name")).alias("region_code")
    ).where(F.col("region_code").isNotNull())
    industry_keys = industry_dim.select(F.col("KEY").alias("okvad_id"), F.col("code").alias("okvad"))
    return (
        dim.select(F.col("KEY").alias("ogrn_id"), "inn")
        .join(region_map.select("inn", "region_code"), "inn", "left")
        .join(industry_map.select("inn", "okvad"), "inn", "left")
        .join(region_keys, "region_code", "left")
        .join(industry_keys, "okvad", "left")
        .select("ogrn_id", "inn", "region_id", "okvad_id")
    )


def company_facts(
    dim: DataFrame,
    taxes_paid: DataFrame,
    special_regimes: DataFrame,
    income: DataFrame,
    fines: DataFrame,
    staff: DataFrame,
    region_map: DataFrame,
    industry_map: DataFrame,
    region_dim: DataFrame,
    industry_dim: DataFrame,
) -> DataFrame:
    """Income, expenses, fines and staff per organisation, region and industry.

    Several rows of one organisation in several tables combine, as in the chain of left joins they come
    from. The first two tables give no column: only their row counts per INN are joined, and the rows are
    repeated after the filter.
    """
    rows = _placed(dim, region_map, industry_map, region_dim, industry_dim)
    times = F.lit(1).cast("bigint")
    for place, table in enumerate((taxes_paid, special_regimes)):
        partners = table.groupBy("inn").agg(F.count("*").alias(f"_times{place}"))
        rows = rows.join(partners, "inn", "left")
        times = times * F.coalesce(f"_times{place}", F.lit(1).cast("bigint"))
    rows = rows.select("inn", "ogrn_id", "region_id", "okvad_id", times.alias("_times"))
    measured = [income.select("inn", "income_75", "expenses_75"), fines.select("inn", "fine_78"), staff.select("inn", "employees_85")]
    rows = grid_product(rows, measured, "inn")
    measures = ["income_75", "expenses_75", "fine_78", "employees_85"]
    rows = rows.where(any_present(*[F.col(m) for m in measures]))
    repeated = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_times"))).alias("_n")
    return rows.select("ogrn_id", "region_id", "okvad_id", *measures, repeated).drop("_n")


def tax_facts(
    dim: DataFrame,
    paid: DataFrame,
    arrears: DataFrame,
    region_map: DataFrame,
    industry_map: DataFrame,
    region_dim: DataFrame,
    industry_dim: DataFrame,
    tax_dim: DataFrame,
) -> DataFrame:
    """Paid taxes and arrears per organisation, region, industry and tax name."""
    rows = _placed(dim, region_map, industry_map, region_dim, industry_dim)
    owed = ["nedo_nal", "peni", "shtraf", "sum_nedo"]
    rows = grid_product(rows, [paid.select("inn", "tax_name", "sum_nal"), arrears.select("inn", *owed)], "inn")
    rows = rows.where(any_present(*[F.col(m) for m in ["sum_nal", *owed]]))
    taxes = tax_dim.select(F.col("KEY").alias("nalog_id"), F.col("name").alias("tax_name"))
    rows = rows.join(taxes, "tax_name", "left")
    return rows.select("region_id", "ogrn_id", "nalog_id", "okvad_id", "sum_nal", *owed)


# Target names of the investment columns and the constant service mark.
INVESTMENT = {
    "otrasl": "Отрасль",
    "country": "Страна",
    "investingSum": "ОбщиеИнвестиции",
    "investing2021": "ВложенныеИнвестицииДо2021",
    "investing2022": "ЗапланированныеВ2022Инвестиции",
    "restInvesting": "ОстатокИнвестиций",
    "num": "Номер",
}


def investments(table: DataFrame) -> DataFrame:
    """Renamed investment columns and the constant service mark."""
    return table.select(*[F.col(source).alias(name) for name, source in INVESTMENT.items()], F.lit(1).alias("sluzhb"))

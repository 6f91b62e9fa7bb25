"""Headcount spreadsheets: dated wide files with one or two heading lines to long tables."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from granary.functions import text
from granary.functions.dates import dotted_date
from granary.functions.numbers import number_or_null, whole
from granary.operators import reshape
from granary.operators.keys import registered
from granary.operators.rows import numbered
from granary.sources import sinks
from granary.sources.records import data_records
from granary.sources.tables import lines, quoted_cells

# The ten text columns before the dated ones, as named in the long tables.
ID_COLUMNS = [
    "Головная (да нет)",
    "ИНН головной организации",
    "ОКПО",
    "Полное наименование организации",
    "ИНН",
    "ОГРН",
    "ОКФС",
    "ОКВЭД2",
    "Учредители акционеры",
    "Субъект Российской Федерации",
]
OWNERS, INDUSTRY, ORGANISATION = "Учредители акционеры", "ОКВЭД2", "Полное наименование организации"

# Ownership classes by phrase.
OWNERSHIP = [
    ("Россия(0.000%)", "Иностранная собственность"),
    ("Россия(100.000%)", "Российская собственность"),
]
JOINT_OWNERSHIP = "Совместная российская и иностранная собственность"

# Industry classes by code prefix.
INDUSTRIES = {
    "29.": "Производство автотранспортных средств, прицепов и полуприцепов",
    "47.": "Торговля розничная, кроме торговли автотранспортными средствами и мотоциклами",
    "56.": "Деятельность по предоставлению продуктов питания и напитков",
    "52.": "Складское хозяйство и вспомогательная транспортная деятельность",
    "30.": "Производство прочих транспортных средств и оборудования",
    "16.": "Обработка древесины и производство изделий из дерева и пробки, кроме мебели, производство изделий из соломки и материалов для плетения",
    "27.": "Производство электрического оборудования",
    "22.": "Производство резиновых и пластмассовых изделий",
    "25.": "Производство готовых металлических изделий, кроме машин и оборудования",
}
OTHER_INDUSTRY = "Другое"

PART1_MEASURES = ["value_total", "value_in", "value_out"]

# The measures of the second file and the heading text each is found under.
PART2_MEASURES = {
    "value_total_pfr": "ПФР",
    "value_total_prr": "РВР",
    "value_total_diff": "разница ПФР и РВР",
    "value_firing": "Работники к увольнению",
    "value_vacation": "Работники в отпуске",
    "value_rest": "Работники в простое",
    "value_parttime": "Работники неполный день",
    "value_distant": "Работники удаленно",
}
DATE_IN_NAME = re.compile(r"(\d{2})\.(\d{2})\.(\d{4})|(\d{4})-(\d{2})-(\d{2})")


def ownership_class(owners: Column) -> Column:
    return text.class_by_phrase(owners, OWNERSHIP, JOINT_OWNERSHIP)


def industry_class(code: Column) -> Column:
    return text.class_by_prefix(code, INDUSTRIES, OTHER_INDUSTRY)


def _heading(spark: SparkSession, path: str, count: int) -> list[str]:
    """The first lines of the file: the only rows that reach the driver."""
    return [row["str"] for row in lines(spark, path).head(count)]


def _names(cells: DataFrame) -> list[str]:
    return [row["name"] for row in cells.orderBy("pos").collect()]


def _one_row(spark: SparkSession, line: str) -> DataFrame:
    return spark.createDataFrame([("", line)], "file string, line string")


def _defect(line: Column, cells: int) -> Column:
    """Why a record cannot be split into its cells; NULL for a good one."""
    outside = F.regexp_replace(line, '"[^"]*"', "")
    found = F.length(outside) - F.length(F.replace(outside, F.lit(";"), F.lit(""))) + 1
    quotes = F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))
    return F.when(quotes % 2 == 1, "open quote").when(found > cells, "too many cells").when(found < cells, "too few cells")


def _unreadable(columns: Sequence[str], kind: str) -> Column:
    """True where a measure is written but is no number."""
    written = F.array(*[F.trim(F.col(f"`{c}`")) for c in columns]) if columns else F.array().cast("array<string>")
    return F.exists(written, lambda c: c.isNotNull() & (c != "") & number_or_null(c, kind).isNull())


def _split(rows: DataFrame, names: Sequence[str], measured: Sequence[str], kind: str) -> DataFrame:
    """The cells of each record under ``names``, the record itself as ``_line`` and what is wrong with it as ``_reason``."""
    wide = quoted_cells(rows, "str", names, keep="_line")
    reason = F.coalesce(_defect(F.col("_line"), len(names)), F.when(_unreadable(measured, kind), "not a number"))
    return wide.withColumn("_reason", reason)


def _measured(groups: dict[str, dict[str, str | None]]) -> list[str]:
    return sorted({c for columns in groups.values() for c in columns.values() if c is not None})


def one_line_groups(names: Sequence[str]) -> dict[str, dict[str, str | None]]:
    """Date → measure columns; a date without an in or out column keeps NULL there."""
    marks = (f"_{reshape.IN_MARK}", f"_{reshape.OUT_MARK}")
    dated = [n for n in names if not n.endswith((reshape.IN_MARK, reshape.OUT_MARK))]
    found = set(names)
    return {
        d: {
            "value_total": d,
            "value_in": d + marks[0] if d + marks[0] in found else None,
            "value_out": d + marks[1] if d + marks[1] in found else None,
        }
        for d in dated
    }


def two_line_groups(names: Sequence[str]) -> dict[str, dict[str, str | None]]:
    """Date → measure columns; a date that lacks any of the eight measures is dropped."""
    by_date: dict[str, dict[str, str | None]] = {}
    for name in names:
        date = DATE_IN_NAME.search(name)
        if date is None:
            continue
        d, m, y, iso_y, iso_m, iso_d = date.groups()
        key = f"{d or iso_d}.{m or iso_m}.{y or iso_y}"
        label = DATE_IN_NAME.sub("", name).strip(" _")
        for measure, phrase in PART2_MEASURES.items():
            if label == phrase:
                by_date.setdefault(key, {})[measure] = name
    return {key: columns for key, columns in by_date.items() if len(columns) == len(PART2_MEASURES)}


def rejected(wide: DataFrame) -> DataFrame:
    """``line, reason`` of the records that the readers leave out: an open quote, too many or too few cells, a measure that is no
    number."""
    return wide.where(F.col("_reason").isNotNull()).select(F.col("_line").alias("line"), F.col("_reason").alias("reason"))


def _one_line_cells(spark: SparkSession, path: str, heading_path: str | None) -> tuple[DataFrame, list[str]]:
    (header,) = _heading(spark, heading_path or path, 1)
    names = _names(reshape.one_line_names(reshape.heading_cells(_one_row(spark, header), "line")))
    wide = _split(data_records(spark, path, [header]), ID_COLUMNS + names[10:], _measured(one_line_groups(names[10:])), "int")
    # The heading rule also drops rows whose first cell is empty.
    return wide.where(F.col(f"`{ID_COLUMNS[0]}`").isNotNull() | F.col("_reason").isNotNull()), names


def read_one_line(spark: SparkSession, path: str, heading_path: str | None = None) -> DataFrame:
    """Headcount with a one-line heading: ten text columns, ``date`` and three counts.

    ``heading_path`` names the file that holds the heading when the data is split over many files. Lines that cannot be
    read whole are left out; :func:`rejects_of_one_line` returns them.
    """
    wide, names = _one_line_cells(spark, path, heading_path)
    return _long(wide.where(F.col("_reason").isNull()), one_line_groups(names[10:]), PART1_MEASURES, "int")


def rejects_of_one_line(spark: SparkSession, path: str, heading_path: str | None = None) -> DataFrame:
    return rejected(_one_line_cells(spark, path, heading_path)[0])


def _two_line_cells(spark: SparkSession, path: str, heading_path: str | None, skip: int) -> tuple[DataFrame, list[str]]:
    heading = _heading(spark, heading_path or path, skip)
    upper, lower = (reshape.heading_cells(_one_row(spark, line), "line") for line in heading[:2])
    names = _names(reshape.two_line_names(upper, lower))
    return _split(data_records(spark, path, heading), ID_COLUMNS + names[10:], _measured(two_line_groups(names[10:])), "decimal(38,6)"), names


def rejects_of_two_lines(spark: SparkSession, path: str, heading_path: str | None = None, skip: int = 3) -> DataFrame:
    return rejected(_two_line_cells(spark, path, heading_path, skip)[0])


def read_two_lines(spark: SparkSession, path: str, heading_path: str | None = None, skip: int = 3) -> DataFrame:
    """Headcount with a two-line heading: ten text columns, ``date`` and eight values.

    ``skip`` lines are no data: both heading lines and the line of units below them. Lines that cannot be read whole are
    left out; :func:`rejects_of_two_lines` returns them.
    """
    wide, names = _two_line_cells(spark, path, heading_path, skip)
    long = _long(wide.where(F.col("_reason").isNull()), two_line_groups(names[10:]), list(PART2_MEASURES), "decimal(38,6)")
    return long.withColumn("value_total_diff", whole(F.col("value_total_diff")))


def _long(wide: DataFrame, groups: dict, measures: Sequence[str], kind: str) -> DataFrame:
    long = reshape.wide_to_long(wide, [F.col(f"`{c}`") for c in ID_COLUMNS], groups, measures)
    typed = {m: number_or_null(F.trim(m), kind) for m in measures}
    return long.withColumns({"date": dotted_date(F.col("date")), **typed})


def classified(long: DataFrame, industry: bool = True) -> DataFrame:
    """Ownership and, where asked, industry classes in place of the raw texts."""
    df = long.withColumn(OWNERS, ownership_class(F.col(OWNERS)))
    return df.withColumn(INDUSTRY, industry_class(F.col(INDUSTRY))) if industry else df


def dictionary(df: DataFrame, column: str, extra: dict[str, str] | None = None) -> DataFrame:
    """Distinct values with ``KEY``, ``name``, ``ord`` and further columns of the group.

    The values are numbered in their natural order, without bringing them into one task.
    """
    columns = {"name": column, **(extra or {})}
    values = df.select(*[F.col(f"`{c}`").alias(n) for n, c in columns.items()]).distinct()
    keyed = numbered(values, list(columns), "KEY")
    return keyed.select("KEY", "name", F.col("KEY").alias("ord"), *(extra or {}))


def kept_dictionary(df: DataFrame, column: str, folder: str, extra: dict[str, str] | None = None) -> DataFrame:
    """As :func:`dictionary`, for a refill: a value keeps the ``KEY`` that the registry in ``folder`` has for it.

    ``ord`` is the place among the values of this refill, which changes when values come and go.
    """
    columns = {"name": column, **(extra or {})}
    keyed = registered(df.select(*[F.col(f"`{c}`").alias(n) for n, c in columns.items()]), folder)
    return numbered(keyed, list(columns), "ord").select("KEY", "name", "ord", *(extra or {}))


# The dictionaries, the column each lists, and the further columns of its group.
DICTIONARIES = {
    "t8646": ("Головная (да нет)", {}),
    "t8649": ("date", {}),
    "t8651": (ORGANISATION, {"head_inn": "ИНН головной организации", "okpo": "ОКПО", "inn": "ИНН", "ogrn": "ОГРН"}),
    "t8653": (INDUSTRY, {}),
    "t8655": ("ОКФС", {}),
    "t8657": ("Субъект Российской Федерации", {}),
    "t8659": (OWNERS, {}),
}


def dictionary_of(long: DataFrame, name: str) -> DataFrame:
    """One of the dictionaries; the industry dictionary lists classes, not codes."""
    column, extra = DICTIONARIES[name]
    return dictionary(classified(long) if column == INDUSTRY else long, column, extra)


def refresh_dictionaries(long: DataFrame, folder: str, industries: DataFrame | None = None) -> None:
    """Refill all dictionaries; ``industries`` is the table the industry codes are read from, if another one."""
    for name, (column, _) in DICTIONARIES.items():
        source = industries if industries is not None and column == INDUSTRY else long
        sinks.replace(dictionary_of(source, name), f"{folder}/{name}")


def daily_totals(long: DataFrame) -> DataFrame:
    """Total, in and out per date."""
    sums = [F.sum(m).alias(m) for m in PART1_MEASURES]
    return long.groupBy("date").agg(*sums).orderBy("date")

"""Headcount files with the heading inside the file, missing columns, a byte-order mark and quoted cells."""

import csv
import datetime as dt
import io
import random

import pytest

from granary.plans import headcount as plan
from granary.sources.records import data_records
from granary.sources.tables import quoted_cells

IDS = ["Головная (данет)", "ИНН головной организации", "ОКПО", "Полное наименование организации", "ИНН", "ОГРН", "ОКФС", "ОКВЭД2",
       "Учредители/акционеры (доля участия)", "Субъект Российской Федерации"]


def firm(head, name, owners, code="29.10"):
    return f'{head};7;K;"{name}";77;G;16;{code};{owners};Тула'


def test_one_line_heading(spark, tmp_path):
    heading = ";".join([*IDS, "01.02.2022", " принято ", "уволено", "01.03.2022", "01.04.2022", "принято"])
    data = [
        firm("да", 'ООО ""А; Б""', "Россия(100.000%)") + ";10;2;1;11;12;3",
        firm("", "без головной", "") + ";1;1;1;1;1;1",
        firm("нет", "В", '"Россия(0.000%); Китай(100.000%)"', "99.1") + ";;;0;7;;4",
        firm("да", "Г", "") + ";;x;0;7;;4",
        firm("да", "Д", "") + ";1;2;3",
        firm("да", "Е", "") + ";1;1;1;1;1;1;1",
        'да;7;K;"Ж',
        'з";77;G;16;29.10;;Тула;1;1;1;1;1;1',
    ]
    path = tmp_path / "1.csv"
    path.write_text("\n".join([heading, *data]) + "\n", encoding="utf-8")
    long = plan.read_one_line(spark, str(path))
    name = plan.ORGANISATION
    got = {(r["Головная (да нет)"], r["date"]): (r["value_total"], r["value_in"], r["value_out"]) for r in long.collect() if r[name] != "Ж\nз"}
    # A line break inside quotes belongs to the cell.
    broken = [(r["date"], r["value_total"], r["value_in"], r["value_out"]) for r in long.collect() if r[name] == "Ж\nз"]
    assert sorted(broken) == [(dt.date(2022, 2, 1), 1, 1, 1), (dt.date(2022, 3, 1), 1, None, None), (dt.date(2022, 4, 1), 1, 1, None)]
    feb, mar, apr = (dt.date(2022, m, 1) for m in (2, 3, 4))
    assert got == {
        ("да", feb): (10, 2, 1), ("да", mar): (11, None, None), ("да", apr): (12, 3, None),
        ("нет", feb): (None, None, 0), ("нет", mar): (7, None, None), ("нет", apr): (None, 4, None),
    }
    reasons = [r["reason"] for r in plan.rejects_of_one_line(spark, str(path)).collect()]
    assert sorted(reasons) == ["not a number", "too few cells", "too many cells"]
    assert {r[plan.ORGANISATION] for r in long.collect()} == {'ООО "А; Б"', "В", "Ж\nз"}
    classes = {(r["Головная (да нет)"], r[plan.OWNERS], r[plan.INDUSTRY]) for r in plan.classified(long).collect()}
    assert classes == {
        ("да", "Российская собственность", plan.INDUSTRIES["29."]), ("нет", "Иностранная собственность", "Другое"),
        ("да", plan.JOINT_OWNERSHIP, plan.INDUSTRIES["29."]),
    }


@pytest.mark.parametrize("split", [None, 40, 300])
def test_records_over_line_breaks(spark, tmp_path, split):
    """Random quoted cells with line breaks against Python's csv module, in splits of any size; a stray quote costs its own line."""
    pick = random.Random(split or 1)
    rows = [[pick.choice(["a", "b;c", 'd"e', "f\ng", "h\n\ni;\n", "", "j k"]) for _ in range(4)] for _ in range(120)]
    for number, stray in ((1, False), (2, True)):
        text = io.StringIO()
        csv.writer(text, delimiter=";", quoting=csv.QUOTE_ALL, lineterminator="\n").writerows(rows)
        tail = 'x;"y;z\nlast;1;2;3\n' if stray else ""
        (tmp_path / f"{number}.csv").write_text("one;two;three;four\n" + text.getvalue() + tail, encoding="utf-8")
    kept = [spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")]
    if split:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        records = [r["str"] for r in data_records(spark, str(tmp_path), ["one;two;three;four"]).collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept[0])
        spark.conf.set("spark.sql.files.openCostInBytes", kept[1])
    got = sorted(next(csv.reader(io.StringIO(r), delimiter=";")) for r in records if r not in ('x;"y;z', "last;1;2;3"))
    assert got == sorted(rows * 2) and len(records) == 242
    cells = quoted_cells(spark.createDataFrame([(r,) for r in records], "str string"), "str", list("abcd"))
    assert sorted(tuple(v or "" for v in r) for r in cells.collect() if r[0] not in ("x", "last")) == sorted(map(tuple, rows * 2))


def test_far_apart_quotes_are_strays(spark, tmp_path):
    (tmp_path / "1.csv").write_text('h\na;"b\n' + "c;d\n" * 30 + 'e";f\n', encoding="utf-8")
    got = [r["str"] for r in data_records(spark, str(tmp_path), ["h"], most_lines=10).collect()]
    assert sorted(got) == sorted(['a;"b', *["c;d"] * 30, 'e";f'])
    assert data_records(spark, str(tmp_path), ["h"]).count() == 1


def test_heading_lines_go_by_their_place(spark, tmp_path):
    heading = ";".join([*IDS, "01.02.2022"])
    path = tmp_path / "1.csv"
    path.write_text("\n".join([heading, firm("да", "А", "") + ";1", heading]) + "\n", encoding="utf-8")
    with pytest.raises(ValueError, match="2 lines equal a heading line where 1 are expected"):
        plan.read_one_line(spark, str(path))


def test_null_owner_and_code_fall_to_the_last_class(spark):
    df = spark.createDataFrame([(None, None)], f"`{plan.OWNERS}` string, `{plan.INDUSTRY}` string")
    assert tuple(plan.classified(df).first()) == (plan.JOINT_OWNERSHIP, plan.OTHER_INDUSTRY)


def test_two_line_heading(spark, tmp_path):
    phrases = list(plan.reshape.SHORT_MEASURES)
    upper = ["﻿", *[""] * 9, "Численность работников предприятия, чел.", "", "", "", "", ""]
    lower = [*IDS, "01.02.2022 ПФР", "01.02.2022 РВР", "разница ПФР и РВР", "01.03.2022 ПФР", "01.03.2022 РВР", "разница ПФР и РВР"]
    for phrase in phrases:
        kept = ["2022-02-01", "2022-03-01"] if phrase != phrases[-1] else ["2022-02-01"]
        upper += [phrase, *[""] * (len(kept) - 1)]
        lower += kept
    cells = ["100.5", "98", "2.5", "7", "6", "1", "1", "2", "3", "4", "5", "6", "7", "8", "9"]
    lines = [";".join(upper), ";".join(lower), ";".join(str(i) for i in range(len(lower))), firm("да", "А", "Россия(1.000%)") + ";" + ";".join(cells)]
    path = tmp_path / "2.csv"
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    (row,) = plan.read_two_lines(spark, str(path)).collect()
    # March lacks the last measure and is dropped; the difference is rounded half away from zero.
    assert row["date"] == dt.date(2022, 2, 1)
    values = [row[m] for m in plan.PART2_MEASURES]
    assert [float(v) for v in values] == [100.5, 98.0, 3.0, 1.0, 3.0, 5.0, 7.0, 9.0]


def test_dictionaries_number_every_value(spark):
    rows = [(None,), ("b",), ("a",), ("b",)]
    df = spark.createDataFrame(rows, "`Субъект Российской Федерации` string")
    got = plan.dictionary(df, "Субъект Российской Федерации").orderBy("KEY").collect()
    assert [tuple(r) for r in got] == [(1, None, 1), (2, "a", 2), (3, "b", 3)]


def test_all_dictionaries_are_refilled(spark, tmp_path):
    names = [*plan.ID_COLUMNS, "date"]
    row = ["да", "7", "K", "А", "77", "G", "16", "29.10", "x", "Тула", dt.date(2022, 1, 1)]
    long = spark.createDataFrame([tuple(row), tuple(row)], ", ".join(f"`{n}` {'date' if n == 'date' else 'string'}" for n in names))
    for _ in range(2):
        plan.refresh_dictionaries(long, str(tmp_path))
    got = {n: spark.read.parquet(str(tmp_path / n)).collect() for n in plan.DICTIONARIES}
    assert all(len(rows) == 1 and rows[0]["KEY"] == 1 for rows in got.values())
    assert got["t8651"][0].asDict() == {"KEY": 1, "name": "А", "ord": 1, "head_inn": "7", "okpo": "K", "inn": "77", "ogrn": "G"}
    assert got["t8653"][0]["name"] == plan.INDUSTRIES["29."]


LINES = "file string, pos int, cell string"


def _shuffles(df):
    plan_ = df._jdf.queryExecution().executedPlan().toString()
    return plan_.count("Exchange hashpartitioning"), plan_


def test_two_line_names_move_lines_and_not_cells(spark):
    difference = plan.reshape.DIFFERENCE
    lower = [("a", 1, "x"), ("a", 2, difference), ("a", 3, None), ("a", 4, "w\0\1N"), ("b", 1, "p"), ("b", 1, "p"), ("c", 2, "abcdefghijkl"), ("c", 1, "y"), ("c", 3, difference)]
    upper = [("a", 1, ""), ("a", 2, "U"), ("a", 3, ""), ("a", 4, "﻿"), ("b", 1, "V"), ("b", 2, ""), ("c", 1, "S"), ("c", 3, ""), ("c", 2, ""), (None, 1, "n")]
    got = plan.reshape.two_line_names(*[spark.createDataFrame(rows, LINES).coalesce(1) for rows in (upper, lower)])
    expected = [
        ("a", 1, "x"), ("a", 2, f"x_{difference} U"), ("a", 3, None), ("a", 4, "w\0\1N"), ("b", 1, "p V"), ("b", 1, "p V"),
        ("c", 1, "y S"), ("c", 2, "abcdefghijkl S"), ("c", 3, f"abcdefghij_{difference} S"),
    ]
    count, text = _shuffles(got)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(expected, key=str)
    assert count == 2 and text.count("MapInArrow") == 2 and "Window" not in text


def test_joined_names_move_lines_and_not_cells(spark):
    cells = [("a", 2, "y"), ("a", 1, "x"), ("a", 4, None), ("a", 5, "z\0\1"), (None, 1, "n"), ("b", 1, ""), ("b", 2, "q"), ("b", 2, "p")]
    got = plan.reshape.joined_names(spark.createDataFrame(cells, LINES).coalesce(1).withColumnRenamed("cell", "name"))
    count, text = _shuffles(got)
    assert sorted(map(tuple, got.collect()), key=str) == sorted([("a", "x,y,z\0\1"), (None, "n"), ("b", ",p,q")], key=str)
    # What is shuffled are texts of several cells; no array of cells is gathered before.
    before = text[text.index("Exchange hashpartitioning") :]
    assert count == 1 and "MapInArrow" in before and "collect_list" not in before

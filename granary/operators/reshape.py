"""Dated spreadsheet headings and the wide-to-long step.

A heading is one or two lines of ``;``-separated cells. The heading functions work on DataFrames with
one row per file, so that many files with different headings can be read in one plan; a heading has
a few dozen cells, so a window over the cells of one file is small whatever the size of the data.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from granary.functions import text

IN_MARK, OUT_MARK = "принято", "уволено"

# The difference measure and the cells of the upper heading line that count as empty.
DIFFERENCE = "разница ПФР и РВР"
EMPTY_CELLS = ["\ufeff", "Численность работников предприятия, чел."]

# Long measure phrases and their short names.
SHORT_MEASURES = {
    "Численность работников, предполагаемых к увольнению, чел": "Работники к увольнению",
    "Численность работников, находящихся в отпусках без сохранения платы, чел": "Работники в отпуске",
    "Численность работников, находящихся в простое, чел": "Работники в простое",
    "Численность работников, работающих неполный рабочий день, чел": "Работники неполный день",
    "Численность работников, работающих на удаленной работе, чел": "Работники удаленно",
}


def heading_cells(lines: DataFrame, line: str, file: str = "file", separator: str = ";") -> DataFrame:
    """One row per cell of a heading line: ``file``, ``pos`` from 1, trimmed ``cell``."""
    cells = F.posexplode(F.split(F.col(line), separator)).alias("pos", "cell")
    return lines.select(file, cells).select(file, (F.col("pos") + 1).alias("pos"), F.trim("cell").alias("cell"))


def filled_forward(cells: DataFrame, file: str = "file") -> DataFrame:
    """Merged cells: an empty cell takes the text of the last filled cell before it.

    ``block`` counts the filled cells so far; ``filled`` is the first text of the block.
    """
    so_far = Window.partitionBy(file).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    block = F.count(F.when(F.col("cell") != "", 1)).over(so_far)
    first = F.first("cell").over(Window.partitionBy(file, "block").orderBy("pos"))
    return cells.withColumn("block", block).withColumn("filled", first)


def one_line_names(cells: DataFrame, file: str = "file") -> DataFrame:
    """Names of a one-line heading: the in and out columns take the date one or two cells before."""
    order = Window.partitionBy(file).orderBy("pos")
    owner = F.when(F.col("cell") == IN_MARK, F.lag("cell", 1).over(order)).when(
        F.col("cell") == OUT_MARK, F.lag("cell", 2).over(order)
    )
    return cells.select(file, "pos", F.concat(F.coalesce(F.concat(owner, F.lit("_")), F.lit("")), "cell").alias("name"))


# A line on its way between tasks: its cells in one text, with marks for the end of a cell, for these marks in a cell and for NULL.
_END, _MARK = "\0", "\1"
_NULL, _ESCAPED_END, _ESCAPED_MARK = f"{_MARK}N", f"{_MARK}\3", f"{_MARK}\2"


def _runs():
    """Cells ``file, pos, cell`` that follow each other in one row: the place of the first one, their number and texts.

    The function is made here, so that it travels whole and tasks need no module of this package.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            file, pos, cell = batch.columns
            if cell.null_count or pc.any(pc.match_substring_regex(cell, f"[{_END}{_MARK}]")).as_py():
                cell = pc.replace_substring(pc.replace_substring(cell, _MARK, _ESCAPED_MARK), _END, _ESCAPED_END).fill_null(_NULL)
            new = np.ones(batch.num_rows, bool)
            place = pos.fill_null(0).to_numpy(zero_copy_only=False)
            known = pos.is_valid().to_numpy(zero_copy_only=False)
            same = pc.equal(file[1:], file[:-1]).fill_null(False).to_numpy(zero_copy_only=False)
            new[1:] = ~same | (np.diff(place) != 1) | ~known[1:] | ~known[:-1]
            first = np.flatnonzero(new)
            lines = pa.ListArray.from_arrays(pa.array(np.append(first, len(new)), pa.int32()), cell)
            yield pa.RecordBatch.from_arrays([file.take(pa.array(first)), pos.take(pa.array(first)), pa.array(np.diff(np.append(first, len(new))), pa.int32()), pc.binary_join(lines, _END)], names=["file", "pos", "n", "cell"])

    return run


def _lines(cells: DataFrame, file: str, cell: str) -> DataFrame:
    """One row per file: ``runs``, an array of ``pos, n, cell`` in this order, and whether they lie ``apart`` (no place twice or NULL).

    The cells of a line mostly follow each other already, so they are put together before the shuffle: a file moves as a
    few texts, without a row or a number for each cell.
    """
    kinds = dict(cells.dtypes)
    runs = cells.select(file, "pos", cell).mapInArrow(_runs(), f"`{file}` {kinds[file]}, pos {kinds['pos']}, n int, cell string")
    # Runs leave for their file as they are; gathering them before the shuffle would hold and sort a task's whole input.
    lines = runs.repartition(file).groupBy(file).agg(F.array_sort(F.collect_list(F.struct("pos", "n", "cell"))).alias("runs"))
    follows = F.zip_with("runs", F.slice("runs", F.lit(2), F.size("runs")), lambda r, s: F.when(s.isNull(), True).otherwise(F.coalesce(r["pos"] + r["n"] <= s["pos"], F.lit(False))))
    return lines.withColumn("apart", F.element_at("runs", 1)["pos"].isNotNull() & F.forall(follows, lambda x: x))


def _cells(runs: str, apart: str, kind: str) -> Column:
    """The array of ``pos, cell`` in this order."""

    def plain(c: Column) -> Column:
        return F.when(c != _NULL, F.replace(F.replace(c, F.lit(_ESCAPED_END), F.lit(_END)), F.lit(_ESCAPED_MARK), F.lit(_MARK)))

    def unfolded(run: Column, read) -> Column:
        return F.transform(F.split(run["cell"], _END), lambda c, i: F.struct((run["pos"] + i).cast(kind).alias("pos"), read(c).alias("cell")))

    together = F.flatten(F.transform(runs, lambda r: F.when(F.contains(r["cell"], F.lit(_MARK)), unfolded(r, plain)).otherwise(unfolded(r, lambda c: c))))
    return F.when(F.col(apart), together).otherwise(F.array_sort(together))


def _shifted(array: Column, before: Column) -> Column:
    """For each element the one before it; ``before`` for the first."""
    return F.concat(F.array(before), F.slice(array, F.lit(1), F.size(array) - 1))


def _stretches(array: Column, begins: Column, value) -> Column:
    """``array`` cut where ``begins`` is true (always at its first element): ``value(first element, elements)`` of each part."""
    first = F.filter(F.zip_with(F.transform(array, lambda x, i: F.struct(i.alias("at"), x.alias("x"))), begins, lambda x, b: F.struct(x["at"].alias("at"), x["x"].alias("x"), b.alias("b"))), lambda x: (x["at"] == 0) | x["b"])
    after = F.concat(F.slice(F.transform(first, lambda x: x["at"]), F.lit(2), F.size(first)), F.array(F.size(array)))
    return F.zip_with(first, after, value)


def two_line_names(upper: DataFrame, lower: DataFrame, file: str = "file") -> DataFrame:
    """Names of a two-line heading: lower cell, then the upper cell carried over merged columns.

    Lines move, not cells: one shuffle of each line's text, and the rest is done inside the row of a file.
    """
    lines = _lines(lower, file, "cell").withColumnsRenamed({"runs": "below", "apart": "below_apart"})
    both = lines.join(_lines(upper, file, "cell").withColumnsRenamed({"runs": "above", "apart": "above_apart"}), file)
    read = [_cells(c, f"{c}_apart", dict(df.dtypes)["pos"]).alias(c) for c, df in (("below", lower), ("above", upper))]
    both = both.select(file, *read, "below_apart", "above_apart")

    previous = _shifted(F.transform("below", lambda c: c["cell"]), F.lit(None).cast("string"))

    def with_owner(c: Column, before: Column) -> Column:
        owned = F.concat(F.substring(before, 1, 10), F.lit("_"), c["cell"])
        return F.struct(c["pos"].alias("pos"), F.when(c["cell"].like(DIFFERENCE) & before.isNotNull(), owned).otherwise(c["cell"]).alias("name"))

    marked = F.zip_with("below", previous, with_owner)
    filled = _stretches(F.col("above"), F.transform("above", lambda c: c["cell"] != ""), lambda f, after: F.array_repeat(text.blank_if(f["x"]["cell"], EMPTY_CELLS), after - f["at"]))
    carried = F.zip_with("above", F.flatten(filled), lambda c, x: F.struct(c["pos"].alias("pos"), x.alias("name")))
    known = lambda apart, cells: F.when(F.col(apart), cells).otherwise(F.filter(cells, lambda c: c["pos"].isNotNull()))
    usual = (F.col("below_apart") & F.col("above_apart")).alias("usual")
    both = both.select(file, known("below_apart", marked).alias("below"), known("above_apart", carried).alias("above"), usual)

    def named(pos: Column, below: Column, above: Column) -> Column:
        name = F.when(above == "", below).otherwise(F.concat(below, F.lit(" "), above))
        # A shorter name holds none of the phrases.
        long = F.length(name) >= min(map(len, SHORT_MEASURES))
        return F.struct(pos.alias("pos"), F.when(long, text.renamed_phrases(name, SHORT_MEASURES)).otherwise(name).alias("name"))

    # The usual case: both lines have the same places, each once. Otherwise every two cells of a place are put together.
    usual = F.col("usual") & (F.transform("below", lambda c: c["pos"]) == F.transform("above", lambda c: c["pos"]))
    plain = F.zip_with("below", "above", lambda b, a: named(b["pos"], b["name"], a["name"]))
    sided = [F.transform(c, lambda x: F.struct(x["pos"].alias("pos"), F.lit(k).alias("side"), x["name"].alias("name"))) for k, c in enumerate(("below", "above"))]
    both = both.select(file, F.when(usual, plain).alias("plain"), F.when(~usual, F.array_sort(F.concat(*sided))).alias("mixed"))
    begins = F.zip_with("mixed", _shifted(F.transform("mixed", lambda c: c["pos"]), F.element_at("mixed", 1)["pos"]), lambda c, p: c["pos"] != p)
    groups = _stretches(F.col("mixed"), begins, lambda f, after: F.slice("mixed", f["at"] + 1, after - f["at"]))
    side = lambda group, k: F.filter(group, lambda c: c["side"] == k)
    pairs = F.transform(groups, lambda g: F.flatten(F.transform(side(g, 0), lambda b: F.transform(side(g, 1), lambda a: named(b["pos"], b["name"], a["name"])))))
    return both.select(file, F.inline(F.when(F.col("mixed").isNull(), F.col("plain")).when(F.size("mixed") > 0, F.flatten(pairs))))


def joined_names(names: DataFrame, file: str = "file", separator: str = ",") -> DataFrame:
    """All names of a file in one text, in column order."""
    ready = F.col("apart") & ~F.exists("runs", lambda r: F.contains(r["cell"], F.lit(_MARK)))
    texts = F.transform("runs", lambda r: F.replace(r["cell"], F.lit(_END), F.lit(separator)))
    cells = F.transform(_cells("runs", "apart", dict(names.dtypes)["pos"]), lambda c: c["cell"])
    return _lines(names, file, "name").select(file, F.array_join(F.when(ready, texts).otherwise(cells), separator).alias("names"))


def wide_to_long(
    df: DataFrame,
    ids: Sequence[str | Column],
    groups: Mapping[str, Mapping[str, str | None]],
    measures: Sequence[str],
    label: str = "date",
) -> DataFrame:
    """One row per input row and group; ``groups`` maps a date to its measure columns.

    A measure without a column becomes NULL. The row is unfolded from an array of structs, a narrow
    step with no shuffle.
    """
    def cell(columns: Mapping[str, str | None], measure: str) -> Column:
        name = columns.get(measure)
        value = F.lit(None).cast("string") if name is None else F.col(f"`{name}`")
        return value.alias(measure)

    unfolded = F.array(
        *[F.struct(F.lit(key).alias(label), *[cell(columns, m) for m in measures]) for key, columns in groups.items()]
    )
    return df.select(*ids, F.inline(unfolded))

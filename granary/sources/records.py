"""Records of delimited text whose quoted cells may hold line breaks, from files of any number of splits.

A split does not know whether it begins inside quotes. So the lines with an odd number of quotes are counted per split, the
counts before a split tell how it begins, and only splits that hold such lines or lie between them are looked at line by line;
all other lines are records as they are. The lines between an odd one and the next belong to one record, also across the seam
of two splits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from granary.session import materialise
from granary.sources.tables import lines

#: A record of more lines is taken for a stray quote: each of its lines is then judged by itself.
MOST_LINES = 1000
SPLIT = ["file", "block"]


def _odd(line: str, quote: str) -> Column:
    return (F.length(line) - F.length(F.replace(F.col(line), F.lit(quote), F.lit("")))) % 2 == 1


def placed_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines ``str`` with the file, the place where their split begins in it, and an order inside the split."""
    return lines(spark, path).select(
        "str", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("pos")
    )


def data_records(spark: SparkSession, path: str, heading: Sequence[str], quote: str = '"', most_lines: int = MOST_LINES) -> DataFrame:
    """Records ``str`` of all lines but the heading; the line breaks inside a record stay.

    Heading lines go by their place: only those in the split that begins a file are left out, and a file must give all of
    them or none. A line with the text of a heading further down is data. An odd line that none follows is a record as it is.
    """
    rows = placed_lines(spark, path)
    is_heading = (F.col("block") == 0) & F.col("str").isin(*heading)
    splits = rows.groupBy(*SPLIT).agg(F.count_if(is_heading).alias("heads"), F.count_if(_odd("str", quote)).alias("odd"))
    splits = materialise(splits, "splits")
    heads = splits.groupBy("file").agg(F.sum("heads").alias("n"))
    wrong = heads.where((F.col("n") > 0) & (F.col("n") != len(heading))).limit(1).collect()
    if wrong:
        raise ValueError(f"{wrong[0]['file']}: {wrong[0]['n']} lines equal a heading line where {len(heading)} are expected")
    data = rows.where(~is_heading)
    if splits.where("odd > 0").isEmpty():
        return data.select("str")
    file = Window.partitionBy("file")
    before = F.coalesce(F.sum("odd").over(file.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counted = splits.select(*SPLIT, "odd", before.alias("before"), F.sum("odd").over(file).alias("total"))
    # Odd lines go in pairs; one without a partner is the last of its file and pairs with nothing.
    paired = F.col("total") - F.col("total") % 2
    inside = F.least("before", paired) % 2 == 1
    noisy = counted.where((F.col("odd") > 0) | inside).drop("odd")
    calm = data.join(noisy, SPLIT, "left_anti").select("str")
    order = Window.partitionBy(*SPLIT).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    looked = data.join(noisy, SPLIT).withColumn("so_far", F.col("before") + F.sum(_odd("str", quote).cast("int")).over(order))
    so_far = F.least("so_far", paired)
    turns = _odd("str", quote) & (F.col("so_far") <= paired)
    record = F.when((so_far % 2 == 1) | turns, F.ceil(so_far / 2))
    looked = materialise(looked.select("str", *SPLIT, "pos", record.alias("record")), "lines")
    alone = looked.where(F.col("record").isNull()).select("str")
    several = looked.where(F.col("record").isNotNull())
    sizes = several.groupBy("file", "record").agg((F.count("*") > most_lines).alias("stray"))
    several = several.join(sizes, ["file", "record"])
    ordered = F.array_sort(F.collect_list(F.struct("block", "pos", "str")))
    joined = several.where(~F.col("stray")).groupBy("file", "record").agg(F.array_join(F.transform(ordered, lambda x: x["str"]), "\n").alias("str"))
    return calm.unionAll(alone).unionAll(joined.select("str")).unionAll(several.where("stray").select("str"))

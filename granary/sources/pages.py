"""Paged extracts of a source."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from granary.operators.rows import numbered
from granary.session import materialise_counted

#: Rows of a key range of an indexed extract.
RANGE = 1 << 20


def page(df: DataFrame, key: str, skip: int, top: int) -> DataFrame:
    """One page in key order. Only for looking at a page: every call sorts up to the page's end."""
    return df.orderBy(key).offset(skip).limit(top)


def extract(df: DataFrame, predicate: Column, columns: Sequence[str]) -> DataFrame:
    """Filter and column list of the source, both pushed into the scan."""
    return df.where(predicate).select(*columns)


def extract_size(df: DataFrame, predicate: Column) -> DataFrame:
    """Row count of the filtered source, the same set that is paged."""
    return df.where(predicate).agg(F.count("*").alias("row_count"))


def paged(df: DataFrame, key: str, size: int) -> DataFrame:
    """All pages in one pass: ``page_no`` from 0 by position in key order."""
    places = numbered(df, [key], "_row", start=0)
    return places.withColumn("page_no", F.floor(F.col("_row") / size).cast("bigint")).drop("_row")


def write_ranges(df: DataFrame, order: Sequence[str], path: str, rows_per_range: int = RANGE) -> None:
    """Write an extract in key ranges of about ``rows_per_range`` rows, and the fences: where each range begins.

    ``order`` must tell the rows apart, else equal rows may change places between pages. One range sort of the extract; the
    fences are one row per range, told from the written rows, so they fit whatever the ranges turned out to be.
    """
    extract, count = materialise_counted(df, "extract")
    ranges = max(1, -(-count // rows_per_range))
    placed = extract.repartitionByRange(ranges, *order).withColumn("range", F.spark_partition_id())
    placed.write.partitionBy("range").parquet(f"{path}/rows")
    written = extract.sparkSession.read.schema(placed.schema).parquet(f"{path}/rows")
    sizes = written.groupBy("range").agg(F.count("*").alias("rows"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    fences = sizes.select("range", "rows", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("before"))
    fences.write.parquet(f"{path}/fences")
    extract.sparkSession.createDataFrame([], extract.schema).write.parquet(f"{path}/schema")


def ranges_of_page(spark: SparkSession, path: str, skip: int, top: int) -> list[tuple[int, int]]:
    """``(range, rows before it)`` of the ranges a page lies in: one or two, as long as a page is smaller than a range."""
    met = (F.col("before") < skip + top) & (F.col("before") + F.col("rows") > skip)
    found = spark.read.parquet(f"{path}/fences").where(met).select("range", "before").collect()
    return sorted((r["range"], r["before"]) for r in found)


def indexed_page(spark: SparkSession, path: str, order: Sequence[str], skip: int, top: int) -> DataFrame:
    """A page of an extract written by :func:`write_ranges`: only the ranges it lies in are read and sorted.

    The page after the last row is empty.
    """
    ranges = ranges_of_page(spark, path, skip, top)
    schema = spark.read.parquet(f"{path}/schema").schema
    if not ranges:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).parquet(*[f"{path}/rows/range={r}" for r, _ in ranges])
    return rows.orderBy(*order).offset(skip - ranges[0][1]).limit(top)


def indexed_size(spark: SparkSession, path: str) -> int:
    """Rows of an indexed extract, told by its fences."""
    return spark.read.parquet(f"{path}/fences").agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]

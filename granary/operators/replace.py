"""Table changes as new tables: replace a slice, replace groups, drop a batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def replace_slice(table: DataFrame, fresh: DataFrame, in_slice: Column) -> DataFrame:
    """The rows of ``table`` outside the slice, plus ``fresh``."""
    return table.where(~F.coalesce(in_slice, F.lit(False))).unionByName(fresh)


def without_keys(table: DataFrame, keyed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Delete the rows whose key occurs in ``keyed``; rows with a NULL key stay."""
    return table.join(keyed.select(*keys).distinct(), list(keys), "left_anti")


def replace_groups(table: DataFrame, fresh: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Replace every group of ``table`` that occurs in ``fresh`` by its rows in ``fresh``."""
    return without_keys(table, fresh, keys).unionByName(fresh.select(*table.columns))


def without_batch(table: DataFrame, column: str, value) -> DataFrame:
    """Delete one consumed batch; rows that name no batch stay."""
    return table.where(~F.coalesce(F.col(column) == F.lit(value), F.lit(False)))


def overwrite_partitions(df: DataFrame, path: str, column: str, values: Sequence | None = None) -> None:
    """Replace the partitions of ``column`` held by ``df``, without reading the rest of the table.

    ``values`` lists the partitions asked for; one that gets no rows is emptied too, as a delete
    followed by an insert of nothing would leave it. Rows are gathered by partition before writing, and
    adaptive execution splits a partition that is too large for one task, so there are neither many small
    files nor one huge writer.
    """
    df.hint("rebalance", column).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path)
    if values is None:
        return
    # Only the partitions asked for are looked up, at most as many as there are values.
    written = {row[0] for row in df.where(F.col(column).isin(list(values))).select(column).distinct().collect()}
    for value in values:
        if value not in written:
            nothing = df.where(F.lit(False)).drop(column)
            nothing.write.mode("overwrite").parquet(f"{path}/{column}={value}")


def read_partitions(spark: SparkSession, path: str, schema) -> DataFrame:
    """Read a table written by :func:`overwrite_partitions` with its full schema."""
    return spark.read.schema(schema).parquet(path)

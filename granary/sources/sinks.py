"""Append, replace, refresh and create-as sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def replace(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def refresh(view: DataFrame, path: str, columns: Sequence[str]) -> None:
    """Refill a mart from a view with an explicit column list."""
    view.select(*columns).write.mode("overwrite").parquet(path)


def create_as(df: DataFrame, table: str, path: str | None = None) -> None:
    """Create a catalogue table from a query; a ``path`` keeps its files outside the warehouse."""
    writer = df.write.mode("overwrite").format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(table)


def named_view(df: DataFrame, name: str, columns: Sequence[str]) -> DataFrame:
    """Register ``df`` as a view with the given output names."""
    renamed = df.toDF(*columns)
    renamed.createOrReplaceTempView(name)
    return renamed

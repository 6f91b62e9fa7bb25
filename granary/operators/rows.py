"""Row-set operators: distinct unions, one row per key, dense numbering."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from granary.session import materialise


def distinct_union(*frames: DataFrame) -> DataFrame:
    """Union by column name that keeps each row once, also within one input."""
    return reduce(lambda a, b: a.unionByName(b), frames).distinct()


def any_present(*columns: Column) -> Column:
    """True where at least one of the measures is not NULL."""
    return reduce(lambda a, b: a | b, [c.isNotNull() for c in columns])


def one_row_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None, keep: str = "first") -> DataFrame:
    """Keep the first (or last) row of each key in the order of ``order`` and the other columns.

    Rows with a NULL in the key equal no other row and are all kept. A grouped minimum of the whole
    row combines on the map side, so a key that fills a third of the table is no single task.
    """
    keys = list(keys)
    lead = [c for c in (order or []) if c not in keys]
    rest = lead + [c for c in df.columns if c not in keys and c not in lead]
    if not rest:
        whole_key = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
        return df.where(whole_key).distinct().unionByName(df.where(~whole_key))
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    pick = F.min if keep == "first" else F.max
    kept = df.where(known).groupBy(*keys).agg(pick(F.struct(*rest)).alias("_row"))
    kept = kept.select(*[F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in df.columns])
    return kept.unionByName(df.where(~known))


def numbered(df: DataFrame, order: Sequence[str], name: str, start: int = 1) -> DataFrame:
    """Dense numbers ``start, start + 1, …`` in the total order of ``order``.

    The rows are range-sorted once and written with their place inside the partition. The row counts
    per partition, one row for each, then give every partition its offset. No task sees all rows.
    """
    place = F.monotonically_increasing_id()
    ranked = materialise(df.orderBy(*order).withColumn("_place", place), "numbered")
    part = F.shiftright("_place", 33)
    sizes = ranked.groupBy(part.alias("_part")).agg(F.count("*").alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    inside = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    number = (F.col("_offset") + inside + F.lit(start)).cast("bigint")
    # One row per written partition, so the broadcast side cannot grow with the data.
    return (
        ranked.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, number)
        .drop("_part", "_place", "_offset")
    )

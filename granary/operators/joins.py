"""Joins that stay balanced when one key fills a large share of the rows.

A join to a table with one row per key needs nothing of its own: the side that repeats keys is the left one or the join is
an inner one, so adaptive execution splits its large partitions. A left join whose *right* side repeats keys cannot be
split there; :func:`left_join_many` deals such keys over salts.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from granary.operators.rows import one_row_per_key

#: Right rows of one key and salt. A left row is copied once for each salt of its key, that is for every
#: ``ROWS_PER_SALT`` rows it has in the result anyway.
ROWS_PER_SALT = 1000


def null_safe(pairs: dict[str, str]) -> Column:
    """Join condition on pairs of column names, left to right, in which two nulls are equal."""
    return reduce(lambda a, b: a & b, [F.col(f"`{a}`").eqNullSafe(F.col(f"`{b}`")) for a, b in pairs.items()])


def salts_per_key(right: DataFrame, keys: Sequence[str], rows_per_salt: int = ROWS_PER_SALT) -> DataFrame:
    """Every key of ``right`` with the number of salts its rows are dealt over; one for an ordinary key."""
    return right.groupBy(*keys).agg(F.ceil(F.count("*") / rows_per_salt).cast("int").alias("_salts"))


def left_join_many(left: DataFrame, right: DataFrame, keys: Sequence[str], rows_per_salt: int = ROWS_PER_SALT) -> DataFrame:
    """Left join whose *right* side may repeat a key any number of times; one plan, whatever the sizes.

    The right rows of a key are dealt over as many salts as their count asks for, by their place in ``right``: pass a scan or
    a written table. The left rows of the key are copied once per salt. A left row without a partner has one copy and is
    kept; a copy that meets an empty salt of a key with partners is dropped.
    """
    keys = list(keys)
    salts = salts_per_key(right, keys, rows_per_salt)
    placed = right.withColumn("_place", F.monotonically_increasing_id())
    dealt = placed.join(salts, keys).withColumn("_salt", F.pmod(F.xxhash64("_place"), F.col("_salts")).cast("int"))
    dealt = dealt.drop("_place", "_salts").withColumn("_met", F.lit(True))
    last = F.coalesce(F.col("_salts"), F.lit(1)) - 1
    copies = left.join(salts, keys, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), last)))
    joined = copies.join(dealt, [*keys, "_salt"], "left")
    return joined.where(F.col("_met") | F.col("_salts").isNull()).drop("_salts", "_salt", "_met")


def grid_product(base: DataFrame, tables: Sequence[DataFrame], key: str, rows_per_block: int = ROWS_PER_SALT) -> DataFrame:
    """``base`` left-joined to each of ``tables`` on ``key``, where every side may repeat a key any number of times.

    A chain of left joins shuffles its growing product. Here the input is shuffled once: the rows of each side are dealt into
    blocks of about ``rows_per_block`` of a key, a cell is one block of every side, and the product of a cell is unfolded after the
    shuffle, in the last narrow step. A key with a block of each side, as nearly all have, has one cell and no row is copied; a
    hot key has many cells, in as many tasks, and a row is copied once for each block of the other sides, which is its
    part of the product divided by ``rows_per_block`` for each side but one. Pass scans or written tables, as rows are dealt by their place.
    """
    sides = [base, *tables]
    names = [[c for c in side.columns if c != key] for side in sides]
    each = range(len(sides))
    counted = reduce(DataFrame.unionAll, [side.where(F.col(key).isNotNull()).select(key, F.lit(i).alias("_side")) for i, side in enumerate(sides)])
    blocks = [F.greatest(F.ceil(F.count_if(F.col("_side") == i) / rows_per_block), F.lit(1)).cast("int").alias(f"_p{i}") for i in each]
    # Only keys with several blocks of a side are listed: fewer than one for every ``rows_per_block`` rows.
    shares = counted.groupBy(key).agg(*blocks).where(reduce(lambda a, b: a | b, [F.col(f"_p{i}") > 1 for i in each]))
    dealt = []
    for i, side in enumerate(sides):
        placed = side.withColumn("_place", F.monotonically_increasing_id()).join(shares, key, "left")
        placed = placed.withColumns({f"_p{j}": F.coalesce(f"_p{j}", F.lit(1)) for j in each})
        for j in each:
            own = F.pmod(F.xxhash64("_place"), F.col(f"_p{j}")).cast("int")
            placed = placed.withColumn(f"_b{j}", own if i == j else F.explode(F.sequence(F.lit(0), F.col(f"_p{j}") - 1)))
        rows = placed.where(F.col(key).isNotNull())
        cells = [F.struct(F.lit(True).alias("_met"), *[F.col(c) for c in n]) if i == j else None for j, n in enumerate(names)]
        dealt.append((rows, cells))
    types = [f"struct<_met:boolean,{','.join(f'`{f.name}`:{f.dataType.simpleString()}' for f in side.schema if f.name != key)}>" for side in sides]
    marks = [f"_p{j}" for j in each] + [f"_b{j}" for j in each]
    parts = [
        rows.select(key, *marks, *[(F.lit(None).cast(t) if c is None else c.cast(t)).alias(f"_s{j}") for j, (c, t) in enumerate(zip(cells, types, strict=True))])
        for rows, cells in dealt
    ]
    gathered = reduce(DataFrame.unionAll, parts).groupBy(key, *marks).agg(*[F.collect_list(f"_s{j}").alias(f"_s{j}") for j in each])
    # An empty block of a side with several blocks adds nothing; a side without any row of the key adds one row of nulls.
    for j, t in enumerate(types):
        none = F.array(F.lit(None).cast(t))
        alone = (F.size(f"_s{j}") == 0) & (F.col(f"_p{j}") == 1)
        cells = F.col("_s0") if j == 0 else F.when(alone, none).otherwise(F.col(f"_s{j}"))
        gathered = gathered.withColumn(f"_s{j}", F.explode(cells))
    met = gathered.select(key, *[F.col(f"_s{j}")[c].alias(c) for j, n in enumerate(names) for c in n])
    # A null key meets no row of another side, and such rows are not gathered anywhere.
    unnamed = base.where(F.col(key).isNull())
    missing = [F.lit(None).cast(side.schema[c].dataType).alias(c) for side, n in zip(tables, names[1:], strict=True) for c in n]
    return met.unionAll(unnamed.select(key, *names[0], *missing))


def update_from(target: DataFrame, source: DataFrame, on: dict[str, str], assign: dict[str, str]) -> DataFrame:
    """Set ``assign`` columns of the rows that find a partner in ``source``; others keep their value.

    ``on`` and ``assign`` map target columns to source columns. A key with several source rows takes
    the least of them, so that the result does not depend on row order; a NULL key finds no partner.
    """
    keys = [F.col(s).alias(f"_k_{t}") for t, s in on.items()]
    values = [F.col(s).alias(f"_v_{t}") for t, s in assign.items()]
    names = [f"_k_{t}" for t in on]
    known = reduce(lambda a, b: a & b, [F.col(n).isNotNull() for n in names])
    slim = one_row_per_key(source.select(*keys, *values).where(known), names).withColumn("_found", F.lit(True))
    match = reduce(lambda a, b: a & b, [target[t] == slim[f"_k_{t}"] for t in on])
    joined = target.join(slim, match, "left")
    new = {t: F.when(F.col("_found"), F.col(f"_v_{t}")).otherwise(F.col(t) if t in target.columns else F.lit(None)) for t in assign}
    kept = [new[c].alias(c) if c in new else F.col(c) for c in target.columns]
    return joined.select(*kept, *[new[c].alias(c) for c in assign if c not in target.columns])

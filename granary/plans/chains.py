"""Demand chains: incremental connected components with stable chain numbers.

A log row links a demand item to its successor; the target ``(0, 0)`` ends a chain. Items keep the
number of the chain they joined first, and when chains meet the smallest number wins. A row opens a
chain when no item of it was known before, so chain numbers follow the order of the rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from granary.functions.dates import stamp as stamp_of
from granary.operators.components import component_roots
from granary.operators.rows import numbered
from granary.session import materialise

ORDER = ["pl_udate", "pl_utime", "pl_rsnum", "pl_rspos", "pl_rsnum_new", "pl_rspos_new"]
CHAIN_SCHEMA = (
    "plc_rsnum bigint, plc_rspos bigint, plc_udate date, plc_utime string, chain_id bigint, plc_lchg_date_time timestamp"
)


def is_terminal() -> Column:
    return (F.col("pl_rsnum_new") == 0) & (F.col("pl_rspos_new") == 0)


def is_self() -> Column:
    return (F.col("pl_rsnum") == F.col("pl_rsnum_new")) & (F.col("pl_rspos") == F.col("pl_rspos_new"))


def has_null_key() -> Column:
    """Log rows without a full key; they can equal no item and are kept out of the chains."""
    return F.col("pl_rsnum").isNull() | F.col("pl_rspos").isNull() | F.col("pl_rsnum_new").isNull() | F.col("pl_rspos_new").isNull()


def numbered_log(log: DataFrame) -> DataFrame:
    """Distinct log rows with their place ``seq`` in the order date, time, key."""
    return numbered(log.where(~has_null_key()).select(*ORDER).distinct(), ORDER, "seq")


def first_rows(log: DataFrame) -> DataFrame:
    """Items ``a, b`` of a numbered log and the place of the first row that names each.

    A terminal row names only its source. A hub item combines on the map side, on numbers.
    """
    source = F.struct(F.col("pl_rsnum").alias("a"), F.col("pl_rspos").alias("b"))
    target = F.struct(F.col("pl_rsnum_new").alias("a"), F.col("pl_rspos_new").alias("b"))
    ends = F.when(is_terminal(), F.array(source)).otherwise(F.array(source, target))
    return log.select("seq", F.inline(ends)).groupBy("a", "b").agg(F.min("seq").alias("seq"))


@dataclass
class Growth:
    """What one load does to the chains: new items, chains merged into smaller ones, the largest number still in use.

    ``items(plc_rsnum, plc_rspos, plc_udate, plc_utime, chain_id)``; ``merged(chain_id, root)`` of chains that were there
    before; ``top`` is None where it takes a look at all chains to find it.
    """

    items: DataFrame
    merged: DataFrame
    top: int | None


def growth(log: DataFrame, known: Callable[[DataFrame], DataFrame], base: int) -> Growth:
    """The effect of one load ``log`` on chains numbered up to ``base``.

    ``known`` gives ``a, b, old_id`` of those of the items ``a, b`` that are in a chain. Numbers are drawn after ``base``.
    Date and time of a new item are those of the first row that names it, in the order date, time, key.

    The components are found among numbers, not items: a known item stands for its chain, the items of an opening row for
    the new chain, and every other new item gets a number above all chains. So only the load takes part in the rounds, and
    the least number of a component is its final chain.
    """
    log = numbered_log(log)
    single = (is_terminal() | is_self()).alias("single")
    first = materialise(first_rows(log), "first-rows")
    items = first.join(known(first.select("a", "b")), ["a", "b"], "left")
    items = materialise(items.join(log.select("seq", "pl_udate", "pl_utime", single), "seq"), "items")

    # A row opens a chain when all its items are new and first named by it.
    named = items.where(F.col("old_id").isNull()).groupBy("seq", "single").agg(F.count("*").alias("items"))
    opening = named.where(F.col("items") == F.when(F.col("single"), 1).otherwise(2)).select("seq")
    opened = numbered(opening, ["seq"], "opened_id", start=base + 1)
    top = opened.agg(F.coalesce(F.max("opened_id"), F.lit(base)).alias("top")).first()["top"]

    # Any other new item: some number above all chains, fixed by writing it.
    other = F.monotonically_increasing_id() + F.lit(top + 1)
    placed = items.join(opened, "seq", "left").withColumn("vertex", F.coalesce("old_id", "opened_id", other)).drop("opened_id")
    vertices = materialise(placed, "vertices")

    links = log.where(~is_terminal() & ~is_self()).drop("seq", "pl_udate", "pl_utime")
    ends = vertices.select("a", "b", "vertex")
    sources = ends.withColumnsRenamed({"a": "pl_rsnum", "b": "pl_rspos", "vertex": "u"})
    targets = ends.withColumnsRenamed({"a": "pl_rsnum_new", "b": "pl_rspos_new", "vertex": "v"})
    half = links.join(sources, ["pl_rsnum", "pl_rspos"]).select("pl_rsnum_new", "pl_rspos_new", "u")
    edges = half.join(targets, ["pl_rsnum_new", "pl_rspos_new"])
    roots = component_roots(edges.select("u", "v"))

    fell = roots.where((F.col("root") < F.col("vertex")) & (F.col("vertex") <= top))
    merged = materialise(fell.select(F.col("vertex").alias("chain_id"), "root"), "merged")
    last = opened.join(merged, opened["opened_id"] == merged["chain_id"], "left_anti").agg(F.max("opened_id")).first()[0]
    if last is None:
        last = base if merged.where(F.col("chain_id") == base).isEmpty() else None
    # Only the two items of an opening row share a vertex, so this join repeats no vertex more than twice.
    new_items = vertices.where(F.col("old_id").isNull()).join(roots, "vertex", "left").select(
        F.col("a").alias("plc_rsnum"),
        F.col("b").alias("plc_rspos"),
        F.col("pl_udate").alias("plc_udate"),
        F.col("pl_utime").alias("plc_utime"),
        F.coalesce("root", "vertex").alias("chain_id"),
    )
    return Growth(new_items, merged.where(F.col("chain_id") <= base), last)


def extended_chains(chains: DataFrame, log: DataFrame, now: dt.datetime) -> DataFrame:
    """``chains`` as one table after one load ``log``; ``now`` stamps new items and items whose chain was merged.

    ``chains`` is read more than once: pass a scan or a written table. A table that many loads follow on is better kept by
    :mod:`granary.plans.chain_store`, where a load does not pass over the whole of it.
    """
    known = chains.select(F.col("plc_rsnum").alias("a"), F.col("plc_rspos").alias("b"), F.col("chain_id").alias("old_id"))
    base = chains.agg(F.coalesce(F.max("chain_id"), F.lit(0)).alias("top")).first()["top"]
    grown = growth(log, lambda items: known.join(items, ["a", "b"], "left_semi"), base)
    stamp = stamp_of(now)
    fell = F.col("root").isNotNull()
    old_items = chains.join(grown.merged, "chain_id", "left").select(
        "plc_rsnum",
        "plc_rspos",
        "plc_udate",
        "plc_utime",
        F.coalesce("root", "chain_id").alias("chain_id"),
        F.when(fell, stamp).otherwise(F.col("plc_lchg_date_time")).alias("plc_lchg_date_time"),
    )
    return old_items.unionByName(grown.items.withColumn("plc_lchg_date_time", stamp))


def no_chains(spark) -> DataFrame:
    return spark.createDataFrame([], CHAIN_SCHEMA)


def chains_of_loads(chains: DataFrame, log: DataFrame, loads: Sequence[str], now: dt.datetime) -> DataFrame:
    """Run the pending loads one after another, as chain numbers depend on their order."""
    for load in loads:
        chains = materialise(extended_chains(chains, log.where(F.col("load_id") == load), now), "chains")
    return chains

"""Demand chains kept as a union-find in tables, so that a load costs what the load is.

``items`` holds each demand item with the chain it joined, in buckets by item; ``moves`` holds, in buckets by chain, which chain
went into which and when. A load looks up its own items and follows their chains through the moves, adds its new items and its
moves, and leaves every other item alone. When the moves have become a fair share of the items they are folded in: the items
are written once with their final chains. That happens after so many moves that each pays for a bounded number of rows.

A number is used again when the chain that had the largest one has gone into another, so inside the tables a chain is told by
the version that opened it and its number. All of it switches with the version of the folder (``operators.versions``), and the
facts of the version name the last load or stream batch, so one that is handed out again changes nothing.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from granary.functions.dates import stamp as stamp_of
from granary.operators.versions import ROWS, Change, Versions
from granary.plans import chains
from granary.session import discard, materialise

ITEMS, MOVES = "items", "moves"
ITEM_SCHEMA = T.StructType(
    [
        T.StructField("plc_rsnum", T.LongType()),
        T.StructField("plc_rspos", T.LongType()),
        T.StructField("plc_udate", T.DateType()),
        T.StructField("plc_utime", T.StringType()),
        T.StructField("chain", T.LongType()),
        T.StructField("plc_lchg_date_time", T.TimestampType()),
    ]
)
MOVE_SCHEMA = T.StructType([T.StructField("chain", T.LongType()), T.StructField("into", T.LongType()), T.StructField("at", T.TimestampType())])
ITEM = ["plc_rsnum", "plc_rspos"]
#: A chain is its number and, above that, the version that opened it.
NUMBER = (1 << 40) - 1
#: Moves are folded into the items when they are more than one in so many of them, and more than so few.
SHARE, FEW = 4, 1000


@dataclass
class Report:
    """What a load did: rows added to the two tables, bytes opened and written, whether the moves were folded."""

    items: int
    moves: int
    read: int
    written: int
    folded: bool


def _followed(moves: DataFrame) -> DataFrame:
    """``chain, into, at`` with every move followed to its end; the stamp is that of the last step."""
    while True:
        ahead = moves.select(F.col("chain").alias("into"), F.col("into").alias("_into"), F.col("at").alias("_at"))
        further = materialise(
            moves.join(ahead, "into", "left").select(
                "chain", F.coalesce("_into", "into").alias("into"), F.coalesce("_at", "at").alias("at"), F.col("_into").isNotNull().alias("_on")
            ),
            "moves",
        )
        moves = further.drop("_on")
        if further.where("_on").isEmpty():
            return moves


def _current(items: DataFrame, moves: DataFrame) -> DataFrame:
    """Items with their chain of today; many items of a chain join one move, and adaptive execution splits them."""
    return items.join(_followed(moves), "chain", "left").select(
        *ITEM,
        "plc_udate",
        "plc_utime",
        F.coalesce("into", "chain").alias("chain"),
        F.coalesce("at", "plc_lchg_date_time").alias("plc_lchg_date_time"),
    )


def _with_number(items: DataFrame) -> DataFrame:
    number = F.col("chain").bitwiseAND(F.lit(NUMBER)).alias("chain_id")
    return items.select(*ITEM, "plc_udate", "plc_utime", number, "plc_lchg_date_time")


def read_chains(spark: SparkSession, folder: str) -> DataFrame:
    """The whole chain table of the newest version, with the columns of ``chains.CHAIN_SCHEMA``."""
    store = Versions(spark, folder)
    if ITEMS not in store.tables:
        return chains.no_chains(spark)
    return _with_number(_current(store.read(ITEMS), store.read(MOVES)))


class ChainStore:
    """The chains in ``folder``; ``rows`` is the size at which a bucket splits."""

    def __init__(self, spark: SparkSession, folder: str, rows: int = ROWS):
        self.spark, self.folder, self.rows = spark, folder, rows

    def facts(self) -> dict:
        return Versions(self.spark, self.folder).facts

    def adopt(self, table: DataFrame) -> None:
        """Begin with a plain chain table."""
        change = self._change()
        first = table.select(*ITEM, "plc_udate", "plc_utime", F.col("chain_id").alias("chain"), "plc_lchg_date_time")
        change.append(ITEMS, first.select(*[F.col(f.name).cast(f.dataType) for f in ITEM_SCHEMA]))
        change.commit(top=table.agg(F.coalesce(F.max("chain_id"), F.lit(0))).first()[0], loads=[])

    def _change(self) -> Change:
        change = Change(self.spark, self.folder, self.rows)
        change.table(ITEMS, ITEM_SCHEMA, ITEM)
        change.table(MOVES, MOVE_SCHEMA, ["chain"])
        return change

    def _known(self, change: Change, items: DataFrame) -> DataFrame:
        """``a, b, chain``: chains of today of those of ``items(a, b)`` that have one, out of the buckets they fall into."""
        asked = items.select(F.col("a").alias(ITEM[0]), F.col("b").alias(ITEM[1]))
        leaves = change.touched(ITEMS, asked)
        held = change.read(ITEMS, leaves).join(asked, ITEM, "left_semi").select(*ITEM, "chain")
        held = materialise(held.withColumn("_on", F.lit(True)), "known")
        while change.tables[MOVES].rows:
            # One step for every chain that has moved; a step is a look into the buckets of these chains.
            asked = held.where("_on").select("chain").distinct()
            leaves = change.touched(MOVES, asked)
            moved = change.read(MOVES, leaves).select("chain", "into")
            held = materialise(held.join(moved, "chain", "left").select(*ITEM, F.coalesce("into", "chain").alias("chain"), F.col("into").isNotNull().alias("_on")), "known")
            if held.where("_on").isEmpty():
                break
        return held.select(F.col(ITEM[0]).alias("a"), F.col(ITEM[1]).alias("b"), "chain")

    def load(self, log: DataFrame, now: dt.datetime, **facts) -> Report:
        """One load: ``now`` stamps new items and items whose chain went into another; ``facts`` are noted with the version."""
        change = self._change()
        base, version = change.facts.get("top", 0), change.version + 1
        found: list[DataFrame] = []

        def known(items: DataFrame) -> DataFrame:
            found.append(materialise(self._known(change, items), "known-chains"))
            return found[0].select("a", "b", F.col("chain").bitwiseAND(F.lit(NUMBER)).alias("old_id"))

        grown = chains.growth(log, known, base)
        stamp = stamp_of(now)
        own = found[0].select(F.col("chain").bitwiseAND(F.lit(NUMBER)).alias("chain_id"), "chain").distinct()
        opened = F.lit(version << 40) + F.col("chain_id")
        items = grown.items.join(own, "chain_id", "left").select(
            *ITEM, "plc_udate", "plc_utime", F.coalesce("chain", opened).alias("chain"), stamp.alias("plc_lchg_date_time")
        )
        into = own.select(F.col("chain_id").alias("root"), F.col("chain").alias("into"))
        moves = grown.merged.join(own, "chain_id").join(into, "root").select("chain", "into", stamp.alias("at"))
        items, moves = materialise(items, "new-items"), materialise(moves, "new-moves")
        added = change.append(ITEMS, items), change.append(MOVES, moves)
        discard(items)
        discard(moves)
        folded = change.tables[MOVES].rows > max(FEW, change.tables[ITEMS].rows // SHARE)
        if folded:
            whole = materialise(_current(change.read(ITEMS), change.read(MOVES)), "whole")
            change.rewrite(ITEMS, list(change.tables[ITEMS].buckets), whole)
            discard(whole)
            change.rewrite(MOVES, list(change.tables[MOVES].buckets), self.spark.createDataFrame([], MOVE_SCHEMA))
        top = grown.top
        if top is None:  # the chain with the largest number has gone into another, and none has been opened after it
            numbers = _with_number(_current(change.read(ITEMS), change.read(MOVES)))
            top = numbers.agg(F.coalesce(F.max("chain_id"), F.lit(0))).first()[0]
        cost = change.cost()
        change.commit(top=top, **facts)
        return Report(*added, cost["read"], cost["written"], folded)


def chain_batches(folder: str, now: Callable[[str], dt.datetime], rows: int = ROWS) -> Callable[[DataFrame, int], None]:
    """Handler for ``streaming.loads.run_available``: the loads of a batch one after another, in the order of their ids.

    Each load makes a version that names the batch and the loads of it that are done. A batch handed out again goes on where it
    broke off; one that is done, or older than the last one, changes nothing.
    """

    def handle(batch: DataFrame, number: int) -> None:
        store = ChainStore(batch.sparkSession, folder, rows)
        batch = materialise(batch, "batch")
        for load in [r[0] for r in batch.select("load_id").distinct().orderBy("load_id").collect()]:
            facts = store.facts()
            last, done = facts.get("batch", -1), facts.get("batch_loads", [])
            if last > number or (last == number and load in done):
                continue
            done = [*done, load] if last == number else [load]
            store.load(batch.where(F.col("load_id").eqNullSafe(F.lit(load))), now(load), batch=number, batch_loads=done)

    return handle

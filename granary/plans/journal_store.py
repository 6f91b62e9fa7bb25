"""The load journal as folded state and a tail of events.

Events are appended under a sequence number and never changed. ``state`` holds one row per load, its last event and its first
stamp, as of the sequence number it was folded up to; ``tail`` holds the events after that; ``history`` the folded ones, which no
question about the present reads. A fold reads the tail and the buckets of state its loads fall into, so it costs what the
tail is. All three switch with one version of the folder.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from granary.operators.journal import IN_WORK, LOAD, NEW, SUCCESS
from granary.operators.versions import ROWS, Change, Versions
from granary.session import discard, materialise

STATE, TAIL, HISTORY, SEQ = "state", "tail", "history", "seq"
#: Appends in the tail before they are folded.
LENGTH = 16
EVENT = T.StructType(
    [
        T.StructField("flow_id", T.StringType()),
        T.StructField("target_lvl", T.StringType()),
        T.StructField("load_id", T.StringType()),
        T.StructField("stg_status", T.StringType()),
        T.StructField("row_count", T.LongType()),
        T.StructField("crea_datetime", T.TimestampType()),
        T.StructField("last_delta_ts", T.TimestampType()),
    ]
)
STATE_ROW = T.StructType([*EVENT.fields, T.StructField("created", T.TimestampType())])
TAIL_ROW = T.StructType([*EVENT.fields, T.StructField(SEQ, T.LongType())])


def _latest(rows: DataFrame) -> DataFrame:
    """One state row per load from state rows, whatever number of events each stands for; equal stamps are ordered N, I, S."""
    rank = F.array_position(F.array(F.lit(NEW), F.lit(IN_WORK), F.lit(SUCCESS)), F.col("stg_status"))
    rest = [c for c in EVENT.names if c not in LOAD]
    last = F.max(F.struct(F.col("crea_datetime").alias("_at"), rank.alias("_rank"), "stg_status", "row_count", "crea_datetime", "last_delta_ts"))
    grouped = rows.groupBy(*LOAD).agg(last.alias("_last"), F.min("created").alias("created"))
    return grouped.select(*LOAD, *[F.col(f"_last.{c}").alias(c) for c in rest], "created")


def _as_state(events: DataFrame) -> DataFrame:
    return events.select(*EVENT.names, F.col("crea_datetime").alias("created"))


class JournalStore:
    """A journal in ``folder``; ``rows`` bounds a bucket of the state, ``length`` the appends of the tail."""

    def __init__(self, spark: SparkSession, folder: str, rows: int = ROWS, length: int = LENGTH):
        self.spark, self.folder, self.rows, self.length = spark, folder, rows, length

    def append(self, events: DataFrame) -> int:
        """Add events under the next sequence number, which is returned; the tail is folded when it has become long."""
        change = Change(self.spark, self.folder, self.rows)
        seq = change.facts.get(SEQ, 0) + 1
        missing = {f.name: F.lit(None).cast(f.dataType) for f in EVENT if f.name not in events.columns}
        typed = events.withColumns(missing).select(*[F.col(f.name).cast(f.dataType) for f in EVENT], F.lit(seq).cast("bigint").alias(SEQ))
        change.table(STATE, STATE_ROW, LOAD)
        change.table(HISTORY, TAIL_ROW, LOAD)
        change.slices(TAIL, typed, SEQ, [seq])
        change.commit(**{SEQ: seq})
        if len(change.tables[TAIL].buckets) >= self.length:
            self.fold()
        return seq

    def fold(self) -> dict[str, int]:
        """Fold the tail into the state and move its events to the history; bytes opened and written."""
        change = Change(self.spark, self.folder, self.rows)
        if TAIL not in change.tables or not change.tables[TAIL].buckets:
            return change.cost()
        tail = change.read(TAIL)
        leaves = change.touched(STATE, tail)
        latest = materialise(_latest(change.read(STATE, leaves).unionByName(_as_state(tail))), "latest")
        change.rewrite(STATE, leaves, latest)
        discard(latest)
        change.append(HISTORY, tail)
        change.slices(TAIL, tail.where(F.lit(False)), SEQ, list(change.tables[TAIL].buckets))
        cost = change.cost()
        change.commit()
        return cost

    def state(self) -> DataFrame:
        """The last event of every load with its first stamp ``created``, from the fold and the tail.

        Two arrivals of one event are one state. An empty journal has no rows.
        """
        store = Versions(self.spark, self.folder)
        if STATE not in store.tables:
            return self.spark.createDataFrame([], STATE_ROW)
        return _latest(store.read(STATE).unionByName(_as_state(store.read(TAIL))))

    def bytes_of_state(self) -> dict[str, int]:
        """Bytes that :meth:`state` reads, and bytes of the whole log."""
        store = Versions(self.spark, self.folder)
        sizes = {n: store.size_of([p for b in t.buckets.values() for p in b.paths]) for n, t in store.tables.items()}
        return {"read": sizes[STATE] + sizes[TAIL], "log": sizes[TAIL] + sizes[HISTORY]}

    def events(self) -> DataFrame:
        """Every event with its sequence number."""
        store = Versions(self.spark, self.folder)
        return store.read(HISTORY).unionByName(store.read(TAIL)) if TAIL in store.tables else self.spark.createDataFrame([], TAIL_ROW)

    def pending(self, flow: str, level: str, states: Sequence[str] = (NEW,)) -> DataFrame:
        """``load_id, stg_status, created`` of the loads not finished yet; the filter on flow and level reaches the scans."""
        wanted = (F.col("flow_id") == flow) & (F.col("target_lvl") == level)
        return self.state().where(wanted & F.col("stg_status").isin(*states)).select("load_id", "stg_status", "created")

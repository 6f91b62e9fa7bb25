"""Every load file is processed once: Structured Streaming in place of a polled journal."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from granary.operators.journal import IN_WORK, NEW
from granary.plans import loads
from granary.session import materialise
from pyspark.sql.types import StructType


def run_available(
    spark: SparkSession, source: str, schema: StructType | str, checkpoint: str, handle: Callable[[DataFrame, int], None]
) -> None:
    """Hand all files not seen before to ``handle`` and stop.

    The checkpoint remembers the files done, as the states N, I and S of a journal would; a batch that
    failed is handed out again with the same number.
    """
    stream = spark.readStream.schema(schema).parquet(source)
    query = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def into_batches(folder: str) -> Callable[[DataFrame, int], None]:
    """Handler that writes each batch to its own folder, so that a repeated batch replaces itself."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/batch={number}")

    return write


def snapshot_batches(like: DataFrame, journal: DataFrame, core: str, events: str, now: dt.datetime) -> Callable[[DataFrame, int], None]:
    """Handler that carries a snapshot load from batch to batch.

    ``like`` has the columns of the core table at ``core``, ``journal`` the events before the stream. A batch replaces its
    groups in the core as it is by then and writes its journal events under its own number to ``events``. Only loads that
    the batch brings rows of are moved. The events of the batch itself are not looked at and its folder is
    overwritten, so a batch handed out again ends in the same core and the same journal; one before the last is done.
    """

    def load(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        batch = materialise(batch, "batch")
        brought = batch.select("load_id").distinct()
        known = journal
        place = spark._jvm.org.apache.hadoop.fs.Path(events)
        if place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
            logged = spark.read.parquet(events)
            if not logged.where(F.col("batch") > number).isEmpty():
                return  # later batches stand on this one
            earlier = logged.where(F.col("batch") < number).drop("batch")
            known = journal.unionByName(earlier, allowMissingColumns=True)
        outcome = loads.snapshot_load(batch, loads.read_snapshots(like, core), known.join(brought, "load_id", "left_semi"), now, (NEW, IN_WORK))
        logged = materialise(outcome.events, "events")
        loads.write_snapshot(outcome.fresh.select(*like.columns), core)
        logged.write.mode("overwrite").parquet(f"{events}/batch={number}")

    return load

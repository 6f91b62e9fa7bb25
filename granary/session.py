"""Session settings and the shared folder used to cut long lineages."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A split skewed join is worth another shuffle after it.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

_own_folder: str | None = None


def configure(spark: SparkSession) -> SparkSession:
    """Pin the run-time settings every plan here relies on."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach, as named by ``spark.checkpoint.dir``, or by :func:`use_folder`."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or _own_folder
    if not folder:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return folder.rstrip("/")


def use_folder(spark: SparkSession) -> SparkSession:
    """For tests and trials on one machine: name a temporary folder where the session names none."""
    global _own_folder
    if not spark.conf.get("spark.checkpoint.dir", None) and _own_folder is None and re.match(r"local(\[|$)", spark.sparkContext.master):
        _own_folder = tempfile.mkdtemp(prefix="granary-")
    return spark


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder."""
    application = spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/granary/{application}/{label}-{uuid.uuid4().hex[:12]}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and continue from the written table.

    Later plans start at a plain scan, so a lost executor costs one re-read and not a replay of
    every earlier round; row counts come from the parquet footers.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._granary_path = path
    return table


def discard(table: DataFrame) -> None:
    """Remove the files of a table made by :func:`materialise` once whatever was derived from it is written."""
    spark = table.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(table._granary_path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialise_counted(df: DataFrame, label: str) -> tuple[DataFrame, int]:
    """As :func:`materialise`, with the row count observed while writing."""
    seen = Observation(label)
    table = materialise(df.observe(seen, F.count(F.lit(1)).alias("rows")), label)
    return table, seen.get["rows"]

"""Small helpers of the operators: session settings, tables and whole groups out of sorted batches."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from granary.session import configure, use_folder

#: Arrow batches stay small whatever the length of the texts.
SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "8388608",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


_shipped: set[str] = set()


def _ship(spark: SparkSession) -> None:
    """Send this package to the executors, whatever folder the driver imported it from."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[2]
    bundle = Path(tempfile.mkdtemp(prefix="granary-code-")) / "granary.zip"
    with zipfile.ZipFile(bundle, "w") as out:
        for file in sorted((root / "granary").rglob("*.py")):
            out.write(file, file.relative_to(root))
    context.addPyFile(str(bundle))
    _shipped.add(context.applicationId)


def prepared(spark: SparkSession) -> SparkSession:
    """Set what the operators rely on and make their modules known to the executors.

    A local session without ``spark.checkpoint.dir`` gets a folder of its own; a cluster has to name one.
    """
    use_folder(configure(spark))
    _ship(spark)
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id, modulus: int, remainder: int):
    """True where crc32 of the id as text leaves ``remainder``."""
    return (F.crc32(F.col(doc_id).cast("string")) % modulus) == remainder


def whole_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables that hold every row of each of their keys, out of batches sorted by ``key``."""
    kept: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(batch.schema.get_field_index(key))
        last = column[-1].as_py()
        if column[0].as_py() == last:
            if kept and kept[-1].column(batch.schema.get_field_index(key))[-1].as_py() != last:
                yield pa.Table.from_batches(kept)
                kept = []
            kept.append(batch)
            continue
        cut = batch.num_rows - 1  # where the last key begins
        low = 0
        while low < cut:
            middle = (low + cut) // 2
            if column[middle].as_py() == last:
                cut = middle
            else:
                low = middle + 1
        kept.append(batch.slice(0, cut))
        yield pa.Table.from_batches(kept)
        kept = [batch.slice(cut)]
    if kept:
        yield pa.Table.from_batches(kept)


def bounded_sample(df: DataFrame, key: str, most: int) -> DataFrame:
    """At most ``most`` rows of ``df``, those with the least hashes of ``key`` among a share of about four times as many.

    The share is taken by the hash as well, so no single task gathers rows from every partition of a large table.
    """
    rows = df.count()
    share = min(1.0, 4 * most / max(rows, 1))
    mark = F.xxhash64(F.col(key))
    some = df.where(F.pmod(mark, F.lit(1 << 30)) < F.lit(int(share * (1 << 30)) + 1)) if share < 1 else df
    return some.orderBy(mark, key).limit(most)


#: Marks of ids: so few that a set of them may be sent to every task.
MARKS = 1 << 20


def free_name(columns: Iterable[str], name: str) -> str:
    """``name``, with as many lines below it as it takes to differ from all ``columns``."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def _mark(doc_id) -> Column:
    return F.pmod(F.xxhash64(F.col(doc_id).cast("bigint")), F.lit(MARKS))


def maybe_with(docs: DataFrame, ids: DataFrame, how: str = "left_semi") -> DataFrame:
    """Rows of ``docs`` whose ``doc_id`` may be among ``ids(doc_id)``; with ``left_anti`` those where it surely is not.

    An id is told by one of ``MARKS`` marks, so the broadcast side has ``MARKS`` rows at most, whatever the number of ids. An
    exact join is left for the rows that may. With far more ids than marks nearly all rows may, and that join is the work.
    """
    name = free_name(docs.columns, "_mark")
    marks = ids.select(_mark("doc_id").alias(name)).distinct()
    return docs.join(F.broadcast(marks), _mark("doc_id") == F.col(name), how)


def without_ids(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose ``doc_id`` is not among ``ids(doc_id)``, a written table; rows with a null id stay."""
    maybe = maybe_with(docs, ids).join(ids.select("doc_id").distinct(), "doc_id", "left_anti").select(docs.columns)
    return maybe_with(docs, ids, "left_anti").unionAll(maybe)

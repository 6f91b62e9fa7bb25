"""Watermark loads that take rows which arrive late with the stamp of the mark itself, each once.

A load that reads strictly after the last stamp loses the rows that reach the source later with that same stamp; one that reads
from the stamp on takes some twice. Here the keys taken at the mark are kept beside it. A load reads from the mark on and leaves
those keys out. Rows, mark and keys switch with one version of the folder, so a load that broke off leaves no trace and
can be run again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from granary.functions.dates import stamp as stamp_of
from granary.operators.joins import null_safe
from granary.operators.versions import ROWS, Change, Versions
from granary.session import discard, materialise_counted

LOADED, SEEN, MARK = "rows", "seen", "mark"


def read_loaded(spark: SparkSession, folder: str) -> DataFrame:
    return Versions(spark, folder).read(LOADED)


def load_from_mark(source: DataFrame, stamp: str, keys: Sequence[str], folder: str, rows: int = ROWS) -> tuple[int, str | None]:
    """Append the rows of ``source`` that no earlier load has taken to the table in ``folder``; their number and the new mark.

    The comparison ``stamp >= mark`` reaches the scan, and only rows at the mark are compared with the keys taken there.
    A key names a row of the source: rows that repeat a key in one load are all taken, a later one with the mark's stamp
    and a known key is not. Nulls in keys are equal. Rows without a stamp are never taken, nor are those that arrive with a stamp
    before the mark. An empty source leaves mark and table as they are.
    """
    change = Change(source.sparkSession, folder, rows)
    mark = change.facts.get(MARK)
    kind = source.schema[stamp].dataType
    change.table(LOADED, source.schema, [f"`{k}`" for k in keys])
    taken = source.where(F.col(stamp).isNotNull())
    if mark is not None:
        at_mark = F.col(stamp) == stamp_of(mark, kind)
        known = change.read(SEEN).withColumnsRenamed({k: f"_seen_{k}" for k in keys})
        taken = taken.where(F.col(stamp) >= stamp_of(mark, kind)).join(
            known, null_safe({k: f"_seen_{k}" for k in keys}) & at_mark, "left_anti"
        )
    fresh, count = materialise_counted(taken, "from-mark")
    if count:
        latest = fresh.agg(F.max(stamp).cast("string")).first()[0]
        seen = fresh.where(F.col(stamp) == stamp_of(latest, kind)).select(*keys).distinct()
        if latest == mark:
            seen = seen.unionByName(change.read(SEEN))
        change.append(LOADED, fresh)
        change.whole(SEEN, seen)
        change.commit(**{MARK: latest})
        mark = latest
    discard(fresh)
    return count, mark

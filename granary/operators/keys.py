"""Surrogate keys that survive a refill: a registry of values and their numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from granary.operators.joins import null_safe
from granary.operators.rows import numbered
from granary.operators.versions import ROWS, Change
from granary.session import materialise, materialise_counted

REGISTRY, TOP, KEY = "keys", "top", "KEY"


def registered(values: DataFrame, folder: str, rows: int = ROWS) -> DataFrame:
    """The distinct rows of ``values`` with their ``KEY`` from the registry in ``folder``.

    A value the registry knows keeps its number for good, also when it was away for some refills. New values take the next
    numbers in their natural order. The registry lies in buckets by value that split as it grows, so only the buckets that
    the values fall into are read, and new values are added as files of their own. Nulls are values like others and
    equal each other. Numbers and rows switch with one version: after a run that broke off the same numbers are given again.
    """
    names = values.columns
    spark = values.sparkSession
    values = materialise(values.distinct(), "values")
    change = Change(spark, folder, rows)
    schema = T.StructType([T.StructField(KEY, T.LongType()), *values.schema.fields])
    change.table(REGISTRY, schema, [f"`{n}`" for n in names])
    aside = {n: f"_known_{n}" for n in names}
    known = change.read(REGISTRY, change.touched(REGISTRY, values)).withColumnsRenamed(aside)
    new, count = materialise_counted(values.join(known, null_safe(aside), "left_anti"), "new-values")
    if count:
        top = change.facts.get(TOP, 0)
        given = materialise(numbered(new, names, KEY, start=top + 1).select(KEY, *names), "new-keys")
        change.append(REGISTRY, given)
        change.commit(**{TOP: top + count})
    held = change.read(REGISTRY, change.touched(REGISTRY, values)).withColumnsRenamed(aside)
    return values.join(held, null_safe(aside)).select(KEY, *[F.col(f"`{n}`") for n in names])

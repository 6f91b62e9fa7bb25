"""Connected components by alternating stars (Kiveris et al., 2014) on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from granary.session import discard, materialise


def _oriented(edges: DataFrame) -> DataFrame:
    """Distinct edges from the larger to the smaller end, without loops."""
    return (
        edges.where(F.col("u") != F.col("v"))
        .select(F.greatest("u", "v").alias("hi"), F.least("u", "v").alias("lo"))
        .distinct()
    )


def _neighbourhoods(edges: DataFrame) -> DataFrame:
    """Least neighbour and degree of every vertex; hubs combine on the map side."""
    both = edges.select(F.col("hi").alias("x"), F.col("lo").alias("y")).unionAll(
        edges.select(F.col("lo").alias("x"), F.col("hi").alias("y"))
    )
    return both.groupBy("x").agg(F.min("y").alias("least"), F.count("*").alias("degree"))


def component_roots(edges: DataFrame) -> DataFrame:
    """``(vertex, root)`` for every vertex of ``edges(u, v)``; the root is the least vertex reached.

    Each round links all larger neighbours of a vertex to its least neighbour, then all smaller ones,
    until only stars are left. Vertices may be of any ordered type. Every half round starts from a written
    edge table; the ones before it are removed. A hub is one row on one side of each join, so adaptive
    execution splits its edges; its minimum is combined before the shuffle.
    """
    current = materialise(_oriented(edges), "edges")
    while True:
        around = _neighbourhoods(current).persist()
        try:
            # A vertex with a smaller neighbour and any other one breaks the star shape.
            loose = around.where((F.col("least") < F.col("x")) & (F.col("degree") > 1))
            if loose.isEmpty():
                break
            best = around.select(F.col("x").alias("lo"), F.least("x", "least").alias("root"))
            large = materialise(current.join(best, "lo").select("hi", F.col("root").alias("lo")), "large-star")
        finally:
            around.unpersist()
        lowest = large.groupBy("hi").agg(F.min("lo").alias("root"))
        # The larger end of an edge goes to the root once, whatever the number of its edges; root < lo < hi.
        rest = large.join(lowest, "hi").where(F.col("lo") != F.col("root")).select(F.col("lo").alias("hi"), F.col("root").alias("lo"))
        stars = lowest.select("hi", F.col("root").alias("lo")).unionAll(rest).distinct()
        before, current = current, materialise(stars, "edges")
        discard(before)
        discard(large)
    leaves = current.select(F.col("hi").alias("vertex"), F.col("lo").alias("root"))
    centres = current.select(F.col("lo").alias("vertex"), F.col("lo").alias("root")).distinct()
    return leaves.unionAll(centres)

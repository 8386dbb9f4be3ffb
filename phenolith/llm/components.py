"""Connected components of a graph of longs, by alternating large-star and small-star steps (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_written, written


def _pointed(edges: DataFrame) -> DataFrame:
    """Distinct edges from the larger end to the smaller one, loops and nulls left out."""
    e = edges.select(F.greatest("src", "dst").alias("hi"), F.least("src", "dst").alias("lo"))
    return e.where("hi <> lo").distinct()


def _state(e: DataFrame) -> tuple:
    row = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)")).alias("h"), F.count_distinct("hi").alias("heads")).first()
    return tuple(row)


def connected_components(edges: DataFrame) -> DataFrame:
    """(src, dst) longs -> (node, root): each node that has an edge, and the smallest node it reaches.

    A node's minimum comes from a grouped min with map-side combining, is written, and is joined back
    between two plain scans, where Spark splits a hub's rows over tasks. Each round is written to the shared folder; the driver
    sees only a count and a checksum. Loops and rows with a null end are ignored; an empty graph
    gives an empty table.
    """
    e = written(_pointed(edges), "cc")
    state = _state(e)
    while True:
        both = e.select(F.col("lo").alias("u"), F.col("hi").alias("v")).unionAll(e.select(F.col("hi").alias("u"), F.col("lo").alias("v")))
        least = written(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "cc-least")
        large = e.join(least, e.lo == least.u).select("hi", F.col("m").alias("lo")).distinct()
        low = large.groupBy("hi").agg(F.min("lo").alias("m")).withColumnRenamed("hi", "u")
        small = large.join(low, large.hi == low.u).where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        new = written(small.unionAll(low.select(F.col("u").alias("hi"), F.col("m").alias("lo"))).distinct(), "cc")
        now = _state(new)
        drop_written(e)
        drop_written(least)
        e = new
        if now == state and now[0] == now[2]:
            return e.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionAll(e.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct())
        state = now

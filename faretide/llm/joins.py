"""Joins and labels shared by the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faretide.session import stage

#: Key lists up to this many rows (one number each, so at most some 64 MB) are broadcast.
BROADCAST_ROWS = 2_000_000


def only(rows: DataFrame, keys: DataFrame, key: str, how: str = "left_semi") -> DataFrame:
    """``rows`` whose ``key`` is in ``keys`` (one number a row): broadcast if few, else shuffled."""
    if keys.count() <= BROADCAST_ROWS:
        keys = F.broadcast(keys)
    return rows.join(keys, key, how)


def components(links: DataFrame) -> DataFrame:
    """``(id, component)``: the smallest id that each end of ``(a, b)`` rows can reach.

    Every round takes the smallest label among the neighbours, then the label of that label, so
    that paths shrink by about half. Labels are written once a round, which cuts the lineage.
    """
    both = links.select("a", "b").union(links.select(F.col("b"), F.col("a")))
    both = stage(both.where("a <> b").distinct(), "links")
    labels = stage(
        both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("n"))
        .select("id", F.least("id", "n").alias("component")), "labels",
    )
    while True:
        near = (
            both.join(labels.select(F.col("id").alias("b"), "component"), "b")
            .groupBy(F.col("a").alias("id")).agg(F.min("component").alias("near"))
        )
        lower = labels.join(near, "id").select(
            "id", F.col("component").alias("old"), F.least("component", "near").alias("c")
        )
        jump = labels.select(F.col("id").alias("c"), F.col("component").alias("further"))
        found = stage(
            lower.join(jump, "c", "left").select(
                "id", F.coalesce(F.least("c", "further"), "c").alias("component"), "old"
            ),
            "labels",
        )
        labels = found.select("id", "component")
        if found.where("component <> old").isEmpty():
            return labels

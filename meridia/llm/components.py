"""Connected components of a table of links, without gathering any component in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meridia.session import materialize


def components(links: DataFrame) -> DataFrame:
    """Smallest reachable node for every node of ``links`` (a, b): columns ``node``, ``component``.

    Alternates two rounds until nothing moves: every node hands its larger neighbours to its smallest one,
    then its smaller ones. Only minima are grouped, so a node with very many links is reduced before the
    shuffle, and the join back to its links is one that adaptive execution may split. Each round is written.
    Null ends and loops are left out; an empty table gives an empty one.
    """
    links = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links = materialize(links, "links")
    before = None
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _towards_least(both, links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        small = materialize(_towards_least(large, large), "links")
        now = small.agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")
        ).first()
        links = small
        if now == before:
            return small.select(F.col("a").alias("node"), F.col("b").alias("component"))
        before = now


def _towards_least(pairs: DataFrame, kept: DataFrame) -> DataFrame:
    """For each node of ``kept`` (a, b): links from each b, and from the node, to the node's least neighbour."""
    least = pairs.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    moved = kept.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    own = least.select("a", F.col("m").alias("b"))
    return (
        moved.unionByName(own)
        .where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )

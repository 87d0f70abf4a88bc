"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Stored, release, salted_join

#: Tasks over which the edges of one node spread in a step.
SPREAD = 16


def _largest(edges: DataFrame) -> DataFrame:
    """Each node links its larger neighbours to the smallest of its neighbourhood."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    met = salted_join(both.where(F.col("v") > F.col("u")), low, ["u"], F.col("v"), salts=SPREAD)
    return met.select(F.col("v").alias("u"), F.col("m").alias("v"))


def _smallest(edges: DataFrame) -> DataFrame:
    """Each node links itself and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    met = salted_join(down, low, ["u"], F.col("v"), salts=SPREAD).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return met.union(low.select("u", F.col("m").alias("v"))).where(F.col("u") != F.col("v"))


def connected_components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``node`` and ``component`` (its smallest node) of every node on an edge ``u``-``v``.

    Edges stay distributed; each round is written to the shared folder and the
    last one removed, so a lost executor costs a round's partitions at most.
    The edges of a node with many spread over SPREAD tasks; minima combine
    before the shuffle.

    Self-links and null ends are ignored, repeated edges count once, and no
    edges give no rows.
    """
    now = Stored(edges.where("u is not null and v is not null and u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    mark = None
    for _ in range(most_rounds):
        if mark is None:
            mark = now.df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        new = Stored(_smallest(_largest(now.df)).distinct())
        now.drop()
        now, old = new, mark
        release(now.spark)
        mark = now.df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == old:
            break
    else:
        raise RuntimeError("components did not settle")
    stars = now.df.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.union(stars.select(F.col("component").alias("node"), "component").distinct())

"""Connected components of a table of links, by alternating stars.

A large star links the larger neighbours of a node to its smallest one, a small
star the smaller ones; both keep components whole, and after a number of rounds
that grows with the logarithm of the longest path every node is linked to the
smallest of its component. Minima are combined before the shuffle, and the joins
are equalities that adaptive execution can split when a node has many links.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txrisk.llm.common import discard, stored


def _large_star(links: DataFrame) -> DataFrame:
    """Links (u, v) with u > v to (v's larger neighbours, smallest neighbour)."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return (
        both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    )


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    others = links.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return others.unionByName(least.select("u", F.col("m").alias("v")))


def _fingerprint(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def connected(links: DataFrame) -> DataFrame:
    """``u``, ``v`` links to one row per linked node that is not the smallest of
    its component: ``node`` and ``component``, that smallest node."""
    high, low = F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    links = stored(links.select(high, low).filter("u <> v").distinct(), "links")
    seen = _fingerprint(links)
    while True:
        spent = links
        links = stored(_small_star(_large_star(links)).distinct(), "links")
        discard(spent)
        now = _fingerprint(links)
        if now == seen:
            return links.select(F.col("u").alias("node"), F.col("v").alias("component"))
        seen = now

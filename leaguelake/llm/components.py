"""Connected components of a link table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leaguelake.llm.common import grown
from leaguelake.sources.store import cut


def _distinct(links: DataFrame) -> DataFrame:
    return links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()



def components(links: DataFrame) -> DataFrame:
    """(node, root): for each node of links (u, v), the smallest node that it reaches.

    Each round hangs all neighbours below their smallest one: first those above a node, then those
    below. A node with many links enters as a pre-combined minimum, never as a list of neighbours.
    The table is written once a round, and the rounds end when one changes nothing.
    """
    now, before = cut(_distinct(links), "links"), None
    while not now.isEmpty():
        state = now.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("u", "v") % 1000003)).first()
        if state == before:
            break
        before = state
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = _distinct(both.where("v > u").join(grown(low), "u").select(F.col("v").alias("u"), F.col("m").alias("v")))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(grown(low), "u")
        small = hung.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            low.select("u", F.col("m").alias("v"))
        )
        now = cut(_distinct(small), "links")
    roots = now.groupBy("u").agg(F.min("v").alias("root")).select(F.col("u").alias("node"), "root")
    tops = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return roots.unionByName(tops.join(grown(roots), "node", "left_anti"))

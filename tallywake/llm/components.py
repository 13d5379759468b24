"""Connected groups of a graph by alternating stars, for graphs of any size and diameter."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywake.llm.common import stored


# Links that one task writes at least; a round's files are as many as its links ask for, not as shuffles have partitions.
LINKS = 1 << 18


def _to_least(edges: DataFrame) -> DataFrame:
    """Each edge (u, v) with the least of u and of all that u has edges to, as `m`."""
    # Never a broadcast: links grow with the input, and Spark takes exploded ones for half of what they are.
    least = edges.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")).hint("merge")
    return edges.join(least, "u")


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b), root being the least node it is connected to.

    Each round hangs all larger neighbours of a node on its least neighbour, then all smaller ones, until the
    links are stars. Rounds grow as the logarithm of the longest path; each is written to the shared folder.
    Links with a null end are left out; a node linked to itself only is its own root.
    """
    given = links.select(F.col("a").alias("u"), F.col("b").alias("v")).where("u IS NOT NULL AND v IS NOT NULL")
    alone = given.where("u = v").select(F.col("u").alias("node"), F.col("u").alias("root"))
    edges, seen = stored(given.where("u <> v").distinct(), "links"), None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == seen or not state[0]:
            break
        seen = state
        both = edges.union(edges.select("v", "u"))
        large = _to_least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        small = _to_least(down).select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
        # A round at most doubles the links, whose number is known.
        edges = stored(small.where("u <> v").distinct().coalesce(2 * state[0] // LINKS + 1), "links")
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.union(alone.join(stars.hint("merge"), "node", "left_anti").distinct())

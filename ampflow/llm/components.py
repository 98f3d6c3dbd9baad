"""Connected components of a link table by alternating large-star and small-star rounds.

Each round replaces links so that nodes point at smaller nodes of their component; after about log(nodes) rounds every
node points at the smallest one. Minima combine before each shuffle, and the join back to the links has many rows on
one side only, which adaptive execution splits where a node has very many links.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ampflow.llm.common import written


def _large_star(links: DataFrame) -> DataFrame:
    """Larger neighbours of a node now point at the node's smallest neighbour."""
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("least")).withColumn("least", F.least("least", "a"))
    moved = both.where("b > a").join(least, "a")
    return moved.select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours point at the smallest of these. Links run from the larger node."""
    least = links.groupBy("a").agg(F.min("b").alias("least"))
    moved = links.join(least, "a")
    return (
        moved.select(F.col("b").alias("a"), F.col("least").alias("b"))
        .where("a > b")
        .union(least.select("a", F.col("least").alias("b")))
        .distinct()
    )


def _state(links: DataFrame) -> tuple:
    """Equal for equal link sets: the count and a sum of hashes."""
    digest = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    return tuple(links.agg(F.count("*"), digest).first())


def connected_components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of the links ``(a, b)``; ``root`` is the component's smallest node.

    No links give no rows; repeated links and links of a node with itself do no harm.
    """
    current = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    current = written(current, "links")
    state = _state(current)
    while state[0]:
        current = written(_small_star(_large_star(current)), "links")
        state, earlier = _state(current), state
        if state == earlier:
            break
    roots = current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())

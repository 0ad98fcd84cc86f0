"""Connected components of a distributed link table by random contraction.

Each round every node moves to the neighbour (or itself) that comes first in
a fresh random order, links are rewritten between the nodes that remain, and
the moves are written down; the number of nodes falls by a constant factor
whatever the shape of the graph (long chains and large stars included). The
moves are composed afterwards. No link or label reaches the driver; per-key
work is a combined minimum or a join whose skewed side can be split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import staged


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node that has a link to another node.

    ``root`` names the component (one of its nodes, not the smallest). Null
    ends and self-links are ignored; repeated links count once."""
    links = links.select(F.col(a).alias("a"), F.col(b).alias("b"))
    links = staged(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    moves: list[DataFrame] = []
    while not links.isEmpty():
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        order = lambda c: F.struct(F.xxhash64(F.col(c), F.lit(len(moves))).alias("p"), F.col(c).alias("n"))
        first = both.groupBy("a").agg(F.min(order("b")).alias("m"))
        move = staged(first.select(F.col("a").alias("node"), F.least("m", order("a"))["n"].alias("to")), "moves")
        moves.append(move)
        at = lambda end: move.select(F.col("node").alias(end), F.col("to").alias(f"{end}_to"))  # noqa: E731, B023
        links = staged(
            links.join(at("a"), "a").join(at("b"), "b").where("a_to <> b_to")
            .select(F.least("a_to", "b_to").alias("a"), F.greatest("a_to", "b_to").alias("b")).distinct(),
            "links",
        )
    if not moves:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = moves[-1].select("node", F.col("to").alias("root"))
    for move in reversed(moves[:-1]):
        later = roots.select(F.col("node").alias("to"), "root")
        roots = move.join(later, "to", "left").select("node", F.coalesce("root", "to").alias("root"))
    return roots

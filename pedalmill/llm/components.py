"""Connected components of a graph given by its links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pedalmill.session import cut

#: Rounds after which the search gives up; each round at least halves the trees' depth.
MAX_ROUNDS = 60


def connected_components(links: DataFrame, max_rounds: int = MAX_ROUNDS) -> DataFrame:
    """(node, component) of every node of ``links`` (src, dst); component is the smallest node reachable.

    Alternates large-star and small-star rounds (Kiveris et al., 2014), each a grouping by node, until
    no link changes. Links stay in files: every round is checkpointed to the shared folder, so a lost
    executor costs a task, and nothing but a count comes to the driver. Links with a null end, loops and
    repeated links are left out; no links give an empty result.
    """
    edges = links.select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")).where("u is not null and v is not null and u <> v").distinct()
    edges = cut(edges)
    for _ in range(max_rounds):
        # large star: every neighbour larger than u goes to the smallest of u's closed neighbourhood
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: u and its smaller neighbours go to the smallest of them
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        nxt = (
            large.join(small, "u")
            .select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v")
            .where("u <> v")
            .distinct()
        )
        nxt = cut(nxt)
        changed = nxt.exceptAll(edges).isEmpty() and edges.exceptAll(nxt).isEmpty()
        edges = nxt
        if changed:
            break
    else:
        raise RuntimeError(f"components not found within {max_rounds} rounds")
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())

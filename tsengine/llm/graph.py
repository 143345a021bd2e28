"""Connected components of an edge table, on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tsengine.llm._common import save_table


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``edges(a, b)`` -> ``(node, comp)``: comp is the smallest node reachable.

    Each round every node points to its smallest neighbour (a partial
    aggregate, so a hub is no single task), pointers are followed twice, the
    edges are rewritten to the targets and finished ones dropped.  Every round
    is written to the shared folder.  Loops and repeated edges are harmless;
    an empty table gives an empty result; ``null`` ends are left out.
    """
    edges = edges.where("a is not null and b is not null").select("a", "b")
    labels = save_table(edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
                        .withColumn("comp", F.col("node")), "labels")
    live = save_table(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                      .distinct(), "edges")
    for _ in range(max_rounds):
        if live.isEmpty():
            return labels
        to = save_table(live.union(live.select("b", "a")).groupBy("a").agg(F.min("b").alias("m"))
                        .select(F.col("a").alias("u"), F.least("a", "m").alias("p")), "pointers")
        for _ in range(2):
            nxt = to.select(F.col("u").alias("v"), F.col("p").alias("q"))
            to = to.join(nxt, to.p == nxt.v, "left").select("u", F.coalesce("q", "p").alias("p"))
        to = save_table(to, "pointers")
        labels = save_table(labels.join(to, labels.comp == to.u, "left")
                            .select("node", F.coalesce("p", "comp").alias("comp")), "labels")
        ta, tb = to.select(F.col("u").alias("a"), F.col("p").alias("x")), to.select(F.col("u").alias("b"), F.col("p").alias("y"))
        live = save_table(live.join(ta, "a").join(tb, "b").where("x <> y")
                          .select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct(), "edges")
    raise RuntimeError("components did not converge")

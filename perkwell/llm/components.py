"""Connected components of a graph given as edges, without bringing any group into one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from perkwell.llm.common import salted_join
from perkwell.sources.checkpoints import written

# Parts over which the edges of a node with very many are dealt.
SALTS = 8


def components(edges: DataFrame) -> DataFrame:
    """node, root for every node of ``edges`` (a, b); the root is the smallest node of its component.

    Every node keeps pointers to smaller nodes only. A round leaves each node with its
    smallest one and passes the others on to each other, so the pointers of a node never
    outgrow its own edges; it ends when every node has one pointer. Pointers are
    then followed, twice as far each time.
    """
    down = written(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("to")).distinct()
    )
    while True:
        # Written once, as both the test and the next pointers read it.
        least = written(down.groupBy("node").agg(F.min("to").alias("least"), F.count("*").alias("n")))
        several = least.filter("n > 1").select("node", "least")
        if several.isEmpty():
            break
        passed = down.join(several, "node").filter("to <> least").select(
            F.col("to").alias("node"), F.col("least").alias("to")
        )
        down = written(least.select("node", F.col("least").alias("to")).union(passed).distinct())
    while True:
        further = down.select(F.col("node").alias("to"), F.col("to").alias("beyond"))
        stepped = written(down.join(further, "to", "left").select(
            "node", F.coalesce("beyond", "to").alias("to"), F.col("beyond").isNotNull().alias("moved")
        ))
        down = stepped.select("node", "to")
        if stepped.filter("moved").isEmpty():
            break
    roots = down.select(F.col("to").alias("node"), "to").distinct()
    return down.union(roots).select("node", F.col("to").alias("root"))


def near_roots(edges: DataFrame, rounds: int = 2) -> DataFrame:
    """node, root: the smallest node within reach of ``2 * rounds`` edges, a cheap part of the components.

    Nodes with one root are in one component, but a wide component may keep several roots. Around a few centres,
    which is what comparisons with anchors give, two edges reach everything.
    """
    both = written(edges.filter("a <> b").select("a", "b").union(edges.filter("a <> b").select("b", "a")).distinct())
    root = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.min("a")).alias("root"))
    for _ in range(2 * rounds - 1):
        told = salted_join(both, root.withColumnRenamed("node", "b"), ["b"], "a", SALTS).groupBy(F.col("a").alias("node")).agg(F.min("root").alias("_told"))
        root = root.join(told, "node").select("node", F.least("root", "_told").alias("root"))
    return root

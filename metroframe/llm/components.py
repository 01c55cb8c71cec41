"""Connected components of a link table by repeated contraction.

Each round every node joins the neighbour (or itself) of the smallest random
priority; links are rewritten to the joined nodes and loops and repeats go.
The number of nodes falls by a constant factor per round in expectation, for
long chains too, so rounds grow with the logarithm of the longest path. The
rounds are then unwound from the smallest graph back to the first one.

Nothing about nodes or links reaches the driver but a row count per round.
Every join reads tables written to the shared folder, so a hot node's rows
meet plain exchanges that adaptive execution splits, and lost executors cost
one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metroframe.llm.common import stored


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node that has a link to another node; two nodes
    share a root exactly if links connect them. ``root`` is some node of the
    component. Loops, repeated and null links are ignored; no links, no rows."""
    def tidy(x, y):
        return F.least(x, y).alias("a"), F.greatest(x, y).alias("b")

    links = stored(links.where(F.col(a) != F.col(b)).select(*tidy(F.col(a), F.col(b))).distinct(), "links")
    steps: list[DataFrame] = []
    while True:
        n = len(steps)

        def priority(node):
            return F.struct(F.xxhash64(node, F.lit(n)).alias("p"), node.alias("node"))

        both = links.union(links.select("b", "a"))
        near = both.groupBy("a").agg(F.min(priority(F.col("b"))).alias("near"))
        step = stored(near.select(F.col("a").alias("node"), F.least(priority(F.col("a")), F.col("near"))["node"].alias("to")), f"step{n}")
        if step.isEmpty():
            break
        steps.append(step)
        left, right = (step.select(F.col("node").alias(k), F.col("to").alias(f"to_{k}")) for k in ("a", "b"))
        moved = links.join(left, "a").join(right, "b").where("to_a <> to_b")
        links = stored(moved.select(*tidy(F.col("to_a"), F.col("to_b"))).distinct(), f"links{n}")
    if not steps:
        return step.select("node", F.col("to").alias("root"))
    roots = steps.pop().select("node", F.col("to").alias("root"))
    while steps:
        step = steps.pop()
        above = roots.select(F.col("node").alias("to"), "root")
        roots = stored(step.join(above, "to", "left").select("node", F.coalesce("root", "to").alias("root")), "roots")
    return roots

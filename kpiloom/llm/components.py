"""Connected components of an edge table, by contraction; nothing is collected.

Each round every node points to the neighbour (or itself) of least pseudo-random
priority, and the edges are carried over to the nodes pointed to.  A fixed share of
the nodes vanishes per round, so paths as well as stars need rounds in the logarithm
of their size.  Every round is a written table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.common import lookup
from kpiloom.session import stage

#: Above this many rounds something is wrong with the input; priorities change per round.
MOST_ROUNDS = 200


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (long columns ``a``, ``b``); one root per component."""
    edges = stage(
        edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges"
    )
    steps: list[DataFrame] = []
    for number in range(MOST_ROUNDS):
        if not edges.head(1):
            break
        rank = lambda c: F.struct(F.xxhash64(F.lit(number), F.col(c)).alias("h"), F.col(c).alias("node"))
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = stage(
            both.groupBy(F.col("a").alias("node")).agg(
                F.least(F.min(rank("b")), F.min(rank("a")))["node"].alias("to")
            ),
            "step",
        )
        steps.append(step)
        moved = stage(
            lookup(edges, step.select(F.col("node").alias("a"), F.col("to").alias("a2")), "a", "inner")
            .select(F.col("a2").alias("a"), "b"),
            "moved",
        )
        moved = lookup(moved, step.select(F.col("node").alias("b"), F.col("to").alias("b2")), "b", "inner")
        edges = stage(
            moved.select(F.col("a"), F.col("b2").alias("b")).where("a <> b")
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
            "edges",
        )
    else:
        raise RuntimeError("components did not end")
    if not steps:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    # from the last round back: where a node points to, the later rounds say where that ended
    found = steps[-1].select("node", F.col("to").alias("root"))
    for step in reversed(steps[:-1]):
        later = found.select(F.col("node").alias("to"), "root")
        found = stage(
            lookup(step, later, "to").select("node", F.coalesce("root", "to").alias("root")), "roots"
        )
    return found

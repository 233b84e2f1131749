"""Connected components of an edge list by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lodegrain.llm import common


def _shortened(parent: DataFrame) -> DataFrame:
    """Each node's root in the forest ``parent`` (v, p), by pointer jumping: chains halve each round."""
    while True:
        up = parent.select(F.col("v").alias("p"), F.col("p").alias("end"))
        moved = common.settle(parent.join(up, "p").select("v", F.col("end").alias("p"), (F.col("end") != F.col("p")).alias("moved")), "labels")
        common.drop(parent)
        parent = moved.select("v", "p")
        parent._lodegrain_scratch = moved._lodegrain_scratch
        if not moved.filter("moved").limit(1).count():
            return parent


def connected(edges: DataFrame) -> DataFrame:
    """(v, root) for each end of the edges (a long, b long); root is the least node of the component.

    Each node is hooked to its least neighbour if that is less, which needs one row for
    each node after partial sums, whatever the number of its edges. The trees are shortened
    to stars and the edges renamed to their roots; edges within a tree go, so few are left
    after a round, and at most log n rounds are needed. Every table is written to the shared
    scratch folder, and removed when the next one stands.
    """
    way = lambda v, u: F.struct(F.col(v).alias("v"), F.col(u).alias("u"))
    rest = common.settle(edges.select("a", "b").distinct(), "edges")
    labels, rounds = None, []
    while labels is None or rest.limit(1).count():
        both = rest.select(F.explode(F.array(way("a", "b"), way("b", "a"))).alias("e")).select("e.*")
        roots = _shortened(common.settle(both.groupBy("v").agg(F.min("u").alias("u")).select("v", F.least("v", "u").alias("p")), "hooked"))
        named = lambda side: roots.select(F.col("v").alias(side), F.col("p").alias(f"{side}_root"))
        left = rest.join(named("a"), "a").select("a_root", "b").distinct().join(named("b"), "b")
        after = common.settle(left.filter("a_root != b_root").select(F.col("a_root").alias("a"), F.col("b_root").alias("b")).distinct(), "edges")
        common.drop(rest)
        rest = after
        if labels is None:
            labels = roots.select("v", F.col("p").alias("root"))
        else:
            rounds.append(roots)
    common.drop(rest)
    for roots in rounds:
        labels = labels.join(roots.select(F.col("v").alias("root"), "p"), "root", "left").select("v", F.coalesce("p", "root").alias("root"))
    return common.settle(labels, "components") if rounds else labels

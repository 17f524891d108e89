"""Connected components of a large graph, by rounds of contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskbook.llm.common import stored


def connected_components(edges: DataFrame) -> DataFrame:
    """``node`` and ``label`` of every node of ``edges`` (``a``, ``b``, both long); nodes share a label if and only if
    a path joins them. A label is one of the nodes, not a particular one.

    In each round every node moves to the neighbour with the smallest hash, then once more to where that one moved, and
    the edges follow; hashes differ by round, so long chains shrink as fast as stars. Rounds end when no edge is left.
    Nothing is gathered by node: minima are combined before the shuffle, and joins on crowded nodes are left to AQE.

    Loops, repeated and reversed edges change nothing; edges with a null end are left out; no edges give no rows.
    """
    edges = edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    left = stored(edges, "edges")
    moves: list[DataFrame] = []
    while not left.isEmpty():
        moves.append(stored(_moves(left, len(moves)), "moves"))
        to_a = moves[-1].select(F.col("node").alias("a"), F.col("to").alias("to_a"))
        to_b = moves[-1].select(F.col("node").alias("b"), F.col("to").alias("to_b"))
        moved = left.join(to_a, "a").join(to_b, "b").where("to_a <> to_b")
        left = stored(
            moved.select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b")).distinct(), "edges"
        )
    if not moves:
        return left.select(F.col("a").alias("node"), F.col("b").alias("label"))
    labels = moves[0].select("node", F.col("to").alias("label"))
    for later in moves[1:]:
        labels = labels.join(later.select(F.col("node").alias("label"), "to"), "label", "left").select(
            "node", F.coalesce("to", "label").alias("label")
        )
    return labels


def _moves(edges: DataFrame, round_no: int) -> DataFrame:
    """Where each node goes: the least hash among itself and its neighbours, followed twice."""

    def ranked(node: str):
        return F.struct(F.xxhash64(F.lit(round_no), F.col(node)).alias("rank"), F.col(node).alias("node"))

    both = edges.select("a", "b").union(edges.select("b", "a"))
    first = both.groupBy(F.col("a").alias("node")).agg(F.min(ranked("b")).alias("other"))
    first = first.select("node", F.least(ranked("node"), "other").getField("node").alias("to"))
    second = first.select(F.col("node").alias("to"), F.col("to").alias("then"))
    return first.join(second, "to").select("node", F.col("then").alias("to"))

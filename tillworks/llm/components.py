"""Connected components by contraction with random priorities."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillworks.session import materialize, release


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``id, root`` for every vertex of ``edges`` (``a, b``), written; vertices share a root when joined.

    In each round every vertex takes the label with the least priority among
    itself and its neighbours, and edges move to the new labels.  A priority is
    a hash that serves two rounds: a star is one label after both, and a fresh
    one for each two rounds takes about half of the labels whatever the shape,
    paths included.  Minima combine before the shuffle, so hubs need no gathering.
    """
    edges = materialize(edges.filter("a <> b").distinct(), "edges")
    labels = None
    for turn in range(max_rounds):
        if edges.isEmpty():
            break
        rank = lambda c: F.struct(F.xxhash64(F.lit(turn // 2), c).alias("p"), F.col(c).alias("v"))  # noqa: B023, E731
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        moves = materialize(
            both.groupBy("a").agg(F.min(rank("b")).alias("m")).select("a", F.least("m", rank("a"))["v"].alias("to")), "moves"
        )
        if labels is None:
            before, labels = None, materialize(moves.select(F.col("a").alias("id"), F.col("to").alias("root")), "labels")
        else:
            step = moves.select(F.col("a").alias("_a"), F.col("to").alias("_to"))
            before, labels = labels, materialize(
                labels.join(step, labels["root"] == step["_a"], "left").select("id", F.coalesce("_to", "root").alias("root")), "labels"
            )
        to_a = moves.select(F.col("a"), F.col("to").alias("x"))
        to_b = moves.select(F.col("a").alias("b"), F.col("to").alias("y"))
        moved = edges.join(to_a, "a").join(to_b, "b").filter("x <> y")
        done, edges = edges, materialize(moved.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges")
        # What the next round reads has been written.
        release(done, moves, *([before] if before is not None else []))
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    if labels is None:
        return materialize(edges.select(F.col("a").alias("id"), F.col("b").alias("root")), "labels")
    return labels

"""Connected components of an edge table, as rounds of joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codeledger.session import checkpointed

MAX_ROUNDS = 100


def components(edges: DataFrame) -> DataFrame:
    """(node, component): for each end of an edge the least node it is joined to.

    ``edges`` has the columns a and b, of one orderable type; direction, copies
    and loops do not matter, an edge with a null end is none.  Every round hangs
    all larger neighbours of a node on the least one around it (large star), then
    all smaller ones (small star), until nothing changes; the number of rounds
    grows with the logarithm of the number of nodes.  Neighbourhoods are never
    gathered: only their minimum is, by a partial aggregate, and a node with very
    many edges is split by the join's skew handling.  Each round is written to
    the shared checkpoint folder; the driver sees two numbers a round.
    """
    pairs = edges.where("a is not null and b is not null and a <> b")
    pairs = pairs.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("near")).distinct()
    pairs = checkpointed(pairs)
    before = _state(pairs)
    for _ in range(MAX_ROUNDS):
        if not before[0]:
            break
        pairs = checkpointed(_small_star(_large_star(pairs)))
        after = _state(pairs)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components do not settle within {MAX_ROUNDS} rounds")
    roots = pairs.select("near").distinct()
    return pairs.select("node", F.col("near").alias("component")).union(
        roots.select(F.col("near").alias("node"), F.col("near").alias("component"))
    )


def _state(pairs: DataFrame) -> tuple:
    """Number of pairs and a sum over their hashes: equal when nothing has changed."""
    row = pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("node", "near").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def _large_star(pairs: DataFrame) -> DataFrame:
    both = pairs.union(pairs.select(F.col("near").alias("node"), F.col("node").alias("near")))
    least = both.groupBy("node").agg(F.least(F.col("node"), F.min("near")).alias("least"))
    larger = both.where("near > node").join(least, "node")
    return larger.select(F.col("near").alias("node"), F.col("least").alias("near")).distinct()


def _small_star(pairs: DataFrame) -> DataFrame:
    least = pairs.groupBy("node").agg(F.min("near").alias("least"))
    moved = pairs.join(least, "node").where("near <> least").select(F.col("near").alias("node"), F.col("least").alias("near"))
    kept = least.select("node", F.col("least").alias("near"))
    return moved.union(kept).where("node <> near").distinct()

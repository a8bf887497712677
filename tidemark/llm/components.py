"""Connected components of an edge table by alternating large and small stars, without collecting anything."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Tables, packed

#: Bytes that an edge takes while its stars are made.
EDGE_BYTES = 64


def _least(edges: DataFrame) -> DataFrame:
    """u and the least of itself and its neighbours; the minima are combined map-side, so hubs don't meet in one task."""
    return edges.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("hub"), F.least("u", "m").alias("m"))


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """Link each vertex's larger (or smaller) neighbours, and for small stars itself, to the least vertex that it sees."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if larger:
        both = both.unionByName(both.select(F.col("v").alias("u"), F.col("u").alias("v")))
        linked = both.join(_least(both), F.col("u") == F.col("hub")).filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:  # a is the larger end of every edge
        least = _least(both)
        linked = both.join(least, F.col("u") == F.col("hub")).select(F.col("v").alias("a"), F.col("m").alias("b"))
        linked = linked.unionByName(least.select(F.col("hub").alias("a"), F.col("m").alias("b")))
    return linked.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).dropDuplicates()


def components(edges: DataFrame, max_rounds: int = 200) -> DataFrame:
    """(id, component) of each vertex that has an edge, from edges (a, b); component: the smallest id that is reachable.

    Graphs of less than a partition's bytes stay in one partition, so that their rounds cost no exchange. A labelling
    that hasn't settled after max_rounds is an error, never a result.
    """
    tables = Tables(edges.sparkSession)
    pairs = tables.keep(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).dropDuplicates())
    n, last = pairs.count(), None
    for _ in range(max_rounds):
        pairs = tables.keep(_star(_star(packed(pairs, n, EDGE_BYTES), larger=True), larger=False), instead_of=(pairs,))
        # Stars with the least vertex in the middle don't change any more; count and sums tell any change.
        state = packed(pairs, n, EDGE_BYTES).agg(F.count("*"), F.sum(F.col("b").cast("decimal(38,0)")), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == last:
            break
        n, last = state[0], state
    else:
        raise RuntimeError(f"components have not settled after {max_rounds} rounds")
    roots = pairs.select(F.col("b").alias("id")).dropDuplicates()
    return pairs.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(roots.select("id", F.col("id").alias("component")))

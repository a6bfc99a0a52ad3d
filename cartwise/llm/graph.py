"""Connected components of an edge table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwise.llm.common import written


def _star(edges: DataFrame, around: DataFrame) -> DataFrame:
    """Edges (big, small): every neighbour ``n`` of ``u`` re-attached to the smallest
    of ``u`` and its neighbours. The minimum is a map-side combined aggregate that is
    joined back, so a node with very many neighbours is no single-task group."""
    least = around.groupBy("u").agg(F.min("n").alias("m")).select("u", F.least("u", "m").alias("m"))
    return around.join(least, "u")


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of ``edges``; the component is its smallest node.

    Each round is a large star and a small star; the edge table is written to the
    shared folder after each round and rounds end when it no longer changes.
    Self-loops and repeated edges are allowed. No edges: no rows.
    """
    e = written(edges.where(F.col(a) != F.col(b))
                .select(F.greatest(a, b).alias("x"), F.least(a, b).alias("y")).distinct(), "edges")
    mark = None
    while True:
        both = e.selectExpr("x AS u", "y AS n").unionAll(e.selectExpr("y AS u", "x AS n"))
        large = (_star(e, both).where("n > u").selectExpr("n AS x", "m AS y").where("x <> y").distinct())
        down = large.selectExpr("x AS u", "y AS n")
        small = _star(large, down)
        e2 = written(small.selectExpr("n AS x", "m AS y").unionAll(small.selectExpr("u AS x", "m AS y"))
                     .where("x <> y").distinct(), "edges")
        now = e2.agg(F.count("*").alias("n"), F.sum(F.xxhash64("x", "y").cast("decimal(38,0)")).alias("s")).first()
        if (now["n"], now["s"]) == mark:
            break
        mark, e = (now["n"], now["s"]), e2
    return e2.selectExpr("x AS node", "y AS component").unionAll(
        e2.selectExpr("y AS node", "y AS component").distinct())

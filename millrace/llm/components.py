"""Connected components by contraction, all in DataFrames.

Each round points every vertex at its smallest neighbour (or itself), follows the pointers to their roots by
doubling, and contracts the edges to those roots. At least half of the vertices that still
have edges vanish in a round, so rounds and steps are logarithmic whatever the shape of the
graph, and nothing but counts reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.workspace import Workspace


def components(ws: Workspace, edges: DataFrame) -> DataFrame:
    """(vertex, root) for every vertex of edges(a, b); the root is the smallest vertex of the component."""
    edges = ws.save(edges.select("a", "b").where("a <> b").distinct(), "edges")
    found = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = ws.save(both.groupBy(F.col("a").alias("vertex")).agg(F.least(F.min("b"), F.first("a")).alias("root")), "nearest")
        while True:
            up = near.select(F.col("vertex").alias("root"), F.col("root").alias("upper"))
            jumped = ws.save(near.join(up, "root").select("vertex", F.col("upper").alias("root"), (F.col("upper") != F.col("root")).alias("moved")), "jump")
            ws.drop(near)
            near = jumped
            if jumped.where("moved").isEmpty():
                break
        near = near.select("vertex", "root")
        if found is None:
            found = near
        else:
            up = near.select(F.col("vertex").alias("root"), F.col("root").alias("upper"))
            found = ws.save(found.join(up, "root", "left").select("vertex", F.coalesce("upper", "root").alias("root")), "found")
        left, right = near.toDF("a", "ra"), near.toDF("b", "rb")
        edges = ws.save(edges.join(left, "a").join(right, "b").select(F.col("ra").alias("a"), F.col("rb").alias("b")).where("a <> b").distinct(), "edges")
        if edges.isEmpty():
            return found

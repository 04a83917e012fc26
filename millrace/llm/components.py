"""Connected components by Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import materialize


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of `edges` (a, b); the root is one node of its component.

    Each round hooks every node onto its smallest neighbour if that is smaller, follows the hooks to
    their ends by pointer jumping, and contracts the edges to those ends. What is left shrinks by
    half at least, so rounds grow with the logarithm of the number of nodes. Minima are pre-aggregated
    and everything else is an equi-join of plain columns, so a node with very many edges is split.
    Loops and null ends are left out.
    """
    spark = edges.sparkSession
    left = materialize(edges.select("a", "b").where("a <> b").distinct(), "edges")
    found = None
    while not left.isEmpty():
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = materialize(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b")).select(
            "node", F.least("node", "b").alias("root")), "hooks")
        while True:
            up = hooks.select(F.col("node").alias("root"), F.col("root").alias("next"))
            jumped = materialize(hooks.join(up, "root").select(
                "node", F.col("next").alias("root"), (F.col("next") != F.col("root")).alias("moved")
            ), "hooks")
            hooks = jumped.select("node", "root")
            if jumped.where("moved").isEmpty():
                break
        if found is None:
            found = hooks
        else:
            up = hooks.select(F.col("node").alias("root"), F.col("root").alias("next"))
            found = materialize(found.join(up, "root", "left").select(
                "node", F.coalesce("next", "root").alias("root")), "roots")
        ends = hooks.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        others = hooks.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        left = materialize(left.join(ends, "a").join(others, "b").where("ra <> rb").select(
            F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), "edges")
    if found is None:
        kind = edges.schema["a"].dataType
        return spark.range(0).select(F.lit(None).cast(kind).alias("node"),
                                     F.lit(None).cast(kind).alias("root"))
    return found

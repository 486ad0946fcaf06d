"""Connected components of a link table, by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import cut, discard


def _flatten(parents: DataFrame) -> DataFrame:
    """Pointer jumping: every node ends at the root of its tree. `parents` was cut."""
    while True:
        up = parents.select(F.col("node").alias("parent"), F.col("parent").alias("over"))
        jumped = cut(
            parents.join(up, "parent", "left").select(
                "node",
                F.coalesce("over", "parent").alias("parent"),
                (F.coalesce("over", "parent") != F.col("parent")).alias("moved"),
            ),
            "jump",
        )
        discard(parents)
        parents = jumped
        if jumped.filter("moved").isEmpty():
            return jumped


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of `links` (columns a, b of one orderable type).

    The root is the smallest node of the component. Each round hooks every node below its
    smallest neighbour, flattens the trees and keeps only links between different trees.
    At least half of the nodes that still have links lose their root each round, so rounds
    grow as the logarithm of the table. Neighbour lists are never gathered: a node with any
    number of links costs one `min` with map-side combine, and joins that Spark may split.
    Null ends are ignored; an empty table gives no rows.
    """
    links = links.select("a", "b").filter("a != b")
    found, own = None, None
    while True:
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
        flat = _flatten(cut(hooks.select("node", F.least("node", "least").alias("parent")), "hook"))
        parents = flat.select("node", "parent")
        left = parents.select(F.col("node").alias("a"), F.col("parent").alias("ra"))
        right = parents.select(F.col("node").alias("b"), F.col("parent").alias("rb"))
        between = links.join(left, "a").join(right, "b").filter("ra != rb")
        links = cut(between.select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct(), "links")
        if own is not None:
            discard(own)
        own = links
        if found is None:
            found = flat
        else:
            later = parents.select(F.col("node").alias("parent"), F.col("parent").alias("over"))
            joined = cut(found.join(later, "parent", "left").select("node", F.coalesce("over", "parent").alias("parent")), "roots")
            discard(found, flat)
            found = joined
        if links.isEmpty():
            discard(links)
            return found.select("node", F.col("parent").alias("root"))

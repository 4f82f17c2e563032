"""Connected components of a graph given by its links, without a hub in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import Shelf


def components(links: DataFrame, shelf: Shelf, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): every node that has a link, with the smallest node reachable from it; kept on the shelf.

    Rounds of hooking and jumping: every link joins the roots of its ends, every root takes the smallest root it meets,
    and then every node takes its root's last root. Roots only get smaller, so the rounds end, after about log(n) of
    them. The joins are on node names with both sides fresh from storage, so Spark can split the rows of a hub; minima
    are pre-aggregated in each task.
    """
    with Shelf(links.sparkSession) as own:
        labels = _rounds(links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a != b"), own)
        return shelf.put(labels, "components")


def _rounds(links: DataFrame, own: Shelf) -> DataFrame:
    pairs = own.put(links.distinct())
    labels = own.put(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct().select("node", F.col("node").alias("root")))
    open_pairs = own.put(pairs.select(F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high")).distinct())
    while not open_pairs.isEmpty():
        hooks = own.put(open_pairs.groupBy(F.col("high").alias("root")).agg(F.min("low").alias("next")))
        # Follow the hooks to their ends: a hook leads to a smaller root, so there is no circle.
        moved = True
        while moved:
            ahead = hooks.select(F.col("root").alias("next"), F.col("next").alias("after"))
            jumped = own.put(
                hooks.join(ahead, "next", "left")
                .select("root", F.coalesce("after", "next").alias("next"), F.col("after").isNotNull().alias("moved"))
            )
            moved = not jumped.where("moved").isEmpty()
            hooks = jumped.drop("moved")
        labels = own.put(labels.join(hooks, "root", "left").select("node", F.coalesce("next", "root").alias("root")))
        # Roots are nodes too, so links between old roots stand for the links between their nodes. Only those between
        # different new roots still matter.
        new = open_pairs.join(labels.select(F.col("node").alias("low"), F.col("root").alias("ra")), "low").join(
            labels.select(F.col("node").alias("high"), F.col("root").alias("rb")), "high"
        )
        open_pairs = own.put(
            new.where("ra != rb").select(F.least("ra", "rb").alias("low"), F.greatest("ra", "rb").alias("high")).distinct()
        )
    return labels

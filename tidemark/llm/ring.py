"""Sharding by a consistent-hash ring with virtual nodes and bounded loads, in built-in functions only.

The ring has PLACES places. Every shard has virtual nodes on it; the stretch of places up to a virtual node is its arc.
A key's hash is its place, and the key belongs to the arc it falls into. A shard takes keys up to its bound; a key that
finds its shard full continues clockwise to the next shard that has room. With a slack of zero the bounds add up to the
number of rows, so the shards' counts differ by one at most.

All keys of an arc meet the same shards in the same order. So only the arcs' counts, as many as there are virtual nodes,
come to the driver; they decide how many keys of which arc each shard takes, and a row finds its shard and slot by its
rank in its arc. Ranks are worked out in groups of bounded size.

Rules for odd input: a null text has no bytes (size 1) and crc32 0; null and repeated ids are keys like any other and may
be split over shards when these are full; an empty table has no rows.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidemark.llm.common import Shelf, col, text_of

SHARDS = 16
VIRTUAL_NODES = 64
PLACES = 1 << 16

# Rows that are ranked together, about; only a group of like rows can be larger before it is split.
GROUP_ROWS = 100_000


def ring(spark: SparkSession, shards: int, virtual_nodes: int = VIRTUAL_NODES) -> list[tuple[int, int]]:
    """(place, shard) of every virtual node, clockwise. A shard's nodes do not depend on how many shards there are."""
    nodes = spark.range(shards * virtual_nodes).select(
        F.floor(F.col("id") / virtual_nodes).cast("int").alias("shard"), (F.col("id") % virtual_nodes).alias("node")
    ).select("shard", F.pmod(F.xxhash64(F.lit("node"), "shard", "node"), F.lit(PLACES)).cast("int").alias("place"))
    return sorted((r.place, r.shard) for r in nodes.collect())


def arcs_of(nodes: Sequence[tuple[int, int]]) -> list[int]:
    """For every place the number of the first virtual node at or after it, clockwise."""
    out, at = [], 0
    for place in range(PLACES):
        while at < len(nodes) and nodes[at][0] < place:
            at += 1
        out.append(at if at < len(nodes) else 0)
    return out


def bounds(n: int, shards: int, slack: float) -> list[int]:
    """How many rows each shard takes at most; without slack they add up to n."""
    if slack <= 0:
        return [n // shards + (s < n % shards) for s in range(shards)]
    return [int(-(-n * (1 + slack) // shards))] * shards


def plan(nodes: Sequence[tuple[int, int]], counts: dict[int, int], free: Sequence[int]) -> list[dict]:
    """Which ranks of which arc go to which shard, from what slot on.

    In the first round every arc turns to its own shard, in each further one to the next other shard clockwise.
    """
    shards, free = len(free), list(free)
    orders = {}
    for arc in counts:
        seen: list[int] = []
        for i in range(len(nodes)):
            shard = nodes[(arc + i) % len(nodes)][1]
            if shard not in seen:
                seen.append(shard)
            if len(seen) == shards:
                break
        orders[arc] = seen + [s for s in range(shards) if s not in seen]
    done, next_slot, out = dict.fromkeys(counts, 0), [0] * shards, []
    for step in range(shards):
        for arc in sorted(counts):
            shard = orders[arc][step]
            take = min(counts[arc] - done[arc], free[shard])
            if take:
                out.append({"arc": arc, "low": done[arc], "high": done[arc] + take, "shard": shard, "slot": next_slot[shard], "home": orders[arc][0], "hops": step})
                done[arc] += take
                free[shard] -= take
                next_slot[shard] += take
    return out


def _place(key: Column) -> Column:
    return F.pmod(F.xxhash64(key.cast("string")), F.lit(PLACES)).cast("int")


def assign(
    docs: DataFrame, text: str = "text", key: str = "doc_id", shards: int = SHARDS, slack: float = 0.0,
    virtual_nodes: int = VIRTUAL_NODES, group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """One row per document: the key, size, text_crc32, shard, slot, home_shard (the arc's own) and hops (shards passed)."""
    spark, shelf = docs.sparkSession, Shelf(docs.sparkSession)
    nodes = ring(spark, shards, virtual_nodes)
    arcs = F.split(F.lit(",".join(map(str, arcs_of(nodes)))), ",").cast("array<int>")
    data = text_of(docs, text).cast("binary")
    rows = docs.select(
        col(docs, key).alias("k"), (F.octet_length(data) + 1).cast("long").alias("size"), F.crc32(data).alias("crc"),
        F.element_at(arcs, _place(col(docs, key)) + 1).alias("arc"), F.monotonically_increasing_id().alias("uid"),
    )
    rows = shelf.put(rows, "ring")
    n = rows.count()
    parts = F.lit(max(1, -(-n // (group_rows * len(nodes)))))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("k", "size", "crc"), parts))
    sizes = shelf.put(rows.groupBy("arc", "part").agg(F.count(F.lit(1)).alias("n")), "sizes")
    # Rows alike in key and text share a part however many they are. Parts that came out large are cut by input place;
    # there are at most n / (2 * group_rows) of them.
    large = sizes.where(F.col("n") > 2 * group_rows).select("arc", "part", F.ceil(F.col("n") / group_rows).alias("cuts"))
    rows = rows.join(large, ["arc", "part"], "left").withColumn(
        "cut", F.coalesce(F.pmod(F.xxhash64("uid"), F.col("cuts")), F.lit(0))
    ).drop("cuts")
    groups = ["arc", "part", "cut"]
    counted = rows.groupBy(*groups).agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("arc").orderBy("part", "cut").rowsBetween(Window.unboundedPreceding, -1)
    offsets = shelf.put(counted.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))), "offsets")
    counts = {r.arc: r.n for r in offsets.groupBy("arc").agg(F.sum("n").alias("n")).collect()}

    takes = json.dumps(plan(nodes, counts, bounds(n, shards, slack)))
    kinds = "array<struct<arc:int,low:bigint,high:bigint,shard:int,slot:bigint,home:int,hops:int>>"
    # At most one row per virtual node and shard, whatever the table's size.
    taken = F.broadcast(spark.range(1).select(F.inline(F.from_json(F.lit(takes), kinds))).withColumnRenamed("arc", "of"))
    order = Window.partitionBy(*groups).orderBy("k", "crc", "size", "uid")
    ranked = rows.withColumn("rank", F.row_number().over(order) - 1).join(offsets.drop("n"), groups)
    at = F.col("before") + F.col("rank")
    return ranked.join(taken, (F.col("arc") == F.col("of")) & (at >= F.col("low")) & (at < F.col("high"))).select(
        F.col("k").alias(key), "size", F.col("crc").alias("text_crc32"), "shard",
        (F.col("slot") + at - F.col("low")).alias("slot"), F.col("home").alias("home_shard"), "hops",
    )

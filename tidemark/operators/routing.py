"""Sampling, traffic split and partitioning by key."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators.ordering import row_hash
from tidemark.session import broadcast_if_small, settle


def bucket(*key: str | Column, seed: int = 0) -> Column:
    """A stable number in 0..99 for a row; reruns and retries give the same one."""
    return F.pmod(F.xxhash64(F.lit(seed), *key), F.lit(100)).cast("int")


def picked(percent: int, draw: Column, strict: bool = False) -> Column:
    """Whether a draw in 0..99 is used. The kept rule is `<=`, so p picks p + 1 of 100; `strict` picks p."""
    return draw < percent if strict else draw <= percent


def choice(weights: Sequence[int], draw: Column) -> Column:
    """Index of the slot a draw in 0..99 falls into; the last slot takes whatever the weights leave over."""
    if not weights:
        raise ValueError("no weights")
    bounds, total = [], 0
    for weight in weights:
        total += weight
        bounds.append(total)
    bounds[-1] = 100
    slot = None
    for i, bound in enumerate(bounds):
        slot = F.when(draw < bound, F.lit(i)) if slot is None else slot.when(draw < bound, F.lit(i))
    return slot.otherwise(F.lit(0))


def partition_by_key(df: DataFrame, key: Sequence[str], partitions: int, rows_per_task: int = 2_000_000) -> DataFrame:
    """Hash-partition by key; a key with more rows than a task should hold is spread over as many tasks as it needs.

    Rows of an ordinary key share a partition. The table of large keys has at most rows / rows_per_task rows.
    """
    large = settle(
        df.groupBy(*key)
        .count()
        .where(F.col("count") > rows_per_task)
        .select(*[F.col(k).alias(f"_of_{k}") for k in key], F.ceil(F.col("count") / rows_per_task).alias("_spread"))
    )
    if large.isEmpty():
        return df.repartition(partitions, *key)
    same = F.lit(True)
    for k in key:
        same = same & F.col(k).eqNullSafe(F.col(f"_of_{k}"))
    spread = df.join(broadcast_if_small(large), same, "left")
    salt = F.pmod(row_hash(df), F.coalesce(F.col("_spread"), F.lit(1)))
    return spread.withColumn("_salt", salt).repartition(partitions, *key, "_salt").select(*df.columns)


def fan_out(df: DataFrame, outputs: Sequence[Callable[[DataFrame], None]]) -> None:
    """One computed table to several outputs; it is kept (on disk where memory is short) while they run."""
    kept = df.persist()
    try:
        for output in outputs:
            output(kept)
    finally:
        kept.unpersist()

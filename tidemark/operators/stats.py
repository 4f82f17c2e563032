"""Serving statistics (A1-A4)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidemark.operators.ordering import TARGET_ROWS, running


def serving_stats(scored: DataFrame, version: Sequence[str], duration: str, since: str) -> DataFrame:
    """Count, total, least and greatest duration per model activation; rows without a model form one group."""
    return scored.groupBy(*version).agg(
        F.count(F.lit(1)).alias("score_count"),
        F.sum(duration).alias("duration"),
        F.min(duration).alias("min"),
        F.max(duration).alias("max"),
        F.min(since).alias("since"),
    )


def activation_stats(
    versions: DataFrame, scored: DataFrame, version: Sequence[str], duration: str, valid_from: str, seq: str | None = None
) -> DataFrame:
    """The statistics of every activation, also of those without a record yet: since counts from the activation.

    `versions` is the version table, its rows told apart by the `version` columns; all its other columns go along.
    Without records the count and the duration are 0 and least and greatest are null. Records without a model form one
    more row, without a start. The table of versions is never larger than what was sent.
    """
    mine = scored.groupBy(*version).agg(
        F.count(F.lit(1)).alias("score_count"), F.coalesce(F.sum(duration), F.lit(0)).alias("duration"),
        F.min(duration).alias("min"), F.max(duration).alias("max"),
    )
    named = mine.select(*[F.col(v).alias(f"_of_{v}") for v in version], "score_count", "duration", "min", "max")
    same = F.lit(True)
    for v in version:
        same = same & versions[v].eqNullSafe(F.col(f"_of_{v}"))
    since = versions[valid_from].alias("since")
    carried = [c for c in versions.columns if c not in (*version, valid_from)]
    known = versions.join(named, same, "left").select(
        *version, *carried, since, F.coalesce("score_count", F.lit(0)).alias("score_count"),
        F.coalesce("duration", F.lit(0)).alias("duration"), "min", "max",
    )
    nobody = F.lit(True)
    for v in version:
        nobody = nobody & F.col(v).isNull()
    # A row without a model has no scorer that could take time.
    rest = mine.where(nobody).select(*version, "score_count", F.lit(0).cast(known.schema["duration"].dataType).alias("duration"))
    return known.unionByName(rest, allowMissingColumns=True)


def current_activation(stats: DataFrame, order: Sequence[str] = ("since",)) -> DataFrame:
    """The statistics of the latest activation, whether it has records or not: one row."""
    return stats.orderBy(*[F.desc_nulls_last(c) for c in order]).limit(1)


def running_stats(
    scored: DataFrame, version: Sequence[str], order: Sequence[str], duration: str, target_rows: int = TARGET_ROWS
) -> DataFrame:
    """The statistics as they stood after each row, in the order of whole-number columns that leaves no ties."""
    return running(
        scored.withColumn("_one", F.lit(1)),
        version,
        order,
        {
            "score_count": ("count", "_one"),
            "duration_sum": ("sum", duration),
            "duration_min": ("min", duration),
            "duration_max": ("max", duration),
        },
        target_rows,
    ).drop("_one")


def every_nth(stats: DataFrame, n: int = 100) -> DataFrame:
    return stats.where(F.col("score_count") % n == 0)


def current_stats(stats: DataFrame, since: str = "since") -> DataFrame:
    """The statistics of the latest activation: one row."""
    return stats.orderBy(F.desc_nulls_last(since)).limit(1)

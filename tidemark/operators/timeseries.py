"""Time-bucketed counts and means with gap filling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tidemark.operators.asof import micros
from tidemark.operators.ordering import TARGET_ROWS, following, running
from tidemark.session import settle

# Buckets of a gap that are made from one array.
_BLOCK_BUCKETS = 10_000

# Range per point in milliseconds up to which a bucket width in milliseconds is used.
WIDTH_LADDER = (
    (15, 10), (35, 20), (75, 50), (150, 100), (350, 200), (750, 500), (1_500, 1_000), (3_500, 2_000), (7_500, 5_000),
    (12_500, 10_000), (17_500, 15_000), (25_000, 20_000), (45_000, 30_000), (90_000, 60_000), (210_000, 120_000),
    (450_000, 300_000), (750_000, 600_000), (1_050_000, 900_000), (1_500_000, 1_200_000), (2_700_000, 1_800_000),
    (5_400_000, 3_600_000), (9_000_000, 7_200_000), (16_200_000, 10_800_000), (32_400_000, 21_600_000),
    (86_400_000, 43_200_000), (604_800_000, 86_400_000), (1_814_400_000, 604_800_000), (3_628_800_000, 2_592_000_000),
)
_WIDEST = 31_536_000_000


def bucket_start(time: str | Column, width_us: int) -> Column:
    """Start of the bucket in epoch microseconds."""
    at = micros(time)
    return at - F.pmod(at, F.lit(width_us))


def bucket_aggregate(
    df: DataFrame, time: str, width_us: int, measures: Mapping[str, Column], tags: Sequence[str] = ()
) -> DataFrame:
    """One row per tag values and non-empty bucket, ordered only where asked for; partial aggregation comes first."""
    timed = df.where(F.col(time).isNotNull())
    return timed.groupBy(*tags, bucket_start(time, width_us).alias("bucket")).agg(
        *[c.alias(name) for name, c in measures.items()]
    )


def fill_gaps(
    buckets: DataFrame,
    width_us: int,
    fills: Mapping[str, str],
    tags: Sequence[str] = (),
    span: tuple[int, int] | None = None,
    target_rows: int = TARGET_ROWS,
) -> DataFrame:
    """Every series gets a row for every bucket of the span (by default from first to last bucket over all series).

    The ends of a span need not be bucket edges: the buckets they fall into are the first and the last. Fills: "linear"
    between two known buckets of the series, whole numbers cut to whole numbers; "previous" carries the last known value
    on; "none" leaves nulls. What lies before the first known value stays null, and with linear what lies after the last
    one too.

    All that a gap needs is worked out on the buckets that have rows: the last known value up to each and the first
    known one after it. The gaps are then exploded, in blocks, so neither a window nor an array grows with them.
    """
    unknown = set(fills.values()) - {"linear", "previous", "none"}
    if unknown:
        raise ValueError(f"unknown fill {sorted(unknown)[0]}")
    if span is not None:
        first, last = (int(at) - int(at) % width_us for at in span)
        inside = buckets.where(F.col("bucket").between(first, last))
    else:
        # The aggregated rows are used twice; the scan below them should run once.
        inside = buckets = settle(buckets)
        ends = buckets.agg(F.min("bucket"), F.max("bucket")).first()
        if ends[0] is None:
            return buckets
        first, last = int(ends[0]), int(ends[1])

    names = list(fills)
    known = inside.select(
        *tags, "bucket", *names, (-F.col("bucket")).alias("_back"),
        *[F.when(F.col(n).isNotNull(), F.struct(F.col("bucket").alias("t"), F.col(n).alias("v"))).alias(f"_known_{n}") for n in names],
    )
    # A series has at most one row per bucket. If even that is a small task, a plain window will do.
    small = (last - first) // width_us + 1 <= target_rows
    before = {f"_a_{n}": ("last", f"_known_{n}") for n in names} | {"_first": ("min", "bucket")}
    known = _running(known, tags, "bucket", before, small, target_rows)
    known = _running(known, tags, "_back", {f"_b_{n}": ("last", f"_known_{n}") for n in names}, small, target_rows)
    known = known.withColumn("_here", F.struct("bucket", *[f"_b_{n}" for n in names]))
    if small:
        known = known.withColumn("_next", F.lead("_here").over(Window.partitionBy(*tags).orderBy("bucket")))
    else:
        known = following(known, tags, ["bucket"], "_here", "_next", target_rows)

    step, at = F.lit(width_us), F.col("_slot")
    begin = F.when(F.col("bucket") == F.col("_first"), F.lit(first)).otherwise(F.col("bucket"))
    end = F.coalesce(F.col("_next.bucket") - step, F.lit(last))
    flat = known.select(
        *tags, "bucket", *names, begin.alias("_begin"), end.alias("_end"),
        *[F.col(f"_a_{n}")[part].alias(f"_a{part}_{n}") for n in names for part in "tv"],
        *[F.col(f"_next._b_{n}")[part].alias(f"_b{part}_{n}") for n in names for part in "tv"],
    )
    blocks = flat.withColumn("_block", F.explode(F.sequence("_begin", "_end", F.lit(width_us * _BLOCK_BUCKETS))))
    until = F.least(F.col("_end"), F.col("_block") + F.lit(width_us * (_BLOCK_BUCKETS - 1)))
    slots = blocks.withColumn("_slot", F.explode(F.sequence(F.col("_block"), until, step)))

    filled = []
    for name, fill in fills.items():
        (at_a, a), (at_b, b) = ([F.col(f"_{side}{part}_{name}") for part in "tv"] for side in "ab")
        if fill == "none":
            filled.append(F.when(at == F.col("bucket"), F.col(name)).alias(name))
        elif fill == "previous":
            filled.append(F.when(at >= F.col("bucket"), a).alias(name))
        else:
            kind = buckets.schema[name].dataType
            line = a + (b - a) / (at_b - at_a) * (at - at_a)
            if isinstance(kind, T.IntegralType):
                line = line.cast(kind)
            filled.append(F.when(at < F.col("bucket"), None).when(at == at_a, a).when(at_b > at_a, line).alias(name))
    return slots.select(*tags, at.alias("bucket"), *filled)


def _running(
    df: DataFrame, tags: Sequence[str], order: str, totals: Mapping[str, tuple[str, str]], small: bool, target_rows: int
) -> DataFrame:
    if not small:
        return running(df, list(tags), [order], dict(totals), target_rows)
    so_far = Window.partitionBy(*tags).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    kinds = {"last": lambda c: F.last(c, ignorenulls=True), "min": F.min}
    return df.select("*", *[kinds[kind](column).over(so_far).alias(out) for out, (kind, column) in totals.items()])


def count_by_tag(df: DataFrame, time: str, width_us: int, field: str, tags: Sequence[str], span=None) -> DataFrame:
    """Serving count per model and bucket, gaps filled linearly (A5)."""
    buckets = bucket_aggregate(df, time, width_us, {"count": F.count(field)}, tags)
    return fill_gaps(buckets, width_us, {"count": "linear"}, tags, span)


def mean_by_tag(df: DataFrame, time: str, width_us: int, field: str, tags: Sequence[str], span=None) -> DataFrame:
    """Average score per model and bucket, gaps filled linearly."""
    buckets = bucket_aggregate(df, time, width_us, {"mean": F.avg(field)}, tags)
    return fill_gaps(buckets, width_us, {"mean": "linear"}, tags, span)


def mean_of_fields(df: DataFrame, time: str, width_us: int, fields: Mapping[str, str], span=None) -> DataFrame:
    """Means of several fields under their aliases per bucket, gaps filled with the previous value."""
    buckets = bucket_aggregate(df, time, width_us, {alias: F.avg(f) for alias, f in fields.items()})
    return fill_gaps(buckets, width_us, {alias: "previous" for alias in fields}, (), span)


def recent(df: DataFrame, time: str, span: timedelta, now: Column | None = None) -> DataFrame:
    """Rows of the last `span` before `now`, by default before the newest row.

    The newest time is read first and becomes a constant, so the scan can skip row groups.
    """
    if now is None:
        newest = df.agg(F.max(time).alias("t")).first().t
        now = F.lit(newest).cast(df.schema[time].dataType)
    micro = int(span / timedelta(microseconds=1))
    return df.where(F.col(time) >= now - F.expr(f"INTERVAL '{micro / 1_000_000:.6f}' SECOND"))


def auto_width(first_us: Column, last_us: Column, points: int) -> Column:
    """Bucket width in milliseconds for about `points` buckets over a range, from a fixed ladder."""
    per_point = (last_us - first_us) / F.lit(1000 * points)
    width = None
    for limit, value in WIDTH_LADDER:
        width = F.when(per_point <= limit, F.lit(value)) if width is None else width.when(per_point <= limit, F.lit(value))
    return width.otherwise(F.lit(_WIDEST)).cast("bigint")


def auto_width_of(df: DataFrame, time: str, points: int) -> DataFrame:
    """One row: the range of the data and the width chosen for it."""
    ends = df.agg(micros(F.min(time)).alias("first_us"), micros(F.max(time)).alias("last_us"))
    return ends.select("first_us", "last_us", auto_width(F.col("first_us"), F.col("last_us"), points).alias("width_ms"))

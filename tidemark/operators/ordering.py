"""Running totals, sequence numbers and next values over a long order, without a long task.

A plain window puts a whole key into one task. Here a key with more rows than one task should hold is cut into
slices of its order columns; each slice is its own window, and what earlier slices contribute is added from one row
per slice. Slices are cut again until each is small or all its rows are alike, so one hot key, one hot moment or no key
at all make no difference to the size of a task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tidemark.session import BROADCAST_ROWS, broadcast_if_small, settle, shared_dir

TARGET_ROWS = 2_000_000
_LOWEST = -(2**63)


def _both(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def _has_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(_has_map(f.dataType) for f in kind.fields)
    return isinstance(kind, T.MapType) or isinstance(kind, T.ArrayType) and _has_map(kind.elementType)


def _hashable(column: Column, kind: T.DataType) -> Column:
    if not _has_map(kind):
        return column
    if isinstance(kind, T.ArrayType):
        return F.transform(column, lambda x: _hashable(x, kind.elementType))
    if isinstance(kind, T.StructType):
        return F.when(column.isNotNull(), F.struct(*[_hashable(column[f.name], f.dataType).alias(f.name) for f in kind.fields]))
    return F.array_sort(F.transform(
        F.map_entries(column),
        lambda e: F.struct(_hashable(e["key"], kind.keyType).alias("key"), _hashable(e["value"], kind.valueType).alias("value")),
    ))


def row_hash(df: DataFrame) -> Column:
    """64-bit hash of a whole row. Maps, at any depth, count as their sorted entries."""
    return F.xxhash64(*[_hashable(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields])


def _whole(column: str, kind: T.DataType) -> Column:
    """An order column as whole numbers that compare like it: times as microseconds, zone-less ones without any zone."""
    value = F.col(column)
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(value)
    if isinstance(kind, T.TimestampNTZType):
        seconds = F.unix_date(value.cast("date")) * F.lit(86_400).cast("bigint") + F.hour(value) * 3600 + F.minute(value) * 60
        return seconds * 1_000_000 + (F.extract(F.lit("SECOND"), value) * 1_000_000).cast("bigint")
    if isinstance(kind, T.DateType):
        return F.unix_date(value).cast("bigint")
    return value.cast("bigint")


def _attach(df: DataFrame, facts: DataFrame, group: Sequence[str]) -> DataFrame:
    """Add the columns of a settled per-slice table to every row of the slice."""
    named = facts.select(
        *[F.col(name).alias(f"_of_{name}") for name in group], *[c for c in facts.columns if c not in group]
    )
    same = _both([F.col(name).eqNullSafe(F.col(f"_of_{name}")) for name in group])
    return df.join(broadcast_if_small(named), same, "left").drop(*[f"_of_{name}" for name in group])


class Sliced:
    """A table with slice columns; `cut` tells whether any key had to be cut."""

    def __init__(self, df: DataFrame, keys: Sequence[str], order: Sequence[str], marks: Sequence[str], cut: bool):
        self.df, self.keys, self.order, self.marks, self.cut = df, list(keys), list(order), list(marks), cut

    @property
    def group(self) -> list[str]:
        return self.keys + self.marks if self.cut else self.keys

    def window(self):
        return Window.partitionBy(*self.group).orderBy(*self.order)

    def in_cut_key(self) -> Column:
        """True on rows of keys that were cut; only those need anything from other slices."""
        return reduce(lambda a, b: a | b, [F.col(mark).isNull() | (F.col(mark) > _LOWEST) for mark in self.marks])


# Sampled rows per slice that is to come out; sizes are then right within some ten percent.
_SAMPLE_PER_SLICE = 100


def slice_by_order(df: DataFrame, keys: Sequence[str], order: Sequence[str], target_rows: int = TARGET_ROWS) -> Sliced:
    """Add slice columns so that no (key, slice) holds many more than `target_rows` rows.

    `order` names columns of whole numbers or times; end it with a unique one where rows may tie. Slice columns compare like the
    order columns do, so slices of a key are themselves in order. One grouped count finds the keys that are too large,
    and without any nothing else happens. Otherwise one more scan samples those keys, and where to cut is worked out
    on the sample. The sample decides only how even the slices are, never a result.
    """
    marks = [f"_slice{i}" for i in range(len(order))]
    # At most rows / target_rows keys can be this large, which bounds the table.
    large = settle(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > target_rows).drop("_n"))
    if large.isEmpty():
        return Sliced(df, keys, order, marks, False)
    start = [F.lit(_LOWEST).cast("bigint").alias(mark) for mark in marks]
    cur = df.select("*", *start)
    sample, sample_target = _sample(df, large, keys, order, target_rows)
    sample = sample.select("*", *start)
    while True:
        cuts = settle(_cuts(sample, [*keys, *marks], order, sample_target))
        if cuts.isEmpty():
            return Sliced(cur, keys, order, marks, True)
        cur = _cut(cur, cuts, keys, order, marks)
        sample = _cut(sample, cuts, keys, order, marks)


def _sample(
    df: DataFrame, large: DataFrame, keys: Sequence[str], order: Sequence[str], target_rows: int
) -> tuple[DataFrame, int]:
    """Order values of some rows of the large keys, and how many of them make up a slice.

    Rows are picked by a hash of what they hold, so a task that runs again picks the same ones.
    """
    of_large = df.select(*keys, *[_whole(c, df.schema[c].dataType).alias(c) for c in order])
    if keys:
        of_large = _attach(of_large, large.withColumn("_large", F.lit(True)), keys).where("_large").drop("_large")
    if target_rows <= _SAMPLE_PER_SLICE:
        return settle(of_large), target_rows
    share = F.lit(2**31 * _SAMPLE_PER_SLICE // target_rows)
    picked = of_large.where(F.pmod(F.xxhash64(*keys, *order), F.lit(2**31)) < share)
    return settle(picked), _SAMPLE_PER_SLICE


def _cuts(sample: DataFrame, group: Sequence[str], order: Sequence[str], target: int) -> DataFrame:
    """For every group that is too large: which order column to cut, around which middle, in steps of what width."""
    ends = [
        f(column).alias(f"_{tag}{i}")
        for i, column in enumerate(order)
        for tag, f in (("lo", F.min), ("hi", F.max), ("mid", lambda c: F.percentile_approx(c, 0.5)))
    ]
    sizes = sample.groupBy(*group).agg(F.count(F.lit(1)).alias("_n"), *ends).where(F.col("_n") > target)

    def first_uneven(value) -> Column:
        return F.coalesce(*[F.when(F.col(f"_hi{i}") > F.col(f"_lo{i}"), value(i)) for i in range(len(order))])

    parts = F.ceil(F.col("_n") / F.lit(target)) * 2
    span = first_uneven(lambda i: F.col(f"_hi{i}") - F.col(f"_lo{i}") + 1)
    return sizes.select(
        *group,
        first_uneven(lambda i: F.lit(i)).alias("_axis"),
        *[first_uneven(lambda i, t=tag: F.col(f"_{t}{i}")).alias(f"_{tag}") for tag in ("lo", "mid", "hi")],
        F.greatest(F.lit(1), F.ceil(span / parts)).cast("bigint").alias("_step"),
    ).where("_axis IS NOT NULL")


def _cut(df: DataFrame, cuts: DataFrame, keys: Sequence[str], order: Sequence[str], marks: Sequence[str]) -> DataFrame:
    """Move rows of the groups in `cuts` to finer slices.

    Even steps on both sides of the middle value, which becomes a slice of its own: a value that many rows share is
    split off at once. Whole-number arithmetic throughout, since doubles would blur large values.
    """
    moved = []
    for i, (column, mark) in enumerate(zip(order, marks)):
        x = F.greatest(F.col("_lo"), F.least(F.col("_hi"), _whole(column, df.schema[column].dataType)))
        place = (
            F.when(F.col(column).isNull(), F.lit(None))
            .when(x < F.col("_mid"), x - (x - F.col("_lo")) % F.col("_step"))
            .when(x > F.col("_mid"), x - (x - F.col("_mid") - 1) % F.col("_step"))
            .otherwise(F.col("_mid"))
        )
        moved.append(F.when(F.col("_axis") == i, place).otherwise(F.col(mark)).alias(mark))
    return _attach(df, cuts, [*keys, *marks]).select(*[c for c in df.columns if c not in marks], *moved)


def _latest(column: str, order: Sequence[str]) -> Column:
    return F.max_by(column, F.when(F.col(column).isNotNull(), F.struct(*order)))


_COMBINE = {
    # kind: (value within a slice, value of a slice, value over earlier slices, both together)
    "count": (
        lambda c, w: F.count(c).over(w),
        lambda c, o: F.count(c),
        lambda c, w: F.sum(c).over(w),
        lambda mine, before: mine + F.coalesce(before, F.lit(0)),
    ),
    "sum": (
        lambda c, w: F.sum(c).over(w),
        lambda c, o: F.sum(c),
        lambda c, w: F.sum(c).over(w),
        lambda mine, before: F.coalesce(mine + before, mine, before),
    ),
    "min": (
        lambda c, w: F.min(c).over(w),
        lambda c, o: F.min(c),
        lambda c, w: F.min(c).over(w),
        lambda mine, before: F.least(mine, before),
    ),
    "max": (
        lambda c, w: F.max(c).over(w),
        lambda c, o: F.max(c),
        lambda c, w: F.max(c).over(w),
        lambda mine, before: F.greatest(mine, before),
    ),
    "last": (
        lambda c, w: F.last(c, ignorenulls=True).over(w),
        lambda c, o: _latest(c, o),
        lambda c, w: F.last(c, ignorenulls=True).over(w),
        lambda mine, before: F.coalesce(mine, before),
    ),
}


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    totals: dict[str, tuple[str, str]],
    target_rows: int = TARGET_ROWS,
) -> DataFrame:
    """Add running totals up to and including each row: {"n": ("count", "id"), "model": ("last", "model"), ...}."""
    sliced = slice_by_order(df, keys, order, target_rows)
    inside = sliced.window().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    names = list(df.columns)
    if not sliced.cut:
        return sliced.df.select(*names, *[_COMBINE[k][0](c, inside).alias(n) for n, (k, c) in totals.items()])

    mine = sliced.df.select(
        *names, *sliced.marks, *[_COMBINE[k][0](c, inside).alias(f"_in_{n}") for n, (k, c) in totals.items()]
    )
    per_slice = (
        sliced.df.where(sliced.in_cut_key())
        .groupBy(*sliced.group)
        .agg(*[_COMBINE[k][1](c, order).alias(f"_total_{n}") for n, (k, c) in totals.items()])
    )
    earlier = Window.partitionBy(*keys).orderBy(*sliced.marks).rowsBetween(Window.unboundedPreceding, -1)
    before = settle(
        per_slice.select(
            *sliced.group, *[_COMBINE[k][2](f"_total_{n}", earlier).alias(f"_before_{n}") for n, (k, c) in totals.items()]
        )
    )
    return _attach(mine, before, sliced.group).select(
        *names,
        *[_COMBINE[k][3](F.col(f"_in_{n}"), F.col(f"_before_{n}")).alias(n) for n, (k, c) in totals.items()],
    )


def following(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], column: str, out: str, target_rows: int = TARGET_ROWS
) -> DataFrame:
    """Add the value of `column` on the next row of the same key, null on the last row."""
    sliced = slice_by_order(df, keys, order, target_rows)
    names = list(df.columns)
    ahead = F.lead(F.struct(column)).over(sliced.window())
    if not sliced.cut:
        return sliced.df.select(*names, ahead[column].alias(out))
    mine = sliced.df.select(*names, *sliced.marks, ahead.alias("_ahead"))
    firsts = (
        sliced.df.where(sliced.in_cut_key())
        .groupBy(*sliced.group)
        .agg(F.min_by(F.struct(column), F.struct(*order)).alias("_first"))
    )
    after = settle(
        firsts.select(
            *sliced.group, F.lead("_first").over(Window.partitionBy(*keys).orderBy(*sliced.marks)).alias("_after")
        )
    )
    return _attach(mine, after, sliced.group).select(
        *names, F.coalesce(F.col("_ahead"), F.col("_after"))[column].alias(out)
    )


def numbered(
    df: DataFrame, order: Sequence[str], out: str = "seq", keys: Sequence[str] = (), target_rows: int = TARGET_ROWS
) -> DataFrame:
    """Sequence number from 1 in the given order."""
    marked = df.select("*", F.lit(1).alias("_one"))
    return running(marked, keys, order, {out: ("count", "_one")}, target_rows).drop("_one")


def numbered_lines(
    lines: DataFrame, out: str = "seq", file: str = "file_idx", line: str = "line_no", limit: int = BROADCAST_ROWS
) -> DataFrame:
    """Sequence number from 1 in file and line order, for lines as `read_lines` gives them, filtered or parsed.

    Tasks read stretches of files in order, so a line's number is the lines of earlier stretches plus its place in its
    own. The lines are written once to the shared folder, with their place in the task that read them, so whatever made
    them runs once; their numbers come from one row per stretch, and the lines are not shuffled. With more stretches than
    `limit`, or where rows of a file do not stand together in a task, the lines are ordered like any other table.
    """
    path = shared_dir(lines.sparkSession, "lines")
    lines.withColumn("_row", F.monotonically_increasing_id()).write.parquet(path)
    marked = lines.sparkSession.read.parquet(path)
    stretch = F.shiftright("_row", 33)
    stretches = settle(
        marked.groupBy(F.col(file).alias("_of_file"), stretch.alias("_of_task")).agg(
            F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"), F.max("_row").alias("_last"), F.min(line).alias("_low")
        )
    )
    apart = F.col("_last") - F.col("_first") + 1 != F.col("_n")
    if stretches.where(apart).limit(1).count() or stretches.count() > limit:
        return numbered(marked.drop("_row"), [file, line], out)
    # One row per stretch, that is per split of a file.
    before = Window.orderBy("_of_file", "_low").rowsBetween(Window.unboundedPreceding, -1)
    placed = settle(
        stretches.select("_of_file", "_of_task", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first") + 1).alias("_shift"))
    )
    joined = marked.join(F.broadcast(placed), F.col(file).eqNullSafe(F.col("_of_file")) & (stretch == F.col("_of_task")), "left")
    return joined.select(*[F.col(f"`{c}`") for c in lines.columns], (F.col("_row") + F.col("_shift")).alias(out))


def first_n(df: DataFrame, n: int, order: Sequence[str | Column]) -> DataFrame:
    """The first n rows in the given order; Spark keeps n rows per task, not a full sort."""
    return df.orderBy(*order).limit(n)

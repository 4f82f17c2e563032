"""A pyramid of time buckets: counts, sums, least and greatest values at several widths, kept up as rows come in.

Every level is made from the finer one, and levels of several batches add up, so a reader of hours or days opens neither
raw rows nor finer buckets. A width asked for is read from the widest level that divides it. Levels live in stores of
merged runs: a batch that is added again after a failure counts once, and the number of files to open stays bounded.

Rows without a time are in no bucket. A null value counts as a row but not as a value; a bucket without values has null
for sum, least, greatest and mean. Sums of whole numbers are exact; those of doubles may differ in the last digits by the
order in which batches came.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.timeseries import bucket_start
from tidemark.streaming.runs import FAN_IN, RunStore

_PARTS = ("n", "sum", "min", "max")


def _sum_kind(kind: T.DataType) -> T.DataType:
    return T.DecimalType(38, 0) if isinstance(kind, T.IntegralType) else kind


def rollup(df: DataFrame, time: str, width_us: int, values: Sequence[str], tags: Sequence[str] = ()) -> DataFrame:
    """Rows to mergeable buckets: tags, bucket, rows, and for each value its n, sum, min and max."""
    parts = [F.count(F.lit(1)).alias("rows")]
    for v in values:
        total = F.sum(F.col(v).cast(_sum_kind(df.schema[v].dataType))).cast(_sum_kind(df.schema[v].dataType))
        parts += [F.count(v).alias(f"{v}_n"), total.alias(f"{v}_sum"), F.min(v).alias(f"{v}_min"), F.max(v).alias(f"{v}_max")]
    return df.where(F.col(time).isNotNull()).groupBy(*tags, bucket_start(time, width_us).alias("bucket")).agg(*parts)


def merged(buckets: DataFrame, values: Sequence[str], tags: Sequence[str] = (), width_us: int | None = None) -> DataFrame:
    """Buckets of the same start become one; with a width, which must be a multiple of theirs, all that begin within it."""
    at = F.col("bucket") if width_us is None else F.col("bucket") - F.pmod("bucket", F.lit(width_us))
    parts = [F.sum("rows").alias("rows")]
    for v in values:
        kind = buckets.schema[f"{v}_sum"].dataType
        parts += [
            F.sum(f"{v}_n").alias(f"{v}_n"), F.sum(f"{v}_sum").cast(kind).alias(f"{v}_sum"),
            F.min(f"{v}_min").alias(f"{v}_min"), F.max(f"{v}_max").alias(f"{v}_max"),
        ]
    return buckets.groupBy(*tags, at.alias("bucket")).agg(*parts)


def mean_of(value: str) -> Column:
    """The mean of a value from a bucket's parts."""
    return F.col(f"{value}_sum").cast("double") / F.col(f"{value}_n")


class _Level(RunStore):
    """A store of runs whose rows of one key add up instead of replacing one another."""

    values: Sequence[str] = ()

    def _last(self, rows: DataFrame) -> DataFrame:
        return merged(rows, self.values, self.by[:-1]).select(*self.schema.names)


class Pyramid:
    """Buckets of several widths below one folder; each width is a multiple of the one before it."""

    def __init__(
        self, spark: SparkSession, folder: str, widths_us: Sequence[int], values: Mapping[str, str],
        tags: Mapping[str, str] | None = None, fan_in: int = FAN_IN,
    ):
        """`values` and `tags` map column names to their Spark types."""
        widths = sorted(widths_us)
        if not widths or any(b % a for a, b in zip(widths, widths[1:])):
            raise ValueError("every width must be a multiple of the one before it")
        self.values, self.tags, self.widths = list(values), list(tags or {}), widths
        schema = T.StructType()
        for name, kind in (tags or {}).items():
            schema = schema.add(name, kind)
        schema = schema.add("bucket", T.LongType()).add("rows", T.LongType())
        for name, kind in values.items():
            kind = T._parse_datatype_string(kind)
            for part, own in zip(_PARTS, (T.LongType(), _sum_kind(kind), kind, kind)):
                schema = schema.add(f"{name}_{part}", own)
        self.levels = {}
        for width in widths:
            level = _Level(spark, f"{folder.rstrip('/')}/width_us={width}", schema, [*self.tags, "bucket"], "bucket", fan_in=fan_in, history=False)
            level.values = self.values
            self.levels[width] = level

    def add(self, batch: DataFrame, time: str, batch_id: int) -> None:
        """Add the rows of a batch to all levels; the rows are read once, wider levels come from the finer one's buckets."""
        buckets = rollup(batch, time, self.widths[0], self.values, self.tags).persist()
        try:
            for width in self.widths:
                level = self.levels[width]
                own = buckets if width == self.widths[0] else merged(buckets, self.values, self.tags, width)
                level.add(own.select(*level.schema.names), batch_id)
        finally:
            buckets.unpersist()

    def level_for(self, width_us: int) -> int:
        """The widest level that can be merged to a width."""
        fitting = [w for w in self.widths if width_us % w == 0]
        if not fitting:
            raise ValueError(f"no level of {self.widths} divides {width_us}")
        return fitting[-1]

    def buckets(self, width_us: int, span: tuple[int, int] | None = None) -> DataFrame:
        """Merged buckets of a width; with a span (first and last epoch microsecond), those that it touches."""
        level = self.levels[self.level_for(width_us)]
        rows = level.rows()
        if span is not None:
            first, last = span[0] - span[0] % width_us, span[1] - span[1] % width_us + width_us - 1
            rows = rows.where(F.col("bucket").between(first, last))
        return merged(rows, self.values, self.tags, width_us)

    def ends(self) -> tuple[int, int] | None:
        """Start of the first and the last bucket of the finest level."""
        row = self.levels[self.widths[0]].rows().agg(F.min("bucket"), F.max("bucket")).first()
        return None if row[0] is None else (row[0], row[1])


def keep_pyramid(stream: DataFrame, time: str, pyramid: Pyramid, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Keep a pyramid up by a stream; late rows add to their bucket whenever they come."""
    from tidemark.streaming.serving import _start

    return _start(stream, checkpoint, every, lambda batch, batch_id: pyramid.add(batch, time, batch_id))

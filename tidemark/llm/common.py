"""What the text operators share."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark.session import remove_dir, shared_dir

# White space of the word rules: U+0020 and U+0009 to U+000D, which is what bytes.split() takes for white space too.
WORD = r"[^\x20\x09-\x0D]+"
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))

_TIMES_TO_SPLIT = 4
_LEAST_SPLIT_BYTES = 4 << 20


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The given names, lengthened where the table has a column of that name in any case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def col(df: DataFrame, name: str) -> Column:
    return df[quoted(name)]


def text_of(df: DataFrame, text: str) -> Column:
    """A null text counts as an empty one."""
    return F.coalesce(col(df, text).cast("string"), F.lit(""))


def light(df: DataFrame, keep: Sequence[str], text: str) -> DataFrame:
    """The kept columns and the text last, under names of no meaning; for functions over Arrow batches."""
    return df.select(*[col(df, c).alias(f"c{i}") for i, c in enumerate(keep)], col(df, text).cast("string").alias("t"))


def row_key(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    """Two 64-bit hashes of the named columns; rows alike in them get the same key, and only those."""
    cols = [col(df, c) for c in columns]
    return [F.xxhash64(*cols), F.xxhash64(F.lit(1), *cols)]


def pieces(batches: Iterable[pa.RecordBatch], rows: int = 512, size: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that what is made of one stays small, however long its texts are."""
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            n = min(rows, batch.num_rows - at)
            part = batch.slice(at, n)
            while n > 1 and part.get_total_buffer_size() and part.nbytes > size:
                n = max(1, n // 2)
                part = batch.slice(at, n)
            yield part
            at += n


def texts_of(batch: pa.RecordBatch, column: int | str = -1) -> list[str]:
    """Texts of a batch, null as empty."""
    values = batch.column(column if isinstance(column, str) else column % batch.num_columns)
    return [x or "" for x in values.to_pylist()]


def struct_with(df: DataFrame, keep: Sequence[str], extra: str) -> T.StructType:
    """Schema of the kept columns followed by the given new ones, all nullable."""
    kept = [T.StructField(c, df.schema[c].dataType, True) for c in keep]
    return T.StructType(kept + T._parse_datatype_string(extra).fields)


def arrow_schema(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def with_columns(batch: pa.RecordBatch, keep: int, schema: pa.Schema, *new: Sequence) -> pa.RecordBatch:
    """The first `keep` columns of a batch, followed by new ones."""
    arrays = [batch.column(i).cast(schema.field(i).type) for i in range(keep)]
    for i, values in enumerate(new, keep):
        kind = schema.field(i).type
        arrays.append(values.cast(kind) if isinstance(values, pa.Array) else pa.array(values, kind))
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def bucket(column: Column, n: int) -> Column:
    """crc32 of a value's text modulo n; the folds of the learning operators."""
    return F.crc32(column.cast("string").cast("binary")) % n


def clean_name(name: str) -> str:
    return re.sub(r"\W+", "_", name)


class Shelf:
    """Helper tables written once to the cluster's shared folder and read back.

    Unlike cached blocks they outlive executors, and unlike a long plan they are cheap to plan on. Leaving the block
    removes the tables; an operator that returns a table based on some uses an outer shelf that is not left.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def put(self, df: DataFrame, name: str = "helper") -> DataFrame:
        path = shared_dir(self.spark, name)
        df.write.parquet(path)
        self.paths.append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def __enter__(self) -> "Shelf":
        return self

    def __exit__(self, *_) -> None:
        for path in self.paths:
            remove_dir(path)
        self.paths = []

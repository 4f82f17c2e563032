"""Text and time-series outputs (K1-K4)."""

from __future__ import annotations

import logging
import re
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F, types as T

log = logging.getLogger(__name__)

# Prefixes of the three applications' text output.
WINE_PREFIX = "Wine Quality: "
AIRLINE_PREFIX = "Airline Flight Delay Prediction: "
RECOMMENDER_PREFIX = "Recommender: "


def console_lines(df: DataFrame, prefix: str) -> DataFrame:
    """One text column: the prefix and the record as JSON (K1)."""
    return df.select(F.concat(F.lit(prefix), F.to_json(F.struct("*"))).alias("value"))


def write_text(df: DataFrame, prefix: str, path: str, mode: str = "errorifexists") -> None:
    console_lines(df, prefix).write.mode(mode).text(path)


@dataclass(frozen=True)
class PointSpec:
    """What a point holds: fields and tags as SQL over the record (K3)."""

    measurement: str
    fields: Mapping[str, str]
    tags: Mapping[str, str] = field(default_factory=dict)


# The points written by the three applications.
WINE_RESULT_POINT = PointSpec(
    "wine_result",
    {"result": "modelResult.value", "duration": "modelResultMetadata.duration"},
    {"model": "modelResultMetadata.modelName"},
)
WINE_RECORD_POINT = PointSpec("wine_record", {"alcohol": "alcohol", "ph": "pH", "citric_acid": "citric_acid"})
AIRLINE_RESULT_POINT = PointSpec(
    "airline_flight_result",
    {"prediction_label": "modelResult.label", "delay_probability": "modelResult.probability"},
)
AIRLINE_RECORD_POINT = PointSpec(
    "airline_flight_record",
    {"carrier": "uniqueCarrier", "destination": "destination", "delay": "CAST(arrDelay AS DOUBLE)"},
)


def _kinds(df: DataFrame, spec: PointSpec) -> dict[str, T.DataType]:
    probe = df.select(*[F.expr(sql).alias(name) for name, sql in spec.fields.items()])
    return {f.name: f.dataType for f in probe.schema.fields}


def _sparse_map(pairs: Mapping[str, Column], value: str) -> Column:
    """Map of the entries that are not null."""
    if not pairs:
        return F.map_from_arrays(F.array().cast("array<string>"), F.array().cast(f"array<{value}>"))
    whole = F.create_map(*[x for name, c in pairs.items() for x in (F.lit(name), c.cast(value))])
    return F.map_filter(whole, lambda k, v: v.isNotNull())


def points(df: DataFrame, spec: PointSpec, time: str) -> DataFrame:
    """(measurement, time in ms, tags, fields, texts): numbers in `fields`, text values in `texts`."""
    kinds = _kinds(df, spec)
    numbers = {n: F.expr(s) for n, s in spec.fields.items() if not isinstance(kinds[n], T.StringType)}
    texts = {n: F.expr(s) for n, s in spec.fields.items() if isinstance(kinds[n], T.StringType)}
    tags = {n: F.nullif(F.expr(s).cast("string"), F.lit("")) for n, s in spec.tags.items()}
    return df.select(
        F.lit(spec.measurement).alias("measurement"),
        _millis(time).alias("time"),
        _sparse_map(tags, "string").alias("tags"),
        _sparse_map(numbers, "double").alias("fields"),
        _sparse_map(texts, "string").alias("texts"),
    )


def _millis(time: str) -> Column:
    return F.unix_millis(F.col(time).cast("timestamp"))


def point_error() -> Column:
    """Why a point cannot be stored, null when it can."""
    empty = (F.size("fields") == 0) & (F.size("texts") == 0)
    return F.when(F.col("time").isNull(), F.lit("point without a time")).when(empty, F.lit("point without fields"))


def _escaped(value: Column, marks: str) -> Column:
    """Marks get a backslash before them; a line break becomes its two-character name, since a point is one line."""
    return F.regexp_replace(F.regexp_replace(value, f"([{marks}])", r"\\$1"), r"\r\n|\r|\n", r"\\n")


def _name(text: str, marks: str = ",= ") -> str:
    for mark in marks:
        text = text.replace(mark, f"\\{mark}")
    return re.sub(r"\r\n|\r|\n", r"\\n", text)


def line_protocol(df: DataFrame, spec: PointSpec, time: str) -> DataFrame:
    """One text line per point: measurement,tag=value field=value time in ms. Points without fields or time are null."""
    kinds = _kinds(df, spec)
    tags = []
    for name, sql in sorted(spec.tags.items()):
        value = F.nullif(F.expr(sql).cast("string"), F.lit(""))
        tags.append(F.when(value.isNotNull(), F.concat(F.lit(f",{_name(name)}="), _escaped(value, ",= "))))
    fields = []
    for name, sql in spec.fields.items():
        value = F.expr(sql)
        if isinstance(kinds[name], T.StringType):
            shown = F.concat(F.lit('"'), _escaped(value, r'"\\\\'), F.lit('"'))
        elif isinstance(kinds[name], T.IntegralType):
            shown = F.concat(value.cast("string"), F.lit("i"))
        else:
            # Not-a-number and infinity cannot be stored.
            shown = F.when(~F.isnan(value) & (F.abs(value) < F.lit(float("inf"))), value.cast("string"))
        fields.append(F.concat(F.lit(f"{_name(name)}="), shown))
    body = F.nullif(F.concat_ws(",", *fields), F.lit(""))
    head = F.concat_ws("", F.lit(_name(spec.measurement, ", ")), *tags)
    return df.select(
        F.concat(head, F.lit(" "), body, F.lit(" "), _millis(time).cast("string")).alias("line")
    )


def write_points(
    df: DataFrame,
    spec: PointSpec,
    time: str,
    folder: str,
    batch: str,
    on_failure: Callable[[Exception], None] | None = None,
) -> str | None:
    """Store points below folder/batch=..., good and bad ones side by side, in one pass (K4).

    Writing a batch again replaces it. A failed write is reported and swallowed: the caller goes on.
    """
    path = f"{folder.rstrip('/')}/batch={batch}"
    judged = points(df, spec, time).withColumn("error", point_error())
    laid = judged.select(
        "*",
        F.when(F.col("error").isNull(), F.lit("stored")).otherwise(F.lit("failed")).alias("status"),
        F.to_date(F.timestamp_millis("time")).alias("day"),
    )
    try:
        # Days come together, a large one in as many files as its size asks for, not one file per task and day.
        laid.hint("rebalance", "status", "day").write.mode("overwrite").partitionBy("status", "day").parquet(path)
        return path
    except Exception as e:
        (on_failure or (lambda x: log.error("Failed to write points to %s: %s", path, x)))(e)
        return None


def read_points(spark, folder: str) -> DataFrame:
    return spark.read.option("basePath", folder).parquet(f"{folder.rstrip('/')}/batch=*").where("status = 'stored'")


def failed_points(spark, folder: str) -> DataFrame:
    return spark.read.option("basePath", folder).parquet(f"{folder.rstrip('/')}/batch=*").where("status = 'failed'")


def each_batch(write: Callable[[DataFrame], None]) -> Callable[[DataFrame, int], None]:
    """A user's write function as a stream's batch function (K2)."""
    return lambda df, batch_id: write(df)

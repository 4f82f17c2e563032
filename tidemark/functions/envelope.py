"""Result envelopes, score metadata and the split of scored rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.schemas import RESULT_METADATA

DEFAULT_DOUBLE = 0.0


def metadata(
    errors: Column | None = None,
    model_type: Column | None = None,
    model_name: Column | None = None,
    start_ms: Column | None = None,
    duration_ms: Column | None = None,
) -> Column:
    """Score metadata; anything not given, or null, takes the record type's default."""
    return F.struct(
        F.coalesce(errors if errors is not None else F.lit(None), F.lit("")).alias("errors"),
        F.coalesce(model_type if model_type is not None else F.lit(None), F.lit("UNKNOWN")).alias("modelType"),
        F.coalesce(model_name if model_name is not None else F.lit(None), F.lit("")).alias("modelName"),
        F.coalesce(start_ms if start_ms is not None else F.lit(None), F.lit(0)).cast("bigint").alias("startTime"),
        F.coalesce(duration_ms if duration_ms is not None else F.lit(None), F.lit(0)).cast("bigint").alias("duration"),
    ).cast(RESULT_METADATA)


def now_ms() -> Column:
    """Start time of the query, for scorers that run as expressions."""
    return F.unix_millis(F.current_timestamp())


def double_result(score: Column) -> Column:
    return F.struct(F.coalesce(score, F.lit(DEFAULT_DOUBLE)).alias("value"))


def label_result(label: Column, probability: Column) -> Column:
    return F.struct(
        F.coalesce(label, F.lit("")).alias("label"), F.coalesce(probability, F.lit(0.0)).alias("probability")
    )


def key_values_result(keys: Column, values: Column) -> Column:
    return F.struct(
        F.coalesce(keys, F.array().cast("array<string>")).alias("keys"),
        F.coalesce(values, F.array().cast("array<double>")).alias("values"),
    )


def envelope(df: DataFrame, record: list[str], result: Column, meta: Column, keep: tuple[str, ...] = ()) -> DataFrame:
    """Nest record, result and metadata the way the result types declare them."""
    return df.select(
        *keep,
        F.struct(*record).alias("inputRecord"),
        result.alias("modelResult"),
        meta.alias("modelResultMetadata"),
    )


def succeeded(results: DataFrame) -> DataFrame:
    return results.where("modelResultMetadata.errors = ''")


def failed(results: DataFrame) -> DataFrame:
    return results.where("modelResultMetadata.errors != ''")

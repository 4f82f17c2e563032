"""Projections that feed models."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.schemas import WINE_FEATURES

# The flight model's feature names and the record fields behind them.
AIRLINE_FEATURES = {
    "Year": "year",
    "Month": "month",
    "DayofMonth": "dayOfMonth",
    "DayOfWeek": "dayOfWeek",
    "CRSDepTime": "crsDepTime",
    "UniqueCarrier": "uniqueCarrier",
    "Origin": "origin",
    "Dest": "destination",
}


def text_features(df: DataFrame, names: Mapping[str, str] = AIRLINE_FEATURES, keep: Sequence[str] = ()) -> DataFrame:
    """The named fields as text under the model's names; all other columns are pruned."""
    return df.select(*keep, *[F.col(field).cast("string").alias(name) for name, field in names.items()])


def feature_vector(names: Sequence[str] = WINE_FEATURES) -> Column:
    """Array of the named columns in order, narrowed to float."""
    return F.array(*[F.col(name).cast("float") for name in names])


def field_column(model_field: str) -> str:
    """Record column a model's field reads: blanks are underscores."""
    return model_field.replace(" ", "_")


def model_fields(df: DataFrame, fields: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Only the columns the model declares."""
    return df.select(*keep, *[F.col(f"`{field_column(name)}`") for name in fields])

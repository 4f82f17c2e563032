"""Checks and texts on model descriptors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.schemas import MODEL_TYPES

# What a descriptor of each type must carry.
NEEDS_BYTES = ("PMML", "TENSORFLOW", "H2O")
NEEDS_LOCATION = ("TENSORFLOWSAVED", "TENSORFLOWSERVING")
WINE_TYPES = ("TENSORFLOW", "TENSORFLOWSAVED", "PMML")
AIRLINE_TYPES = ("H2O",)
RECOMMENDER_TYPES = ("TENSORFLOWSERVING",)

PREVIEW_BYTES = 128
IDENTITY = ("modelName", "description", "modelType", "modelBytes", "modelSourceLocation")


def display_name(name: str = "modelName", location: str = "modelSourceLocation") -> Column:
    """The name, else the last part of the location, else a stand-in."""
    # A path's own name ignores separators at its end.
    last = F.element_at(F.split(F.regexp_replace(location, "/+$", ""), "/"), -1)
    return (
        F.when(F.length(name) > 0, F.col(name))
        .when(F.col(location).isNull() | (F.col(location) == ""), F.lit("unnamed-model"))
        .otherwise(last)
    )


def byte_count(data: str = "modelBytes") -> Column:
    return F.coalesce(F.octet_length(data), F.lit(0))


def summary(data: str = "modelBytes") -> Column:
    """One line with every field, the number of bytes and the first of them in hexadecimal."""
    preview = F.when(byte_count(data) > 0, F.hex(F.substring(data, 1, PREVIEW_BYTES))).otherwise(F.lit("[]"))
    parts = [
        F.concat(F.lit(f"{label}="), F.coalesce(F.col(name).cast("string"), F.lit("null")))
        for label, name in (("name", "modelName"), ("about", "description"), ("type", "modelType"), ("at", "modelSourceLocation"))
    ]
    return F.concat(F.concat_ws("; ", *parts), F.lit("; bytes["), byte_count(data).cast("string"), F.lit("]="), preview)


def same_descriptor(left: str, right: str) -> Column:
    """Equality of two descriptor structs, bytes included; null equals null."""
    both = F.lit(True)
    for name in IDENTITY:
        both = both & F.col(f"{left}.{name}").eqNullSafe(F.col(f"{right}.{name}"))
    return both


def content_hash(data: str = "modelBytes") -> Column:
    """Names the bytes of a model; null for none."""
    return F.sha2(data, 256)


def fingerprint(data: str = "modelBytes", hashed: str | None = None) -> Column:
    """Stands for the whole descriptor in comparisons, so that model bytes need not be moved.

    `hashed` names a column that has the content hash already.
    """
    parts = [F.coalesce(F.concat(F.lit("="), name), F.lit("-")) for name in IDENTITY if name != "modelBytes"]
    lengths = [F.coalesce(F.length(name), F.lit(-1)).cast("string") for name in IDENTITY if name != "modelBytes"]
    content = F.col(hashed) if hashed else content_hash(data)
    return F.sha2(F.encode(F.concat_ws("|", *lengths, *parts, F.coalesce(content, F.lit("-"))), "utf-8"), 256)


def descriptor_error(supported: Sequence[str]) -> Column:
    """Null for a usable descriptor, else why it is refused: type not supported here, or its payload is missing."""
    kind = F.col("modelType")
    unknown = ~kind.isin(*MODEL_TYPES) | kind.isNull()
    unsupported = ~kind.isin(*supported)
    missing = (kind.isin(*NEEDS_BYTES) & F.col("modelBytes").isNull()) | (
        kind.isin(*NEEDS_LOCATION) & F.col("modelSourceLocation").isNull()
    )
    return (
        F.when(unknown, F.concat(F.lit("Unknown model type "), F.coalesce(kind, F.lit("null"))))
        .when(unsupported, F.concat(F.lit("No factory found for model type "), kind))
        .when(missing, F.concat(F.lit("Invalid descriptor "), summary()))
    )


def check_descriptors(descriptors: DataFrame, supported: Sequence[str]) -> DataFrame:
    """Add `error`, null where a model of this application can be made from the descriptor."""
    return descriptors.withColumn("error", descriptor_error(supported))

"""Whole files as bytes, and the model catalogue made from them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.schemas import MODEL_DESCRIPTOR
from tidemark.sources.text import _literal, existing_paths, qualified

MAX_BYTES = 1024 * 1024 * 1024


def read_bytes(spark: SparkSession, paths: Sequence[str], max_bytes: int = MAX_BYTES) -> DataFrame:
    """(path, modified, bytes, error): a missing or too large file is an error value, not a failure.

    The bytes of too large files are never loaded: the length is checked on the listing.
    """
    found = set(existing_paths(spark, list(paths), False))
    missing = spark.createDataFrame(
        [(qualified(spark, p), f"{p} (No such file or directory)") for p in paths if p not in found],
        "path string, error string",
    ).select("path", F.lit(None).cast("timestamp").alias("modified"), F.lit(None).cast("binary").alias("bytes"), "error")
    if not found:
        return missing
    listing = spark.read.format("binaryFile").load([_literal(p) for p in sorted(found)])
    small = listing.where(F.col("length") < max_bytes).select(
        "path", F.col("modificationTime").alias("modified"), F.col("content").alias("bytes"),
        F.lit(None).cast("string").alias("error"),
    )
    large = listing.where(F.col("length") >= max_bytes).select(
        "path", F.col("modificationTime").alias("modified"), F.lit(None).cast("binary").alias("bytes"),
        F.concat(
            F.lit("not read: "), F.col("path"), F.lit(f" has {max_bytes} bytes or more, the largest size taken"),
        ).alias("error"),
    )
    return small.unionByName(large).unionByName(missing)


def model_names(model_type, path, idx, number):
    """Display names by kind: path without its last five characters (PMML), prefixed path or a running number."""
    return (
        F.when(model_type == "PMML", F.substring(path, F.lit(1), F.greatest(F.length(path) - 5, F.lit(0))))
        .when(
            model_type == "H2O",
            F.concat(F.lit("Airline flight Model "), number.cast("string"), F.lit(" (model #"),
                     (idx + 1).cast("string"), F.lit(")")),
        )
        .when(model_type == "TENSORFLOWSERVING", F.lit("Recommender Model"))
        .otherwise(F.concat(F.lit("Tensorflow Model - "), path))
    )


# What each model type's descriptor says about its origin.
DESCRIPTIONS = {
    "TENSORFLOW": "generated from TensorFlow",
    "TENSORFLOWSAVED": "generated from TensorFlow",
    "PMML": "generated from Spark",
    "H2O": "Airline H2O flight Model",
    "TENSORFLOWSERVING": "Recommender TF serving model Serving",
}


def model_catalogue(spark: SparkSession, sources: Mapping[str, Sequence[str]]) -> DataFrame:
    """Descriptor rows for {model type: paths or service addresses}, with valid_from and error columns.

    valid_from is the file's modification time; service addresses have no bytes and are valid from the start.
    """
    remote = "TENSORFLOWSERVING"
    wanted = []
    for kind, paths in sources.items():
        for i, path in enumerate([paths] if isinstance(paths, str) else paths):
            wanted.append((kind, i, path, path if kind == remote else qualified(spark, path)))
    if not wanted:
        raise ValueError("no model sources were given")
    listed = spark.createDataFrame(wanted, "model_type string, idx int, source string, place string")
    loaded = read_bytes(spark, list(dict.fromkeys(path for kind, _, path, _ in wanted if kind != remote)))
    joined = listed.join(loaded, F.col("place") == F.col("path"), "left")
    kind = F.col("model_type")
    description = F.coalesce(F.create_map(*[F.lit(x) for pair in DESCRIPTIONS.items() for x in pair])[kind], F.lit(""))
    keep_location = kind.isin("H2O", "TENSORFLOWSERVING", "TENSORFLOWSAVED")
    out = joined.select(
        model_names(kind, F.col("source"), F.col("idx"), F.col("idx")).alias("modelName"),
        description.alias("description"),
        kind.alias("modelType"),
        F.col("bytes").alias("modelBytes"),
        F.when(keep_location, F.col("source")).alias("modelSourceLocation"),
        F.coalesce("modified", F.timestamp_seconds(F.lit(0))).alias("valid_from"),
        "error",
    )
    assert out.columns[:5] == MODEL_DESCRIPTOR.names
    return out

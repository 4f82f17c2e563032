"""The table of model versions: which are usable, which is current, and keeping that over a restart (M1-M3, M5-M7)."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidemark.functions.descriptors import check_descriptors, content_hash, fingerprint, summary
from tidemark.operators.ordering import TARGET_ROWS, following
from tidemark.operators.asof import micros

# Earlier than any record: where a restored model becomes valid.
BEFORE_ALL = "1900-01-01 00:00:00"

# Model bytes that `load_models` takes into the driver.
DRIVER_BYTES = 512 << 20


def usable_versions(descriptors: DataFrame, supported: Sequence[str]) -> DataFrame:
    """Descriptors that give a model; a refused one leaves the model before it in place."""
    return check_descriptors(descriptors, supported).where("error IS NULL").drop("error")


def refused_versions(descriptors: DataFrame, supported: Sequence[str]) -> DataFrame:
    return check_descriptors(descriptors, supported).where("error IS NOT NULL")


def store_bytes(descriptors: DataFrame, folder: str) -> DataFrame:
    """Keep every different model once, under the hash of its bytes; the descriptors get `modelHash` for `modelBytes`.

    A folder may be added to: only hashes it does not have yet are written. What is decided on the versions afterwards
    (resent ones, the current one, who is valid when) moves hashes only; `with_bytes` gives the bytes to what is left.
    Descriptors without bytes have a null hash.
    """
    spark = descriptors.sparkSession
    known = descriptors.select(content_hash().alias("modelHash"), "modelBytes").where(F.col("modelBytes").isNotNull())
    if place_exists(spark, folder):
        known = known.join(spark.read.parquet(folder).select("modelHash"), "modelHash", "left_anti")
    once = known.groupBy("modelHash").agg(F.first("modelBytes").alias("modelBytes"))
    once.write.mode("append").parquet(folder)
    return descriptors.withColumn("modelHash", content_hash()).drop("modelBytes")


def with_bytes(versions: DataFrame, folder: str) -> DataFrame:
    """The versions with the bytes that `store_bytes` kept; a hash it does not have gives null."""
    # Two writers at once may both have written a hash.
    kept = versions.sparkSession.read.parquet(folder).join(versions.select("modelHash").distinct(), "modelHash", "left_semi")
    return versions.join(kept.groupBy("modelHash").agg(F.first("modelBytes").alias("modelBytes")), "modelHash", "left")


def place_exists(spark: SparkSession, folder: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(place)


def load_models(
    descriptors: DataFrame, load: Callable[[str, bytes | None, str | None], object], most_bytes: int = DRIVER_BYTES
) -> tuple[dict, DataFrame]:
    """Make models from a catalogue of descriptors that have a `version_id`.

    Returns ({version_id: model}, table of version_id and error). Whatever `load` raises becomes an error value and
    the version stays out of the first part. Model files are read one by one, but the models stay in the driver: with
    more than `most_bytes` of them this refuses before reading any, and `score_by_any_version`, which loads on the
    workers, is the way.
    """
    size = descriptors.agg(F.sum(F.octet_length("modelBytes"))).first()[0] or 0
    if size > most_bytes:
        raise ValueError(f"models of {size} bytes are more than the driver should hold ({most_bytes}); score them on the workers")
    models, outcome = {}, []
    wanted = descriptors.select(
        "version_id", "modelType", "modelBytes", "modelSourceLocation", summary().alias("summary")
    )
    for row in wanted.toLocalIterator():
        try:
            data = bytes(row.modelBytes) if row.modelBytes is not None else None
            models[row.version_id] = load(row.modelType, data, row.modelSourceLocation)
            outcome.append((row.version_id, None))
        except Exception as e:  # a model that cannot be made is a value, not a failed job
            outcome.append(
                (row.version_id, f"No model could be made of {row.summary}: {e}")
            )
    kind = descriptors.schema["version_id"].dataType.simpleString()
    return models, descriptors.sparkSession.createDataFrame(outcome, f"version_id {kind}, error string")


def drop_resent(
    descriptors: DataFrame, by: Sequence[str], valid_from: str, seq: str, target_rows: int = TARGET_ROWS
) -> DataFrame:
    """Drop a descriptor equal to the one right before it for the same key (P13, `dedupe`).

    Descriptors may have `modelBytes` or, as `store_bytes` gives them, only `modelHash`.
    """
    hashed = "modelHash" if "modelHash" in descriptors.columns else None
    timed = descriptors.select("*", (-micros(valid_from)).alias("_back"), (-F.col(seq)).alias("_back_seq"),
                               fingerprint(hashed=hashed).alias("_mark"))
    seen = following(timed, list(by), ["_back", "_back_seq"], "_mark", "_mark_before", target_rows)
    return seen.where(~F.col("_mark").eqNullSafe(F.col("_mark_before"))).drop(
        "_back", "_back_seq", "_mark", "_mark_before"
    )


def latest_versions(versions: DataFrame, by: Sequence[str], valid_from: str = "valid_from", seq: str | None = None) -> DataFrame:
    """The current version per key, found with partial aggregates rather than a sort (M6)."""
    order = F.struct(valid_from, seq) if seq else F.struct(valid_from)
    rest = [c for c in versions.columns if c not in by]
    return versions.groupBy(*by).agg(F.max_by(F.struct(*rest), order).alias("_v")).select(*by, "_v.*")


def save_snapshot(versions: DataFrame, folder: str, name: str, by: Sequence[str], seq: str | None = None) -> str:
    """Write the current versions to a folder of their own; a finished write is what makes it count."""
    path = f"{folder.rstrip('/')}/snapshot={name}"
    latest_versions(versions, by, seq=seq).write.mode("overwrite").parquet(path)
    return path


def restore_snapshot(spark: SparkSession, path: str) -> tuple[DataFrame | None, str | None]:
    """(versions valid before any record, None), or (None, why not): a snapshot that cannot be read is a warning."""
    try:
        saved = spark.read.parquet(path)
    except Exception as e:
        return None, f"Error restoring the model state from {path}. {str(e).splitlines()[0]}"
    kind = saved.schema["valid_from"].dataType
    return saved.withColumn("valid_from", F.lit(BEFORE_ALL).cast(kind)), None


def with_restored(versions: DataFrame, restored: DataFrame | None) -> DataFrame:
    return versions if restored is None else versions.unionByName(restored, allowMissingColumns=True)

"""What the registered queries share: table access and the model versions they use."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.descriptors import WINE_TYPES
from tidemark.operators.registry import usable_versions
from tidemark.session import prepare

# name, type, valid from, sequence, payload, intercept, slope. The third has no payload and is refused.
EVENT_MODELS = (
    ("base", "PMML", "2023-12-01 00:00:00", 1, "b", 1.0, 0.5),
    ("alpha", "PMML", "2024-01-08 00:00:00", 2, "a", 2.0, 0.25),
    ("broken", "PMML", "2024-01-12 00:00:00", 3, None, 9.0, 9.0),
    ("beta", "TENSORFLOW", "2024-01-15 12:00:00", 4, "t", -3.0, 1.5),
    ("gamma", "PMML", "2024-01-22 00:00:00", 5, "g", 0.125, 0.75),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def event_models(spark: SparkSession) -> DataFrame:
    """The few versions of the event server, as descriptors with a start."""
    rows = ", ".join(
        f"('{n}', '{t}', TIMESTAMP'{at}', {seq}, {'NULL' if p is None else repr(p)}, {i}D, {s}D)"
        for n, t, at, seq, p, i, s in EVENT_MODELS
    )
    return prepare(spark).sql(
        "SELECT name AS modelName, '' AS description, type AS modelType, CAST(payload AS BINARY) AS modelBytes, "
        "CAST(NULL AS STRING) AS modelSourceLocation, valid_from, seq, intercept, slope "
        f"FROM VALUES {rows} AS v(name, type, valid_from, seq, payload, intercept, slope)"
    )


# The same versions for the comparison SQL, without the refused one.
EVENT_MODELS_SQL = "(VALUES " + ", ".join(
    f"('{n}', TIMESTAMP '{at}', {i}::DOUBLE, {s}::DOUBLE)" for n, t, at, seq, p, i, s in EVENT_MODELS if p is not None
) + ") AS v(model_name, valid_from, intercept, slope)"

# Descriptors made from orders: one server per customer, a new descriptor per order.
ORDER_DESCRIPTOR_COLUMNS = {
    "server": "o_custkey",
    "seq": "o_orderkey",
    "modelName": "CASE WHEN o_orderstatus = 'P' THEN '' ELSE concat('model-', o_orderstatus) END",
    "description": "concat('priority ', substring(o_orderpriority, 1, 1))",
    "modelType": "CASE substring(o_orderpriority, 1, 1) WHEN '1' THEN 'PMML' WHEN '2' THEN 'TENSORFLOW' "
    "WHEN '3' THEN 'TENSORFLOWSAVED' WHEN '4' THEN 'H2O' ELSE 'CUSTOM' END",
    "payload": "CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 5 = 1 THEN '' ELSE concat('w', o_orderstatus) END",
    "modelSourceLocation": "CASE WHEN o_orderkey % 3 = 0 THEN NULL WHEN o_orderkey % 3 = 1 THEN '' "
    "ELSE concat('/models/', o_orderstatus, '/net.bin') END",
}
ORDER_DESCRIPTORS_SQL = (
    "(SELECT " + ", ".join(f"{sql} AS {name}" for name, sql in ORDER_DESCRIPTOR_COLUMNS.items())
    + ", o_orderdate AS valid_from FROM orders) AS d"
)


def order_descriptors(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    named = orders.select(
        *[F.expr(sql).alias(name) for name, sql in ORDER_DESCRIPTOR_COLUMNS.items()], F.col("o_orderdate").alias("valid_from")
    )
    return named.withColumn("modelBytes", F.col("payload").cast("binary")).drop("payload")


def signup_descriptors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream of model updates as large as the data: every signup is a descriptor; those below 5 come without a model."""
    events = table(spark, sf_dir, "events").where("event_type = 'signup'")
    return events.select(
        F.concat(F.lit("m"), F.col("event_id").cast("string")).alias("modelName"), F.lit("").alias("description"),
        F.lit("PMML").alias("modelType"), F.when(F.col("value") >= 5, F.lit("x")).cast("binary").alias("modelBytes"),
        F.lit(None).cast("string").alias("modelSourceLocation"), "user_id", F.col("ts").alias("valid_from"), F.col("event_id").alias("version"),
    )


def signup_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The usable ones; the registry refuses the others."""
    return usable_versions(signup_descriptors(spark, sf_dir), WINE_TYPES).select("user_id", "valid_from", "version")


def served_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All other events are records to score."""
    return table(spark, sf_dir, "events").where("event_type != 'signup'")

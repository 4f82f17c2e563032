"""Declared record types and the check that a table meets one of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

# Field names and order of the record types, and the model type names.
WINE_FEATURES = (
    "fixed_acidity", "volatile_acidity", "citric_acid", "residual_sugar", "chlorides", "free_sulfur_dioxide",
    "total_sulfur_dioxide", "density", "pH", "sulphates", "alcohol",
)
AIRLINE_FIELDS = (
    "year", "month", "dayOfMonth", "dayOfWeek", "depTime", "crsDepTime", "arrTime", "crsArrTime", "uniqueCarrier",
    "flightNum", "tailNum", "actualElapsedTime", "crsElapsedTime", "airTime", "arrDelay", "depDelay", "origin",
    "destination", "distance", "taxiIn", "taxiOut", "canceled", "cancellationCode", "diverted", "carrierDelay",
    "weatherDelay", "nASDelay", "securityDelay", "lateAircraftDelay",
)
AIRLINE_TEXT_FIELDS = ("uniqueCarrier", "origin", "destination")
MODEL_TYPES = ("UNKNOWN", "TENSORFLOW", "TENSORFLOWSAVED", "TENSORFLOWSERVING", "PMML", "H2O")


def _struct(*pairs: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in pairs])


WINE_RECORD = _struct(("lot_id", T.StringType()), *((name, T.DoubleType()) for name in WINE_FEATURES))
AIRLINE_RECORD = _struct(
    *((name, T.StringType() if name in AIRLINE_TEXT_FIELDS else T.IntegerType()) for name in AIRLINE_FIELDS)
)
RECOMMENDER_RECORD = _struct(("user", T.LongType()), ("products", T.ArrayType(T.LongType())))
MODEL_DESCRIPTOR = _struct(
    ("modelName", T.StringType()),
    ("description", T.StringType()),
    ("modelType", T.StringType()),
    ("modelBytes", T.BinaryType()),
    ("modelSourceLocation", T.StringType()),
)
RESULT_METADATA = _struct(
    ("errors", T.StringType()),
    ("modelType", T.StringType()),
    ("modelName", T.StringType()),
    ("startTime", T.LongType()),
    ("duration", T.LongType()),
)
DOUBLE_RESULT = _struct(("value", T.DoubleType()))
LABEL_RESULT = _struct(("label", T.StringType()), ("probability", T.DoubleType()))
KEY_VALUES_RESULT = _struct(("keys", T.ArrayType(T.StringType())), ("values", T.ArrayType(T.DoubleType())))
SERVING_STATS = _struct(
    ("modelType", T.StringType()),
    ("modelName", T.StringType()),
    ("description", T.StringType()),
    ("scoreCount", T.LongType()),
    ("since", T.LongType()),
    ("duration", T.LongType()),
    ("min", T.LongType()),
    ("max", T.LongType()),
)


def result_schema(record: T.StructType, result: T.StructType) -> T.StructType:
    return _struct(("inputRecord", record), ("modelResult", result), ("modelResultMetadata", RESULT_METADATA))


WINE_RESULT = result_schema(WINE_RECORD, DOUBLE_RESULT)
AIRLINE_RESULT = result_schema(AIRLINE_RECORD, LABEL_RESULT)
RECOMMENDER_RESULT = result_schema(RECOMMENDER_RECORD, KEY_VALUES_RESULT)


class SchemaMismatch(ValueError):
    """A table lacks declared columns or holds them with another type."""


# Widenings that lose nothing.
_WIDER = {
    "int": {"bigint", "double"},
    "smallint": {"int", "bigint", "float", "double"},
    "tinyint": {"smallint", "int", "bigint", "float", "double"},
    "float": {"double"},
}


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the declared columns in order; widen numbers where nothing is lost, refuse anything else."""
    have = {field.name: field.dataType for field in df.schema.fields}
    problems, columns = [], []
    for field in schema.fields:
        kind = have.get(field.name)
        want = field.dataType.simpleString()
        if kind is None:
            problems.append(f"{field.name} is missing")
        elif kind.simpleString() == want:
            columns.append(F.col(f"`{field.name}`"))
        elif want in _WIDER.get(kind.simpleString(), ()) or isinstance(kind, T.NullType):
            columns.append(F.col(f"`{field.name}`").cast(field.dataType).alias(field.name))
        else:
            problems.append(f"{field.name} is {kind.simpleString()}, not {want}")
    if problems:
        raise SchemaMismatch("; ".join(problems))
    return df.select(*columns)

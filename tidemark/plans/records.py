"""Queries over text records: scan, parse, set aside, number, project."""

from __future__ import annotations

import bz2
import io
import json
import os
import zipfile
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.functions.envelope import double_result, envelope, failed, label_result, metadata, now_ms, succeeded
from tidemark.functions.features import feature_vector, model_fields, text_features
from tidemark.functions.parse import (
    bad_records, good_records, parse_airline, parse_fields, parse_lines, parse_wine, quality_counts,
)
from tidemark.operators.ordering import numbered_lines
from tidemark.plans.common import table
from tidemark.schemas import AIRLINE_RECORD, AIRLINE_RESULT, WINE_FEATURES, WINE_RECORD, conform
from tidemark.scoring.models import LinearModel
from tidemark.scoring.score import missing_error, with_score
from tidemark.scoring.tables import parse_boosted
from tidemark.session import shared_dir, spread
from tidemark.sinks.points import AIRLINE_RESULT_POINT, points
from tidemark.sources.binary import read_bytes
from tidemark.sources.text import read_lines

QUERIES, ORACLE = {}, {}


def query(sql: str | None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return register


_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
_KEYS = ", ".join(_KEY)

# The eleven numbers of a record, from line items; which rows are damaged, and how.
_NUMBERS = (
    "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
    "l_quantity", "l_discount", "l_tax",
)


def _line(numbers) -> str:
    return "concat_ws(';', " + ", ".join(f"CAST({n} AS STRING)" for n in numbers) + ")"


_BLANK = list(_NUMBERS)
_BLANK[3] = "''"
_WORD = list(_NUMBERS)
_WORD[0] = "'good'"
WINE_LINE = (
    "CASE l_orderkey % 17 "
    f"WHEN 0 THEN {_line(_BLANK)} "
    f"WHEN 1 THEN {_line(_NUMBERS[:10])} "
    f"WHEN 2 THEN concat({_line(_NUMBERS)}, ';') "
    f"WHEN 3 THEN concat({_line(_NUMBERS)}, ';x') "
    f"WHEN 4 THEN {_line(_WORD)} "
    f"ELSE concat({_line(_NUMBERS)}, ';5') END"
)
_TEXTS = f"(SELECT {_KEYS}, rtrim({WINE_LINE}, ';') AS line FROM lineitem)"
_GOOD = "l_orderkey % 17 NOT IN (0, 1, 3, 4)"
_BAD_ERROR = (
    "CASE l_orderkey % 17 WHEN 1 THEN 'Record does not have 11 fields, ' || line "
    "WHEN 0 THEN 'Failed to parse string ' || line || '. cause: java.lang.NumberFormatException: empty String' "
    "WHEN 3 THEN 'Failed to parse string ' || line || '. cause: java.lang.NumberFormatException: For input string: \"x\"' "
    "ELSE 'Failed to parse string ' || line || '. cause: java.lang.NumberFormatException: For input string: \"good\"' END"
)


def wine_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "lineitem")).select(*_KEY, F.expr(WINE_LINE).alias("value"))


_TOKENS = ", ".join(
    f"TRY_CAST(string_split(line, ';')[{i + 1}] AS DOUBLE) AS \"{name}\"" for i, name in enumerate(WINE_FEATURES)
)


@query(f"""
SELECT l_orderkey, l_linenumber, 'wine quality sample data' AS lot_id, {_TOKENS} FROM {_TEXTS}
WHERE len(string_split(line, ';')) >= 11
  AND len(list_filter(string_split(line, ';'), lambda t: TRY_CAST(t AS DOUBLE) IS NULL)) = 0
""")
def parse_delimited_good(spark, sf_dir):
    good = good_records(parse_lines(wine_lines(spark, sf_dir), parse_wine), keep=("l_orderkey", "l_linenumber"))
    conform(good, WINE_RECORD)
    return good


@query(f"SELECT {_KEYS}, {_BAD_ERROR} AS error FROM {_TEXTS} WHERE NOT ({_GOOD})")
def parse_delimited_bad(spark, sf_dir):
    parsed = parse_lines(wine_lines(spark, sf_dir), parse_wine)
    return parsed.where("error IS NOT NULL").select(*_KEY, "error")


@query(f"SELECT count(*) FILTER ({_GOOD}) AS good, count(*) FILTER (NOT ({_GOOD})) AS bad FROM lineitem")
def parse_quality(spark, sf_dir):
    return quality_counts(parse_lines(wine_lines(spark, sf_dir), parse_wine))


# 29 fields; NA in many places, one row in eleven with a text tail number, one in thirteen too short.
_FLIGHT = [
    "'1990'", "CAST(l_linenumber AS STRING)", "' 3 '", "'4'", "CAST(l_partkey AS STRING)", "CAST(l_suppkey AS STRING)",
    "'NA'", "'1723'", "CASE WHEN l_returnflag = 'N' THEN 'NA' ELSE l_returnflag END", "CAST(l_orderkey AS STRING)",
    "CASE WHEN l_orderkey % 11 = 0 THEN concat('N', CAST(l_suppkey AS STRING)) ELSE 'NA' END", "'48'", "'53'", "'NA'",
    "CAST(l_linenumber - 4 AS STRING)", "'37'", "l_linestatus", "'IND'", "'182'",
] + ["'NA'"] * 9
_FLIGHT_LINE = (
    f"CASE WHEN l_orderkey % 13 = 0 THEN concat_ws(',', {', '.join(_FLIGHT)}) "
    f"ELSE concat_ws(',', {', '.join(_FLIGHT)}, 'NA') END"
)


@query(f"""
SELECT {_KEYS}, CASE WHEN l_orderkey % 13 = 0 THEN 'ERROR: record does not have 29 fields.'
   WHEN l_orderkey % 11 = 0 THEN 'ERROR: Failed to parse string ' || {_FLIGHT_LINE} || '. cause: java.lang.NumberFormatException: '
     || 'For input string: "N' || l_suppkey || '"' END AS error,
  CASE WHEN {'{ok}'} THEN l_linenumber END AS month, CASE WHEN {'{ok}'} THEN 3 END AS day_of_month,
  CASE WHEN {'{ok}'} THEN 0 END AS arr_time, CASE WHEN {'{ok}'} THEN l_linenumber - 4 END AS arr_delay,
  CASE WHEN {'{ok}'} THEN CASE WHEN l_returnflag = 'N' THEN '0' ELSE l_returnflag END END AS carrier,
  CASE WHEN {'{ok}'} THEN l_linestatus END AS origin, CASE WHEN {'{ok}'} THEN 0 END AS tail_num
FROM lineitem
""".replace("{ok}", "l_orderkey % 13 <> 0 AND l_orderkey % 11 <> 0"))
def parse_na_to_zero(spark, sf_dir):
    lines = spread(table(spark, sf_dir, "lineitem")).select(*_KEY, F.expr(_FLIGHT_LINE).alias("value"))
    parsed = parse_lines(lines, parse_airline)
    assert parsed.schema["record"].dataType == AIRLINE_RECORD
    return parsed.select(
        *_KEY, "error", F.col("record.month").alias("month"), F.col("record.dayOfMonth").alias("day_of_month"),
        F.col("record.arrTime").alias("arr_time"), F.col("record.arrDelay").alias("arr_delay"),
        F.col("record.uniqueCarrier").alias("carrier"), F.col("record.origin").alias("origin"),
        F.col("record.tailNum").alias("tail_num"),
    )


_DELAYS = {
    "init": -0.25, "labels": ["NO", "YES"], "threshold": 0.5,
    "trees": [
        {"field": "uniqueCarrier", "in": ["A", "0"], "left": {"leaf": 0.5}, "right": {"leaf": -0.5}},
        {"field": "arrDelay", "below": 0, "left": {"leaf": -1.0}, "right": {"field": "month", "below": 6, "left": {"leaf": 0.25}, "right": {"leaf": 1.5}}},
    ],
}
_DELAY_ROWS = f"""(SELECT {_KEYS}, 1 / (1 + exp(-(-0.25 + CASE WHEN l_returnflag IN ('A', 'N') THEN 0.5 ELSE -0.5 END
  + CASE WHEN l_linenumber - 4 < 0 THEN -1.0 WHEN l_linenumber < 6 THEN 0.25 ELSE 1.5 END))) AS p
  FROM lineitem WHERE l_orderkey % 13 <> 0 AND l_orderkey % 11 <> 0)"""


def delay_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From flight lines to (label, probability) results in their envelope."""
    flights = spread(table(spark, sf_dir, "lineitem")).select(*_KEY, F.expr(_FLIGHT_LINE).alias("value"))
    records = good_records(parse_lines(flights, parse_airline), keep=tuple(_KEY))
    model = parse_boosted(json.dumps(_DELAYS))
    scored = with_score(records.withColumn("_start", now_ms()), model)
    meta = metadata(missing_error(F.col("score.value"), model.fields), F.lit("H2O"), F.lit("delays"), F.col("_start"))
    names = [f.name for f in AIRLINE_RECORD.fields]
    results = envelope(scored, names, label_result(F.col("score.label"), F.col("score.value")), meta, tuple(_KEY))
    conform(results, AIRLINE_RESULT)
    return results


@query(f"SELECT {_KEYS}, CASE WHEN p >= 0.5 THEN 'YES' ELSE 'NO' END AS label, round(p, 6) AS probability, '' AS errors, true AS started FROM {_DELAY_ROWS}")
def airline_delay_results(spark, sf_dir):
    return delay_results(spark, sf_dir).select(
        *_KEY, F.col("modelResult.label").alias("label"), F.round("modelResult.probability", 6).alias("probability"),
        F.col("modelResultMetadata.errors").alias("errors"), (F.col("modelResultMetadata.startTime") > 0).alias("started"),
    )


@query(f"""
SELECT CASE WHEN p >= 0.5 THEN 'YES' ELSE 'NO' END AS label, count(*) AS n, round(sum(p), 4) AS total FROM {_DELAY_ROWS} GROUP BY 1
""")
def airline_delay_points(spark, sf_dir):
    """The results as points of the airline application."""
    timed = delay_results(spark, sf_dir).withColumn("at", F.timestamp_millis("modelResultMetadata.startTime"))
    made = points(timed, AIRLINE_RESULT_POINT, "at").where("measurement = 'airline_flight_result'")
    return made.groupBy(F.col("texts")["prediction_label"].alias("label")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum(F.col("fields")["delay_probability"]), 4).alias("total")
    )


@query("""
SELECT o_orderkey, o_orderkey % 4 <> 1 AND o_orderkey % 4 <> 2 AS good, CASE WHEN o_orderkey % 4 NOT IN (1, 2) THEN o_orderpriority END AS priority,
  CASE WHEN o_orderkey % 4 NOT IN (1, 2) THEN o_totalprice END AS price FROM orders
""")
def parse_user_fields(spark, sf_dir):
    """A user's own record type, read from lines of which some lack a field and some have a word for a number."""
    line = F.expr(
        "CASE o_orderkey % 4 WHEN 1 THEN concat_ws('|', o_orderkey, o_orderpriority) "
        "WHEN 2 THEN concat_ws('|', o_orderkey, o_orderpriority, 'much') ELSE concat_ws('|', o_orderkey, o_orderpriority, o_totalprice) END"
    )
    kind = T.StructType([T.StructField("id", T.LongType()), T.StructField("priority", T.StringType()), T.StructField("price", T.DoubleType())])
    parsed = parse_lines(table(spark, sf_dir, "orders").select("o_orderkey", line.alias("value")), parse_fields("|", kind))
    return parsed.select("o_orderkey", F.col("error").isNull().alias("good"), F.col("record.priority").alias("priority"), F.col("record.price").alias("price"))


@query("SELECT l_returnflag AS flag, count(*) FILTER (l_tax <> 0) AS ok, count(*) FILTER (l_tax = 0) AS bad FROM lineitem GROUP BY l_returnflag")
def results_by_success(spark, sf_dir):
    """Results split by whether their metadata holds an error."""
    model = LinearModel(0.0, (("l_tax", 1.0),), "inverse")
    scored = with_score(table(spark, sf_dir, "lineitem").select("l_returnflag", "l_tax"), model)
    results = envelope(scored, ["l_tax"], double_result(F.col("score.value")), metadata(missing_error(F.col("score.value"), model.fields)), ("l_returnflag",))
    ok = succeeded(results).groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("ok"))
    bad = failed(results).groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("bad"))
    return ok.join(bad, "l_returnflag", "full").select(
        F.col("l_returnflag").alias("flag"), F.coalesce("ok", F.lit(0)).alias("ok"), F.coalesce("bad", F.lit(0)).alias("bad")
    )


def _write_in_order(lines: DataFrame, folder: str, compression: str = "none") -> str:
    """Text files whose names and lines follow the key order; files are cut by range, as many as the size asks for."""
    ordered = lines.repartitionByRange(*_KEY).sortWithinPartitions(*_KEY)
    ordered.select("value").write.option("compression", compression).text(folder)
    return folder


@query(f"""
SELECT row_number() OVER (ORDER BY {_KEYS}) AS seq, l_extendedprice AS volatile_acidity, l_orderkey::DOUBLE AS chlorides
FROM lineitem WHERE {_GOOD}
""")
def record_sequence(spark, sf_dir):
    """Good records of many files numbered from 1 in file and line order."""
    folder = _write_in_order(wine_lines(spark, sf_dir), shared_dir(spark, "text"))
    parsed = parse_lines(read_lines(spark, dirs=[folder]), parse_wine).where("error IS NULL")
    got = numbered_lines(parsed.select("file_idx", "line_no", "record.volatile_acidity", "record.chlorides"))
    return got.select("seq", "volatile_acidity", "chlorides")


@query(f"""
SELECT l_returnflag AS flag, count(*) AS bad, sum(length(line))::BIGINT AS chars, true AS placed
FROM (SELECT l_returnflag, l_orderkey, {WINE_LINE} AS line FROM lineitem) WHERE NOT ({_GOOD}) GROUP BY l_returnflag
""")
def bad_record_places(spark, sf_dir):
    """Bad lines of compressed files with file, line number and message; files of one folder hold one return flag."""
    lines = spread(table(spark, sf_dir, "lineitem")).select("l_returnflag", F.expr(WINE_LINE).alias("value"))
    root = shared_dir(spark, "flags")
    lines.write.partitionBy("l_returnflag").option("compression", "gzip").text(root)
    # One folder for each flag there is.
    folders = [r.folder for r in spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select(
        F.substring_index("path", "/", -2).alias("last")).select(F.substring_index("last", "/", 1).alias("folder")).where("folder LIKE 'l_returnflag=%'").distinct().collect()]
    parsed = parse_lines(read_lines(spark, dirs=[*[f"{root}/{f}" for f in sorted(folders)], f"{root}/not-there"], name_regex="gz"), parse_wine)
    flag = F.regexp_extract("file", "l_returnflag=([A-Z])", 1)
    placed = F.col("message").startswith("(file:") & F.col("message").contains(") Invalid record string, ")
    return bad_records(parsed).groupBy(flag.alias("flag")).agg(
        F.count(F.lit(1)).alias("bad"), F.sum(F.length("line")).alias("chars"),
        (F.bool_and(placed) & (F.countDistinct("file", "line_no") == F.count(F.lit(1)))).alias("placed"),
    )


@query("SELECT o_orderkey, o_custkey, o_totalprice, true AS numbered FROM orders")
def text_scan_with_header(spark, sf_dir):
    """Plain, gzip and bzip2 files in one scan, the header line of every file skipped, and one listed file missing."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    root = shared_dir(spark, "csv")
    for i, codec in enumerate(("none", "gzip", "bzip2")):
        part = orders.where(F.pmod(F.xxhash64("o_orderkey"), F.lit(3)) == i)
        part.write.option("header", True).option("sep", ";").option("compression", codec).csv(f"{root}/{codec}")
    lines = read_lines(
        spark, [f"{root}/none", f"{root}/not-there", f"{root}/gzip", f"{root}/bzip2"], drop_first=1, fail_if_missing=False
    )
    # The numbers of a file with n lines are 0 to n - 1, each once.
    facts = lines.groupBy("file").agg(
        F.count(F.lit(1)).alias("n"), F.min("line_no").alias("low"), F.max("line_no").alias("high"), F.sum("line_no").alias("total")
    )
    right = (F.col("low") == 0) & (F.col("high") == F.col("n") - 1) & (F.col("total") * 2 == F.col("n") * (F.col("n") - 1))
    tokens = F.split("value", ";")
    return lines.join(facts.select("file", right.alias("numbered")), "file").select(
        tokens[0].cast("bigint").alias("o_orderkey"), tokens[1].cast("bigint").alias("o_custkey"),
        tokens[2].cast("double").alias("o_totalprice"), "numbered",
    )


@query("SELECT sum(strlen(o_orderkey::VARCHAR || ';' || o_orderpriority) + 1)::BIGINT AS bytes, 0 AS refused FROM orders")
def binary_scan(spark, sf_dir):
    """Whole files as bytes with a size limit per file."""
    orders = table(spark, sf_dir, "orders")
    folder = shared_dir(spark, "bytes")
    orders.select(F.concat_ws(";", F.col("o_orderkey").cast("string"), "o_orderpriority")).write.option(
        "maxRecordsPerFile", 1_000_000
    ).text(folder)
    return read_bytes(spark, [folder]).agg(
        F.sum(F.octet_length("bytes")).cast("bigint").alias("bytes"), F.count("error").cast("int").alias("refused")
    )


@query(f"""
SELECT {_KEYS}, CAST(l_linenumber AS VARCHAR) AS "Month", l_returnflag AS "UniqueCarrier",
  CAST(l_partkey AS VARCHAR) AS "Dest", CAST(l_tax AS FLOAT)::DOUBLE AS v0, CAST(l_discount AS FLOAT)::DOUBLE AS v1,
  l_quantity + l_discount AS model_input FROM lineitem
""")
def feature_projection(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    names = {"Month": "l_linenumber", "UniqueCarrier": "l_returnflag", "Dest": "l_partkey"}
    wide = text_features(lines, names, keep=(*_KEY, "l_tax", "l_discount", "l_quantity"))
    vector = wide.withColumn("v", feature_vector(["l_tax", "l_discount"]))
    fields = model_fields(vector, ["l quantity", "l discount"], keep=(*_KEY, *names, "v"))
    return fields.select(
        *_KEY, *names, F.col("v")[0].cast("double").alias("v0"), F.col("v")[1].cast("double").alias("v1"),
        (F.col("l_quantity") + F.col("l_discount")).alias("model_input"),
    )


# Orders of an archive, about.
_ARCHIVED = 20_000


def _pack(folder: str):
    """Writes archives named by number, a zip with an entry per status or, for odd numbers, a bzip2 file."""
    folder = "/" + folder.removeprefix("file:").lstrip("/")

    def zipped(draft, rows):
        with zipfile.ZipFile(draft, "w", zipfile.ZIP_DEFLATED) as archive:
            for status, own in groupby(rows, lambda r: r[1]):
                with io.TextIOWrapper(archive.open(f"{status}.csv", "w"), encoding="utf-8") as entry:
                    entry.writelines(f"{line}\n" for _, _, line in own)

    def squeezed(draft, rows):
        with bz2.open(draft, "wt", encoding="utf-8") as text:
            text.writelines(f"{line}\n" for _, _, line in rows)

    def run(batches):
        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
        os.makedirs(folder, exist_ok=True)
        for number, own in groupby(rows, lambda r: r[0]):
            # Under its name only when it is whole: a task may be lost, or run twice.
            draft = f"{folder}/{os.urandom(8).hex()}.draft"
            (squeezed if number % 2 else zipped)(draft, own)
            os.replace(draft, f"{folder}/{number}.{'bzip2' if number % 2 else 'zip'}")
            yield pa.RecordBatch.from_arrays([pa.array([number])], names=["archive"])

    return run


@query(f"""
WITH n AS (SELECT count(*) // {_ARCHIVED} + 2 AS archives FROM orders)
SELECT o_orderkey, o_orderkey % archives AS archive, o_totalprice,
  row_number() OVER (PARTITION BY o_orderkey % archives ORDER BY o_orderstatus, o_orderkey) - 1 AS line_no FROM orders, n
""")
def archived_lines(spark, sf_dir):
    """Orders in zip archives of several entries and in bzip2 files, with their line numbers."""
    folder = shared_dir(spark, "archives")
    orders = table(spark, sf_dir, "orders")
    n = orders.count() // _ARCHIVED + 2
    line = F.concat_ws(";", "o_orderkey", "o_totalprice").alias("line")
    placed = orders.select((F.col("o_orderkey") % n).alias("archive"), "o_orderstatus", line, "o_orderkey")
    # An archive is a file, so one task writes it.
    packed = placed.repartition("archive").sortWithinPartitions("archive", "o_orderstatus", "o_orderkey").drop("o_orderkey")
    packed.mapInArrow(_pack(folder), "archive bigint").count()
    fields = F.split("value", ";")
    return read_lines(spark, dirs=[folder], name_regex=r"\.(zip|bzip2)$").select(
        fields[0].cast("bigint").alias("o_orderkey"), F.regexp_extract("file", r"([0-9]+)\.[a-z0-9]+$", 1).cast("bigint").alias("archive"),
        fields[1].cast("double").alias("o_totalprice"), "line_no",
    )

"""Delimited-line parsers.

A parser adds `record`, a struct that is null for a bad line, and `error`, a text that is null for a good one. The
parsers here work in steps, each its own projection, so a line is split once and a token is read once however many
fields and checks use it. A user's own parser can be any function Column -> struct<record, error>, see `column_parser`.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.schemas import AIRLINE_FIELDS, AIRLINE_RECORD, AIRLINE_TEXT_FIELDS, WINE_FEATURES, WINE_RECORD

Parser = Callable[[DataFrame, str], DataFrame]

WINE_LOT = "wine quality sample data"
_BLANKS = "".join(map(chr, range(33)))


def trim_control(text: Column) -> Column:
    """Drop blanks and control characters at both ends."""
    return F.btrim(text, F.lit(_BLANKS))


def _checked_double(token: Column, value: Column) -> Column:
    """The double read from a token, or null where a word was read that is not spelled exactly NaN or Infinity."""
    unusual = F.isnan(value) | (F.abs(value) == float("inf"))
    spelled = trim_control(token).rlike("^([+-]?(NaN|Infinity)|[^nN]*)$")
    return F.when(~unusual | spelled, value)


def to_double(token: Column) -> Column:
    """A double or null."""
    return _checked_double(token, token.try_cast("double"))


def _trimmed_int(text: Column) -> Column:
    # A failing cast raises and catches an error inside Spark; looking first is far cheaper on text columns.
    return F.when(text.rlike("^[+-]?[0-9]+$"), text.try_cast("int"))


def to_int(token: Column) -> Column:
    """A 32-bit whole number or null; no fraction, no exponent."""
    return _trimmed_int(trim_control(token))


def _sql_text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _number_error(token: Column) -> Column:
    return F.concat(F.lit('java.lang.NumberFormatException: For input string: "'), token, F.lit('"'))


def split_lines(df: DataFrame, text: str, separator: str) -> DataFrame:
    """Add `_text`, the line without separators at its end, and its `_tokens`; an empty line is one empty token."""
    short = df.withColumn("_text", F.expr(f"trim(TRAILING {_sql_text(separator)} FROM `{text}`)"))
    only_separators = (F.col("_text") == "") & (F.col(text) != "")
    tokens = F.split("_text", re.escape(separator))
    return short.withColumn("_tokens", F.when(only_separators, F.array().cast("array<string>")).otherwise(tokens))


def _token(i: int) -> Column:
    return F.get("_tokens", F.lit(i))


def _judged(df: DataFrame, schema: T.StructType, fields: Sequence[Column], error: Column, keep: Sequence[str]) -> DataFrame:
    record = F.struct(*[c.alias(f.name) for f, c in zip(schema.fields, fields)])
    outcome = df.withColumn("_error", error.cast("string"))
    # A filter on the outcome would otherwise be moved below all steps and do their work a second time; what depends on
    # the task stays where it is.
    settled = F.when(F.spark_partition_id() >= 0, F.col("_error")).alias("error")
    return outcome.select(*keep, F.when(F.col("_error").isNull(), record).cast(schema).alias("record"), settled)


def _first_null(values: Column) -> Column:
    """Position of the first null from 1, 0 when there is none."""
    return F.array_position(F.transform(values, lambda v: v.isNull()), True)


_FINITE = 1.7976931348623157e308


def _all(conditions: Sequence[Column]) -> Column:
    return F.coalesce(reduce(lambda a, b: a & b, conditions), F.lit(False))


def parse_wine(lines: DataFrame, text: str = "value", separator: str = ";", lot: str = WINE_LOT) -> DataFrame:
    """At least eleven numbers; every token must be one, also those past the eleventh, which are dropped.

    Plain lines, of finite numbers and one token more at most, are read as columns; only the others are looked at token
    by token.
    """
    width = len(WINE_FEATURES)
    n = F.size("_tokens")
    cut = split_lines(lines, text, separator)
    read = cut.select("*", *[_token(i).try_cast("double").alias(f"_d{i}") for i in range(width + 1)])
    finite = [F.col(f"_d{i}").between(-_FINITE, _FINITE) for i in range(width + 1)]
    read = read.withColumn("_plain", _all([*finite[:width], (n == width) | (n == width + 1) & finite[width]]))
    # Null on plain lines, here and below.
    read = read.withColumn("_read", F.when(~F.col("_plain"), F.transform("_tokens", lambda t: t.try_cast("double"))))
    checked = read.withColumn("_numbers", F.zip_with("_tokens", "_read", _checked_double))
    marked = checked.withColumn("_bad", trim_control(F.get("_tokens", _first_null(F.col("_numbers")) - 1)))
    cause = F.when(F.col("_bad") == "", F.lit("java.lang.NumberFormatException: empty String")).otherwise(
        _number_error(F.col("_bad"))
    )
    error = F.when(F.col("_plain"), F.lit(None)).when(
        n < width, F.concat(F.lit("Record does not have 11 fields, "), "_text")
    ).when(F.col("_bad").isNotNull(), F.concat(F.lit("Failed to parse string "), "_text", F.lit(". cause: "), cause))
    fields = [F.lit(lot)] + [F.when(F.col("_plain"), F.col(f"_d{i}")).otherwise(F.get("_numbers", F.lit(i))) for i in range(width)]
    return _judged(marked, WINE_RECORD, fields, error, lines.columns)


def parse_airline(
    lines: DataFrame, text: str = "value", separator: str = ",", text_codes: bool = False
) -> DataFrame:
    """At least 29 fields, NA read as 0, all but three of them whole numbers.

    `text_codes` takes the first run of digits (else 0) of tailNum and cancellationCode, instead of refusing rows
    where they are not numbers. Lines without fault and without odd blanks are read as columns; only the others are
    looked at token by token.
    """
    width = len(AIRLINE_FIELDS)
    words = [i for i, name in enumerate(AIRLINE_FIELDS) if name in AIRLINE_TEXT_FIELDS]
    codes = [i for i, name in enumerate(AIRLINE_FIELDS) if name in ("tailNum", "cancellationCode")]

    def clean(token: Column, coded: Column | bool) -> Column:
        value = F.when(token == "NA", F.lit("0"))
        if text_codes and coded is not False:
            digits = F.regexp_extract(token, "[0-9]+", 0)
            value = value.when(F.lit(coded) if coded is True else coded, F.when(digits == "", F.lit("0")).otherwise(digits))
        return value.otherwise(token)

    cut = split_lines(lines, text, separator).withColumn("_odd", F.col("_text").rlike(r"[\x00-\x1f]"))
    words_of = lambda i: clean(F.trim(_token(i)), i in codes)
    read = cut.select("*", *[(words_of(i) if i in words else words_of(i).try_cast("int")).alias(f"_f{i}") for i in range(width)])
    numbers = [F.col(f"_f{i}").isNotNull() for i in range(width) if i not in words]
    read = read.withColumn("_plain", _all([~F.col("_odd"), F.size("_tokens") >= width, *numbers]))
    # Null on plain lines, here and below.
    slow = read.withColumn("_trimmed", F.when(~F.col("_plain"), F.transform(F.slice("_tokens", 1, width), trim_control)))
    slow = slow.withColumn("_clean", F.transform("_trimmed", lambda t, i: clean(t, i.isin(*codes))))
    slow = slow.withColumn(
        "_numbers", F.transform("_clean", lambda t, i: F.when(i.isin(*words), F.lit(0)).otherwise(_trimmed_int(t)))
    )
    marked = slow.withColumn("_bad", F.get("_clean", _first_null(F.col("_numbers")) - 1))
    error = F.when(F.col("_plain"), F.lit(None)).when(F.size("_tokens") < width, F.lit("ERROR: record does not have 29 fields.")).when(
        F.col("_bad").isNotNull(),
        F.concat(F.lit("ERROR: Failed to parse string "), "_text", F.lit(". cause: "), _number_error(F.col("_bad"))),
    )
    fields = [
        F.when(F.col("_plain"), F.col(f"_f{i}")).otherwise(F.get("_clean" if i in words else "_numbers", F.lit(i)))
        for i in range(width)
    ]
    return _judged(marked, AIRLINE_RECORD, fields, error, lines.columns)


def parse_fields(separator: str, schema: T.StructType) -> Parser:
    """A parser for any flat schema: enough tokens, each of them readable as its field's type."""
    readers = {T.DoubleType: to_double, T.IntegerType: to_int, T.StringType: lambda token: token}

    def parse(lines: DataFrame, text: str = "value") -> DataFrame:
        tokens = split_lines(lines, text, separator)
        typed = tokens.select(
            "*",
            *[
                readers.get(type(f.dataType), lambda token, f=f: token.try_cast(f.dataType))(_token(i)).alias(f"_f{i}")
                for i, f in enumerate(schema.fields)
            ],
        )
        fields = [F.col(f"_f{i}") for i in range(len(schema.fields))]
        # A missing token reads as null too.
        unreadable = reduce(lambda a, b: a | b, [c.isNull() for c in fields])
        return _judged(typed, schema, fields, F.when(unreadable, F.col(text)), lines.columns)

    return parse


def column_parser(parse: Callable[[Column], Column]) -> Parser:
    """A parser from a function of the text column to a struct<record, error>, which may be a pandas_udf."""

    def apply(lines: DataFrame, text: str = "value") -> DataFrame:
        parsed = lines.withColumn("_parsed", parse(F.col(text)))
        return parsed.select(*lines.columns, "_parsed.record", "_parsed.error")

    return apply


def parse_lines(lines: DataFrame, parser: Parser, text: str = "value") -> DataFrame:
    """Add `record` and `error` to lines that have `text`."""
    return parser(lines, text)


def good_records(parsed: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    return parsed.where("error IS NULL").select(*keep, "record.*")


def bad_record_message(file: Column, line_no: Column, error: Column, text: Column) -> Column:
    return F.concat(
        F.lit("("), file, F.lit(":"), line_no.cast("string"), F.lit(") Invalid record string, "), error,
        F.lit(". line = "), text,
    )


def bad_records(parsed: DataFrame, text: str = "value") -> DataFrame:
    """The rows set aside, each with its message."""
    return parsed.where("error IS NOT NULL").select(
        "file", "line_no", F.col(text).alias("line"), "error",
        bad_record_message(F.col("file"), F.col("line_no"), F.col("error"), F.col(text)).alias("message"),
    )


class AllRecordsAreBad(ValueError):
    pass


def quality_counts(parsed: DataFrame) -> DataFrame:
    """One row: how many lines are good and bad (P5)."""
    return parsed.agg(
        F.count_if(F.col("error").isNull()).alias("good"), F.count_if(F.col("error").isNotNull()).alias("bad")
    )


def require_good(parsed: DataFrame, files: list[str]) -> tuple[int, int]:
    """Counts of good and bad lines; raises when no line of the whole input is good."""
    counts = quality_counts(parsed).first()
    if counts.good == 0:
        raise AllRecordsAreBad(f"none of the {counts.bad} lines could be read; files: {', '.join(files)}")
    return counts.good, counts.bad


def watch_quality(parsed: DataFrame, observation) -> DataFrame:
    """The same rows; the observation holds the good and bad counts once an action has run, with no scan of its own."""
    return parsed.observe(
        observation,
        F.count_if(F.col("error").isNull()).alias("good"),
        F.count_if(F.col("error").isNotNull()).alias("bad"),
    )

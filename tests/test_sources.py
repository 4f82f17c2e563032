import bz2
import gzip
import sys
import zipfile

import pandas as pd
import pytest
from pyspark import cloudpickle
from pyspark.sql import Observation, functions as F, types as T

from tidemark.functions.parse import (
    AllRecordsAreBad, bad_records, column_parser, good_records, parse_airline, parse_fields, parse_lines, parse_wine, quality_counts,
    require_good, watch_quality,
)
from tidemark.operators.ordering import numbered, numbered_lines
from tidemark.schemas import AIRLINE_RECORD, WINE_FEATURES, WINE_RECORD, SchemaMismatch, conform
from tidemark.sources.binary import model_catalogue, read_bytes
from tidemark.sources.text import MissingInput, UNREADABLE, read_lines

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PAIR = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("name", T.StringType())])
WINE_LINE = "7.4;0.31;0.2;2.6;0.05;14;40;0.991;3.3;0.61;10.2"
AIRLINE_TOKENS = "2003,7,14,1,845,840,1010,1005,XY,512,NA,85,86,NA,5,6,ABC,DEF,400,NA,NA,0,NA,0,NA,NA,NA,NA,NA".split(",")


@pytest.fixture
def mixed(tmp_path):
    data = lambda start: "".join(f"{i},n{i}\n" for i in range(start, start + 3)).encode()
    (tmp_path / "a.txt").write_bytes(data(0))
    (tmp_path / "b.gz").write_bytes(gzip.compress(data(10)))
    (tmp_path / "c.gzip").write_bytes(gzip.compress(data(20)))
    (tmp_path / "d.bz2").write_bytes(bz2.compress(data(30)))
    (tmp_path / "e.bzip2").write_bytes(bz2.compress(data(40)))
    with zipfile.ZipFile(tmp_path / "f g+h[1].zip", "w") as z:
        z.writestr("one", data(50))
        z.writestr("two", "60,x\r\n61,y")
    return tmp_path


def test_all_compressions_in_one_list(spark, mixed):
    names = ["f g+h[1].zip", "e.bzip2", "d.bz2", "c.gzip", "b.gz", "a.txt"]
    df = read_lines(spark, [str(mixed / n) for n in names])
    got = {}
    for r in df.orderBy("file_idx", "line_no").collect():
        got.setdefault(r.file_idx, []).append((r.line_no, r.value))
    assert [v for _, v in got[0]] == ["50,n50", "51,n51", "52,n52", "60,x", "61,y"]
    for i, start in enumerate([40, 30, 20, 10, 0], start=1):
        assert got[i] == [(j, f"{start + j},n{start + j}") for j in range(3)]


def test_header_lines_are_dropped_per_file(spark, mixed):
    df = read_lines(spark, [str(mixed / "a.txt"), str(mixed / "e.bzip2")], drop_first=1)
    assert sorted((r.line_no, r.value) for r in df.collect()) == [(0, "1,n1"), (0, "41,n41"), (1, "2,n2"), (1, "42,n42")]


def test_line_numbers_over_many_splits(spark, tmp_path):
    (tmp_path / "big.txt").write_text("".join(f"{i}\n" for i in range(5000)))
    (tmp_path / "other.txt").write_text("".join(f"{i}\n" for i in range(777)))
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "1000")
    try:
        df = read_lines(spark, dirs=[str(tmp_path)])
        assert df.where("line_no != value").count() == 0
        assert df.count() == 5777
        kept = df.where("pmod(xxhash64(file, line_no), 3) != 0")
        pairs = numbered_lines(kept).join(numbered(kept, ["file_idx", "line_no"], "want"), ["file_idx", "line_no"])
        assert pairs.count() == kept.count() and pairs.where("seq != want").count() == 0
        plan = numbered_lines(kept)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan.replace("BroadcastExchange", "")
        assert numbered_lines(kept, limit=1).where("seq = 1").count() == 1
    finally:
        spark.conf.set(key, before)


def test_directory_regex_is_a_search(spark, mixed):
    assert read_lines(spark, dirs=[str(mixed)], name_regex="zip").select("file").distinct().count() == 3
    assert read_lines(spark, dirs=[str(mixed)], name_regex="^[ab]").count() == 6
    assert read_lines(spark, dirs=[str(mixed)], name_regex="g[+]h").count() == 5
    assert read_lines(spark, dirs=[str(mixed)]).count() == 20
    with pytest.raises(MissingInput, match="nothing"):
        read_lines(spark, dirs=[str(mixed)], name_regex="nothing")
    assert read_lines(spark, dirs=[str(mixed)], name_regex="nothing", fail_if_missing=False).count() == 0
    one = read_lines(spark, [str(mixed / "a.txt")], dirs=[str(mixed)], name_regex="nothing")
    assert one.count() == 3  # explicit paths win


def test_missing_input_policy(spark, mixed):
    good, bad = str(mixed / "a.txt"), [str(mixed / "no1"), str(mixed / "no2")]
    with pytest.raises(MissingInput) as e:
        read_lines(spark, [bad[0], good, bad[1]])
    assert bad[0] in str(e.value) and bad[1] in str(e.value) and good not in str(e.value)
    assert read_lines(spark, [bad[0], good], fail_if_missing=False).count() == 3
    assert read_lines(spark, bad, fail_if_missing=False).count() == 0
    with pytest.raises(MissingInput, match="no file"):
        read_lines(spark, dirs=[str(mixed / "no-folder")])
    with pytest.raises(MissingInput, match="no paths"):
        from tidemark.sources.text import existing_paths

        existing_paths(spark, [])
    with pytest.raises(MissingInput):
        read_lines(spark)


def test_a_folder_among_the_paths(spark, mixed, tmp_path_factory):
    """A folder's archives are read, every line has the place of its file, and a path listed twice counts twice."""
    other = tmp_path_factory.mktemp("other")
    (other / "x.txt").write_text("7,x\n")
    one = str(other / "x.txt")
    rows = read_lines(spark, [one, str(mixed), one]).orderBy("file_idx", "line_no").collect()
    assert len(rows) == 22 and all(r.file_idx is not None for r in rows)
    assert (rows[0].file_idx, rows[0].value, rows[-1].file_idx, rows[-1].value) == (0, "7,x", 7, "7,x")
    assert sum(r.file.endswith((".zip", ".bzip2")) for r in rows) == 8
    folders = read_lines(spark, dirs=[str(mixed), str(other)]).groupBy("file").agg(F.max("file_idx").alias("i")).collect()
    assert max(folders, key=lambda r: r.i).file.endswith("x.txt")


def test_a_corrupt_archive_is_a_bad_line(spark, tmp_path):
    (tmp_path / "a.zip").write_bytes(b"PK no archive")
    (tmp_path / "b.bzip2").write_bytes(bz2.compress(b"1,x\n2,y\n" * 50_000)[:-20])
    (tmp_path / "c.txt").write_text("5,z\n")
    lines = read_lines(spark, dirs=[str(tmp_path)])
    assert lines.where(F.col("value").startswith(UNREADABLE)).select("file").distinct().count() == 2
    good = parse_lines(lines, parse_fields(",", PAIR)).where("error IS NULL")
    assert good.where("file LIKE '%c.txt'").count() == 1 and good.where("file LIKE '%a.zip'").count() == 0


def test_long_digit_runs_are_not_cut(spark):
    """A code whose digits make no 32-bit number is an error, not another number."""
    tokens = AIRLINE_TOKENS[:10] + ["N1234567890"] + AIRLINE_TOKENS[11:]
    df = spark.createDataFrame([(",".join(tokens),)], "value string")
    row = parse_lines(df, lambda d, text: parse_airline(d, text, text_codes=True)).first()
    assert row.error is not None and "1234567890" in row.error or row.record.tailNum == 1234567890


def test_sequence_over_files_in_order(spark, tmp_path):
    (tmp_path / "z1").write_text("10,ash\n20,birch\nbad\n30,cedar\n")
    (tmp_path / "a2").write_text("40,elm\n50,fir\n60,oak\n")
    lines = read_lines(spark, [str(tmp_path / "z1"), str(tmp_path / "a2")])
    good = parse_lines(lines, parse_fields(",", PAIR)).where("error IS NULL")
    got = numbered(good, ["file_idx", "line_no"], target_rows=2).orderBy("seq").collect()
    again = numbered_lines(good).orderBy("seq").collect()
    assert [(r.seq, r.value) for r in again] == [(r.seq, r.value) for r in got]
    assert [(r.seq, r.record.id, r.record.name) for r in got] == [
        (1, 10, "ash"), (2, 20, "birch"), (3, 30, "cedar"), (4, 40, "elm"), (5, 50, "fir"), (6, 60, "oak"),
    ]


def test_bad_records_are_set_aside_with_their_place(spark, tmp_path):
    texts = ["17,", "north", "8east", "west,9", ",south"]
    (tmp_path / "bad.csv").write_text("\n".join(texts) + "\n")
    path = str(tmp_path / "bad.csv")
    parsed = parse_lines(read_lines(spark, [path]), parse_fields(",", PAIR))
    rows = bad_records(parsed).orderBy("line_no").collect()
    assert [r.message for r in rows] == [
        f"(file:{path}:{i}) Invalid record string, {t}. line = {t}" for i, t in enumerate(texts)
    ]
    with pytest.raises(AllRecordsAreBad, match="bad.csv"):
        require_good(parsed, [path])
    ok = parse_lines(read_lines(spark, [path]).withColumn("value", F.regexp_replace("value", "north", "2,north")), parse_fields(",", PAIR))
    assert require_good(ok, [path]) == (1, 4)
    seen = Observation("quality")
    assert len(watch_quality(ok, seen).collect()) == 5 and seen.get == {"good": 1, "bad": 4}


def test_wine_lines(spark):
    tokens = WINE_LINE.split(";")
    lines = [WINE_LINE + ";5", ";".join(tokens[:10])]
    lines += [";".join(["" if j == i else t for j, t in enumerate(tokens)] + ["5"]) for i in range(11)]
    lines += [WINE_LINE + ";", "", ";;;", WINE_LINE + ";x", WINE_LINE.replace("7.4", " 7.4\t"), WINE_LINE.replace("7.4", "nan"),
              WINE_LINE.replace("7.4", "NaN"), WINE_LINE.replace("7.4", "inf"), WINE_LINE.replace("7.4", "1d")]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(lines)], "i int, value string")
    rows = parse_lines(df, parse_wine).orderBy("i").collect()
    assert [r.i for r in rows if r.error is None] == [0, 13, 17, 19, 21]
    assert rows[1].error == "Record does not have 11 fields, " + lines[1]
    assert rows[2].error == f"Failed to parse string {lines[2]}. cause: java.lang.NumberFormatException: empty String"
    assert rows[16].error.endswith('For input string: "x"')
    assert rows[14].error == "Record does not have 11 fields, " and rows[15].error == "Record does not have 11 fields, "
    first = rows[0].record
    assert first.lot_id == "wine quality sample data"
    assert [first[name] for name in WINE_FEATURES] == [float(t) for t in tokens]
    assert rows[17].record.fixed_acidity == 7.4
    assert conform(good_records(parse_lines(df, parse_wine)), WINE_RECORD).count() == 5
    assert quality_counts(parse_lines(df, parse_wine)).first().asDict() == {"good": 5, "bad": 17}


def test_airline_lines(spark):
    good = ",".join(AIRLINE_TOKENS)
    lines = [good, good + ",extra", ",".join(good.split(",")[:28]), good.replace(",512,NA,", ",512,N123,"),
             good.replace("845", "17.5"), good.replace("845", " 845 "), good.replace("XY", "NA"), good.replace("845", "99999999999")]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(lines)], "i int, value string")
    rows = parse_lines(df, parse_airline).orderBy("i").collect()
    assert [r.i for r in rows if r.error is None] == [0, 1, 5, 6]
    assert rows[2].error == "ERROR: record does not have 29 fields."
    assert rows[3].error == f'ERROR: Failed to parse string {lines[3]}. cause: java.lang.NumberFormatException: For input string: "N123"'
    assert rows[4].error.endswith('For input string: "17.5"') and rows[7].error.endswith('"99999999999"')
    assert (rows[0].record.year, rows[0].record.tailNum, rows[0].record.origin, rows[0].record.lateAircraftDelay) == (2003, 0, "ABC", 0)
    assert rows[6].record.uniqueCarrier == "0"
    assert conform(good_records(parse_lines(df, parse_airline)), AIRLINE_RECORD).count() == 4
    loose = parse_airline(df, text_codes=True).orderBy("i").collect()
    assert loose[3].error is None and loose[3].record.tailNum == 123


def count_words(text: pd.Series) -> pd.DataFrame:
    n = text.str.split().str.len()
    return pd.DataFrame({"record": [{"n": x} for x in n], "error": [None if x > 1 else "too few words" for x in n]})


def test_parsers_can_be_users_own(spark):
    df = spark.createDataFrame([("a b c",), ("a",)], "value string")
    rows = parse_lines(df, column_parser(F.pandas_udf(count_words, "record struct<n: bigint>, error string"))).collect()
    assert (rows[0].record.n, rows[0].error, rows[1].error) == (3, None, "too few words")
    kind = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.DoubleType())])
    wide = spark.createDataFrame([("12|0.5",), ("|1",), ("7|inf",)], "value string")
    assert [r.error for r in parse_lines(wide, parse_fields("|", kind)).collect()] == [None, "|1", "7|inf"]


def test_conform_refuses_other_shapes(spark):
    df = spark.sql("SELECT 1 AS id, 'x' AS name, 3 AS more")
    assert conform(df, PAIR).columns == ["id", "name"]
    with pytest.raises(SchemaMismatch, match="name is missing"):
        conform(df.drop("name"), PAIR)
    with pytest.raises(SchemaMismatch, match="id is string"):
        conform(df.withColumn("id", F.lit("a")), PAIR)


def test_bytes_and_catalogue(spark, tmp_path):
    (tmp_path / "m1.pmml").write_bytes(b"<PMML/>")
    (tmp_path / "m2.pmml").write_bytes(b"<PMML> </PMML>")
    (tmp_path / "gbm.json").write_bytes(b"{}")
    p = lambda n: str(tmp_path / n)
    rows = {r.path: r for r in read_bytes(spark, [p("m1.pmml"), p("m2.pmml"), p("none")], max_bytes=10).collect()}
    assert bytes(rows["file:" + p("m1.pmml")].bytes) == b"<PMML/>" and rows["file:" + p("m1.pmml")].error is None
    assert rows["file:" + p("m2.pmml")].bytes is None and "has 10 bytes or more" in rows["file:" + p("m2.pmml")].error
    assert "none" in rows["file:" + p("none")].error
    cat = model_catalogue(
        spark,
        {"PMML": [p("m1.pmml"), p("m2.pmml")], "H2O": p("gbm.json"), "TENSORFLOW": [p("none")],
         "TENSORFLOWSERVING": ["http://host:8501/v1/models/r:predict"]},
    )
    got = {r.modelName: r for r in cat.collect()}
    assert set(got) == {p("m1"), p("m2"), "Airline flight Model 0 (model #1)", "Tensorflow Model - " + p("none"), "Recommender Model"}
    assert bytes(got[p("m2")].modelBytes) == b"<PMML> </PMML>" and got[p("m2")].modelSourceLocation is None
    assert got["Recommender Model"].modelBytes is None and got["Recommender Model"].modelSourceLocation.startswith("http")
    assert got["Tensorflow Model - " + p("none")].error
    assert got["Airline flight Model 0 (model #1)"].modelSourceLocation == p("gbm.json")

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators.timeseries import (
    auto_width, bucket_aggregate, count_by_tag, fill_gaps, mean_by_tag, mean_of_fields, recent,
)
from tidemark.sinks.points import (
    PointSpec, console_lines, failed_points, line_protocol, points, read_points, write_points, write_text,
)

S = 1_000_000


@pytest.fixture(scope="module")
def measured(spark):
    rng = random.Random(4)
    rows = []
    for _ in range(120):
        second = rng.choice([s for s in range(-30, 90) if s % 7])
        rows.append((rng.choice(["a", "b", None]), second * S + rng.randrange(S), rng.choice([None, rng.random()])))
    df = spark.createDataFrame(rows, "tag string, us bigint, v double").withColumn("ts", F.timestamp_micros("us"))
    return rows, df


def buckets_of(rows, width):
    out = {}
    for tag, us, v in rows:
        out.setdefault((tag, us - us % width), []).append(v)
    return out


def test_counts_and_means_with_linear_gaps(measured):
    rows, df = measured
    width = 3 * S
    groups = buckets_of(rows, width)
    starts = sorted({b for _, b in groups})
    spine = range(starts[0], starts[-1] + 1, width)
    counts = {(r.tag, r.bucket): r["count"] for r in count_by_tag(df, "ts", width, "v", ["tag"]).collect()}
    means = {(r.tag, r.bucket): r["mean"] for r in mean_by_tag(df, "ts", width, "v", ["tag"]).collect()}
    assert len(counts) == len(means) == 3 * len(spine)
    for tag in ("a", "b", None):
        known_n = {b: sum(v is not None for v in vs) for (t, b), vs in groups.items() if t == tag}
        known_m = {}
        for (t, b), vs in groups.items():
            values = [v for v in vs if v is not None]
            if t == tag and values:
                known_m[b] = sum(values) / len(values)
        for known, got, cut in ((known_n, counts, True), (known_m, means, False)):
            for b in spine:
                left = [k for k in known if k <= b]
                right = [k for k in known if k >= b]
                if b in known:
                    want = known[b]
                elif left and right:
                    a, c = max(left), min(right)
                    want = known[a] + (known[c] - known[a]) / (c - a) * (b - a)
                    want = int(want) if cut else want
                else:
                    want = None
                assert got[tag, b] == (want if want is None or cut else pytest.approx(want)), (tag, b)


def test_previous_fill_and_span(spark):
    df = spark.sql("SELECT timestamp_micros(us * 1000000) AS ts, x, y FROM VALUES (10, 1.0D, NULL), (13, NULL, 4.0D), (14, 3.0D, NULL) AS t(us, x, y)")
    got = mean_of_fields(df, "ts", S, {"ax": "x", "ay": "y"}, span=(9 * S, 16 * S)).orderBy("bucket").collect()
    assert [(r.bucket // S, r.ax, r.ay) for r in got] == [
        (9, None, None), (10, 1.0, None), (11, 1.0, None), (12, 1.0, None), (13, 1.0, 4.0), (14, 3.0, 4.0), (15, 3.0, 4.0), (16, 3.0, 4.0)]


def test_long_gaps(spark):
    """Thirty days in one-second buckets: 2.6 million of them between two rows."""
    last = 30 * 86_400 * S
    buckets = spark.createDataFrame([(0, 0), (last, 30 * 86_400)], "bucket long, n long")
    filled = fill_gaps(buckets, S, {"n": "linear"})
    assert filled.count() == last // S + 1 and filled.where(f"n != bucket div {S}").count() == 0
    assert fill_gaps(buckets.where("false"), S, {"n": "linear"}).count() == 0
    with pytest.raises(ValueError, match="unknown fill"):
        fill_gaps(buckets, S, {"n": "cubic"})


@pytest.mark.parametrize("fill", ["linear", "previous", "none"])
def test_long_series_fill_like_short_ones(spark, fill):
    """Series cut into slices give what a plain window gives."""
    rows = [(tag, b * S, None if b % 4 == 0 else float(b * b)) for tag in ("a", "b") for b in range(0, 60) if b % 7 not in (2, 3)]
    buckets = spark.createDataFrame(rows, "tag string, bucket long, x double")
    plain = fill_gaps(buckets, S, {"x": fill}, ["tag"], (-3 * S, 70 * S))
    cut = fill_gaps(buckets, S, {"x": fill}, ["tag"], (-3 * S, 70 * S), target_rows=5)
    assert sorted(map(str, plain.collect())) == sorted(map(str, cut.collect())) and plain.count() == 2 * 74


def test_span_between_bucket_edges(spark):
    """A span that begins inside a bucket keeps that bucket's value."""
    buckets = spark.createDataFrame([(0, 1.0), (60 * S, 2.0), (120 * S, 3.0)], "bucket long, x double")
    got = fill_gaps(buckets, 60 * S, {"x": "previous"}, (), (61 * S, 199 * S)).orderBy("bucket").collect()
    assert [(r.bucket // S, r.x) for r in got] == [(60, 2.0), (120, 3.0), (180, 3.0)]


def test_recent_is_a_constant_bound(spark, tmp_path):
    start = datetime(2024, 1, 1)
    df = spark.createDataFrame([(i, start + timedelta(minutes=i)) for i in range(60)], "i int, ts timestamp_ntz")
    df.write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    got = recent(table, "ts", timedelta(minutes=5))
    assert sorted(r.i for r in got.collect()) == [54, 55, 56, 57, 58, 59]
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts," in got._jdf.queryExecution().executedPlan().toString()


def test_width_ladder(spark):
    df = spark.sql("SELECT * FROM VALUES (300L), (3600L), (86400L), (2592000L), (34560000L), (3456000000L) AS t(s)")
    got = df.select("s", auto_width(F.lit(0), F.col("s") * S, 100).alias("w")).orderBy("s").collect()
    assert [r.w for r in got] == [2_000, 30_000, 900_000, 21_600_000, 86_400_000, 31_536_000_000]


SPEC = PointSpec("my point", {"n": "n", "v": "v", "label": "name"}, {"model": "tag", "kind": "kind"})


@pytest.fixture(scope="module")
def records(spark):
    return spark.sql(
        "SELECT * FROM VALUES (1, 1.5D, 'say \"hi\"', 'a b,c=d', 'k', TIMESTAMP'1970-01-01 00:00:01.234'), "
        "(NULL, double('NaN'), NULL, '', 'k', TIMESTAMP'1970-01-01'), (2, 2.0D, 'x', 'm', NULL, NULL), "
        "(3, NULL, 'back\\\\slash', NULL, NULL, TIMESTAMP'1970-01-01') AS t(n, v, name, tag, kind, ts)"
    )


def test_line_protocol(records):
    got = [r.line for r in line_protocol(records, SPEC, "ts").collect()]
    assert got == [
        'my\\ point,kind=k,model=a\\ b\\,c\\=d n=1i,v=1.5,label="say \\"hi\\"" 1234', None, None,
        'my\\ point n=3i,label="back\\\\slash" 0',
    ]


def test_points_and_their_store(spark, records, tmp_path):
    first = points(records, SPEC, "ts").first()
    assert first.measurement == "my point" and first.time == 1234
    assert first.tags == {"model": "a b,c=d", "kind": "k"} and first.fields == {"n": 1.0, "v": 1.5}
    assert first.texts == {"label": 'say "hi"'}
    folder = str(tmp_path / "points")
    empty = PointSpec("p", {"n": "CAST(NULLIF(n, 3) AS DOUBLE)"})
    for _ in range(2):  # writing a batch again replaces it
        assert write_points(records, empty, "ts", folder, "7")
    assert write_points(records, empty, "ts", folder, "8")
    assert read_points(spark, folder).count() == 2
    assert {r.error for r in failed_points(spark, folder).collect()} == {"point without a time", "point without fields"}
    assert failed_points(spark, folder).count() == 6
    seen = []
    assert write_points(records, empty, "ts", "nosuch://place", "1", seen.append) is None and len(seen) == 1


def test_text_output(spark, tmp_path):
    df = spark.sql("SELECT 1 AS a, 'x' AS b")
    assert console_lines(df, "Wine Quality: ").first().value == 'Wine Quality: {"a":1,"b":"x"}'
    write_text(df, "P ", str(tmp_path / "out"))
    assert [r.value for r in spark.read.text(str(tmp_path / "out")).collect()] == ['P {"a":1,"b":"x"}']


def test_line_breaks_and_names_in_points(spark):
    df = spark.createDataFrame([("a\nb", "x\r\ny", 1.5)], "t string, s string, v double").withColumn("ts", F.timestamp_millis(F.lit(5)))
    spec = PointSpec("m\n1", {"a field": "v", "te,xt": "s"}, {"the=tag": "t"})
    (row,) = line_protocol(df, spec, "ts").collect()
    assert row.line == 'm\\n1,the\\=tag=a\\nb a\\ field=1.5,te\\,xt="x\\ny" 5'

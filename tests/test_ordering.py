import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators.asof import assign_models, version_intervals
from tidemark.operators.ordering import following, first_n, numbered, running, slice_by_order


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(7)
    rows = []
    for i in range(900):
        # a third of the rows in one key and one moment, some without a time
        key = "hot" if i % 3 == 0 else rng.choice(["hot", "a", "b", None])
        at = 5_000_000 if i % 3 == 0 else rng.choice([None, rng.randrange(0, 10_000_000_000)])
        rows.append((i, key, at, rng.choice([None, float(rng.randrange(100))])))
    return rows, spark.createDataFrame(rows, "id bigint, key string, at bigint, v double").repartition(5)


def _ordered(rows):
    return sorted(rows, key=lambda r: (r[2] is not None, r[2] or 0, r[0]))


@pytest.mark.parametrize("target", [20, 100, 10_000])
def test_running_totals_match_a_plain_loop(skewed, target):
    rows, df = skewed
    got = {
        r.id: r
        for r in running(
            df,
            ["key"],
            ["at", "id"],
            {"n": ("count", "id"), "s": ("sum", "v"), "lo": ("min", "v"), "hi": ("max", "v"), "l": ("last", "v")},
            target_rows=target,
        ).collect()
    }
    assert len(got) == len(rows)
    state = {}
    for i, key, at, v in _ordered(rows):
        n, values = state.get(key, (0, []))
        n, values = n + 1, values + ([v] if v is not None else [])
        state[key] = (n, values)
        r = got[i]
        assert r.n == n
        assert (r.s, r.lo, r.hi, r.l) == (
            (sum(values), min(values), max(values), values[-1]) if values else (None, None, None, None)
        )


@pytest.mark.parametrize("target", [20, 10_000])
def test_following_and_numbers(skewed, target):
    rows, df = skewed
    got = {r.id: r.nxt for r in following(df, ["key"], ["at", "id"], "id", "nxt", target_rows=target).collect()}
    per_key = {}
    for row in _ordered(rows):
        per_key.setdefault(row[1], []).append(row[0])
    for ids in per_key.values():
        assert [got[i] for i in ids] == ids[1:] + [None]
    seq = {r.id: r.seq for r in numbered(df, ["at", "id"], target_rows=target).collect()}
    assert [seq[r[0]] for r in _ordered(rows)] == list(range(1, len(rows) + 1))


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp", "date"])
def test_numbers_in_order_of_a_time(spark, kind):
    """Over the size of one slice and in a zone that skips an hour; many rows of one second differ in microseconds only."""
    rng = random.Random(3)
    times = [None] * 20 + [datetime(2024, 3, 10, 2, 30, 7, m) for m in range(300)]
    times += [datetime(1969, 12, 31, 23, 59, 58) + timedelta(hours=rng.randrange(0, 480_000), microseconds=rng.randrange(10)) for _ in range(300)]
    times += [datetime(2024, 3, 10, 0, 0) + timedelta(minutes=m) for m in range(0, 360, 2)]
    # The later the time, the smaller the number that decides between equal ones.
    rows = [(len(times) - i, t if t is None else t.isoformat(" ")) for i, t in enumerate(times)]
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame(rows, "id bigint, said string").select("id", F.col("said").cast(kind).alias("at")).repartition(5)
        want = [r.id for r in df.select("id", "at").orderBy(F.col("at").asc_nulls_first(), "id").collect()]
        got = [r.id for r in numbered(df, ["at", "id"], target_rows=90).orderBy("seq").collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert got == want


def test_slices_stay_small(skewed):
    _, df = skewed
    sliced = slice_by_order(df, ["key"], ["at", "id"], target_rows=40)
    assert sliced.cut
    sizes = [r["count"] for r in sliced.df.groupBy(*sliced.group).count().collect()]
    assert max(sizes) <= 40 and sum(sizes) == 900
    assert not slice_by_order(df, ["key"], ["at", "id"], target_rows=10_000).cut


def test_first_n_is_a_bounded_top(skewed):
    rows, df = skewed
    assert [r.id for r in first_n(df, 7, [F.asc_nulls_last("at"), "id"]).collect()] == [
        r[0] for r in sorted(rows, key=lambda r: (r[2] is None, r[2] or 0, r[0]))[:7]
    ]


def _as_of(rows, versions, keyed):
    out = {}
    for i, key, at, _ in rows:
        best = None
        for vkey, start, seq, name in versions:
            if at is None or start > at or (keyed and vkey != key):
                continue
            if best is None or (start, seq) > best[:2]:
                best = (start, seq, name)
        out[i] = best[2] if best else None
    return out


@pytest.mark.parametrize("form,target", [("broadcast", 10), ("window", 25), ("window", 10_000)])
@pytest.mark.parametrize("keyed", [True, False])
def test_as_of_forms_agree_with_brute_force(spark, skewed, form, target, keyed):
    rows, df = skewed
    rng = random.Random(3)
    versions = [(rng.choice(["hot", "a"]), rng.randrange(0, 9_000_000_000), s, f"m{s}") for s in range(60)]
    versions += [("hot", 5_000_000, 100, "tie-low"), ("hot", 5_000_000, 101, "tie-high")]
    vdf = spark.createDataFrame(versions, "key string, start bigint, seq int, name string").withColumn(
        "valid_from", F.timestamp_micros("start")
    )
    records = df.withColumn("ts", F.timestamp_micros("at"))
    joined = assign_models(
        records, vdf, on="ts", by=["key"] if keyed else [], seq="seq", form=form, target_rows=target
    )
    assert joined.columns == records.columns + ["model"]
    got = {r.id: r.model.name if r.model else None for r in joined.collect()}
    assert got == _as_of(rows, versions, keyed)


def test_intervals_end_at_the_next_version(spark):
    vdf = spark.sql(
        "SELECT * FROM VALUES ('a', TIMESTAMP'2024-01-01', 1), ('a', TIMESTAMP'2024-01-05', 2), "
        "('b', TIMESTAMP'2024-01-03', 3) AS t(server, valid_from, seq)"
    )
    got = {r.seq: r.valid_to for r in version_intervals(vdf, by=["server"], seq="seq", target_rows=1).collect()}
    assert str(got[1]) == "2024-01-05 00:00:00" and got[2] is None and got[3] is None

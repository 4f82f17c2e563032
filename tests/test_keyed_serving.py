"""Serving from keyed state and the store of versions, against the batch join."""

import random
from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.operators.asof import assign_models
from tidemark.streaming import keyed, serving
from tidemark.streaming.keyed import serve_keyed

START = datetime(2024, 1, 1)
RECORDS = "id long, server string, at timestamp, amount double, note string"
VERSIONS = "server string, valid_from timestamp, seq long, name string, share double"


def made(rng, n, servers, first, last):
    """Random records and versions of some minutes; several share a time, and a version may share it with a record."""
    at = lambda: START + timedelta(minutes=rng.randrange(first, last), microseconds=rng.choice([0, 0, 1, 999_999]))
    records = [(rng.randrange(2**62), rng.choice(servers), at(), rng.choice([0.1, -1e300, None]), rng.choice(["é\n\"", None])) for _ in range(n)]
    versions = [(rng.choice(servers), at(), i, f"v{first}-{i}", rng.random()) for i in range(n // 4)]
    return records, versions


def served(spark, folder, parts, **options):
    """Run the stream once per part, each with records, versions and whether the input ends; restart in between."""
    for records, versions, ends in parts:
        spark.createDataFrame(records, RECORDS).write.mode("append").parquet(f"{folder}/records")
        spark.createDataFrame(versions, VERSIONS).write.mode("append").parquet(f"{folder}/versions")
        spark.createDataFrame([(datetime(2200, 1, 1),)] if ends else [], "at timestamp").write.mode("append").parquet(f"{folder}/ticks")
        streams = [serving.file_stream(spark, f"{folder}/{n}", s) for n, s in (("records", RECORDS), ("versions", VERSIONS), ("ticks", "at timestamp"))]
        out = serve_keyed(streams[0], streams[1], on="at", by=["server"], seq="seq", ticks=streams[2], **options)
        serving.append_to(out, f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{folder}/out")


def plain(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("slots", [1, 3])
def test_keyed_state_gives_the_batch_join(spark, tmp_path, slots):
    rng = random.Random(slots)
    servers = ["a", "a", "a", "b", "c", None]
    first, second = made(rng, 120, servers, 0, 600), made(rng, 120, servers, 600, 1200)
    # Versions of the last two hours of the first part come only with the second; they are within the delay.
    late = [v for v in first[1] if v[1] >= START + timedelta(minutes=480)]
    assert late
    on_time = [v for v in first[1] if v not in late]
    got = served(spark, str(tmp_path), [(first[0], on_time, False), (second[0], late + second[1], True)], delay="3 hours", slots=slots)
    want = assign_models(
        spark.createDataFrame(first[0] + second[0], RECORDS), spark.createDataFrame(first[1] + second[1], VERSIONS), on="at", by=["server"], seq="seq"
    )
    assert plain(got.select(*want.columns)) == plain(want)
    assert got.schema["model"].dataType == want.schema["model"].dataType


def test_records_wait_for_the_watermark_and_state_holds_no_history(spark, tmp_path):
    # Records ten hours before the end of what was seen are out, later ones wait for the next run.
    records = [(i, "a", START + timedelta(hours=i), 1.0, None) for i in range(24)]
    versions = [("a", START + timedelta(hours=i), i, f"v{i}", 0.5) for i in range(1, 24, 2)]
    early = served(spark, str(tmp_path), [(records, versions, False)], delay="10 hours")
    assert {r.id: r.model and r.model.name for r in early.collect()} == {i: None if i == 0 else f"v{i if i % 2 else i - 1}" for i in range(14)}
    everything = served(spark, str(tmp_path), [([], [], True)], delay="10 hours")
    assert everything.count() == 24 and everything.where("id = 23").first().model.name == "v23"
    # After the last version has passed only it is kept.
    state = spark.read.format("statestore").option("stateVarName", "current").load(f"{tmp_path}/checkpoint")
    assert [r.value.body for r in state.collect()][0].count("v23") == 1
    ahead = spark.read.format("statestore").option("stateVarName", "ahead").load(f"{tmp_path}/checkpoint")
    assert ahead.count() == 0


def test_no_versions_and_rows_without_a_time(spark, tmp_path):
    records = [(1, "a", START, 1.0, None), (2, "a", None, 1.0, None)]
    got = served(spark, str(tmp_path), [(records, [("a", None, 1, "x", 0.1)], True)])
    assert [(r.id, r.model) for r in got.collect()] == [(1, None)]


def test_state_has_no_key_per_server(spark, tmp_path):
    """Three hundred servers in two runs, with a few groups: as the batch join, and no more keys of state than groups."""
    rng = random.Random(5)
    servers = [f"s{i}" for i in range(300)]
    first, second = made(rng, 600, servers, 0, 600), made(rng, 600, servers, 600, 1200)
    got = served(spark, str(tmp_path), [(*first, False), (*second, True)], delay="1 hour", slots=2, groups=5)
    want = assign_models(
        spark.createDataFrame(first[0] + second[0], RECORDS), spark.createDataFrame(first[1] + second[1], VERSIONS), on="at", by=["server"], seq="seq"
    )
    assert plain(got.select(*want.columns)) == plain(want)
    assert spark.read.format("statestore").option("stateVarName", "current").load(f"{tmp_path}/checkpoint").count() <= 5


class _List(list):
    """A list state."""

    exists, get, clear = lambda self: bool(self), lambda self: iter(list(self)), list.clear

    def put(self, entries):
        self[:] = entries


def test_chunks_give_every_row_once(monkeypatch):
    monkeypatch.setattr(keyed, "_CHUNK_ROWS", 3)
    monkeypatch.setattr(keyed, "_CHUNKS", 4)
    rng, state, wanted, taken = random.Random(2), _List(), [], []
    for until in range(0, 1000, 20):
        rows = [(f"s{rng.randrange(5)}", until + 1 + rng.randrange(300), f"b{rng.random()}") for _ in range(rng.randrange(0, 9))]
        wanted += rows
        state.extend(keyed._chunks(pd.DataFrame(rows, columns=["server", "at", "body"])))
        passed, following = keyed._Group()._take(state, keyed._RECORD, until)
        taken += list(passed.itertuples(index=False, name=None))
        assert sorted(taken) == sorted(r for r in wanted if r[1] <= until)
        assert following == min((r[1] for r in wanted if r[1] > until), default=None)
        left = [r for c in state for r in keyed._rows([c], ["server", "at", "body"]).itertuples(index=False)]
        assert len(left) == len(wanted) - len(taken) and len(state) <= 4 + len(left) // 3 + 1


def test_last_version_before_each_record():
    rng = random.Random(4)
    for n in (0, 1, 40):
        versions = sorted((rng.randrange(30), i, rng.choice("abc")) for i in range(n))
        records = [(rng.choice("abcd"), rng.randrange(30)) for _ in range(60)]
        got = keyed._last_before(
            pd.DataFrame({"server": pd.Series([v[2] for v in versions], dtype=object), "at": pd.Series([v[0] for v in versions], dtype="int64")}),
            pd.DataFrame(records, columns=["server", "at"]),
        )
        assert list(got) == [max((i for i, v in enumerate(versions) if v[2] == s and v[0] <= at), default=-1) for s, at in records]

"""The store of runs against plain reads of all rows, and what each batch has to open."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.functions.descriptors import WINE_TYPES
from tidemark.operators.asof import assign_models
from tidemark.streaming import serving
from tidemark.streaming.runs import RunStore, collect_runs, keep_latest_runs, serve_from_runs

START = datetime(2024, 1, 1)
KIND = "server string, valid_from timestamp, seq long, name string"
HOUR = 3_600_000_000


def hours(n):
    return START + timedelta(hours=n)


def store_of(spark, folder, batches, **options):
    store = RunStore(spark, str(folder), KIND, ["server"], "valid_from", "seq", **options)
    for i, rows in enumerate(batches):
        assert store.add(spark.createDataFrame(rows, KIND), i)
    return store


@pytest.mark.parametrize("history, batches", [(True, 50), (False, 20)])
def test_what_is_opened_stays_bounded_over_many_batches(spark, tmp_path, history, batches):
    store, opened, names = RunStore(spark, str(tmp_path), KIND, ["server"], "valid_from", "seq", fan_in=3, history=history), [], {}
    for i in range(batches):
        rows = [(s, hours(i), i, f"{s}{i}") for s in ("a", "b") if s == "a" or i % 7 == 0]
        names |= {s: n for s, _, _, n in rows}
        store.add(spark.createDataFrame(rows, KIND).coalesce(1), i)
        now = (int(START.timestamp()) + i * 3600) * 1_000_000
        parts = store.parts(now, now)
        opened.append(len(parts))
        if i % 10 == 9:
            last = store._last(store.rows(now, now))
            assert {r.server: r.name for r in last.collect()} == names == {r.server: r.name for r in store.latest().collect()}
    # Two levels of fewer than three runs each, and the base.
    assert max(opened) <= 2 * 2 + 1
    assert sum(opened[-9:]) <= sum(opened[9:18])
    files = store.rows(now, now).inputFiles()
    assert len(files) <= 2 * max(opened)


def test_rows_of_any_range_give_the_batch_join(spark, tmp_path):
    rng = random.Random(3)
    batches = [
        # Mostly in time order, now and then far behind; several of one time; an empty batch and null times.
        [(rng.choice(["a", "b", None]), None if rng.random() < 0.05 else hours(rng.choice([i, i, i + 1, max(0, i - 15)])), rng.randrange(5), f"v{i}-{k}") for k in range(rng.randint(0, 3))]
        for i in range(30)
    ]
    store = store_of(spark, tmp_path, batches, fan_in=2)
    everything = spark.createDataFrame([r for b in batches for r in b], KIND)
    for low, high in ((0, 40), (5, 9), (28, 31), (20, 20)):
        records = spark.createDataFrame([(s, hours(h), h) for h in range(low, high + 1) for s in ("a", "b", "c")], "server string, at timestamp, n long")
        edge = int(START.timestamp()) * 1_000_000
        got, want = (
            assign_models(records, v, on="at", by=["server"], seq="seq") for v in (store.rows(edge + low * HOUR, edge + high * HOUR), everything)
        )
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_a_batch_counts_once_and_old_files_go(spark, tmp_path):
    store = store_of(spark, tmp_path, [[("a", hours(i), i, f"v{i}")] for i in range(9)], fan_in=2)
    assert not store.add(spark.createDataFrame([("a", hours(99), 9, "again")], KIND), 8)
    assert store.latest().first().name == "v8"
    held = {p.name for p in (tmp_path / "runs").iterdir()} | {p.name for p in (tmp_path / "base").iterdir()}
    manifest = store.manifest()
    named = [r["name"] for r in manifest["runs"]] + manifest["old"] + [manifest["base"]]
    assert held == {n.split("/")[1] for n in named}
    # Another session finds the same.
    other = RunStore(spark, str(tmp_path), KIND, ["server"], "valid_from", "seq", fan_in=2)
    assert other.latest().first().name == "v8" and other.add(spark.createDataFrame([("a", hours(9), 9, "v9")], KIND), 9)


def test_an_empty_store(spark, tmp_path):
    store = RunStore(spark, str(tmp_path / "none"), KIND, ["server"], "valid_from", "seq")
    assert store.latest().count() == 0 and store.parts() == [] and store.rows(0, 1).count() == 0
    with pytest.raises(ValueError):
        RunStore(spark, str(tmp_path), KIND, ["server"], "valid_from", fan_in=1)


def test_streams_over_a_store(spark, tmp_path):
    full = "modelName string, description string, modelType string, modelBytes binary, modelSourceLocation string, server string, valid_from timestamp, seq long"
    updates = [(f"m{i}", "", "PMML", b"x" if i % 4 else None, None, "ab"[i % 2], hours(i), i) for i in range(20)]
    records = [(i, "ab"[i % 2], hours(i / 2)) for i in range(44)]
    for i in range(0, 20, 5):
        spark.createDataFrame(updates[i:i + 5], full).coalesce(1).write.mode("append").parquet(f"{tmp_path}/updates")
    spark.createDataFrame(records, "id long, server string, at timestamp").write.parquet(f"{tmp_path}/records")
    kind = "server string, valid_from timestamp, seq long, modelName string"
    store = RunStore(spark, f"{tmp_path}/store", kind, ["server"], "valid_from", "seq", fan_in=2)
    collect_runs(serving.file_stream(spark, f"{tmp_path}/updates", full, 1), WINE_TYPES, store, f"{tmp_path}/c1").awaitTermination()
    assert store.manifest()["batch"] == 3
    assert spark.read.parquet(f"{tmp_path}/store/refused").count() == 5
    serve_from_runs(
        serving.file_stream(spark, f"{tmp_path}/records", "id long, server string, at timestamp"), store, lambda df: df.select("id", "model.modelName"),
        f"{tmp_path}/out", f"{tmp_path}/c2", on="at",
    ).awaitTermination()
    usable = [u for u in updates if u[3]]
    want = {r[0]: max(((u[6], u[0]) for u in usable if u[5] == r[1] and u[6] <= r[2]), default=(0, None))[1] for r in records}
    assert {r.id: r.modelName for r in serving.served(spark, f"{tmp_path}/out").collect()} == want


def test_latest_state_of_an_updating_stream(spark, tmp_path):
    for i in range(5):
        spark.createDataFrame([(k, 1) for k in range(i, 7)], "k long, n long").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    counts = serving.file_stream(spark, f"{tmp_path}/in", "k long, n long", 1).groupBy("k").agg(F.sum("n").alias("n"))
    store = RunStore(spark, f"{tmp_path}/store", "k long, n long, batch long", ["k"], "batch", fan_in=2, history=False)
    keep_latest_runs(counts, store, f"{tmp_path}/c").awaitTermination()
    assert {r.k: r.n for r in store.latest().collect()} == {k: min(k + 1, 5) for k in range(7)}
    assert len(store.parts()) <= 3

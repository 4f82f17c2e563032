"""Playback by record with stops and faults, and delivery in two phases with lost tasks."""

import os

import pytest
from pyspark.sql import functions as F

from tidemark.sinks.delivery import deliver, deliver_stream, delivered_batches, outcomes
from tidemark.streaming import serving
from tidemark.streaming.paced import lay_out, play


def numbered(spark, n):
    return spark.range(1, n + 1).select(F.col("id").alias("seq"), (F.col("id") * 7).alias("v"))


def played(spark, folder):
    rows = spark.read.option("basePath", folder).parquet(f"{folder}/batch_id=*").collect()
    out = {}
    for r in rows:
        out.setdefault(r.batch_id, []).append(r.seq)
        assert r.v == 7 * r.seq
    return {b: sorted(s) for b, s in out.items()}


def test_playback_survives_faults_and_new_paces(spark, tmp_path):
    """Fails after having written a batch, starts again, ends; then other records cannot come twice."""
    work = str(tmp_path)
    lay_out(numbered(spark, 57).repartition(3), f"{work}/in", block=10)
    fails = [True]

    def write(rows, batch_id):
        rows.write.mode("overwrite").parquet(f"{work}/out/batch_id={batch_id}")
        if batch_id == 2 and fails:
            fails.pop()
            raise OSError("lost")

    with pytest.raises(Exception, match="lost"):
        play(spark, f"{work}/in", 8, write, f"{work}/checkpoint", block=10).await_end(60)
    assert play(spark, f"{work}/in", 15, write, f"{work}/checkpoint", block=10).await_end(60)
    got = played(spark, f"{work}/out")
    assert [len(got[b]) for b in range(4)] == [8, 8, 8, 15]
    assert [s for b in sorted(got) for s in got[b]] == list(range(1, 58))
    # Started again at the end, nothing more is written.
    assert play(spark, f"{work}/in", 15, write, f"{work}/checkpoint", block=10).await_end(60)
    assert played(spark, f"{work}/out") == got


def test_playback_opens_the_blocks_of_its_numbers(spark, tmp_path):
    work, opened = str(tmp_path), []
    lay_out(numbered(spark, 100), f"{work}/in", block=20)
    assert play(spark, f"{work}/in", 20, lambda rows, _: opened.append({r.f for r in rows.select(F.input_file_name().alias("f")).collect()}),
                f"{work}/checkpoint", block=20).await_end(60)
    assert len(opened) == 5 and all(len(files) == 1 for files in opened)


def test_playback_odd_input(spark, tmp_path):
    work, calls = str(tmp_path), []
    lay_out(numbered(spark, 0), f"{work}/none")
    assert play(spark, f"{work}/none", 5, lambda rows, b: calls.append(b), f"{work}/checkpoint").await_end(60)
    assert not calls
    with pytest.raises(ValueError):
        play(spark, f"{work}/none", 0, lambda rows, b: None, f"{work}/other")
    with pytest.raises(Exception, match="without a number"):
        lay_out(spark.createDataFrame([(None,)], "seq bigint"), f"{work}/bad")


def store(folder, fault=None, refuse=lambda line: None):
    """A store that knows tokens: what comes under one a second time is not taken again."""

    def send(lines, token):
        place = f"{folder}/{token}"
        if not os.path.exists(place):
            with open(place + ".draft", "w") as f:
                f.write("".join(f"{line}\n" for line in lines if refuse(line) is None))
            os.rename(place + ".draft", place)
        if fault:
            fault(token)
        return [refuse(line) for line in lines]

    return send


def taken(folder):
    return sorted(line for name in os.listdir(folder) for line in open(f"{folder}/{name}").read().split())


def test_lost_task_leaves_no_duplicate_and_no_half_batch(spark, tmp_path):
    """A worker dies after the store took its chunk; until the batch is whole nobody sees it."""
    work = str(tmp_path)
    os.mkdir(f"{work}/store")
    for i in range(2):
        spark.range(100 * i, 100 * (i + 1), 1, 3).select(F.col("id").cast("string").alias("line")).write.mode("append").parquet(f"{work}/in")
    schema = spark.read.parquet(f"{work}/in").schema
    trap = f"{work}/trap"

    def fault(token):
        if token.startswith("1-") and not os.path.exists(trap):
            open(trap, "w").close()
            os._exit(1)

    def run():
        stream = serving.file_stream(spark, f"{work}/in", schema, files_per_trigger=3)
        deliver_stream(stream, lambda df: df.select("line"), store(f"{work}/store", fault), f"{work}/d", f"{work}/checkpoint",
                       chunk_lines=7).awaitTermination()

    with pytest.raises(Exception):
        run()
    assert delivered_batches(spark, f"{work}/d") == [0]
    assert outcomes(spark, f"{work}/d").count() == 100
    run()
    assert delivered_batches(spark, f"{work}/d") == [0, 1]
    everything = sorted(map(str, range(200)))
    assert taken(f"{work}/store") == everything
    rows = outcomes(spark, f"{work}/d").collect()
    assert sorted(r.line for r in rows) == everything and all(r.error is None for r in rows)


def test_refused_and_failed_lines_are_set_aside(spark, tmp_path):
    work = str(tmp_path)
    os.mkdir(f"{work}/store")
    rows = [(i, None if i % 10 == 0 else f"line{i}") for i in range(50)]
    batch = spark.createDataFrame(rows, "id int, line string").repartition(1).sortWithinPartitions("id")
    calls = f"{work}/calls"

    def fault(token):
        with open(calls, "a") as f:
            f.write(f"{token}\n")
        if token.endswith("-2"):
            raise ConnectionError("away")

    send = store(f"{work}/store", fault, lambda line: "odd" if line.endswith("7") else None)
    for _ in range(2):
        deliver(batch, 5, send, f"{work}/d", chunk_lines=20, retries=2, backoff_s=0.01)
    got = {r.id: r.error for r in outcomes(spark, f"{work}/d").collect()}
    want = {i: "no line" if line is None else "ConnectionError: away" if i >= 40 else "odd" if i % 10 == 7 else None for i, line in rows}
    assert got == want
    # The second call found the batch delivered; the failing chunk was tried three times.
    assert sorted(open(calls).read().split()) == ["5-0", "5-1", "5-2", "5-2", "5-2"]
    with pytest.raises(Exception, match="away"):
        deliver(batch, 6, send, f"{work}/d", chunk_lines=20, retries=0, swallow=False)
    assert delivered_batches(spark, f"{work}/d") == [5]


def test_delivery_odd_input(spark, tmp_path):
    work = str(tmp_path)
    with pytest.raises(ValueError):
        outcomes(spark, f"{work}/d")
    deliver(spark.createDataFrame([], "line string, extra int"), 0, lambda lines, token: None, f"{work}/d")
    assert outcomes(spark, f"{work}/d").count() == 0
    with pytest.raises(ValueError):
        deliver(spark.createDataFrame([("a", 1)], "line string, place int"), 1, lambda lines, token: None, f"{work}/d")
    with pytest.raises(Exception, match="answers came"):
        deliver(spark.createDataFrame([("a",)], "line string"), 2, lambda lines, token: [], f"{work}/d")

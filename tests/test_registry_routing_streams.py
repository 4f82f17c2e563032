import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.functions.descriptors import (
    AIRLINE_TYPES, WINE_TYPES, check_descriptors, display_name, fingerprint, same_descriptor, summary,
)
from tidemark.operators import registry, routing
from tidemark.operators.asof import assign_models
from tidemark.operators.stats import activation_stats, current_activation, current_stats, every_nth, running_stats, serving_stats
from tidemark.schemas import MODEL_DESCRIPTOR
from tidemark.scoring.score import load_model
from tidemark.streaming import serving

ROWS = [
    ("m1", "d", "PMML", b"<x/>", None), ("m2", "d", "PMML", None, "/a/b.pmml"), ("", "d", "TENSORFLOWSAVED", None, "/a/b/c/"),
    ("", "d", "TENSORFLOW", b"", ""), ("", "d", "H2O", b"z", None), ("m6", "d", "UNKNOWN", b"z", None), ("m7", "d", "NEW", b"z", None),
    ("m8", "d", "TENSORFLOWSAVED", b"q", None),
]


@pytest.fixture(scope="module")
def descriptors(spark):
    return spark.createDataFrame(ROWS, MODEL_DESCRIPTOR)


def test_names_and_summaries(descriptors):
    got = [r.n for r in descriptors.select(display_name().alias("n")).collect()]
    assert got == ["m1", "m2", "c", "unnamed-model", "unnamed-model", "m6", "m7", "m8"]
    texts = [r.s for r in descriptors.select(summary().alias("s")).collect()]
    assert texts[0] == "name=m1; about=d; type=PMML; at=null; bytes[4]=3C782F3E"
    assert texts[1].endswith("; at=/a/b.pmml; bytes[0]=[]") and texts[3].endswith("; bytes[0]=[]")


def test_checks_give_error_values(descriptors):
    got = {r.modelName or r.modelType: r.error for r in check_descriptors(descriptors, WINE_TYPES).collect()}
    assert got["m1"] is None and got["TENSORFLOWSAVED"] is None and got["TENSORFLOW"] is None
    assert got["m2"].startswith("Invalid descriptor name=m2") and got["m8"].startswith("Invalid")
    assert got["H2O"] == got["m6"][:-7] + "H2O" == "No factory found for model type H2O" and got["m7"] == "Unknown model type NEW"
    assert registry.usable_versions(descriptors, AIRLINE_TYPES).count() == 1
    assert registry.refused_versions(descriptors, AIRLINE_TYPES).count() == 7


def test_nulls_do_not_make_a_descriptor_usable(spark):
    rows = [(None, "d", "PMML", None, None), ("m", None, "PMML", None, "/x"), (None, None, None, b"x", None), (None, None, "TENSORFLOWSAVED", None, None)]
    checked = check_descriptors(spark.createDataFrame(rows, MODEL_DESCRIPTOR), WINE_TYPES)
    assert checked.where("error IS NULL").count() == 0


def test_equality_of_descriptors(spark, descriptors):
    pairs = descriptors.select(F.struct("*").alias("l")).crossJoin(descriptors.select(F.struct("*").alias("r")))
    assert pairs.where(same_descriptor("l", "r")).count() == len(ROWS)
    assert descriptors.select(fingerprint()).distinct().count() == len(ROWS)


def test_models_that_cannot_be_made_are_values(spark, descriptors):
    with_id = descriptors.where("modelType = 'PMML'").withColumn("version_id", F.col("modelName"))
    models, outcome = registry.load_models(with_id, load_model)
    assert models == {}
    errors = {r.version_id: r.error for r in outcome.collect()}
    assert errors["m1"].startswith("No model could be made of name=m1")
    assert errors["m2"].endswith("the descriptor has no model bytes")


def versions(spark):
    return spark.sql(
        "SELECT server, timestamp_seconds(at) AS valid_from, seq, name AS modelName, 'd' AS description, 'PMML' AS modelType, "
        "CAST(body AS BINARY) AS modelBytes, CAST(NULL AS STRING) AS modelSourceLocation FROM VALUES "
        "('s', 10, 1, 'a', 'x'), ('s', 20, 2, 'a', 'x'), ('s', 30, 3, 'b', 'x'), ('s', 30, 4, 'a', 'x'), ('t', 5, 5, 'a', 'x') "
        "AS v(server, at, seq, name, body)"
    )


def test_resent_models_and_latest(spark):
    v = versions(spark)
    kept = registry.drop_resent(v, ["server"], "valid_from", "seq")
    assert sorted(r.seq for r in kept.collect()) == [1, 3, 4, 5]
    assert kept.columns == v.columns
    latest = {r.server: r.seq for r in registry.latest_versions(v, ["server"], seq="seq").collect()}
    assert latest == {"s": 4, "t": 5}


def test_snapshot_round_trip(spark, tmp_path):
    v = versions(spark)
    path = registry.save_snapshot(v, str(tmp_path), "1", ["server"], "seq")
    restored, warning = registry.restore_snapshot(spark, path)
    assert warning is None
    newer = v.where("seq = 3")
    records = spark.sql("SELECT server, timestamp_seconds(at) AS ts FROM VALUES ('s', 1), ('s', 31), ('t', 1), ('u', 1) AS r(server, at)")
    got = assign_models(records, registry.with_restored(newer, restored), on="ts", by=["server"], seq="seq")
    assert sorted((r.server, r.ts.second, r.model.seq if r.model else None) for r in got.collect()) == [
        ("s", 1, 4), ("s", 31, 3), ("t", 1, 5), ("u", 1, None)]
    none, warning = registry.restore_snapshot(spark, str(tmp_path / "nothing"))
    assert none is None and "Error restoring the model state" in warning
    assert registry.with_restored(newer, None) is newer


def test_bernoulli_and_weighted_choice(spark):
    draws = spark.range(100).select(F.col("id").cast("int").alias("d"))
    count = lambda c: draws.where(c).count()
    assert count(routing.picked(70, F.col("d"))) == 71 and count(routing.picked(70, F.col("d"), strict=True)) == 70
    assert count(routing.picked(0, F.col("d"))) == 1
    per_slot = lambda w: {r.s: r.n for r in draws.groupBy(routing.choice(w, F.col("d")).alias("s")).agg(F.count("*").alias("n")).collect()}
    assert per_slot([90, 10]) == {0: 90, 1: 10} and per_slot([10, 20]) == {0: 10, 1: 90}
    assert per_slot([30]) == {0: 100} and per_slot([60, 70, 5]) == {0: 60, 1: 40}
    keys = spark.range(30_000).select(routing.bucket("id", seed=3).alias("b"))
    share = keys.where(routing.picked(70, F.col("b"), strict=True)).count() / 30_000
    assert abs(share - 0.7) < 0.02


def test_hot_keys_are_spread(spark):
    df = spark.range(4000).select("id", F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 50).cast("string"))).alias("k"))
    out = routing.partition_by_key(df, ["k"], 16, rows_per_task=200)
    assert out.columns == df.columns and out.count() == 4000
    placed = out.withColumn("p", F.spark_partition_id()).groupBy("k").agg(F.countDistinct("p").alias("n"), F.count("*").alias("c")).collect()
    assert next(r.n for r in placed if r.k == "hot") > 3
    assert all(r.n == 1 for r in placed if r.k != "hot")


def test_statistics(spark):
    rng = random.Random(9)
    rows = [(i, rng.choice(["a", "b", None]), i * 10, rng.randrange(50)) for i in range(300)]
    df = spark.createDataFrame(rows, "id bigint, version string, at bigint, took bigint")
    total = {r.version: r for r in serving_stats(df, ["version"], "took", "at").collect()}
    steps = running_stats(df, ["version"], ["at", "id"], "took", target_rows=20)
    for v in ("a", "b", None):
        mine = [r for r in rows if r[1] == v]
        t = [r[3] for r in mine]
        assert (total[v].score_count, total[v].duration, total[v]["min"], total[v]["max"], total[v].since) == (len(t), sum(t), min(t), max(t), mine[0][2])
    got = {r.id: r for r in steps.collect()}
    for v in ("a", "b", None):
        seen = []
        for r in [r for r in rows if r[1] == v]:
            seen.append(r[3])
            g = got[r[0]]
            assert (g.score_count, g.duration_sum, g.duration_min, g.duration_max) == (len(seen), sum(seen), min(seen), max(seen))
    assert every_nth(steps, 40).count() == sum(sum(1 for r in rows if r[1] == v) // 40 for v in ("a", "b", None))
    assert current_stats(serving_stats(df, ["version"], "took", "at")).count() == 1


START = datetime(2024, 1, 1)
RECORD = "id bigint, ts timestamp, x double"


def write_records(spark, folder, ids):
    rows = [(i, START + timedelta(seconds=i), float(i)) for i in ids]
    spark.createDataFrame(rows, RECORD).coalesce(1).write.mode("append").parquet(folder)


def model_rows(spark, specs):
    return spark.createDataFrame(
        [(f"m{s}", "d", "PMML" if good else "H2O", b"x", None, START + timedelta(seconds=at), s) for s, at, good in specs],
        "modelName string, description string, modelType string, modelBytes binary, modelSourceLocation string, valid_from timestamp, seq int",
    )


def test_stream_equals_batch_and_survives_a_restart(spark, tmp_path):
    p = lambda n: str(tmp_path / n)
    specs = [(1, 5, True), (2, 12, False), (3, 20, True)]
    model_rows(spark, specs).coalesce(1).write.parquet(p("models"))
    schema = spark.read.parquet(p("models")).schema

    def update():
        serving.collect_versions(serving.file_stream(spark, p("models"), schema), WINE_TYPES, p("versions"), p("cp-models")).awaitTermination()

    def run():
        stream = serving.file_stream(spark, p("records"), spark.createDataFrame([], RECORD).schema, files_per_trigger=1)
        serving.serve(
            stream, lambda s: serving.collected_versions(s, p("versions"), schema),
            lambda df: df.select("id", "ts", "x", F.col("model.modelName").alias("name")), p("out"), p("cp"), on="ts", seq="seq",
        ).awaitTermination()

    assert serving.collected_versions(spark, p("versions"), schema).count() == 0
    write_records(spark, p("records"), range(0, 10))
    update()
    run()
    first = {r.id: r.name for r in serving.served(spark, p("out")).collect()}
    assert first == {i: "m1" if i >= 5 else None for i in range(10)}
    # a later run goes on where this one stopped; a late version leaves earlier results alone
    write_records(spark, p("records"), range(10, 30))
    model_rows(spark, [(4, 7, True)]).coalesce(1).write.mode("append").parquet(p("models"))
    update()
    run()
    run()
    got = {r.id: r.name for r in serving.served(spark, p("out")).collect()}
    assert {i: got[i] for i in range(10)} == first
    assert {i: got[i] for i in range(10, 30)} == {i: "m3" if i >= 20 else "m4" for i in range(10, 30)}
    assert serving.served(spark, p("out")).count() == 30
    records = spark.read.parquet(p("records"))
    again = assign_models(records, serving.collected_versions(spark, p("versions"), schema), on="ts", seq="seq")
    assert {r.id: r.model.modelName for r in again.where("id >= 7").collect()} == {i: "m3" if i >= 20 else "m4" for i in range(7, 30)}


def test_stream_buckets_and_duplicates(spark, tmp_path):
    p = lambda n: str(tmp_path / n)
    write_records(spark, p("in"), range(0, 100))
    write_records(spark, p("in"), range(50, 100))
    schema = spark.createDataFrame([], RECORD).schema
    stream = lambda: serving.file_stream(spark, p("in"), schema)
    serving.append_to(serving.without_duplicates(stream(), ["id"], "ts", "1 hour"), p("once"), p("cp1")).awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(p("once")).collect()) == list(range(100))
    counts = serving.bucket_counts(stream(), "ts", "10 seconds", "20 seconds", {"n": F.count("*")})
    serving.append_to(counts, p("counts"), p("cp2")).awaitTermination()
    got = {r.bucket: r.n for r in spark.read.parquet(p("counts")).collect()}
    base = int((START - datetime(1970, 1, 1)).total_seconds())
    want = {(base + b) * 1_000_000: 20 if b >= 50 else 10 for b in range(0, 100, 10)}
    closed = [b for b in want if b + 10_000_000 <= (base + 99 - 20) * 1_000_000]
    assert {b: got[b] for b in closed} == {b: want[b] for b in closed} and set(got) <= set(want)
    taken = []
    serving.fan_out_stream(stream(), [lambda df, i: taken.append(df.count()), lambda df, i: taken.append(df.where("id < 10").count())], p("cp3")).awaitTermination()
    assert taken == [150, 10]


def test_map_columns_do_not_matter_to_the_form(spark):
    """As-of joins and spreading by key take records with maps, whatever the sizes."""
    records = spark.sql("SELECT id, timestamp_micros(id * 1000000) AS ts, id % 2 AS k, map('a', id, 'b', 0L) AS m, array(map('x', id)) AS deep FROM range(40)")
    versions = spark.sql("SELECT timestamp_micros(id * 10000000) AS valid_from, id % 2 AS k, id AS v FROM range(4)")
    forms = [assign_models(records, versions, on="ts", by=["k"], few=few) for few in (500, 2)]
    forms.append(assign_models(records, versions, on="ts", by=["k"], form="broadcast", few=2))
    got = [sorted((r.id, r.model and r.model.v, str(r.m)) for r in df.collect()) for df in forms]
    assert got[0] == got[1] == got[2]
    spread = routing.partition_by_key(records, ["k"], 4, rows_per_task=5)
    assert sorted(r.id for r in spread.collect()) == list(range(40))


def test_statistics_of_an_activation_without_records(spark):
    versions = spark.createDataFrame([("a", 0, 1), ("b", 100, 2)], "version string, at long, seq int")
    scored = spark.createDataFrame([("a", 5), ("a", 7), (None, 3)], "version string, took long")
    stats = {r.version: r for r in activation_stats(versions, scored, ["version"], "took", "at").collect()}
    assert (stats["a"].score_count, stats["a"].duration, stats["a"].min, stats["a"].max, stats["a"].since) == (2, 12, 5, 7, 0)
    assert (stats["b"].score_count, stats["b"].duration, stats["b"].min, stats["b"].since) == (0, 0, None, 100)
    assert (stats[None].score_count, stats[None].duration, stats[None].since) == (1, 0, None)
    assert current_activation(activation_stats(versions, scored, ["version"], "took", "at")).first().version == "b"


def test_shared_folder(spark, tmp_path):
    from tidemark import session

    before = spark.sparkContext._jsc.sc().getCheckpointDir()
    spark.sparkContext.setCheckpointDir(str(tmp_path / "set"))
    try:
        path = session.shared_dir(spark, "x")
        assert "/set/" in path and path.startswith(session.shared_base(spark))
        spark.range(3).write.parquet(path)
        session.remove_dir(path)
        assert not list((tmp_path / "set").glob("*/x-*"))
    finally:
        if before.isDefined():
            spark.sparkContext.setCheckpointDir(before.get())

"""The pyramid of buckets against plain loops over raw rows, and models kept by content."""

import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.operators import registry
from tidemark.operators.rollup import Pyramid, mean_of

START = datetime(1969, 12, 30)
KIND = "tag string, at timestamp, x double, k int"
MINUTE = 60_000_000


def plain(rows, width):
    out = {}
    for tag, at, x, k in rows:
        if at is not None:
            us = (at - datetime(1970, 1, 1)) // timedelta(microseconds=1)
            out.setdefault((tag, us // width * width), []).append((x, k))
    return out


def test_levels_equal_raw_rows(spark, tmp_path):
    """Ten batches, one of them added again, times before 1970, nulls in every column, an empty batch."""
    chance = random.Random(5)
    pyramid = Pyramid(spark, str(tmp_path / "p"), [MINUTE, 10 * MINUTE, 60 * MINUTE], {"x": "double", "k": "int"}, {"tag": "string"}, fan_in=2)
    rows = []
    for i in range(10):
        batch = [
            (
                chance.choice(["a", "b", None]), None if chance.random() < 0.05 else START + timedelta(minutes=chance.randrange(5_000), seconds=7),
                None if chance.random() < 0.1 else chance.randrange(100) / 4, None if chance.random() < 0.1 else 2**31 - 1 - chance.randrange(5),
            )
            for _ in range(0 if i == 7 else 60)
        ]
        for _ in range(2 if i == 3 else 1):
            pyramid.add(spark.createDataFrame(batch, KIND), "at", i)
        rows += batch
    for width in (MINUTE, 30 * MINUTE, 60 * MINUTE, 24 * 60 * MINUTE):
        want = plain(rows, width)
        got = {(r.tag, r.bucket): r for r in pyramid.buckets(width).withColumn("mean", mean_of("x")).collect()}
        assert set(got) == set(want)
        for key, values in want.items():
            r, xs, ks = got[key], [x for x, _ in values if x is not None], [k for _, k in values if k is not None]
            assert (r.rows, r.x_n, r.k_n) == (len(values), len(xs), len(ks))
            assert (r.x_sum, r.x_min, r.x_max) == ((sum(xs), min(xs), max(xs)) if xs else (None,) * 3)
            assert (r.k_sum, r.k_min, r.k_max) == ((Decimal(sum(ks)), min(ks), max(ks)) if ks else (None,) * 3)
            assert r["mean"] == (pytest.approx(sum(xs) / len(xs)) if xs else None)
    # What is opened stays bounded: the base and two levels of runs.
    assert all(level.manifest()["base"] for level in pyramid.levels.values())
    assert all(len(level.parts()) <= 2 * level.fan_in for level in pyramid.levels.values())
    assert pyramid.ends() == (min(b for _, b in plain(rows, MINUTE)), max(b for _, b in plain(rows, MINUTE)))
    first = pyramid.ends()[0]
    touched = {r.bucket for r in pyramid.buckets(60 * MINUTE, (first, first + 60 * MINUTE)).collect()}
    hours = {b for _, b in plain(rows, 60 * MINUTE)}
    begin = first // (60 * MINUTE) * 60 * MINUTE
    assert touched == hours & {begin, begin + 60 * MINUTE}


def test_levels_are_chosen_by_width(spark, tmp_path):
    pyramid = Pyramid(spark, str(tmp_path / "p"), [60 * MINUTE, MINUTE], {"x": "double"})
    assert [pyramid.level_for(w * MINUTE) for w in (1, 90, 60, 120)] == [MINUTE, MINUTE, 60 * MINUTE, 60 * MINUTE]
    with pytest.raises(ValueError, match="divides"):
        pyramid.level_for(MINUTE // 2)
    with pytest.raises(ValueError, match="multiple"):
        Pyramid(spark, str(tmp_path / "q"), [MINUTE, 90_000_000], {"x": "double"})
    assert pyramid.ends() is None and pyramid.buckets(MINUTE).count() == 0


DESCRIPTORS = [
    ("s", 1, "m", b"one"), ("s", 2, "m", b"one"), ("s", 3, "m", None), ("t", 1, "m", b"one"), ("t", 2, "n", b""), ("u", 1, "m", b"two"),
]


def _descriptors(spark, rows):
    kind = "server string, seq long, modelName string, modelBytes binary"
    return spark.createDataFrame(rows, kind).selectExpr(
        "*", "'' AS description", "'PMML' AS modelType", "CAST(NULL AS STRING) AS modelSourceLocation",
        "timestamp_seconds(seq) AS valid_from",
    )


def test_models_are_kept_once_by_content(spark, tmp_path):
    folder, df = str(tmp_path / "bytes"), _descriptors(spark, DESCRIPTORS)
    light = registry.store_bytes(df.where("server != 'u'"), folder)
    assert "modelBytes" not in light.columns and spark.read.parquet(folder).count() == 2
    light = registry.store_bytes(df, folder)
    assert sorted(bytes(r.modelBytes) for r in spark.read.parquet(folder).collect()) == [b"", b"one", b"two"]
    with_hashes = registry.drop_resent(light, ["server"], "valid_from", "seq")
    with_files = registry.drop_resent(df, ["server"], "valid_from", "seq")
    rows = lambda d: sorted((r.server, r.seq) for r in d.collect())
    assert rows(with_hashes) == rows(with_files) == [("s", 1), ("s", 3), ("t", 1), ("t", 2), ("u", 1)]
    latest = registry.with_bytes(registry.latest_versions(with_hashes, ["server"], seq="seq"), folder)
    got = {r.server: None if r.modelBytes is None else bytes(r.modelBytes) for r in latest.collect()}
    assert got == {"s": None, "t": b"", "u": b"two"}
    unknown = light.limit(1).withColumn("modelHash", F.lit("none such"))
    assert registry.with_bytes(unknown, folder).first().modelBytes is None


def test_driver_refuses_more_model_bytes_than_it_should_hold(spark):
    df = _descriptors(spark, DESCRIPTORS).withColumn("version_id", F.col("seq"))
    with pytest.raises(ValueError, match="12 bytes"):
        registry.load_models(df, lambda kind, data, place: data, most_bytes=5)

"""Queries over time series, points and streams."""

from __future__ import annotations

from datetime import timedelta

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tidemark.functions.descriptors import WINE_TYPES
from tidemark.operators import registry
from tidemark.operators.asof import micros
from tidemark.operators.ordering import numbered
from tidemark.operators.rollup import Pyramid, keep_pyramid, mean_of
from tidemark.operators.timeseries import auto_width, auto_width_of, count_by_tag, fill_gaps, mean_by_tag, mean_of_fields, recent
from tidemark.plans.common import EVENT_MODELS_SQL, event_models, signup_descriptors, table
from tidemark.plans.serving import assigned_events
from tidemark.session import prepare, shared_dir
from tidemark.sinks.delivery import deliver_stream, outcomes
from tidemark.sinks.points import (
    WINE_PREFIX, PointSpec, each_batch, line_protocol, points, read_points, write_points,
    write_text,
)
from tidemark.streaming import serving
from tidemark.streaming.keyed import serve_keyed
from tidemark.streaming.paced import lay_out, play
from tidemark.streaming.runs import RunStore, collect_runs, keep_latest_runs, serve_from_runs

QUERIES, ORACLE = {}, {}


def query(sql: str | None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return register


# Means are compared at eight places: at six, a mean can lie exactly between two values.
HOUR = 3_600_000_000
QUARTER = 900_000_000


def _spine(width: int, tag: str | None) -> str:
    """Buckets with a row for every step, and the known neighbours of each, for the comparison SQL."""
    tags = f"(SELECT DISTINCT {tag} FROM known)" if tag else "(SELECT 1)"
    return f"""spine AS (SELECT t.*, r.bucket FROM {tags} t,
      (SELECT unnest(range((SELECT min(bucket) FROM known), (SELECT max(bucket) FROM known) + 1, {width})) AS bucket) r)"""


def _linear(aggregate: str, name: str, whole: bool) -> str:
    line = "a + (b - a) / (b_at - a_at) * (bucket - a_at)"
    line = f"trunc({line})::BIGINT" if whole else f"round({line}, 8)"
    known = "v" if whole else "round(v, 8)"
    return f"""
WITH known AS (SELECT event_type, epoch_us(ts) // {HOUR} * {HOUR} AS bucket, {aggregate} AS v FROM events GROUP BY 1, 2),
{_spine(HOUR, 'event_type')},
sides AS (SELECT s.event_type, s.bucket, k.v,
  last_value(k.v IGNORE NULLS) OVER w AS a, last_value(k.bucket IGNORE NULLS) OVER w AS a_at,
  first_value(k.v IGNORE NULLS) OVER x AS b, first_value(k.bucket IGNORE NULLS) OVER x AS b_at
  FROM spine s LEFT JOIN known k ON s.event_type = k.event_type AND s.bucket = k.bucket
  WINDOW w AS (PARTITION BY s.event_type ORDER BY s.bucket ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
    x AS (PARTITION BY s.event_type ORDER BY s.bucket ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT event_type, bucket, CASE WHEN v IS NOT NULL THEN {known} WHEN b_at > a_at THEN {line} END AS "{name}" FROM sides
"""


@query(_linear("count(value)", "count", True))
def bucket_count_linear_fill(spark, sf_dir):
    return count_by_tag(table(spark, sf_dir, "events"), "ts", HOUR, "value", ["event_type"])


@query(_linear("avg(value)", "mean", False))
def bucket_mean_linear_fill(spark, sf_dir):
    means = mean_by_tag(table(spark, sf_dir, "events"), "ts", HOUR, "value", ["event_type"])
    return means.select("event_type", "bucket", F.round("mean", 8).alias("mean"))


@query(f"""
WITH known AS (SELECT epoch_us(ts) // {QUARTER} * {QUARTER} AS bucket, avg(value) AS v, avg(user_id) AS u,
  avg(CAST(json_extract(props, '$.k') AS BIGINT)) AS k FROM events GROUP BY 1), {_spine(QUARTER, None)}
SELECT s.bucket, round(last_value(v IGNORE NULLS) OVER w, 8) AS mean_value, round(last_value(u IGNORE NULLS) OVER w, 8) AS mean_user,
  round(last_value(k IGNORE NULLS) OVER w, 8) AS mean_k FROM spine s LEFT JOIN known n ON s.bucket = n.bucket
WINDOW w AS (ORDER BY s.bucket ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
""")
def bucket_mean_previous_fill(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k").cast("bigint"))
    names = {"mean_value": "value", "mean_user": "user_id", "mean_k": "k"}
    means = mean_of_fields(events, "ts", QUARTER, names)
    return means.select("bucket", *[F.round(n, 8).alias(n) for n in names])


@query("SELECT event_id FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 6 HOUR")
def recent_window(spark, sf_dir):
    return recent(table(spark, sf_dir, "events"), "ts", timedelta(hours=6)).select("event_id")


@query("""
SELECT f AS first_us, l AS last_us, CASE WHEN (l - f) / 100000 <= 16200000 THEN 10800000 WHEN (l - f) / 100000 <= 32400000 THEN 21600000
  ELSE 43200000 END AS width_ms FROM (SELECT epoch_us(min(ts)) AS f, epoch_us(max(ts)) AS l FROM events)
""")
def auto_interval(spark, sf_dir):
    return auto_width_of(table(spark, sf_dir, "events"), "ts", 100)


SPEC = PointSpec("event result", {"value": "value", "user": "user_id", "props": "props"}, {"model": "event_type"})


@query("""
SELECT event_id, 'event result' AS measurement, epoch_us(ts) // 1000 AS time, event_type AS model, value, user_id::DOUBLE AS user_field, props
FROM events
""")
def point_rows(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    spec = PointSpec(SPEC.measurement, {**SPEC.fields, "id": "event_id"}, SPEC.tags)
    made = points(events, spec, "ts")
    return made.select(
        F.col("fields")["id"].cast("bigint").alias("event_id"), "measurement", "time", F.col("tags")["model"].alias("model"),
        F.col("fields")["value"].alias("value"), F.col("fields")["user"].alias("user_field"), F.col("texts")["props"].alias("props"),
    )


@query("""
SELECT 'event\\ result,model=' || event_type || ' value=' || value::VARCHAR || ',user=' || user_id || 'i,props="'
  || replace(props, '"', '\\"') || '" ' || (epoch_us(ts) // 1000)::VARCHAR AS line FROM events
""")
def line_protocol_rows(spark, sf_dir):
    return line_protocol(table(spark, sf_dir, "events"), SPEC, "ts")


@query("SELECT event_type AS model, count(*) AS stored, round(sum(value), 3) AS total FROM events GROUP BY event_type")
def stored_points(spark, sf_dir):
    """Points written to the store, the same batch twice, and read back."""
    folder = shared_dir(spark, "points")
    for _ in range(2):
        write_points(table(spark, sf_dir, "events"), SPEC, "ts", folder, "1")
    stored = read_points(spark, folder)
    return stored.groupBy(F.col("tags")["model"].alias("model")).agg(
        F.count(F.lit(1)).alias("stored"), F.round(F.sum(F.col("fields")["value"]), 3).alias("total")
    )


@query("""
SELECT 'Wine Quality: {"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '","c_nationkey":' || c_nationkey
  || ',"c_acctbal":' || c_acctbal::VARCHAR || ',"c_mktsegment":"' || c_mktsegment || '"}' AS value FROM customer
""")
def console_text(spark, sf_dir):
    folder = shared_dir(spark, "console")
    write_text(table(spark, sf_dir, "customer"), WINE_PREFIX, folder)
    return spark.read.text(folder)


@query(f"""
SELECT model, time, result, duration FROM (SELECT coalesce(v.model_name, '') AS model, epoch_us(e.ts) // 1000 AS time,
  coalesce(v.intercept + v.slope * e.value, 0.0) AS result, 0::DOUBLE AS duration
  FROM events e ASOF LEFT JOIN {EVENT_MODELS_SQL} ON e.ts >= v.valid_from)
""")
def scored_points(spark, sf_dir):
    """From record to chart: assign, score with the version's own numbers, make points."""
    scored = assigned_events(spark, sf_dir).select(
        "ts", F.col("model.modelName").alias("name"),
        F.coalesce(F.col("model.intercept") + F.col("model.slope") * F.col("value"), F.lit(0.0)).alias("result"),
        F.lit(0).cast("bigint").alias("duration"),
    )
    made = points(scored, PointSpec("wine_result", {"result": "result", "duration": "duration"}, {"model": "name"}), "ts")
    return made.select(
        F.coalesce(F.col("tags")["model"], F.lit("")).alias("model"), "time", F.col("fields")["result"].alias("result"),
        F.col("fields")["duration"].alias("duration"),
    )


# --- Streams ----------------------------------------------------------------------------------------------------------


def _event_stream(spark, sf_dir):
    schema = table(spark, sf_dir, "events").schema
    # The file source wants a folder or a pattern.
    return serving.file_stream(spark, f"{sf_dir}/events.parque[t]", schema)


@query(f"SELECT e.event_id, v.model_name, v.intercept + v.slope * e.value AS score FROM events e ASOF LEFT JOIN {EVENT_MODELS_SQL} ON e.ts >= v.valid_from")
def stream_asof_scores(spark, sf_dir):
    """Events as a stream, scored by the table of versions."""
    work = shared_dir(spark, "stream")
    serving.serve(
        _event_stream(spark, sf_dir),
        lambda s: registry.usable_versions(event_models(s), WINE_TYPES),
        lambda df: df.select(
            "event_id", F.col("model.modelName").alias("model_name"), (F.col("model.intercept") + F.col("model.slope") * F.col("value")).alias("score")
        ),
        f"{work}/out", f"{work}/checkpoint", on="ts", seq="seq",
    ).awaitTermination()
    return serving.served(spark, f"{work}/out")


@query("""
SELECT e.event_id, v.event_id AS version FROM (SELECT * FROM events WHERE event_type <> 'signup') e
ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'signup' AND value >= 5) v ON e.user_id = v.user_id AND e.ts >= v.ts
""")
def stream_two_inputs(spark, sf_dir):
    """Model updates and records both as streams: updates go to the version table, records are scored from it."""
    work = shared_dir(spark, "stream")
    updates = signup_descriptors(spark, sf_dir)
    updates.write.parquet(f"{work}/updates")
    store = _signup_store(spark, work)
    collect_runs(serving.file_stream(spark, f"{work}/updates", updates.schema), WINE_TYPES, store, f"{work}/checkpoint-models").awaitTermination()
    serve_from_runs(
        _event_stream(spark, sf_dir).where("event_type != 'signup'").select("event_id", "user_id", "ts"), store,
        lambda df: df.select("event_id", F.col("model.version").alias("version")), f"{work}/out", f"{work}/checkpoint", on="ts",
    ).awaitTermination()
    return serving.served(spark, f"{work}/out")


def _signup_store(spark, work, **options):
    kind = "user_id long, valid_from timestamp_ntz, version long"
    return RunStore(spark, f"{work}/versions", kind, ["user_id"], "valid_from", "version", **options)


@query("""
SELECT e.event_id, v.event_id AS version, true AS bounded FROM (SELECT * FROM events WHERE event_type <> 'signup') e
ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'signup' AND value >= 5) v ON e.user_id = v.user_id AND e.ts >= v.ts
""")
def stream_version_store(spark, sf_dir):
    """Updates and records in many batches in turn; each batch of records opens a bounded number of the store's runs."""
    work = shared_dir(spark, "stream")
    store, opened = _signup_store(spark, work, fan_in=2), []
    records = table(spark, sf_dir, "events").where("event_type != 'signup'").select("event_id", "user_id", "ts")
    updates = signup_descriptors(spark, sf_dir)
    days = [F.lit(f"2024-01-{d:02}").cast("timestamp_ntz") for d in range(1, 32, 5)]
    for i, day in enumerate(days):
        for df, time, name in ((updates, "valid_from", "updates"), (records, "ts", "records")):
            part = (F.col(time) >= day if i else F.lit(True)) & (F.col(time) < days[i + 1] if i + 1 < len(days) else F.lit(True))
            df.where(part).write.mode("append").parquet(f"{work}/{name}")
        collect_runs(serving.file_stream(spark, f"{work}/updates", updates.schema), WINE_TYPES, store, f"{work}/checkpoint-models").awaitTermination()
        serve_from_runs(
            serving.file_stream(spark, f"{work}/records", records.schema), store,
            lambda df: opened.append(len(store.parts(*df.agg(F.min(micros("ts")), F.max(micros("ts"))).first())))
            or df.select("event_id", F.col("model.version").alias("version")),
            f"{work}/out", f"{work}/checkpoint", on="ts",
        ).awaitTermination()
    # Two levels of one run at most, and the base.
    return serving.served(spark, f"{work}/out").withColumn("bounded", F.lit(len(opened) == len(days) and max(opened) <= 3))


@query("""
SELECT e.event_id, v.event_id AS version, round(v.event_id * 0.5 + e.value, 6) AS score FROM (SELECT * FROM events WHERE event_type <> 'signup') e
ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'signup' AND value >= 5) v ON e.user_id = v.user_id AND e.ts >= v.ts
""")
def stream_keyed_state(spark, sf_dir):
    """Both inputs as one keyed stream; it stops half-way, and some descriptors come only after the restart.

    Each server's versions and waiting records are state. The descriptors of the last day before the stop come a day
    late, in the second half, and still count for the records of that day.
    """
    work = shared_dir(spark, "stream")
    records = table(spark, sf_dir, "events").where("event_type != 'signup'").select("event_id", "user_id", "ts", "value")
    updates = signup_descriptors(spark, sf_dir)
    stop, day = F.lit("2024-01-16").cast("timestamp_ntz"), F.expr("INTERVAL 1 DAY")
    for late in (False, True):
        early, known = F.col("ts") < stop, F.col("valid_from") < stop - day
        records.where(~early if late else early).write.mode("append").parquet(f"{work}/records")
        updates.where(~known if late else known).write.mode("append").parquet(f"{work}/updates")
        ends = spark.range(1 if late else 0).select(F.lit("2100-01-01").cast("timestamp").alias("at"))
        ends.write.mode("append").parquet(f"{work}/ticks")
        served = serve_keyed(
            serving.file_stream(spark, f"{work}/records", records.schema),
            registry.usable_versions(serving.file_stream(spark, f"{work}/updates", updates.schema), WINE_TYPES).select("user_id", "valid_from", "version"),
            on="ts", by=["user_id"], seq="version", delay="2 days", slots=2, ticks=serving.file_stream(spark, f"{work}/ticks", ends.schema),
        )
        scored = served.select("event_id", F.col("model.version").alias("version"), F.round(F.col("model.version") * 0.5 + F.col("value"), 6).alias("score"))
        serving.append_to(scored, f"{work}/out", f"{work}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{work}/out")


@query(f"""
SELECT event_type, epoch_us(ts) // {24 * HOUR} * {24 * HOUR} AS bucket, count(*) AS n, round(sum(value), 3) AS total FROM events GROUP BY 1, 2
""")
def stream_bucket_counts(spark, sf_dir):
    """Daily counts on a stream, days still open at its end included."""
    work = shared_dir(spark, "stream")
    measures = {"n": F.count(F.lit(1)), "total": F.sum("value")}
    counts = serving.bucket_counts(_event_stream(spark, sf_dir), "ts", "1 day", "1 hour", measures, ["event_type"])
    kind = "event_type string, bucket long, n long, total double, batch long"
    store = RunStore(prepare(spark), f"{work}/store", kind, ["event_type", "bucket"], "batch", history=False)
    keep_latest_runs(counts, store, f"{work}/checkpoint").awaitTermination()
    written = store.latest()
    return written.select("event_type", "bucket", "n", F.round("total", 3).alias("total"))


def _pyramid(spark, sf_dir):
    """All events as a stream of three batches, kept as quarters, hours and days."""
    work = shared_dir(spark, "stream")
    pyramid = Pyramid(prepare(spark), f"{work}/pyramid", [QUARTER, HOUR, 24 * HOUR], {"value": "double", "user_id": "bigint"}, {"event_type": "string"})
    schema, files = _event_files(spark, sf_dir, f"{work}/in", range(3), 3)
    stream = serving.file_stream(spark, f"{work}/in", schema, files_per_trigger=-(-files // 3))
    keep_pyramid(stream, "ts", pyramid, f"{work}/checkpoint").awaitTermination()
    return pyramid


@query(_linear("avg(value)", "mean", False))
def rollup_mean_linear_fill(spark, sf_dir):
    """Hourly means with filled gaps, from the pyramid's hours instead of the events."""
    means = _pyramid(spark, sf_dir).buckets(HOUR).select("event_type", "bucket", mean_of("value").alias("mean"))
    return fill_gaps(means, HOUR, {"mean": "linear"}, ["event_type"]).select("event_type", "bucket", F.round("mean", 8).alias("mean"))


@query(" UNION ALL ".join(f"""
SELECT {width} AS width_us, event_type, epoch_us(ts) // {width} * {width} AS bucket, count(*) AS n, round(avg(value), 8) AS mean, min(value) AS least,
  max(value) AS greatest, sum(user_id)::BIGINT AS users FROM events GROUP BY 1, 2, 3""" for width in (2 * QUARTER, 3 * HOUR, 48 * HOUR)))
def rollup_levels(spark, sf_dir):
    """Three widths that are no level themselves, each from the widest level that divides it."""
    pyramid, out = _pyramid(spark, sf_dir), None
    for width in (2 * QUARTER, 3 * HOUR, 48 * HOUR):
        part = pyramid.buckets(width).select(
            F.lit(width).alias("width_us"), "event_type", "bucket", F.col("rows").alias("n"), F.round(mean_of("value"), 8).alias("mean"),
            F.col("value_min").alias("least"), F.col("value_max").alias("greatest"), F.col("user_id_sum").cast("bigint").alias("users"),
        )
        out = part if out is None else out.unionByName(part)
    return out


@query(f"""
WITH ends AS (SELECT min(epoch_us(ts) // {QUARTER} * {QUARTER}) AS f, max(epoch_us(ts) // {QUARTER} * {QUARTER}) AS l FROM events),
w AS (SELECT CASE WHEN (l - f) / 100000 <= 16200000 THEN 10800000 WHEN (l - f) / 100000 <= 32400000 THEN 21600000 ELSE 43200000 END::BIGINT * 1000 AS width FROM ends)
SELECT epoch_us(ts) // width * width AS bucket, any_value(width) AS width_us, count(value) AS n FROM events, w GROUP BY 1
""")
def rollup_auto_width(spark, sf_dir):
    """The chosen width for about 100 points picks the level that its buckets are read from."""
    pyramid = _pyramid(spark, sf_dir)
    first, last = pyramid.ends() or (0, 0)
    width = 1000 * spark.range(1).select(auto_width(F.lit(first), F.lit(last), 100)).first()[0]
    return pyramid.buckets(width).groupBy("bucket").agg(F.lit(width).alias("width_us"), F.sum("value_n").alias("n"))


@query("SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def stream_user_sink(spark, sf_dir):
    """A user's own write function as the output of a stream."""
    work = shared_dir(spark, "stream")

    def write(batch):
        batch.groupBy("event_type").count().write.mode("append").parquet(f"{work}/out")

    stream = _event_stream(spark, sf_dir)
    stream.writeStream.foreachBatch(each_batch(write)).option("checkpointLocation", f"{work}/checkpoint").trigger(
        availableNow=True
    ).start().awaitTermination()
    return spark.read.parquet(f"{work}/out").groupBy("event_type").agg(F.sum("count").alias("n"))


def _event_files(spark, sf_dir, folder, parts, of):
    """Write some of the events as files, cut as Spark cuts them; their schema and how many files there are."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value", "event_type")
    wanted = F.pmod(F.xxhash64("event_id"), F.lit(of)).alias("part")
    events.where(wanted.isin(*parts)).withColumn("part", wanted).write.mode("append").partitionBy("part").parquet(folder)
    return events.schema, len(spark.read.parquet(folder).inputFiles())


@query(f"SELECT e.event_id, v.model_name, v.intercept + v.slope * e.value AS score FROM events e ASOF LEFT JOIN {EVENT_MODELS_SQL} ON e.ts >= v.valid_from")
def stream_restart(spark, sf_dir):
    """A stream that ends, gets more input and starts again scores every event once, with the numbers of its version."""
    work = shared_dir(spark, "stream")
    for part in (0, 1):
        schema, _ = _event_files(spark, sf_dir, f"{work}/in", [part], 2)
        serving.serve(
            serving.file_stream(spark, f"{work}/in", schema), lambda s: registry.usable_versions(event_models(s), WINE_TYPES),
            lambda df: df.select(
                "event_id", F.col("model.modelName").alias("model_name"),
                (F.col("model.intercept") + F.col("model.slope") * F.col("value")).alias("score"),
            ),
            f"{work}/out", f"{work}/checkpoint", on="ts", seq="seq",
        ).awaitTermination()
    return serving.served(spark, f"{work}/out")


@query("SELECT event_type, count(*) AS n, true AS paced FROM events GROUP BY event_type")
def stream_paced(spark, sf_dir):
    """A few files per batch: three batches, however many files there are."""
    work = shared_dir(spark, "stream")
    schema, files = _event_files(spark, sf_dir, f"{work}/in", range(3), 3)
    pace = -(-files // 3)
    stream = serving.file_stream(spark, f"{work}/in", schema, files_per_trigger=pace)
    serving.fan_out_stream(
        stream, [lambda batch, batch_id: batch.write.mode("overwrite").parquet(f"{work}/out/batch_id={batch_id}")], f"{work}/checkpoint"
    ).awaitTermination()
    written = spark.read.parquet(f"{work}/out")
    paced = written.select("batch_id").distinct().agg((F.count(F.lit(1)) == -(-files // pace)).alias("paced"))
    return written.groupBy("event_type").agg(F.count(F.lit(1)).alias("n")).join(F.broadcast(paced))


@query("""
WITH n AS (SELECT (count(*) + 5) // 6 AS pace FROM events)
SELECT event_id, (row_number() OVER (ORDER BY ts, event_id) - 1) // pace AS batch FROM events, n
""")
def stream_record_paced(spark, sf_dir):
    """Events in order of time, a sixth of them per batch, with a stop in the middle of a batch and a new start.

    The first run is lost while it writes its third batch; the second one writes that batch again, with the same events.
    """
    work = shared_dir(spark, "stream")
    events = numbered(table(spark, sf_dir, "events").select("event_id", "ts"), ["ts", "event_id"])
    lay_out(events, f"{work}/in", block=100_000)
    pace = -(-spark.read.parquet(f"{work}/in").count() // 6)
    lost = []

    def write(rows, batch_id):
        rows.select("event_id").write.mode("overwrite").parquet(f"{work}/out/batch={batch_id}")
        if batch_id == 2 and not lost:
            lost.append(batch_id)
            raise OSError("lost while writing the third batch")

    try:
        play(spark, f"{work}/in", pace, write, f"{work}/checkpoint", block=100_000).await_end()
    except StreamingQueryException:
        play(spark, f"{work}/in", pace, write, f"{work}/checkpoint", block=100_000).await_end()
    return spark.read.option("basePath", f"{work}/out").parquet(f"{work}/out/batch=*").select("event_id", F.col("batch").cast("bigint").alias("batch"))


@query("""
SELECT event_type, count(*) FILTER (value < 200) AS stored, count(*) FILTER (value >= 200) AS refused FROM events GROUP BY event_type
""")
def stream_delivered_points(spark, sf_dir):
    """Points of a stream sent to a store that takes no values from 200 on; what it refuses is set aside."""
    work = shared_dir(spark, "stream")
    schema, files = _event_files(spark, sf_dir, f"{work}/in", range(3), 3)
    stream = serving.file_stream(spark, f"{work}/in", schema, files_per_trigger=-(-files // 3))
    spec = PointSpec("event", {"value": "value"}, {"model": "event_type"})

    def send(lines, token):
        values = [float(line.split(" ")[1].removeprefix("value=")) for line in lines]
        return ["out of range" if v >= 200 else None for v in values]

    deliver_stream(stream, lambda batch: line_protocol(batch, spec, "ts"), send, f"{work}/delivery", f"{work}/checkpoint").awaitTermination()
    sent = outcomes(spark, f"{work}/delivery").withColumn("event_type", F.regexp_extract("line", "model=([^ ]+) ", 1))
    return sent.groupBy("event_type").agg(F.count_if(F.col("error").isNull()).alias("stored"), F.count("error").alias("refused"))


@query("SELECT DISTINCT event_id, user_id FROM events")
def stream_dedupe(spark, sf_dir):
    """Events delivered twice come out once."""
    work = shared_dir(spark, "stream")
    twice = _event_stream(spark, sf_dir).unionByName(_event_stream(spark, sf_dir))
    once = serving.without_duplicates(twice.select("event_id", "user_id", "ts"), ["event_id"], "ts", "1 hour")
    serving.append_to(once.select("event_id", "user_id"), f"{work}/out", f"{work}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{work}/out")


@query("SELECT event_type, count(*) AS n, 'counts' AS output FROM events GROUP BY event_type "
       "UNION ALL SELECT event_type, count(*), 'points' FROM events GROUP BY event_type")
def stream_fan_out(spark, sf_dir):
    """One stream to two outputs: points, and counts per type."""
    work = shared_dir(spark, "stream")

    def counts(batch, batch_id):
        batch.groupBy("event_type").count().write.mode("overwrite").parquet(f"{work}/counts/batch_id={batch_id}")

    def store(batch, batch_id):
        write_points(batch, SPEC, "ts", f"{work}/points", str(batch_id))

    serving.fan_out_stream(_event_stream(spark, sf_dir), [counts, store], f"{work}/checkpoint").awaitTermination()
    counted = spark.read.parquet(f"{work}/counts").groupBy("event_type").agg(F.sum("count").alias("n"))
    stored = read_points(spark, f"{work}/points").groupBy(F.col("tags")["model"].alias("event_type")).agg(F.count(F.lit(1)).alias("n"))
    return counted.withColumn("output", F.lit("counts")).unionByName(stored.withColumn("output", F.lit("points")))

"""Queries over model versions: as-of assignment, intervals, registry, statistics, routing."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.descriptors import WINE_TYPES, check_descriptors, display_name, summary
from tidemark.operators import registry, routing
from tidemark.operators.asof import assign_models, micros, version_intervals
from tidemark.operators.ordering import first_n
from tidemark.operators.stats import activation_stats, current_activation, current_stats, every_nth, running_stats, serving_stats
from tidemark.plans.common import (
    EVENT_MODELS_SQL, ORDER_DESCRIPTORS_SQL, event_models, order_descriptors, served_events, signup_versions, table,
)
from tidemark.scoring.models import ForestModel, LinearModel, Node, Test
from tidemark.scoring.score import RemoteScorer, score_by_any_version, score_by_version
from tidemark.session import prepare, shared_dir

QUERIES, ORACLE = {}, {}


def query(sql: str | None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return register


_ASSIGNED = f"events e ASOF LEFT JOIN {EVENT_MODELS_SQL} ON e.ts >= v.valid_from"


def assigned_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    versions = registry.usable_versions(event_models(spark), WINE_TYPES)
    return assign_models(table(spark, sf_dir, "events"), versions, on="ts", seq="seq")


@query(f"SELECT e.event_id, v.model_name FROM {_ASSIGNED}")
def asof_model_assignment(spark, sf_dir):
    return assigned_events(spark, sf_dir).select("event_id", F.col("model.modelName").alias("model_name"))


@query(f"SELECT e.event_id, v.model_name, round(v.intercept + v.slope * e.value, 6) AS score FROM {_ASSIGNED}")
def asof_scored_by_version(spark, sf_dir):
    """Every event scored by the model current at its time; each version's expression runs on its rows only."""
    versions = registry.usable_versions(event_models(spark), WINE_TYPES)
    models = {
        r.modelName: LinearModel(r.intercept, (("value", r.slope),))
        for r in versions.select("modelName", "intercept", "slope").collect()
    }
    named = assigned_events(spark, sf_dir).withColumn("model_name", F.col("model.modelName"))
    scored = score_by_version(named.select("event_id", "model_name", "value"), "model_name", models)
    return scored.select("event_id", "model_name", F.round("score.value", 6).alias("score"))


@query("""
SELECT e.event_id, v.event_id AS version
FROM (SELECT * FROM events WHERE event_type <> 'signup') e
ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'signup' AND value >= 5) v
  ON e.user_id = v.user_id AND e.ts >= v.ts
""")
def asof_model_per_server(spark, sf_dir):
    """One server per user and as many versions as there are signups."""
    records = served_events(spark, sf_dir).select("event_id", "user_id", "ts")
    joined = assign_models(records, signup_versions(spark, sf_dir), on="ts", by=["user_id"], seq="version", form="window")
    return joined.select("event_id", F.col("model.version").alias("version"))


@query("""
SELECT e.event_id, v.event_id AS version
FROM (SELECT * FROM events WHERE event_type <> 'signup') e
ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'signup' AND value >= 5) v ON e.ts >= v.ts
""")
def asof_model_one_server(spark, sf_dir):
    """A single server for everything with many versions: the hardest case to spread out."""
    records = served_events(spark, sf_dir).select("event_id", "ts")
    joined = assign_models(records, signup_versions(spark, sf_dir), on="ts", seq="version", form="window")
    return joined.select("event_id", F.col("model.version").alias("version"))


@query("""
SELECT o_orderkey AS seq, epoch_us(o_orderdate) AS valid_from,
  epoch_us(lead(o_orderdate) OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate, o_orderkey)) AS valid_to
FROM orders
""")
def model_version_intervals(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    versions = orders.select("o_orderpriority", F.col("o_orderkey").alias("seq"), F.col("o_orderdate").alias("valid_from"))
    spans = version_intervals(versions, by=["o_orderpriority"], seq="seq")
    return spans.select("seq", micros("valid_from").alias("valid_from"), micros("valid_to").alias("valid_to"))


@query(f"""
SELECT server, max(seq) AS seq, any_value(modelName) AS model_name FROM (
  SELECT *, row_number() OVER (PARTITION BY server ORDER BY valid_from DESC, seq DESC) AS n FROM {ORDER_DESCRIPTORS_SQL}
) WHERE n = 1 GROUP BY server
""")
def latest_model(spark, sf_dir):
    latest = registry.latest_versions(order_descriptors(spark, sf_dir), ["server"], seq="seq")
    return latest.select("server", "seq", F.col("modelName").alias("model_name"))


@query(f"""
WITH marked AS (SELECT *, coalesce(modelName IS NOT DISTINCT FROM lag(modelName) OVER w
    AND description IS NOT DISTINCT FROM lag(description) OVER w AND modelType IS NOT DISTINCT FROM lag(modelType) OVER w
    AND payload IS NOT DISTINCT FROM lag(payload) OVER w
    AND modelSourceLocation IS NOT DISTINCT FROM lag(modelSourceLocation) OVER w AND lag(seq) OVER w IS NOT NULL, false) AS resent
  FROM {ORDER_DESCRIPTORS_SQL} WINDOW w AS (PARTITION BY server ORDER BY valid_from, seq))
SELECT server, seq, sha256(payload) AS hash, hex(payload) AS model FROM (
  SELECT *, row_number() OVER (PARTITION BY server ORDER BY valid_from DESC, seq DESC) AS n FROM marked WHERE NOT resent) WHERE n = 1
""")
def latest_model_by_content(spark, sf_dir):
    """Models are kept once by content; resent and outdated descriptors go before any bytes are moved."""
    folder = shared_dir(prepare(spark), "models")
    light = registry.store_bytes(order_descriptors(spark, sf_dir), folder)
    latest = registry.latest_versions(registry.drop_resent(light, ["server"], "valid_from", "seq"), ["server"], seq="seq")
    found = registry.with_bytes(latest, folder)
    return found.select("server", "seq", F.col("modelHash").alias("hash"), F.hex("modelBytes").alias("model"))


_SUMMARY_SQL = """'name=' || coalesce(modelName, 'null') || '; about=' || coalesce(description, 'null') || '; type='
 || coalesce(modelType, 'null') || '; at=' || coalesce(modelSourceLocation, 'null') || '; bytes[' || coalesce(strlen(payload), 0) || ']='
 || CASE WHEN coalesce(payload, '') = '' THEN '[]' ELSE hex(payload) END"""


@query(f"""
SELECT seq, CASE
  WHEN modelType = 'CUSTOM' THEN 'Unknown model type CUSTOM'
  WHEN modelType = 'H2O' THEN 'No factory found for model type H2O'
  WHEN (modelType IN ('PMML', 'TENSORFLOW') AND payload IS NULL)
    OR (modelType = 'TENSORFLOWSAVED' AND modelSourceLocation IS NULL) THEN 'Invalid descriptor ' || {_SUMMARY_SQL}
  END AS error
FROM {ORDER_DESCRIPTORS_SQL}
""")
def model_dispatch(spark, sf_dir):
    return check_descriptors(order_descriptors(spark, sf_dir), WINE_TYPES).select("seq", "error")


@query(f"""
SELECT seq, CASE WHEN modelName <> '' THEN modelName
  WHEN coalesce(modelSourceLocation, '') = '' THEN 'unnamed-model'
  ELSE string_split(modelSourceLocation, '/')[-1] END AS display_name, {_SUMMARY_SQL} AS summary
FROM {ORDER_DESCRIPTORS_SQL}
""")
def model_display_name(spark, sf_dir):
    return order_descriptors(spark, sf_dir).select("seq", display_name().alias("display_name"), summary().alias("summary"))


@query(f"""
SELECT seq FROM (
  SELECT seq, coalesce(modelName IS NOT DISTINCT FROM lag(modelName) OVER w
    AND description IS NOT DISTINCT FROM lag(description) OVER w AND modelType IS NOT DISTINCT FROM lag(modelType) OVER w
    AND payload IS NOT DISTINCT FROM lag(payload) OVER w
    AND modelSourceLocation IS NOT DISTINCT FROM lag(modelSourceLocation) OVER w
    AND lag(seq) OVER w IS NOT NULL, false) AS resent
  FROM {ORDER_DESCRIPTORS_SQL} WINDOW w AS (PARTITION BY description ORDER BY valid_from, seq)
) WHERE NOT resent
""")
def descriptor_dedupe(spark, sf_dir):
    """Descriptors sent again unchanged are dropped; here one server per priority, so the servers are large."""
    return registry.drop_resent(order_descriptors(spark, sf_dir), ["description"], "valid_from", "seq").select("seq")


@query("""
WITH s AS (SELECT * FROM events WHERE event_type = 'signup' AND value >= 5),
v AS (SELECT user_id, ts AS valid_from, event_id AS version FROM s WHERE ts >= TIMESTAMP '2024-01-15'
  UNION ALL SELECT user_id, TIMESTAMP '1900-01-01', arg_max(event_id, ts) FROM s WHERE ts < TIMESTAMP '2024-01-15' GROUP BY user_id)
SELECT e.event_id, v.version FROM (SELECT * FROM events WHERE event_type <> 'signup' AND ts >= TIMESTAMP '2024-01-15') e
ASOF LEFT JOIN v ON e.user_id = v.user_id AND e.ts >= v.valid_from
""")
def restored_model_assignment(spark, sf_dir):
    """Save the current model of every server, restart from the snapshot, go on with newer versions."""
    versions = signup_versions(spark, sf_dir)
    cut = F.lit("2024-01-15").cast("timestamp_ntz")
    path = registry.save_snapshot(
        versions.where(F.col("valid_from") < cut), shared_dir(spark, "snapshots"), "1", ["user_id"], "version"
    )
    saved, _ = registry.restore_snapshot(spark, path)
    later = registry.with_restored(versions.where(F.col("valid_from") >= cut), saved)
    records = served_events(spark, sf_dir).where(F.col("ts") >= cut).select("event_id", "user_id", "ts")
    joined = assign_models(records, later, on="ts", by=["user_id"], seq="version", form="window")
    return joined.select("event_id", F.col("model.version").alias("version"))


_TIMED = f"(SELECT e.*, v.model_name, CAST(floor(e.value * 10) AS BIGINT) AS took FROM {_ASSIGNED})"


def timed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Assigned events with a duration that does not depend on a clock."""
    return assigned_events(spark, sf_dir).select(
        "event_id", micros("ts").alias("at"), F.col("model.modelName").alias("model_name"),
        F.floor(F.col("value") * 10).cast("bigint").alias("took"),
    )


@query(f"""
SELECT model_name, count(*) AS score_count, sum(took)::BIGINT AS duration, min(took) AS min, max(took) AS max,
  epoch_us(min(ts)) AS since FROM {_TIMED} GROUP BY model_name
""")
def model_serving_stats(spark, sf_dir):
    return serving_stats(timed_events(spark, sf_dir), ["model_name"], "took", "at")


_RUNNING = f"""SELECT event_id, model_name, count(*) OVER w AS score_count, (sum(took) OVER w)::BIGINT AS duration_sum,
  min(took) OVER w AS duration_min, max(took) OVER w AS duration_max FROM {_TIMED}
  WINDOW w AS (PARTITION BY model_name ORDER BY ts, event_id)"""


def stats_so_far(spark, sf_dir):
    steps = running_stats(timed_events(spark, sf_dir), ["model_name"], ["at", "event_id"], "took")
    return steps.select("event_id", "model_name", "score_count", "duration_sum", "duration_min", "duration_max")


@query(_RUNNING)
def serving_stats_running(spark, sf_dir):
    return stats_so_far(spark, sf_dir)


@query(f"SELECT * FROM ({_RUNNING}) WHERE score_count % 100 = 0")
def serving_stats_every_100(spark, sf_dir):
    return every_nth(stats_so_far(spark, sf_dir), 100)


@query(f"""
SELECT model_name, count(*) AS score_count, sum(took)::BIGINT AS duration, min(took) AS min, max(took) AS max,
  epoch_us(min(ts)) AS since FROM {_TIMED} GROUP BY model_name ORDER BY since DESC LIMIT 1
""")
def serving_stats_current(spark, sf_dir):
    return current_stats(serving_stats(timed_events(spark, sf_dir), ["model_name"], "took", "at"))


def activations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of every activation of the event server; the last version starts after all events."""
    fresh = event_models(spark).where("modelName = 'gamma'").select(
        F.lit("fresh").alias("modelName"), "description", "modelType", "modelBytes", F.lit("2099-01-01").cast("timestamp_ntz").alias("valid_from"), F.lit(9).alias("seq"),
    )
    versions = registry.usable_versions(
        event_models(spark).select("modelName", "description", "modelType", "modelBytes", "modelSourceLocation", F.col("valid_from").cast("timestamp_ntz").alias("valid_from"), "seq")
        .unionByName(fresh, allowMissingColumns=True), WINE_TYPES,
    ).select(F.col("modelName").alias("model_name"), F.col("modelType").alias("model_type"), "description", micros("valid_from").alias("at"), "seq")
    return activation_stats(versions, timed_events(spark, sf_dir), ["model_name"], "took", "at")


_ACTIVATIONS = f"""(SELECT v.model_name, v.model_type, '' AS description, epoch_us(v.valid_from) AS since, coalesce(s.score_count, 0) AS score_count,
  coalesce(s.duration, 0)::BIGINT AS duration, s.least_took AS min, s.most_took AS max
FROM (SELECT model_name, valid_from, CASE model_name WHEN 'beta' THEN 'TENSORFLOW' ELSE 'PMML' END AS model_type FROM {EVENT_MODELS_SQL}
  UNION ALL SELECT 'fresh', TIMESTAMP '2099-01-01', 'PMML') v
LEFT JOIN (SELECT model_name, count(*) AS score_count, sum(took) AS duration, min(took) AS least_took, max(took) AS most_took
  FROM {_TIMED} GROUP BY model_name) s ON v.model_name = s.model_name
UNION ALL SELECT NULL, NULL, NULL, NULL, count(*), 0, NULL, NULL FROM {_TIMED} WHERE model_name IS NULL HAVING count(*) > 0)"""
_ACTIVATION_COLUMNS = ("model_name", "model_type", "description", "since", "score_count", "duration", "min", "max")


@query(f"SELECT * FROM {_ACTIVATIONS}")
def serving_stats_fresh_model(spark, sf_dir):
    return activations(spark, sf_dir).select(*_ACTIVATION_COLUMNS)


@query(f"SELECT * FROM {_ACTIVATIONS} WHERE model_name = 'fresh'")
def serving_stats_current_fresh(spark, sf_dir):
    return current_activation(activations(spark, sf_dir), ["since", "seq"]).select(*_ACTIVATION_COLUMNS)


@query("""
SELECT seq, NOT (coalesce(kind, '') IN ('PMML', 'TENSORFLOW') AND payload IS NOT NULL
  OR coalesce(kind, '') = 'TENSORFLOWSAVED' AND place IS NOT NULL) AS refused
FROM (SELECT seq, CASE WHEN seq % 11 = 0 THEN NULL ELSE modelType END AS kind, payload, modelSourceLocation AS place FROM """ + ORDER_DESCRIPTORS_SQL + """)
""")
def descriptor_checks_with_nulls(spark, sf_dir):
    """Descriptors with nulls in any field: what cannot become a model is refused, whatever else is missing."""
    null = F.lit(None).cast("string")
    d = order_descriptors(spark, sf_dir)
    odd = d.withColumns({
        "modelName": F.when(F.col("seq") % 3 == 0, null).otherwise(F.col("modelName")),
        "description": F.when(F.col("seq") % 5 == 0, null).otherwise(F.col("description")),
        "modelType": F.when(F.col("seq") % 11 == 0, null).otherwise(F.col("modelType")),
    })
    return check_descriptors(odd, WINE_TYPES).select("seq", F.col("error").isNotNull().alias("refused"))


@query("""
SELECT o_orderkey, CAST((o_custkey % 500) * 0.5 AS DOUBLE) + CAST((o_custkey % 7) AS DOUBLE) * o_totalprice AS score FROM orders
""")
def scored_by_many_versions(spark, sf_dir):
    """Every order scored by its own one of 3,500 linear versions, from a table of coefficients."""
    models = {f"v{i}-{j}": LinearModel(i * 0.5, (("o_totalprice", float(j)),)) for i in range(500) for j in range(7)}
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice", F.concat(F.lit("v"), (F.col("o_custkey") % 500).cast("string"), F.lit("-"), (F.col("o_custkey") % 7).cast("string")).alias("version")
    )
    return score_by_version(orders, "version", models).select("o_orderkey", F.col("score.value").alias("score"))


# Forests of many versions: version i has trees over price and customer with bounds that depend on i.
_FOREST_VERSIONS, _FOREST_TREES = 2_000, 5


def _order_forest(i: int) -> ForestModel:
    def split(name, bound, left, right):
        return tuple(replace(n, test=Test(name, op, float(bound))) for n, op in ((left, "lessOrEqual"), (right, "greaterThan")))

    def tree(t):
        price = Node(None, split("o_totalprice", 100_000 + 10 * i, Node(None, value=float(i)), Node(None, value=t + 0.5)))
        customer = Node(None, split("o_custkey", 100 * t + i % 7, Node(None, value=-1.0), Node(None, value=2.0)))
        return Node(None, split("o_totalprice", 50_000 * (t + 1), price, customer))

    return ForestModel(tuple(tree(t) for t in range(_FOREST_TREES)))


@query(f"""
SELECT o_orderkey, round((SELECT sum(CASE WHEN o_totalprice <= 50000 * (t + 1) THEN CASE WHEN o_totalprice <= 100000 + 10 * i THEN i::DOUBLE ELSE t + 0.5 END
    ELSE CASE WHEN o_custkey <= 100 * t + i % 7 THEN -1.0 ELSE 2.0 END END) FROM range({_FOREST_TREES}) r(t)) / {_FOREST_TREES}, 6) AS score
FROM (SELECT *, o_custkey % {_FOREST_VERSIONS} AS i FROM orders)
""")
def scored_by_many_forests(spark, sf_dir):
    """Every order scored by its own one of 2,000 forests, from arrays of their splits."""
    models = {i: _order_forest(i) for i in range(_FOREST_VERSIONS)}
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_custkey", (F.col("o_custkey") % _FOREST_VERSIONS).cast("int").alias("version"))
    return score_by_version(orders, "version", models).select("o_orderkey", F.round("score.value", 6).alias("score"))


class _PriceScorer:
    """A user's own model."""

    def load(self):
        self.factor = 0.001

    def score(self, batch):
        return [p * self.factor + 1 for p in batch["o_totalprice"]]

    def cleanup(self):
        pass


def _price_service(records, location):
    """Stands in for a remote service: knows no order whose key is a multiple of seven."""
    if any(r["o_orderkey"] % 7 == 0 for r in records):
        raise ValueError(f"unknown order at {location}")
    return [r["o_totalprice"] / 2 for r in records]


@query("""
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 1.0 + 2.0 * o_totalprice WHEN 'O' THEN round(o_totalprice * 0.001 + 1, 6)
  ELSE CASE WHEN o_orderkey % 7 = 0 THEN 0.0 ELSE o_totalprice / 2 END END::DOUBLE AS score,
  CASE WHEN o_orderstatus NOT IN ('F', 'O') AND o_orderkey % 7 = 0 THEN 'unknown order at stub' ELSE '' END AS errors FROM orders
""")
def scored_by_three_kinds(spark, sf_dir):
    """One server whose versions are a model, a user's scorer and a remote service."""
    handlers = {
        "F": LinearModel(1.0, (("o_totalprice", 2.0),)), "O": _PriceScorer, "P": lambda: RemoteScorer(_price_service, "stub"),
    }
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    scored = score_by_any_version(orders, "o_orderstatus", handlers)
    value = F.when(F.col("o_orderstatus") == "O", F.round("score.value", 6)).otherwise(F.col("score.value"))
    return scored.select("o_orderkey", value.alias("score"), F.col("score.errors").alias("errors"))


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 100 < 20 THEN 0 WHEN o_orderkey % 100 < 50 THEN 1 ELSE 2 END AS slot FROM orders
""")
def ab_split(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    draw = (F.col("o_orderkey") % 100).cast("int")
    return orders.select("o_orderkey", routing.choice([20, 30, 40], draw).alias("slot"))


@query("SELECT o_orderkey FROM orders WHERE o_orderkey % 100 <= 70")
def bernoulli_pick(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return orders.where(routing.picked(70, (F.col("o_orderkey") % 100).cast("int"))).select("o_orderkey")


_TASK_ROWS = 1_000


@query(f"""
SELECT 'flag' AS kind, l_returnflag AS key, count(*) AS records, true AS fits FROM lineitem GROUP BY l_returnflag
UNION ALL SELECT 'order', l_orderkey::VARCHAR, count(*), true FROM lineitem GROUP BY l_orderkey
""")
def partitioned_records(spark, sf_dir):
    """Records spread by key: an ordinary key (an order) is in one partition, a large one (a flag) in no more than it needs."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    out = []
    for kind, key in (("flag", "l_returnflag"), ("order", "l_orderkey")):
        spread = routing.partition_by_key(lines, [key], 64, _TASK_ROWS).withColumn("part", F.spark_partition_id())
        facts = spread.groupBy(key).agg(F.count(F.lit(1)).alias("records"), F.countDistinct("part").alias("parts"))
        fits = F.col("parts") <= F.least(F.lit(64), F.ceil(F.col("records") / _TASK_ROWS))
        # A large key has to be in several partitions, or the spreading did nothing.
        spreads = (F.col("records") <= 4 * _TASK_ROWS) | (F.col("parts") > 1)
        out.append(facts.select(F.lit(kind).alias("kind"), F.col(key).cast("string").alias("key"), "records", (fits & spreads).alias("fits")))
    return out[0].unionByName(out[1])


@query("SELECT event_id, user_id FROM events ORDER BY ts, event_id LIMIT 100")
def take_first_n(spark, sf_dir):
    return first_n(table(spark, sf_dir, "events"), 100, ["ts", "event_id"]).select("event_id", "user_id")

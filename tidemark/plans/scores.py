"""Queries that score the test tables with every model kind."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import functions as F, types as T

from tidemark.functions.envelope import double_result, envelope, metadata
from tidemark.operators.registry import load_models
from tidemark.plans.common import table
from tidemark.scoring.models import LinearModel
from tidemark.scoring.pmml import parse_pmml
from tidemark.scoring.remote import recommend, recommend_request, with_response
from tidemark.scoring.score import (
    load_model, missing_error, network_on_arrays, score_batches, score_by_version, score_with_all, with_score, with_value,
)
from tidemark.scoring.tables import parse_boosted, parse_network
from tidemark.session import shared_dir, spread
from tidemark.sources.binary import model_catalogue, read_bytes

QUERIES, ORACLE = {}, {}


def query(sql: str | None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return register


_ROW = ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"]
_ROWS = ", ".join(_ROW)


def lines(spark, sf_dir):
    return table(spark, sf_dir, "lineitem")


# --- PMML documents over line items -------------------------------------------------------------------------------

_HEAD = (
    '<PMML xmlns="http://www.dmg.org/PMML-4_3" version="4.3"><DataDictionary>'
    '<DataField name="grade" optype="categorical" dataType="string"><Value value="5"/><Value value="6"/><Value value="3"/></DataField>'
    "</DataDictionary>"
)
_TARGET = '<MiningSchema><MiningField name="grade" usageType="target"/></MiningSchema>'


def _leaf(test: str, counts: tuple[int, int, int]) -> str:
    shares = "".join(f'<ScoreDistribution value="{c}" recordCount="{n}"/>' for c, n in zip("563", counts))
    return f"<Node>{test}{shares}</Node>"


def _tree(bounds: tuple[float, float, float], leaves) -> str:
    """Depth-two tree: quantity first, then discount on the low side and tax on the high side."""
    q, d, t = bounds

    def test(field, op, bound):
        return f'<SimplePredicate field="{field}" operator="{op}" value="{bound}"/>'

    def node(head, *children):
        return f"<Node>{head}{''.join(children)}</Node>"

    low, high = "lessOrEqual", "greaterThan"
    return node(
        "<True/>",
        node(test("l quantity", low, q), _leaf(test("l discount", low, d), leaves[0]), _leaf(test("l discount", high, d), leaves[1])),
        node(test("l quantity", high, q), _leaf(test("l tax", low, t), leaves[2]), _leaf(test("l tax", high, t), leaves[3])),
    )


_TREES = (
    ((24.0, 0.05, 0.04), ((30, 10, 0), (5, 20, 15), (8, 8, 4), (1, 2, 7))),
    ((10.0, 0.02, 0.06), ((4, 4, 2), (10, 5, 5), (2, 16, 2), (3, 3, 14))),
    ((35.0, 0.08, 0.01), ((9, 6, 5), (2, 3, 5), (12, 4, 4), (0, 7, 3))),
)
TREE_PMML = f'{_HEAD}<TreeModel functionName="classification">{_TARGET}{_tree(*_TREES[0])}</TreeModel></PMML>'
FOREST_PMML = (
    f'{_HEAD}<MiningModel functionName="classification">{_TARGET}<Segmentation multipleModelMethod="average">'
    + "".join(
        f'<Segment><True/><TreeModel functionName="classification">{_tree(*spec)}</TreeModel></Segment>' for spec in _TREES
    )
    + "</Segmentation></MiningModel></PMML>"
)


def _tree_sql(bounds, values) -> str:
    """The same tree as plain SQL over the given four leaf values."""
    q, d, t = bounds
    return (
        f"CASE WHEN l_quantity <= {q} THEN CASE WHEN l_discount <= {d} THEN {values[0]} ELSE {values[1]} END "
        f"ELSE CASE WHEN l_tax <= {t} THEN {values[2]} ELSE {values[3]} END END"
    )


def _share(leaves, c):
    return [f"({leaf[c]}::DOUBLE / {sum(leaf)})" for leaf in leaves]


_TREE_SHARES = ", ".join(f"round({_tree_sql(_TREES[0][0], _share(_TREES[0][1], c))}, 6) AS p{c}" for c in range(3))
_TREE_LABELS = [f"'{'563'[max(range(3), key=lambda c: (leaf[c], -c))]}'" for leaf in _TREES[0][1]]


@query(f"SELECT {_ROWS}, {_tree_sql(_TREES[0][0], [x.strip(chr(39)) + '.0::DOUBLE' for x in _TREE_LABELS])} AS score FROM lineitem")
def score_tree(spark, sf_dir):
    return with_value(lines(spark, sf_dir), parse_pmml(TREE_PMML), "score").select(*_ROW, "score")


@query(f"SELECT {_ROWS}, {_tree_sql(_TREES[0][0], _TREE_LABELS)} AS label, {_TREE_SHARES} FROM lineitem")
def score_tree_proba(spark, sf_dir):
    scored = with_score(lines(spark, sf_dir), parse_pmml(TREE_PMML))
    return scored.select(
        *_ROW, F.col("score.label").alias("label"),
        *[F.round(F.col("score.probabilities")[c], 6).alias(f"p{c}") for c in range(3)],
    )


_FOREST_SHARES = ", ".join(
    "(" + " + ".join(f"({_tree_sql(b, _share(leaves, c))})" for b, leaves in _TREES) + f") / 3 AS q{c}" for c in range(3)
)


@query(f"""
SELECT {_ROWS}, CASE WHEN q0 >= q1 AND q0 >= q2 THEN 5.0 WHEN q1 >= q2 THEN 6.0 ELSE 3.0 END::DOUBLE AS score,
  round(q0, 6) AS p0, round(q1, 6) AS p1, round(q2, 6) AS p2 FROM (SELECT *, {_FOREST_SHARES} FROM lineitem)
""")
def score_forest(spark, sf_dir):
    scored = with_score(lines(spark, sf_dir), parse_pmml(FOREST_PMML))
    return scored.select(
        *_ROW, F.col("score.value").alias("score"),
        *[F.round(F.col("score.probabilities")[c], 6).alias(f"p{c}") for c in range(3)],
    )


LINEAR_PMML = (
    f'{_HEAD}<RegressionModel functionName="regression"><RegressionTable intercept="3.25">'
    '<NumericPredictor name="l quantity" coefficient="0.125"/><NumericPredictor name="l discount" coefficient="-4.5"/>'
    '<NumericPredictor name="l tax" coefficient="2.75"/></RegressionTable></RegressionModel></PMML>'
)


def _glm_pmml(link: str) -> str:
    betas = (("p0", 0.5), ("p1", 0.02), ("p2", -1.5), ("p3", 3.0))
    fields = (("p1", "l quantity"), ("p2", "l discount"), ("p3", "l tax"))
    return (
        f'{_HEAD}<GeneralRegressionModel modelType="generalizedLinear" functionName="regression" linkFunction="{link}"><PPMatrix>'
        + "".join(f'<PPCell value="1" predictorName="{f}" parameterName="{p}"/>' for p, f in fields)
        + "</PPMatrix><ParamMatrix>"
        + "".join(f'<PCell parameterName="{p}" beta="{b}"/>' for p, b in betas)
        + "</ParamMatrix></GeneralRegressionModel></PMML>"
    )


_GLM_SQL = "0.5 + 0.02 * l_quantity - 1.5 * l_discount + 3.0 * l_tax"


@query(f"SELECT {_ROWS}, round(3.25 + 0.125 * l_quantity - 4.5 * l_discount + 2.75 * l_tax, 6) AS score FROM lineitem")
def score_linear(spark, sf_dir):
    scored = with_value(lines(spark, sf_dir), parse_pmml(LINEAR_PMML), "score")
    return scored.select(*_ROW, F.round("score", 6).alias("score"))


@query(f"""
SELECT {_ROWS}, round({_GLM_SQL}, 6) AS identity, round(exp({_GLM_SQL}), 6) AS log, round(1 / ({_GLM_SQL}), 6) AS inverse,
  round(1 / (1 + exp(-({_GLM_SQL}))), 6) AS logit FROM lineitem
""")
def score_glm(spark, sf_dir):
    scored = lines(spark, sf_dir)
    links = ("identity", "log", "inverse", "logit")
    for link in links:
        scored = with_value(scored, parse_pmml(_glm_pmml(link)), link)
    return scored.select(*_ROW, *[F.round(link, 6).alias(link) for link in links])


# --- Networks over embeddings -------------------------------------------------------------------------------------


def _weight(i: int, j: int, k: int) -> float:
    return ((i * 31 + j * 17 + k * 7) % 19 - 9) / 4


def _layer(units: int, inputs: int, k: int, activation: str) -> dict:
    return {
        "weights": [[_weight(i, j, k) for j in range(inputs)] for i in range(units)],
        "bias": [_weight(i, 5, k) / 2 for i in range(units)], "activation": activation,
    }


_SMALL = {"inputs": [f"e{i}" for i in range(64)], "classes": ["5", "6"], "softmax": True, "single_inputs": False,
          "layers": [_layer(3, 64, 1, "logistic"), _layer(2, 3, 2, "identity")]}
_ONE_LAYER = {"inputs": [f"e{i}" for i in range(64)], "layers": [_layer(10, 64, 3, "logistic")]}
_WIDE = {"inputs": [f"e{i}" for i in range(64)], "layers": [_layer(32, 64, 4, "tanh"), _layer(10, 32, 5, "logistic")]}


def _dot(layer: dict, i: int, inputs: list[str]) -> str:
    terms = " + ".join(f"({w}::DOUBLE) * {x}" for w, x in zip(layer["weights"][i], inputs))
    return f"(({layer['bias'][i]}::DOUBLE) + {terms})"


_HIDDEN = ", ".join(
    f"1 / (1 + exp(-{_dot(_SMALL['layers'][0], i, [f'embedding[{j + 1}]::DOUBLE' for j in range(64)])})) AS h{i}" for i in range(3)
)
_OUT = ", ".join(f"{_dot(_SMALL['layers'][1], i, ['h0', 'h1', 'h2'])} AS z{i}" for i in range(2))


def _columns(df, n):
    return df.select("vec_id", *[F.get("embedding", F.lit(i)).cast("double").alias(f"e{i}") for i in range(n)])


@query(f"""
SELECT vec_id, CASE WHEN z0 >= z1 THEN 5.0 ELSE 6.0 END::DOUBLE AS score, round(1 / (1 + exp(z1 - z0)), 6) AS p0
FROM (SELECT vec_id, {_OUT} FROM (SELECT vec_id, {_HIDDEN} FROM embeddings))
""")
def score_mlp(spark, sf_dir):
    scored = with_score(_columns(table(spark, sf_dir, "embeddings"), 64), parse_network(json.dumps(_SMALL)))
    return scored.select("vec_id", F.col("score.value").alias("score"), F.round(F.col("score.probabilities")[0], 6).alias("p0"))


def _unit_sql(layer: dict, i: int, source: str) -> str:
    weights = ", ".join(f"{w}::DOUBLE" for w in layer["weights"][i])
    return f"(list_dot_product({source}, [{weights}]) + ({layer['bias'][i]}::DOUBLE))"


def _logistic(x: str) -> str:
    return f"1 / (1 + exp(-{x}))"


@query(f"""
SELECT vec_id, (list_position(o, list_max(o)) - 1)::DOUBLE AS score FROM (SELECT vec_id,
  [{', '.join(_logistic(_unit_sql(_ONE_LAYER['layers'][0], i, 'embedding::DOUBLE[]')) for i in range(10))}] AS o FROM embeddings)
""")
def score_dense_argmax(spark, sf_dir):
    scored = with_value(_columns(table(spark, sf_dir, "embeddings"), 64), parse_network(json.dumps(_ONE_LAYER)), "score")
    return scored.select("vec_id", "score")


@query(f"""
SELECT vec_id, (list_position(o, list_max(o)) - 1)::DOUBLE AS score, round(list_max(o), 6) AS top FROM (SELECT vec_id,
  [{', '.join(_logistic(_unit_sql(_WIDE['layers'][1], i, 'h')) for i in range(10))}] AS o FROM (SELECT vec_id,
  [{', '.join('tanh(' + _unit_sql(_WIDE['layers'][0], i, 'embedding::DOUBLE[]') + ')' for i in range(32))}] AS h FROM embeddings))
""")
def score_dense_batches(spark, sf_dir):
    """A network too wide for generated code: Arrow batches straight from the array column."""
    model = parse_network(json.dumps(_WIDE))
    scored = table(spark, sf_dir, "embeddings").select("vec_id", network_on_arrays(model)(F.col("embedding")).alias("s"))
    return scored.select("vec_id", F.col("s.value").alias("score"), F.round(F.array_max("s.probabilities"), 6).alias("top"))


# --- Boosted trees, many models, failures ---------------------------------------------------------------------------

BOOSTED = {
    "init": 0.1, "labels": ["NO", "YES"], "threshold": 0.5,
    "trees": [
        {"field": "o_orderpriority", "in": ["1-URGENT", "2-HIGH"], "left": {"leaf": 0.75}, "right":
            {"field": "o_totalprice", "below": 200000, "left": {"leaf": -0.5}, "right": {"leaf": 0.25}}},
        {"field": "o_orderstatus", "in": ["F"], "left": {"leaf": -0.625}, "right": {"leaf": 0.375}},
        {"field": "o_totalprice", "below": 350000, "left": {"leaf": -0.25}, "right": {"leaf": 0.5}},
    ],
}


@query("""
SELECT o_orderkey, CASE WHEN p >= 0.5 THEN 'YES' ELSE 'NO' END AS label, round(p, 6) AS probability FROM (
SELECT o_orderkey, 1 / (1 + exp(-(0.1
  + CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 0.75 WHEN o_totalprice < 200000 THEN -0.5 ELSE 0.25 END
  + CASE WHEN o_orderstatus = 'F' THEN -0.625 ELSE 0.375 END
  + CASE WHEN o_totalprice < 350000 THEN -0.25 ELSE 0.5 END))) AS p FROM orders)
""")
def score_boosted_binomial(spark, sf_dir):
    scored = with_score(table(spark, sf_dir, "orders"), parse_boosted(json.dumps(BOOSTED)))
    return scored.select("o_orderkey", F.col("score.label").alias("label"), F.round("score.value", 6).alias("probability"))


@query("""
SELECT p_partkey, 'linear' AS model, round(1.5 + 0.25 * p_size - 0.001 * p_retailprice, 6) AS value FROM part
UNION ALL SELECT p_partkey, 'logit', round(1 / (1 + exp(-(-2.0 + 0.08 * p_size))), 6) FROM part
UNION ALL SELECT p_partkey, 'boosted', round(1 / (1 + exp(-(0.5 + CASE WHEN p_size < 20 THEN -1.0 ELSE 1.0 END))), 6) FROM part
""")
def score_all_models(spark, sf_dir):
    models = {
        "linear": LinearModel(1.5, (("p_size", 0.25), ("p_retailprice", -0.001))),
        "logit": LinearModel(-2.0, (("p_size", 0.08),), "logit"),
        "boosted": parse_boosted(json.dumps({"init": 0.5, "labels": ["0", "1"], "trees": [
            {"field": "p_size", "below": 20, "left": {"leaf": -1.0}, "right": {"leaf": 1.0}}]})),
    }
    scored = score_with_all(table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_retailprice"), models)
    return scored.select("p_partkey", "model", F.round("value", 6).alias("value"))


@query(f"""
SELECT {_ROWS}, CASE WHEN l_tax = 0 THEN 0.0 ELSE round(1 / l_tax, 6) END::DOUBLE AS value,
  CASE WHEN l_tax = 0 THEN 'No prediction' ELSE '' END AS errors FROM lineitem
""")
def score_with_errors(spark, sf_dir):
    """A model that has no answer on some rows: the default value and an error text, and every row is kept."""
    model = LinearModel(0.0, (("l_tax", 1.0),), "inverse")
    scored = with_value(lines(spark, sf_dir).select(*_ROW, "l_tax"), model, "v")
    out = envelope(scored, [*_ROW, "l_tax"], double_result(F.col("v")), metadata(missing_error(F.col("v"), model.fields)))
    return out.select(
        *[F.col(f"inputRecord.{c}").alias(c) for c in _ROW], F.round("modelResult.value", 6).alias("value"),
        F.col("modelResultMetadata.errors").alias("errors"),
    )


@query(f"""
SELECT {_ROWS}, l_quantity AS "inputRecord_quantity", 3.25 + 0.125 * l_quantity AS value, '' AS errors, 'PMML' AS model_type,
  'linear' AS model_name, 1700000000000 AS start_time, 0 AS duration FROM lineitem
""")
def result_envelope(spark, sf_dir):
    model = LinearModel(3.25, (("l_quantity", 0.125),))
    scored = with_value(lines(spark, sf_dir).select(*_ROW, "l_quantity"), model, "v")
    meta = metadata(missing_error(F.col("v"), model.fields), F.lit("PMML"), F.lit("linear"), F.lit(1_700_000_000_000), F.lit(0))
    out = envelope(scored, [*_ROW, "l_quantity"], double_result(F.col("v")), meta)
    m = "modelResultMetadata"
    return out.select(
        *[F.col(f"inputRecord.{c}").alias(c) for c in _ROW], F.col("inputRecord.l_quantity").alias("inputRecord_quantity"),
        F.col("modelResult.value").alias("value"), F.col(f"{m}.errors").alias("errors"),
        F.col(f"{m}.modelType").alias("model_type"), F.col(f"{m}.modelName").alias("model_name"),
        F.col(f"{m}.startTime").alias("start_time"), F.col(f"{m}.duration").alias("duration"),
    )


class UnitPrice:
    """A user's scorer: loads once per task, works on batches, and fails on items with neither tax nor discount."""

    def load(self):
        self.message = "neither tax nor discount"

    def score(self, batch: pd.DataFrame):
        if ((batch["l_tax"] == 0) & (batch["l_discount"] == 0)).any():
            raise ValueError(self.message)
        return batch["l_extendedprice"] / batch["l_quantity"]

    def cleanup(self):
        self.message = None


@query(f"""
SELECT {_ROWS}, CASE WHEN l_tax = 0 AND l_discount = 0 THEN 0.0::DOUBLE ELSE l_extendedprice / l_quantity END AS unit_price,
  CASE WHEN l_tax = 0 AND l_discount = 0 THEN 'neither tax nor discount' ELSE '' END AS errors FROM lineitem
""")
def user_scorer(spark, sf_dir):
    """A user's Python model that fails on some rows of nearly every batch."""
    rows = spread(lines(spark, sf_dir).select(*_ROW, "l_quantity", "l_tax", "l_discount"))
    scored = score_batches(rows, UnitPrice, T.DoubleType(), 0.0, clock=lambda: 0)
    return scored.select(*_ROW, F.col("score.result").alias("unit_price"), F.col("score.errors").alias("errors"))


_BRAND_MODEL = "SELECT p_brand, min(p_retailprice) AS intercept, max(p_size) / 10.0 AS weight FROM part GROUP BY p_brand"


@query(f"""
SELECT p_partkey, round(m.intercept + m.weight::DOUBLE * p_size, 6) AS value FROM part p JOIN ({_BRAND_MODEL}) m ON p.p_brand = m.p_brand
""")
def catalogue_scores(spark, sf_dir):
    """One model file per brand, made from the parts; read back as a catalogue, loaded, and each part scored by its brand's."""
    parts = table(spark, sf_dir, "part")
    made = parts.groupBy("p_brand").agg(
        F.min("p_retailprice").cast("string").alias("intercept"), (F.max("p_size") / F.lit(10.0)).cast("string").alias("weight")
    )
    document = F.concat(
        F.lit('<PMML version="4.3"><RegressionModel functionName="regression"><RegressionTable intercept="'), "intercept",
        F.lit('"><NumericPredictor name="p size" coefficient="'), "weight", F.lit('"/></RegressionTable></RegressionModel></PMML>'),
    )
    root = shared_dir(spark, "models")
    made.select(F.replace("p_brand", F.lit("#"), F.lit("-")).alias("brand"), document.alias("value")).write.partitionBy("brand").text(root)
    # One row per brand.
    paths = [r.path for r in read_bytes(spark, [root]).select("path").collect()]
    catalogue = model_catalogue(spark, {"PMML": paths})
    versions = catalogue.withColumn("version_id", F.regexp_extract("modelName", "brand=([^/]*)/", 1))
    models, _ = load_models(versions, load_model)
    named = parts.select("p_partkey", "p_size", F.replace("p_brand", F.lit("#"), F.lit("-")).alias("brand"))
    return score_by_version(named, "brand", models).select("p_partkey", F.round("score.value", 6).alias("value"))


# --- Recommendations ------------------------------------------------------------------------------------------------

# A record is a customer with the parts bought from one hundred-part shelf, so that no list can grow with the data.
_BASKETS = (
    "(SELECT user, shelf, list(p ORDER BY p) AS products FROM (SELECT DISTINCT o_custkey AS user, l_partkey // 100 AS shelf, "
    "l_partkey AS p FROM lineitem JOIN orders ON l_orderkey = o_orderkey) GROUP BY user, shelf)"
)


def baskets(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("user"))
    bought = table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_partkey").alias("p"))
    joined = bought.join(orders, "l_orderkey")
    shelf = F.expr("p div 100")
    return joined.groupBy("user", shelf.alias("shelf")).agg(F.array_sort(F.collect_set("p")).alias("products"))


@query(f"""
SELECT user, shelf, '{{"signature_name":"","inputs":{{"products":[' || list_aggregate(list_transform(products, lambda p: '[' || p || ']'), 'string_agg', ',')
 || '],"users":[' || list_aggregate(list_transform(products, lambda p: '[' || user || ']'), 'string_agg', ',') || ']}}}}' AS request FROM {_BASKETS}
""")
def recommend_requests(spark, sf_dir):
    return baskets(spark, sf_dir).select("user", "shelf", recommend_request().alias("request"))


@query(f"""
SELECT user, shelf, coalesce(list_aggregate(list_transform(k, lambda p: p::VARCHAR), 'string_agg', ','), '') AS keys,
  coalesce(round(list_sum(list_transform(k, lambda p: (p % 97) / 100.0))::DOUBLE, 6), 0.0) AS total
FROM (SELECT user, shelf, CASE WHEN user % 3 = 0 THEN products[:len(products) - 1] ELSE products END AS k FROM {_BASKETS})
""")
def recommend_responses(spark, sf_dir):
    """Responses a row shorter than the products for some users, a row longer for others: the shorter side decides."""
    rows = F.transform("products", lambda p: F.array((p % 97) / 100.0, F.lit(0.5)))
    rows = (
        F.when(F.col("user") % 3 == 0, F.slice(rows, F.lit(1), F.size("products") - 1))
        .when(F.col("user") % 3 == 1, F.concat(rows, F.array(F.array(F.lit(9.0), F.lit(0.5))))).otherwise(rows)
    )
    body = F.to_json(F.struct(F.struct(F.array(F.lit("1")).alias("model-version"), rows.alias("recommendations")).alias("outputs")))
    parsed = with_response(baskets(spark, sf_dir).withColumn("body", body), "body", "r")
    total = F.aggregate("r.values", F.lit(0.0), lambda a, v: a + v)
    return parsed.select("user", "shelf", F.array_join("r.keys", ",").alias("keys"), F.round(total, 6).alias("total"))


def stub_service(requests, location):
    """Stands in for the remote service: refuses users that are multiples of ten."""
    replies = []
    for text in requests:
        inputs = json.loads(text)["inputs"]
        if inputs["users"][0][0] % 10 == 0:
            replies.append((500, f"no user {inputs['users'][0][0]} at {location}"))
        else:
            rows = [[(p % 97) / 100.0] for (p,) in inputs["products"]]
            replies.append((200, json.dumps({"outputs": {"model-version": ["1"], "recommendations": rows}})))
    return replies


_REMOTE_SQL = f"""
SELECT user, CASE WHEN user % 10 = 0 THEN 'Error processing serving request - code 500, error no user ' || user || ' at stub' ELSE '' END AS errors,
  CASE WHEN user % 10 = 0 THEN '' ELSE list_aggregate(list_transform(products, lambda p: p::VARCHAR), 'string_agg', ',') END AS keys,
  CASE WHEN user % 10 = 0 THEN 0.0 ELSE round(list_sum(list_transform(products, lambda p: (p % 97) / 100.0))::DOUBLE, 6) END AS total
FROM {_BASKETS}
"""


def _recommended(spark, sf_dir, **options):
    asked = baskets(spark, sf_dir).withColumn("location", F.lit("stub"))
    out = recommend(asked, stub_service, clock=lambda: 0, **options)
    total = F.aggregate("modelResult.values", F.lit(0.0), lambda a, v: a + v)
    return out.select(
        F.col("inputRecord.user").alias("user"), F.col("modelResultMetadata.errors").alias("errors"),
        F.array_join("modelResult.keys", ",").alias("keys"), F.round(total, 6).alias("total"),
    )


@query(_REMOTE_SQL)
def recommend_remote(spark, sf_dir):
    return _recommended(spark, sf_dir)


@query(_REMOTE_SQL)
def recommend_remote_in_flight(spark, sf_dir):
    """Four calls at a time in every task, equal requests of a batch sent once."""
    return _recommended(spark, sf_dir, in_flight=4, once=True, batch_rows=64)

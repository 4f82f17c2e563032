import json
import math
import os
import random
import sys
import time
from pathlib import Path

import pandas as pd
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F, types as T

from tidemark.functions.envelope import double_result, envelope, failed, metadata, succeeded
from tidemark.functions.features import AIRLINE_FEATURES, feature_vector, text_features
from tidemark.functions.parse import good_records, parse_lines, parse_wine
from tidemark.schemas import RECOMMENDER_RESULT, WINE_FEATURES, WINE_RECORD, WINE_RESULT, conform
from tidemark.scoring import score as scoring
from tidemark.scoring.models import ForestModel, Layer, LinearModel, NetworkModel, Node, Test as Split, TreeModel
from tidemark.scoring.pmml import UnsupportedModel, parse_pmml
from tidemark.scoring.remote import call_service, recommend, recommend_request, with_response
from tidemark.scoring.score import (
    load_model, missing_error, score_batches, score_by_version, score_with_all, with_score, with_value,
)
from tidemark.scoring.tables import parse_boosted, parse_network

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The ten records that the golden scores below belong to.
WINE_LINES = """7.4;0.7;0;1.9;0.076;11;34;0.9978;3.51;0.56;9.4;5
7.8;0.88;0;2.6;0.098;25;67;0.9968;3.2;0.68;9.8;5
7.8;0.76;0.04;2.3;0.092;15;54;0.997;3.26;0.65;9.8;5
11.2;0.28;0.56;1.9;0.075;17;60;0.998;3.16;0.58;9.8;6
7.4;0.7;0;1.9;0.076;11;34;0.9978;3.51;0.56;9.4;5
7.4;0.66;0;1.8;0.075;13;40;0.9978;3.51;0.56;9.4;5
7.9;0.6;0.06;1.6;0.069;15;59;0.9964;3.3;0.46;9.4;5
7.3;0.65;0;1.2;0.065;15;21;0.9946;3.39;0.47;10;7
7.8;0.58;0.02;2;0.073;9;18;0.9968;3.36;0.57;9.5;7
7.5;0.5;0.36;6.1;0.071;17;102;0.9978;3.35;0.8;10.5;5""".split("\n")

# Golden scores of seven public wine models: the all-zero record, then the ten records above.
GOLDEN = {
    "DecisionTreeClassification": [5, 5, 5, 5, 5, 5, 5, 5, 5, 5, 5],
    "DecisionTreeRegression": [5.073059361, 5.073059361, 5.180124224, 5.180124224, 5.558823529, 5.073059361,
                               5.073059361, 5.073059361, 5.206896552, 5.073059361, 5.679104478],
    "winequalityLinearRegression": [3.282519469, 5.178126058, 5.12334597, 5.240199907, 5.681472168, 5.178126058,
                                    5.211647019, 5.205664187, 5.347986286, 5.342460665, 5.700740496],
    "LinearRegressionGaussian": [37.788275171, 5.128828621, 5.158261347, 5.243528751, 5.733064367, 5.128828621,
                                 5.150123536, 5.193290084, 5.389697165, 5.361694952, 5.67382536],
    "LinearRegressionGamma": [2.558204953, 5.276014668, 5.372579851, 5.361234927, 5.60526341, 5.276014668,
                              5.271578364, 5.244083441, 5.510281381, 5.389904417, 5.415519733],
    "MultilayerPerceptron": [5, 5, 5, 5, 6, 5, 5, 5, 5, 5, 5],
    "RandonForrestClassification": [5, 5, 5, 5, 6, 5, 5, 5, 5, 5, 5],
}


def wine_rows(spark):
    lines = ["0;0;0;0;0;0;0;0;0;0;0"] + WINE_LINES
    df = spark.createDataFrame(list(enumerate(lines)), "i int, value string")
    return good_records(parse_lines(df, parse_wine), keep=("i",))


def golden_wine_scores(spark, folder):
    """Hold the seven public models in a folder against their golden scores."""
    models = {}
    for kind in GOLDEN:
        (path,) = folder.glob(f"*{kind}.pmml")
        models[kind] = load_model("PMML", path.read_bytes())
    rows = score_with_all(wine_rows(spark), models).collect()
    got = {(r.model, r.i): r.value for r in rows}
    for kind, values in GOLDEN.items():
        for i, value in enumerate(values):
            assert got[kind, i] == pytest.approx(value, abs=5e-9), (kind, i)
    # expression and batch forms of the network agree
    net = models["MultilayerPerceptron"]
    wine = wine_rows(spark)
    inputs = F.array(*[F.col(n.replace(" ", "_")) for n in net.inputs])
    both = with_score(wine, net).withColumn("batch", scoring.network_on_arrays(net)(inputs)).collect()
    for r in both:
        assert r.score.value == r.batch.value and r.score.label == r.batch.label
        assert r.score.probabilities == pytest.approx(r.batch.probabilities)


# The models are no part of the repository; where their folder is named, they are tested.
if "TIDEMARK_PMML_DIR" in os.environ:

    def test_golden_wine_scores(spark):
        golden_wine_scores(spark, Path(os.environ["TIDEMARK_PMML_DIR"]))


def _split_tree(rng, depth, classes):
    """A random tree as nested tuples: (field, bound, low side, high side) or leaf counts."""
    if not depth:
        return [rng.randint(0, 20) + (i == 0) for i in range(len(classes))]
    return (rng.choice(WINE_FEATURES), round(rng.uniform(0, 10), 3), _split_tree(rng, depth - 1, classes), _split_tree(rng, depth - 1, classes))


def _tree_xml(tree, test, classes):
    if isinstance(tree, list):
        shares = "".join(f'<ScoreDistribution value="{c}" recordCount="{n}"/>' for c, n in zip(classes, tree))
        return f'<Node score="{classes[tree.index(max(tree))]}">{test}{shares}</Node>'
    name, bound, low, high = tree
    field = name.replace("_", " ")
    sides = [(low, "lessOrEqual"), (high, "greaterThan")]
    inner = "".join(_tree_xml(t, f'<SimplePredicate field="{field}" operator="{op}" value="{bound}"/>', classes) for t, op in sides)
    return f'<Node score="{classes[0]}">{test}{inner}</Node>'


def _tree_shares(tree, row):
    while not isinstance(tree, list):
        name, bound, low, high = tree
        tree = low if row[name] <= bound else high
    return [n / sum(tree) for n in tree]


def _document(body, classes):
    values = "".join(f'<Value value="{c}"/>' for c in classes)
    fields = "".join(f'<DataField name="{n.replace("_", " ")}" optype="continuous" dataType="double"/>' for n in WINE_FEATURES)
    return (f'<PMML version="4.3"><DataDictionary><DataField name="grade" optype="categorical" dataType="string">{values}</DataField>{fields}'
            f"</DataDictionary>{body}</PMML>")


_SCHEMA = '<MiningSchema><MiningField name="grade" usageType="target"/>' + "".join(
    f'<MiningField name="{n.replace("_", " ")}"/>' for n in WINE_FEATURES) + "</MiningSchema>"


def test_models_of_real_size_against_loops(spark):
    """A six-class tree of depth 5, ten such trees averaged, and an 11-10-20-6 network, all from PMML documents."""
    rng, classes = random.Random(11), ["5", "6", "7", "4", "8", "3"]
    rows = [{n: round(rng.uniform(0, 10), 2) for n in WINE_FEATURES} | {"i": i} for i in range(60)]
    df = spark.createDataFrame(rows)
    trees = [_split_tree(rng, 5, classes) for _ in range(10)]
    xml = [f'<TreeModel functionName="classification">{_SCHEMA}{_tree_xml(t, "<True/>", classes)}</TreeModel>' for t in trees]
    forest = "".join(f'<Segment id="{i}"><True/>{x}</Segment>' for i, x in enumerate(xml))
    forest = f'<MiningModel functionName="classification">{_SCHEMA}<Segmentation multipleModelMethod="average">{forest}</Segmentation></MiningModel>'
    sizes = [11, 10, 20, 6]
    weights = [[[round(rng.uniform(-1, 1), 3) for _ in range(a)] for _ in range(b)] for a, b in zip(sizes, sizes[1:])]
    biases = [[round(rng.uniform(-1, 1), 3) for _ in range(b)] for b in sizes[1:]]
    inputs = "".join(f'<NeuralInput id="0,{i}"><DerivedField optype="continuous" dataType="double"><FieldRef field="{n.replace("_", " ")}"/></DerivedField></NeuralInput>'
                     for i, n in enumerate(WINE_FEATURES))
    layers = ""
    for d, (w, b) in enumerate(zip(weights, biases), start=1):
        neurons = "".join(f'<Neuron id="{d},{i}" bias="{b[i]}">' + "".join(f'<Con from="{d - 1},{j}" weight="{x}"/>' for j, x in enumerate(row)) + "</Neuron>"
                          for i, row in enumerate(w))
        last = ' activationFunction="identity" normalizationMethod="softmax"' if d == 3 else ""
        layers += f"<NeuralLayer{last}>{neurons}</NeuralLayer>"
    outputs = "".join(f'<NeuralOutput outputNeuron="3,{i}"><DerivedField optype="categorical" dataType="string"><NormDiscrete field="grade" value="{c}"/></DerivedField></NeuralOutput>'
                      for i, c in enumerate(classes))
    net = (f'<NeuralNetwork functionName="classification" activationFunction="logistic">{_SCHEMA}<NeuralInputs>{inputs}</NeuralInputs>{layers}'
           f"<NeuralOutputs>{outputs}</NeuralOutputs></NeuralNetwork>")
    models = {"tree": parse_pmml(_document(xml[0], classes)), "forest": parse_pmml(_document(forest, classes)), "net": parse_pmml(_document(net, classes))}

    def expected(kind, row):
        if kind == "tree":
            return _tree_shares(trees[0], row)
        if kind == "forest":
            each = [_tree_shares(t, row) for t in trees]
            return [sum(s) / len(each) for s in zip(*each)]
        values = [row[n] for n in WINE_FEATURES]
        for d, (w, b) in enumerate(zip(weights, biases)):
            values = [x + sum(a * v for a, v in zip(ws, values)) for ws, x in zip(w, b)]
            values = [1 / (1 + math.exp(-v)) for v in values] if d < 2 else values
        top = max(values)
        powers = [math.exp(v - top) for v in values]
        return [p / sum(powers) for p in powers]

    for kind, model in models.items():
        for r in with_score(df, model).collect():
            want = expected(kind, rows[r.i])
            assert r.score.probabilities == pytest.approx(want), kind
            assert r.score.label == classes[max(range(6), key=lambda c: (round(want[c], 12), -c))], kind
            assert r.score.value == float(r.score.label)


def test_word_labels_have_no_value_in_either_form(spark):
    layer = Layer(((1.0, 0.0), (0.0, 1.0)), (0.0, 0.0), "identity")
    net = NetworkModel(("a", "b"), (layer,), ("low", "2"))
    df = spark.sql("SELECT * FROM VALUES (1.0D, 0.0D), (0.0D, 1.0D) AS t(a, b)")
    both = with_score(df, net).withColumn("batch", scoring.network_on_arrays(net)(F.array("a", "b"))).collect()
    assert [(r.score.value, r.batch.value) for r in both] == [(None, None), (2.0, 2.0)]
    assert [(r.score.label, r.batch.label) for r in both] == [("low", "low"), ("2", "2")]


def test_many_versions_score_alike_in_all_forms(spark):
    linear = {f"v{i}": LinearModel(float(i), (("x", i / 2), ("y", 1.0)), "logit" if i % 2 else "identity") for i in range(40)}
    tree = Node(None, (Node(Split("x", "lessOrEqual", 5.0), value=1.0), Node(Split("x", "greaterThan", 5.0), value=2.0)))
    models = linear | {"tree": TreeModel(tree, ()), "net": NetworkModel(("x", "y"), (Layer(((1.0, 2.0),), (0.5,), "tanh"),))}
    rows = [(f"v{i % 45}" if i % 5 else ("tree", "net", None)[i % 3], float(i % 11), None if i % 13 == 0 else float(i % 7)) for i in range(400)]
    df = spark.createDataFrame(rows, "version string, x double, y double").withColumn("m", F.create_map(F.lit("k"), "x"))
    few = score_by_version(df, "version", models, compiled=5)
    many = score_by_version(df, "version", models, compiled=1000)
    assert few.columns == many.columns == [*df.columns, "score"]
    assert sorted(map(str, few.collect())) == sorted(map(str, many.collect()))
    one = {r.version: r for r in many.where("version = 'v3' AND x = 4 AND y IS NOT NULL").collect()}
    assert one["v3"].score.value == pytest.approx(1 / (1 + math.exp(-(3.0 + 1.5 * 4 + one["v3"].y))))


PMML_HEAD = """<PMML xmlns="http://www.dmg.org/PMML-4_3" version="4.3"><DataDictionary>
<DataField name="grade" optype="categorical" dataType="string"><Value value="3"/><Value value="7"/></DataField>
<DataField name="free acid" optype="continuous" dataType="double"/></DataDictionary>"""
TREE_PMML = PMML_HEAD + """<TreeModel functionName="classification"><MiningSchema>
<MiningField name="grade" usageType="target"/><MiningField name="free acid"/></MiningSchema>
<Node score="3" recordCount="10"><True/>
 <Node score="7" recordCount="4"><SimplePredicate field="free acid" operator="lessOrEqual" value="1.5"/>
  <ScoreDistribution value="7" recordCount="3"/><ScoreDistribution value="3" recordCount="1"/></Node>
 <Node score="3" recordCount="6"><SimplePredicate field="free acid" operator="greaterThan" value="1.5"/>
  <ScoreDistribution value="3" recordCount="6"/></Node></Node></TreeModel></PMML>"""


def test_pmml_tree_with_field_renaming_and_missing_values(spark):
    model = parse_pmml(TREE_PMML)
    df = spark.sql("SELECT * FROM VALUES (1, 1.5D), (2, 1.6D), (3, CAST(NULL AS DOUBLE)) AS t(i, free_acid)")
    scored = with_score(df, model).withColumn("error", missing_error(F.col("score.value"), model.fields))
    got = {r.i: r for r in scored.collect()}
    assert (got[1].score.value, got[1].score.label, got[1].score.probabilities) == (7.0, "7", [0.25, 0.75])
    assert (got[2].score.value, got[2].score.probabilities) == (3.0, [1.0, 0.0])
    assert got[3].score.value is None and got[3].error == "Missing value for free acid" and got[1].error is None


@pytest.mark.parametrize(
    "bad",
    ["nonsense", "<PMML/>", TREE_PMML.replace("lessOrEqual", "isMissing"),
     TREE_PMML.replace("<TreeModel ", '<TreeModel missingValueStrategy="defaultChild" ')],
)
def test_unsupported_documents_are_refused(bad):
    with pytest.raises(UnsupportedModel):
        parse_pmml(bad)


def random_tree(rng, depth, classes):
    def grow(split, d):
        if d == 0 or rng.random() < 0.1:
            counts = tuple(float(rng.randrange(1, 30)) for _ in classes)
            return Node(split, value=rng.random(), counts=counts)
        name, bound = rng.choice("abc"), rng.random()
        return Node(split, (grow(Split(name, "lessOrEqual", bound), d - 1), grow(Split(name, "greaterThan", bound), d - 1)))

    return grow(None, depth)


def descend(node, row):
    while node.children:
        node = next(c for c in node.children if (row[c.test.name] <= c.test.bound) == (c.test.op == "lessOrEqual"))
    return node


def test_random_trees_and_forests_match_a_walk(spark):
    rng = random.Random(11)
    rows = [{"a": rng.random(), "b": rng.random(), "c": rng.random(), "i": i} for i in range(300)]
    df = spark.createDataFrame(pd.DataFrame(rows))
    classes = ("4", "6", "9")
    trees = tuple(random_tree(rng, 5, classes) for _ in range(7))
    forest = {r.i: r.score for r in with_score(df, ForestModel(trees, classes)).collect()}
    mean = {r.i: r.score for r in with_value(df, ForestModel(trees), "score").collect()}
    tree = {r.i: r.score for r in with_score(df, TreeModel(trees[0], classes)).collect()}
    for row in rows:
        leaves = [descend(t, row) for t in trees]
        shares = [sum(x.counts[c] / sum(x.counts) for x in leaves) / 7 for c in range(3)]
        got = forest[row["i"]]
        assert got.probabilities == pytest.approx(shares)
        assert got.label == classes[shares.index(max(shares))] and got.value == float(got.label)
        assert mean[row["i"]] == pytest.approx(sum(x.value for x in leaves) / 7)
        first = leaves[0].counts
        assert tree[row["i"]].label == classes[first.index(max(first))]


def test_wide_forest_stays_in_generated_code(spark):
    rng = random.Random(5)
    classes = tuple(str(i) for i in range(6))
    df = spark.range(50).select(F.rand(1).alias("a"), F.rand(2).alias("b"), F.rand(3).alias("c"))
    model = ForestModel(tuple(random_tree(rng, 5, classes) for _ in range(10)), classes)
    plan = with_score(df, model)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "*(" in plan


def test_linear_links(spark):
    df = spark.sql("SELECT 2.0D AS x, 0.5D AS y")
    z = 0.5 + 2.0 * 0.25 - 0.5
    for link, expected in {"identity": z, "log": math.exp(z), "inverse": 1 / z, "logit": 1 / (1 + math.exp(-z))}.items():
        model = LinearModel(0.5, (("x", 0.25), ("y", -1.0)), link)
        assert with_value(df, model, "v").first().v == pytest.approx(expected)
    zero = LinearModel(0.0, (("x", 0.0),), "inverse")
    assert with_value(df, zero, "v").first().v is None  # an error value, not a failed job


def test_networks_expression_and_batch_agree(spark, monkeypatch):
    rng = random.Random(2)
    weights = lambda n, m: tuple(tuple(rng.uniform(-2, 2) for _ in range(m)) for _ in range(n))
    bias = lambda n: tuple(rng.uniform(-1, 1) for _ in range(n))
    layers = (Layer(weights(6, 4), bias(6), "tanh"), Layer(weights(5, 6), bias(5), "rectifier"), Layer(weights(3, 5), bias(3), "logistic"))
    model = NetworkModel(("a", "b", "c", "d"), layers, single_inputs=True)
    df = spark.range(200).select("id", *[F.rand(i).alias(n) for i, n in enumerate("abcd")])
    df = df.withColumn("a", F.when(F.col("id") != 7, F.col("a")))
    one = {r.id: r.score for r in with_score(df, model).collect()}
    monkeypatch.setattr(scoring, "EXPRESSION_WEIGHTS", 0)
    two = {r.id: r.score for r in with_score(df, model).collect()}
    assert one[7].value is None and two[7].value is None
    for i in set(one) - {7}:
        assert one[i].value == two[i].value and one[i].probabilities == pytest.approx(two[i].probabilities)
        assert one[i].value == one[i].probabilities.index(max(one[i].probabilities))


def test_first_maximum_wins(spark):
    model = parse_network(json.dumps({"inputs": ["a"], "layers": [{"weights": [[0], [1], [1]], "bias": [0, 0, 0], "activation": "logistic"}]}))
    df = spark.sql("SELECT 2.0D AS a")
    assert with_value(df, model, "v").first().v == 1.0


BOOSTED = {
    "init": -0.25, "labels": ["NO", "YES"],
    "trees": [
        {"field": "UniqueCarrier", "in": ["US", "AA"], "left": {"leaf": 0.75}, "right": {"leaf": -0.5}},
        {"field": "Month", "below": 6, "left": {"leaf": 0.125}, "right": {"leaf": -1.0}},
    ],
}


def test_boosted_trees(spark):
    df = spark.sql("SELECT * FROM VALUES (1, 'US', 1), (2, 'DL', 1), (3, 'AA', 6), (4, NULL, 1) AS t(i, UniqueCarrier, Month)")
    model = parse_boosted(json.dumps(BOOSTED))
    got = {r.i: r.score for r in with_score(df, model).collect()}
    logistic = lambda z: 1 / (1 + math.exp(-z))
    assert got[1].label == "YES" and got[1].value == pytest.approx(logistic(0.625))
    assert got[2].label == "NO" and got[2].value == pytest.approx(logistic(-0.625))
    assert got[3].label == "NO" and got[3].value == pytest.approx(logistic(-0.5))
    assert got[4].value is None
    three = parse_boosted(json.dumps({**BOOSTED, "labels": ["NO", "YES", "MAYBE"]}))
    assert with_value(df.where("i = 1"), three, "p").first().p == 0.0


def test_scoring_by_version_runs_each_model_on_its_rows(spark):
    df = spark.sql("SELECT id, CAST(id AS DOUBLE) AS x, CASE id % 3 WHEN 0 THEN 'a' WHEN 1 THEN 'b' END AS version FROM range(9)")
    net = parse_network(json.dumps({"inputs": ["x"], "layers": [{"weights": [[1], [-1]], "bias": [0, 0]}]}))
    models = {"a": LinearModel(1.0, (("x", 2.0),)), "b": net}
    got = {r.id: r.score.value for r in score_by_version(df, "version", models).collect()}
    for i in range(9):
        assert got[i] == (1.0 + 2.0 * i if i % 3 == 0 else (0.0 if i % 3 == 1 else None))


class Fussy:
    def load(self):
        self.loaded = True

    def score(self, batch):
        assert self.loaded
        if (batch["x"] == 3).any():
            raise ValueError("no threes")
        return batch["x"] * 10.0

    def cleanup(self):
        self.loaded = False


class Broken(Fussy):
    def load(self):
        raise RuntimeError("cannot load")


def test_user_scorers_fail_row_by_row(spark):
    df = spark.range(6).select(F.col("id").alias("x"))
    ticks = lambda: 1000
    got = {r.x: r.score for r in score_batches(df, Fussy, T.DoubleType(), 0.0, clock=ticks).collect()}
    assert [got[i].result for i in range(6)] == [0.0, 10.0, 20.0, 0.0, 40.0, 50.0]
    assert got[3].errors == "no threes" and got[2].errors == "" and got[2].start_ms == 1000 and got[2].duration_ms == 0
    assert {r.score.errors for r in score_batches(df, Broken, T.DoubleType(), 0.0).collect()} == {"cannot load"}


def own_rows(spark):
    """Invented records; the first has no alcohol."""
    lines = [";".join(str(round(1.1 * i + k / 8, 3)) for k in range(10)) + f";{3 * i}" for i in range(4)]
    df = spark.createDataFrame(list(enumerate(lines)), "i int, value string")
    return good_records(parse_lines(df, parse_wine), keep=("i",))


def test_envelope_and_split(spark):
    wine = own_rows(spark).drop("i").withColumn("alcohol", F.when(F.col("alcohol") > 0, F.col("alcohol")))
    model = LinearModel(0.0, (("alcohol", 1.0),))
    scored = with_value(wine, model, "v")
    meta = metadata(missing_error(F.col("v"), model.fields), F.lit("PMML"), F.lit("m"), F.lit(5), F.lit(2))
    out = conform(envelope(scored, WINE_RECORD.names, double_result(F.col("v")), meta), WINE_RESULT)
    assert succeeded(out).count() == 3 and failed(out).count() == 1
    bad = failed(out).first()
    assert bad.modelResult.value == 0.0 and bad.modelResultMetadata.errors == "Missing value for alcohol"
    assert bad.modelResultMetadata.modelName == "m" and bad.modelResultMetadata.startTime == 5
    empty = spark.range(1).select(metadata().alias("m")).first().m
    assert empty.asDict() == {"errors": "", "modelType": "UNKNOWN", "modelName": "", "startTime": 0, "duration": 0}


def test_projections(spark):
    wine = own_rows(spark)
    vector = wine.where("i = 1").select(feature_vector().alias("v")).first().v
    assert len(vector) == 11 and vector[0] == pytest.approx(1.1, abs=1e-6) and vector[0] != 1.1
    flights = spark.createDataFrame([(1990, 1, 3, 3, 1630, "US", "CMH", "IND", 9)], ", ".join(
        f"{n} {'string' if n in ('uniqueCarrier', 'origin', 'destination') else 'int'}" for n in [*AIRLINE_FEATURES.values(), "other"]))
    assert text_features(flights).first().asDict() == {
        "Year": "1990", "Month": "1", "DayofMonth": "3", "DayOfWeek": "3", "CRSDepTime": "1630", "UniqueCarrier": "US",
        "Origin": "CMH", "Dest": "IND"}


def service(requests, location):
    out = []
    for text in requests:
        body = json.loads(text)["inputs"]
        users = [u for (u,) in body["users"]]
        if users and users[0] == 13:
            raise RuntimeError("unlucky")
        if users and users[0] == 50:
            out.append((503, "busy"))
        else:
            out.append((200, json.dumps({"outputs": {"model-version": ["1"], "recommendations": [[p / 100] for (p,) in body["products"]]}})))
    return out


def test_remote_recommendations(spark):
    df = spark.createDataFrame([(10, [1, 2, 3, 4]), (50, [5]), (13, [6]), (11, [7])], "user bigint, products array<bigint>")
    text = df.where("user = 10").select(recommend_request().alias("r")).first().r
    assert text == '{"signature_name":"","inputs":{"products":[[1],[2],[3],[4]],"users":[[10],[10],[10],[10]]}}'
    out = recommend(df.withColumn("location", F.lit("http://x")), service, clock=lambda: 7)
    rows = {r.inputRecord.user: r for r in conform(out, RECOMMENDER_RESULT).collect()}
    assert rows[10].modelResult.keys == ["1", "2", "3", "4"] and rows[10].modelResult["values"] == [0.01, 0.02, 0.03, 0.04]
    assert rows[50].modelResultMetadata.errors == "Error processing serving request - code 503, error busy"
    assert rows[50].modelResult.keys == [] and rows[13].modelResultMetadata.errors == "unlucky"
    assert rows[11].modelResultMetadata.errors == "" and rows[11].modelResult.keys == ["7"]
    assert call_service(df.withColumn("request", F.lit("{")).withColumn("location", F.lit("l")), lambda r, l: [(200, "x")] * len(r), batch_rows=1).count() == 4


def test_requests_in_flight(spark, tmp_path):
    """Several calls at a time, equal requests once, busy and failing ones again: the serial form's replies in its order."""
    log = str(tmp_path / "log")

    def note(line):
        at = os.open(log, os.O_CREAT | os.O_APPEND | os.O_WRONLY)
        os.write(at, (line + "\n").encode())
        os.close(at)

    def transport(requests, place):
        note("begin")
        for r in requests:
            note(f"asked {r}")
        time.sleep(0.05)
        asked = [open(log).read().split("\n").count(f"asked {r}") for r in requests]
        note("end")
        if any(r == "bad" for r in requests):
            raise RuntimeError("bad request")
        return [(503, "later") if r == "busy" and n <= 2 else (200, r + place) for r, n in zip(requests, asked)]

    texts = ["busy", "bad"] + [f"r{i // 3}" for i in range(118)]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "i int, request string, location string").coalesce(1)
    options = dict(batch_rows=6, clock=lambda: 5)
    many = call_service(df, transport, in_flight=4, once=True, retries=1, backoff_s=0.01, **options).collect()
    lines = open(log).read().split("\n")
    os.remove(log)
    serial = call_service(df, transport, **options).collect()
    assert [r.i for r in many] == [r.i for r in serial] == list(range(120))
    assert many[0].reply.body == "busyx" and many[1].reply.failure == serial[1].reply.failure == "bad request"
    assert [r.reply for r in many[2:]] == [r.reply for r in serial[2:]]
    running = [sum(1 if x == "begin" else -1 if x == "end" else 0 for x in lines[:k]) for k in range(len(lines))]
    assert 2 <= max(running) <= 4
    # Twenty batches of six with two to three different texts; the first is sent whole, then one by one, then in part again.
    assert len([x for x in lines if x.startswith("asked r")]) < 70
    with pytest.raises(ValueError, match="at least"):
        call_service(df, transport, in_flight=0)


def test_shorter_side_of_a_response_wins(spark):
    body = '{"outputs":{"model-version":["1"],"recommendations":[[0.5,9],[0.25],[0.125]]}}'
    df = spark.createDataFrame([(body, [8, 9]), (body, [1, 2, 3, 4]), ("junk", [1])], "b string, products array<bigint>")
    got = [r.x for r in with_response(df, "b", "x").collect()]
    assert (got[0]["keys"], got[0]["values"]) == (["8", "9"], [0.5, 0.25])
    assert (got[1]["keys"], got[1]["values"]) == (["1", "2", "3"], [0.5, 0.25, 0.125]) and got[2] is None

"""PMML 4 documents to model tables: trees, tree averages, linear and generalised linear models, dense networks."""

from __future__ import annotations

import xml.etree.ElementTree as ET

from tidemark.scoring.models import ForestModel, Layer, LinearModel, Model, NetworkModel, Node, Test, TreeModel


class UnsupportedModel(ValueError):
    """The document holds something other than the model kinds that are compiled."""


def _bare(element: ET.Element) -> ET.Element:
    for e in element.iter():
        e.tag = e.tag.rsplit("}", 1)[-1]
    return element


def parse_pmml(document: bytes | str) -> Model:
    try:
        root = _bare(ET.fromstring(document))
    except ET.ParseError as e:
        raise UnsupportedModel(f"not an XML document: {e}") from e
    categories = {
        f.get("name"): tuple(v.get("value") for v in f.findall("Value")) for f in root.iterfind("DataDictionary/DataField")
    }
    for kind, read in _READERS.items():
        model = root.find(kind)
        if model is not None:
            return read(model, categories)
    raise UnsupportedModel(f"no supported model among {[e.tag for e in root]}")


def _classes(model: ET.Element, categories: dict) -> tuple[str, ...]:
    if model.get("functionName") != "classification":
        return ()
    for f in model.iterfind("MiningSchema/MiningField"):
        if f.get("usageType") in ("target", "predicted"):
            return categories[f.get("name")]
    raise UnsupportedModel("classification without a target field")


def _test(node: ET.Element) -> Test | None:
    if node.find("True") is not None:
        return None
    simple = node.find("SimplePredicate")
    if simple is not None:
        op = simple.get("operator")
        if op not in ("lessOrEqual", "lessThan", "greaterThan", "greaterOrEqual"):
            raise UnsupportedModel(f"operator {op}")
        return Test(simple.get("field"), op, float(simple.get("value")))
    members = node.find("SimpleSetPredicate")
    if members is not None:
        values = tuple(v.strip('"') for v in members.findtext("Array").split())
        return Test(members.get("field"), "in" if members.get("booleanOperator") == "isIn" else "notIn", values)
    raise UnsupportedModel("a tree node without a simple test")


def _node(element: ET.Element, classes: tuple[str, ...], top: bool) -> Node:
    test = _test(element)
    if test is None and not top:
        raise UnsupportedModel("an always-true test below the root")
    children = tuple(_node(c, classes, False) for c in element.findall("Node"))
    if children:
        return Node(test, children)
    if not classes:
        return Node(test, value=float(element.get("score")))
    counts = {d.get("value"): float(d.get("recordCount")) for d in element.findall("ScoreDistribution")}
    if not counts:
        counts = {element.get("score"): 1.0}
    return Node(test, label=element.get("score"), counts=tuple(counts.get(c, 0.0) for c in classes))


def _root(model: ET.Element, classes: tuple[str, ...]) -> Node:
    if model.get("missingValueStrategy", "none") != "none":
        raise UnsupportedModel("missingValueStrategy")
    return _node(model.find("Node"), classes, True)


def _tree(model: ET.Element, categories: dict) -> TreeModel:
    classes = _classes(model, categories)
    return TreeModel(_root(model, classes), classes)


def _ensemble(model: ET.Element, categories: dict) -> ForestModel:
    segmentation = model.find("Segmentation")
    if segmentation is None or segmentation.get("multipleModelMethod") != "average":
        raise UnsupportedModel("only averaged segments")
    classes = _classes(model, categories)
    trees = []
    for segment in segmentation.findall("Segment"):
        if segment.find("True") is None or segment.find("TreeModel") is None:
            raise UnsupportedModel("only segments that are always-on trees")
        trees.append(_root(segment.find("TreeModel"), classes))
    return ForestModel(tuple(trees), classes)


def _regression(model: ET.Element, categories: dict) -> LinearModel:
    tables = model.findall("RegressionTable")
    if len(tables) != 1 or model.get("normalizationMethod", "none") != "none":
        raise UnsupportedModel("only one plain regression table")
    predictors = tables[0].findall("NumericPredictor")
    if any(p.get("exponent", "1") != "1" for p in predictors) or len(tables[0]) != len(predictors):
        raise UnsupportedModel("only first-order numeric predictors")
    terms = tuple((p.get("name"), float(p.get("coefficient"))) for p in predictors)
    return LinearModel(float(tables[0].get("intercept", "0")), terms)


def _general_regression(model: ET.Element, categories: dict) -> LinearModel:
    link = model.get("linkFunction", "identity")
    if model.get("modelType") != "generalizedLinear" or link not in ("identity", "log", "inverse", "logit"):
        raise UnsupportedModel(f"general regression {model.get('modelType')} with link {link}")
    fields: dict[str, str] = {}
    for cell in model.iterfind("PPMatrix/PPCell"):
        if cell.get("value") != "1" or cell.get("parameterName") in fields:
            raise UnsupportedModel("only one first-order predictor per parameter")
        fields[cell.get("parameterName")] = cell.get("predictorName")
    intercept, terms = 0.0, []
    for cell in model.iterfind("ParamMatrix/PCell"):
        name, beta = cell.get("parameterName"), float(cell.get("beta"))
        if name in fields:
            terms.append((fields[name], beta))
        else:
            intercept += beta
    return LinearModel(intercept, tuple(terms), link)


def _network(model: ET.Element, categories: dict) -> NetworkModel:
    place, inputs = {}, []
    for i, item in enumerate(model.iterfind("NeuralInputs/NeuralInput")):
        ref = item.find("DerivedField/FieldRef")
        if ref is None:
            raise UnsupportedModel("only plain input fields")
        place[item.get("id")] = i
        inputs.append(ref.get("field"))
    method = model.get("normalizationMethod", "none")
    layers, before = [], place
    for element in model.findall("NeuralLayer"):
        method = element.get("normalizationMethod", model.get("normalizationMethod", "none"))
        here, weights, bias = {}, [], []
        for j, neuron in enumerate(element.findall("Neuron")):
            row = [0.0] * len(before)
            for link in neuron.findall("Con"):
                row[before[link.get("from")]] = float(link.get("weight"))
            weights.append(tuple(row))
            bias.append(float(neuron.get("bias", "0")))
            here[neuron.get("id")] = j
        activation = element.get("activationFunction", model.get("activationFunction"))
        if activation not in ("identity", "logistic", "tanh", "rectifier"):
            raise UnsupportedModel(f"activation {activation}")
        layers.append(Layer(tuple(weights), tuple(bias), activation))
        before = here
    if method not in ("none", "softmax"):
        raise UnsupportedModel(f"normalization {method}")
    classes: list[str | None] = [None] * len(before)
    for out in model.iterfind("NeuralOutputs/NeuralOutput"):
        discrete = out.find("DerivedField/NormDiscrete")
        if discrete is None:
            raise UnsupportedModel("only class outputs")
        classes[before[out.get("outputNeuron")]] = discrete.get("value")
    return NetworkModel(tuple(inputs), tuple(layers), tuple(classes), method == "softmax")


_READERS = {
    "TreeModel": _tree,
    "MiningModel": _ensemble,
    "RegressionModel": _regression,
    "GeneralRegressionModel": _general_regression,
    "NeuralNetwork": _network,
}

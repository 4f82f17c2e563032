"""This engine's own JSON form for boosted trees and dense networks, whose usual binaries need other runtimes."""

from __future__ import annotations

import json

from tidemark.scoring.models import BoostedModel, Layer, NetworkModel, Node, Test


def _tree(spec: dict, test: Test | None = None) -> Node:
    """{"field", "below", "left", "right"}, {"field", "in": [...], "left", "right"} or {"leaf": x}."""
    if "leaf" in spec:
        return Node(test, value=float(spec["leaf"]))
    name = spec["field"]
    if "in" in spec:
        members = tuple(spec["in"])
        tests = Test(name, "in", members), Test(name, "notIn", members)
    else:
        tests = Test(name, "lessThan", float(spec["below"])), Test(name, "greaterOrEqual", float(spec["below"]))
    return Node(test, (_tree(spec["left"], tests[0]), _tree(spec["right"], tests[1])))


def parse_boosted(document: bytes | str) -> BoostedModel:
    """{"init": x, "labels": [...], "threshold": 0.5, "trees": [...]}"""
    spec = json.loads(document)
    trees = tuple(_tree(t) for t in spec["trees"])
    return BoostedModel(float(spec["init"]), trees, tuple(spec["labels"]), float(spec.get("threshold", 0.5)))


def parse_network(document: bytes | str) -> NetworkModel:
    """{"inputs": [...], "layers": [{"weights": [[...]], "bias": [...], "activation": "..."}], "softmax": false}"""
    spec = json.loads(document)
    layers = tuple(
        Layer(tuple(tuple(map(float, row)) for row in layer["weights"]), tuple(map(float, layer["bias"])),
              layer.get("activation", "logistic"))
        for layer in spec["layers"]
    )
    return NetworkModel(
        tuple(spec["inputs"]), layers, tuple(spec.get("classes", ())), bool(spec.get("softmax", False)),
        bool(spec.get("single_inputs", True)),
    )

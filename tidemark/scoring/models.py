"""Models as tables of numbers, and what they become: SQL text for Spark to compile.

Every model kind is turned into one or more rounds of projections. A round's columns are built from the record's
columns and from earlier rounds, so a value used many times (a hidden neuron, the leaf a tree ends in) is computed
once per row. Nothing leaves the JVM.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from tidemark.functions.features import field_column


def number(x: float) -> str:
    """A double literal."""
    x = float(x)
    if math.isnan(x) or math.isinf(x):
        raise ValueError(f"not a usable model parameter: {x}")
    return f"({x!r}D)" if x < 0 else f"{x!r}D"


def text(x: str) -> str:
    return "'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'"


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def class_value(label: str) -> float | None:
    """A class label as the double it spells, None where it spells none."""
    try:
        value = float(label)
    except ValueError:
        return None
    return value if math.isfinite(value) else None


def as_double(label: str) -> str:
    value = class_value(label)
    return "CAST(NULL AS DOUBLE)" if value is None else number(value)


@dataclass(frozen=True)
class Plan:
    """SQL for one model: rounds of helper columns, then the outputs over them."""

    rounds: tuple[tuple[tuple[str, str], ...], ...]
    value: str
    label: str | None = None
    probabilities: str | None = None


@dataclass(frozen=True)
class Test:
    """A split: numeric comparison with a bound, or membership in a set of texts."""

    name: str
    op: str
    bound: float | tuple[str, ...]

    def sql(self) -> str:
        column = quoted(field_column(self.name))
        if self.op in ("in", "notIn"):
            members = ", ".join(text(v) for v in self.bound)
            return f"{column} {'IN' if self.op == 'in' else 'NOT IN'} ({members})"
        return f"{column} {_COMPARE[self.op]} {number(self.bound)}"


_COMPARE = {
    "lessOrEqual": "<=", "lessThan": "<", "greaterThan": ">", "greaterOrEqual": ">=", "equal": "=", "notEqual": "<>",
}


@dataclass(frozen=True)
class Node:
    """A tree node; children are tried in order and the first whose test holds is entered."""

    test: Test | None
    children: tuple["Node", ...] = ()
    value: float | None = None
    label: str | None = None
    counts: tuple[float, ...] = ()

    def leaves(self) -> list["Node"]:
        return [self] if not self.children else [leaf for child in self.children for leaf in child.leaves()]

    def fields(self) -> set[str]:
        mine = {self.test.name} if self.test else set()
        return mine.union(*[child.fields() for child in self.children]) if self.children else mine


def walk(node: Node, result) -> str:
    """Nested CASE that yields `result(leaf)`; null where no child's test holds, as with a missing field."""
    if not node.children:
        return result(node)
    arms = " ".join(f"WHEN {child.test.sql()} THEN {walk(child, result)}" for child in node.children)
    return f"CASE {arms} END"


def _lookup(values: Sequence[str], index: str) -> str:
    """Pick from a constant table by a helper column; the table is one folded literal."""
    return f"get(array({', '.join(values)}), {index})"


def _leaf_number(tree: Node) -> tuple[str, list[Node]]:
    leaves = tree.leaves()
    place = {id(leaf): i for i, leaf in enumerate(leaves)}
    return walk(tree, lambda leaf: str(place[id(leaf)])), leaves


def argmax(names: Sequence[str], results: Sequence[str]) -> str:
    """Result of the first largest column, null when any is null."""
    if len(names) == 1:
        return f"IF({names[0]} IS NULL, NULL, {results[0]})"
    top = f"greatest({', '.join(names)})"
    arms = " ".join(f"WHEN {n} = {top} THEN {r}" for n, r in zip(names, results))
    known = " AND ".join(f"{n} IS NOT NULL" for n in names)
    return f"CASE WHEN {known} THEN CASE {arms} END END"


@dataclass(frozen=True)
class TreeModel:
    """One tree (X1, X2): a value per leaf, or class counts per leaf in the order of `classes`."""

    root: Node
    classes: tuple[str, ...] = ()

    @property
    def fields(self) -> set[str]:
        return self.root.fields()

    def plan(self, prefix: str) -> Plan:
        if not self.classes:
            return Plan((), walk(self.root, lambda leaf: number(leaf.value)))
        leaf_sql, leaves = _leaf_number(self.root)
        leaf = f"{prefix}leaf"
        shares = [_shares(x) for x in leaves]
        tops = [x.label if x.label is not None else self.classes[_first_largest(s)] for x, s in zip(leaves, shares)]
        return Plan(
            (((leaf, leaf_sql),),),
            value=_lookup([as_double(t) for t in tops], leaf),
            label=_lookup([text(t) for t in tops], leaf),
            probabilities=_lookup([f"array({', '.join(map(number, s))})" for s in shares], leaf),
        )


def _shares(leaf: Node) -> list[float]:
    total = sum(leaf.counts)
    return [c / total for c in leaf.counts]


def _first_largest(values: Sequence[float]) -> int:
    return max(range(len(values)), key=lambda i: (values[i], -i))


@dataclass(frozen=True)
class ForestModel:
    """Trees whose class probabilities, or values, are averaged."""

    trees: tuple[Node, ...]
    classes: tuple[str, ...] = ()

    @property
    def fields(self) -> set[str]:
        return set().union(*[t.fields() for t in self.trees])

    def plan(self, prefix: str) -> Plan:
        n = number(len(self.trees))
        if not self.classes:
            total = " + ".join(walk(t, lambda leaf: number(leaf.value)) for t in self.trees)
            return Plan((), f"({total}) / {n}")
        numbered = [_leaf_number(t) for t in self.trees]
        leaf_round = tuple((f"{prefix}leaf{i}", sql) for i, (sql, _) in enumerate(numbered))
        share_round = []
        for c in range(len(self.classes)):
            parts = [
                _lookup([number(_shares(leaf)[c]) for leaf in leaves], f"{prefix}leaf{i}")
                for i, (_, leaves) in enumerate(numbered)
            ]
            share_round.append((f"{prefix}p{c}", f"({' + '.join(parts)}) / {n}"))
        names = [name for name, _ in share_round]
        return Plan(
            (leaf_round, tuple(share_round)),
            value=argmax(names, [as_double(c) for c in self.classes]),
            label=argmax(names, [text(c) for c in self.classes]),
            probabilities=f"array({', '.join(names)})",
        )


def linear_sum(intercept: float, terms: Sequence[tuple[str, float]], columns=lambda n: quoted(field_column(n))) -> str:
    return " + ".join([number(intercept)] + [f"{number(w)} * {columns(n)}" for n, w in terms])


# Inverse of each link function, around the linear predictor.
_INVERSE_LINK = {
    "identity": "({})",
    "log": "exp({})",
    "inverse": "try_divide(1.0D, {})",
    "logit": "(1.0D / (1.0D + exp(-({}))))",
}


def linear_value(link: str, total: str) -> str:
    """The prediction for a linear predictor given as SQL."""
    return _INVERSE_LINK[link].format(total)


@dataclass(frozen=True)
class LinearModel:
    """Intercept plus weighted fields (X4), behind a link function for generalised models."""

    intercept: float
    terms: tuple[tuple[str, float], ...]
    link: str = "identity"

    @property
    def fields(self) -> set[str]:
        return {name for name, _ in self.terms}

    def plan(self, prefix: str) -> Plan:
        return Plan((), _INVERSE_LINK[self.link].format(linear_sum(self.intercept, self.terms)))


_ACTIVATION = {
    "identity": "{}",
    "logistic": "(1.0D / (1.0D + exp(-({}))))",
    "tanh": "tanh({})",
    "rectifier": "CASE WHEN {0} <= 0.0D THEN 0.0D ELSE {0} END",  # a missing input stays missing
}


@dataclass(frozen=True)
class Layer:
    weights: tuple[tuple[float, ...], ...]  # one row per neuron
    bias: tuple[float, ...]
    activation: str = "logistic"


# A network with more weights than this runs as Arrow batches: the code Spark generates for it would pass the size a
# JVM method may have.
EXPRESSION_WEIGHTS = 600


@dataclass(frozen=True)
class NetworkModel:
    """A dense network (X6, X8): softmax or plain outputs, the first largest output wins.

    With `classes` the value is the winning class as a double, otherwise the winner's index.
    """

    inputs: tuple[str, ...]
    layers: tuple[Layer, ...]
    classes: tuple[str, ...] = ()
    softmax: bool = False
    single_inputs: bool = False  # inputs narrowed to float first

    @property
    def fields(self) -> set[str]:
        return set(self.inputs)

    @property
    def weight_count(self) -> int:
        return sum(len(layer.weights) * (len(layer.weights[0]) + 1) for layer in self.layers)

    def results(self) -> list[str]:
        width = len(self.layers[-1].bias)
        return [as_double(c) for c in self.classes] if self.classes else [number(i) for i in range(width)]

    def plan(self, prefix: str) -> Plan:
        rounds = []
        before = [quoted(field_column(n)) for n in self.inputs]
        if self.single_inputs:
            before = [f"CAST(CAST({n} AS FLOAT) AS DOUBLE)" for n in before]
        for depth, layer in enumerate(self.layers):
            here = []
            for i, (row, bias) in enumerate(zip(layer.weights, layer.bias)):
                z = " + ".join([number(bias)] + [f"{number(w)} * {name}" for w, name in zip(row, before)])
                here.append((f"{prefix}n{depth}_{i}", _ACTIVATION[layer.activation].format(f"({z})")))
            rounds.append(tuple(here))
            before = [name for name, _ in here]
        if self.softmax:
            top = f"greatest({', '.join(before)})" if len(before) > 1 else before[0]
            powers = tuple((f"{prefix}e{i}", f"exp({name} - {top})") for i, name in enumerate(before))
            total = " + ".join(name for name, _ in powers)
            rounds.append(powers)
            rounds.append(tuple((f"{prefix}p{i}", f"{name} / ({total})") for i, (name, _) in enumerate(powers)))
            shares = [name for name, _ in rounds[-1]]
        else:
            shares = before
        # The winner is decided before softmax: rounding there could make two outputs equal.
        return Plan(
            tuple(rounds),
            value=argmax(before, self.results()),
            label=argmax(before, [text(c) for c in self.classes]) if self.classes else None,
            probabilities=f"array({', '.join(shares)})",
        )


@dataclass(frozen=True)
class BoostedModel:
    """Sum of tree outputs through the logistic function, as (label, probability)."""

    init: float
    trees: tuple[Node, ...]
    labels: tuple[str, ...]
    threshold: float = 0.5

    @property
    def fields(self) -> set[str]:
        return set().union(*[t.fields() for t in self.trees])

    def plan(self, prefix: str) -> Plan:
        parts = tuple((f"{prefix}t{i}", walk(t, lambda leaf: number(leaf.value))) for i, t in enumerate(self.trees))
        score = (f"{prefix}score", " + ".join([number(self.init)] + [name for name, _ in parts]))
        one = (f"{prefix}one", f"1.0D / (1.0D + exp(-{score[0]}))")
        picked = f"{one[0]} >= {number(self.threshold)}"
        # The second class's probability counts only where there are exactly two.
        probability = one[0] if len(self.labels) == 2 else f"IF({one[0]} IS NULL, NULL, 0.0D)"
        return Plan(
            (parts, (score,), (one,)),
            value=probability,
            label=f"CASE WHEN {picked} THEN {text(self.labels[1])} WHEN {one[0]} IS NOT NULL THEN {text(self.labels[0])} END"
            if len(self.labels) > 1
            else f"IF({one[0]} IS NULL, NULL, {text(self.labels[0])})",
            probabilities=f"array(1.0D - {one[0]}, {one[0]})",
        )


Model = TreeModel | ForestModel | LinearModel | NetworkModel | BoostedModel

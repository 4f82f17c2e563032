"""Many tree ensembles as one table of arrays, scored in Arrow batches by bit-vectors.

Each tree's leaves are bits. A split that does not hold clears the leaves on its left side, and the lowest bit that all
splits together leave is the leaf a row ends in. So a batch is a comparison of all its (row, split) pairs and one
reduction, whichever ensembles its rows belong to; there is no code per model. The table holds, per split, its field, its
bound and its mask, in the order of fields and bounds within a tree.

A split on a missing field clears nothing; if it lies on the way to the leaf found, the row has no score, as in the
compiled form.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.features import field_column
from tidemark.scoring.models import BoostedModel, ForestModel, Model, Node, TreeModel, class_value

MOST_LEAVES = 64

# (row, split) pairs held at once.
_PAIRS = 2_000_000

# Bytes of one table; more ensembles are laid out in several. Every executor holds them all.
TABLE_BYTES = 64 << 20

_OUTPUTS = "struct<value:double,label:string,probabilities:array<double>>"
_ALL = np.uint64(2**64 - 1)
_STRICT = {("lessOrEqual", "greaterThan"): False, ("lessThan", "greaterOrEqual"): True}


def _trees(model: Model) -> tuple[Node, ...]:
    return (model.root,) if isinstance(model, TreeModel) else model.trees


def shape_of(model: Model):
    """What models must share to be in one table; None for models that a table cannot hold.

    A table holds trees of at most 64 leaves whose splits are numeric: at most a bound, or else above it.
    """
    if not isinstance(model, (TreeModel, ForestModel, BoostedModel)) or not all(map(_plain, _trees(model))):
        return None
    if isinstance(model, BoostedModel):
        return "boosted", model.labels, model.threshold
    leaves = [leaf for t in _trees(model) for leaf in t.leaves()]
    if model.classes:
        if any(len(x.counts) != len(model.classes) or x.label is not None and x.label not in model.classes for x in leaves):
            return None
    return "tree" if isinstance(model, TreeModel) else "forest", model.classes


def _plain(tree: Node) -> bool:
    stack, leaves = [tree], 0
    while stack:
        node = stack.pop()
        if not node.children:
            leaves += 1
            continue
        tests = [c.test for c in node.children]
        if len(tests) != 2 or None in tests or tests[0].name != tests[1].name or (tests[0].op, tests[1].op) not in _STRICT:
            return False
        if tests[0].bound != tests[1].bound or not np.isfinite(tests[0].bound):
            return False
        stack += node.children
    return leaves <= MOST_LEAVES


class Table:
    """Arrays of the ensembles of one shape; `models` come as (number, model)."""

    def __init__(self, shape: tuple, models: Sequence[tuple[int, Model]]):
        self.shape, self.numbers = shape, np.array([i for i, _ in models], np.int64)
        self.fields = sorted(set().union(*[m.fields for _, m in models]))
        place = {name: i for i, name in enumerate(self.fields)}
        field, bound, strict, mask, path, value, top = [], [], [], [], [], [], []
        tree_of, splits_of, leaves_of = [0], [0], [0]
        for _, model in models:
            for tree in _trees(model):
                splits, leaves = self._laid(tree, place)
                for i, (f, b, s, m, _) in enumerate(splits):
                    field.append(f), bound.append(b), strict.append(s), mask.append(m)
                where = {key: i for i, (*_, key) in enumerate(splits)}
                for leaf, keys in leaves:
                    path.append(sum(1 << where[k] for k in keys))
                    value.append(self._values(model, leaf))
                    top.append(self._top(model, leaf))
                splits_of.append(len(field))
                leaves_of.append(len(path))
            tree_of.append(len(splits_of) - 1)
        self.init = np.array([m.init if isinstance(m, BoostedModel) else 0.0 for _, m in models])
        self.field, self.bound, self.strict = np.array(field, np.int32), np.array(bound, float), np.array(strict, bool)
        self.mask, self.path = np.array(mask, np.uint64), np.array(path, np.uint64)
        self.value, self.top = np.array(value, float), np.array(top, np.int32)
        self.tree_of, self.splits_of, self.leaves_of = (np.array(x, np.int64) for x in (tree_of, splits_of, leaves_of))
        self.bit = np.concatenate([np.arange(n) for n in np.diff(self.splits_of)]).astype(np.uint64)

    @property
    def nbytes(self) -> int:
        return sum(x.nbytes for x in vars(self).values() if isinstance(x, np.ndarray))

    @staticmethod
    def _laid(tree: Node, place: dict[str, int]):
        """(field, bound, strict, mask, key) of the splits by field and bound, and the leaves with the keys on their way."""
        splits, leaves = [], []

        def visit(node: Node, way: tuple) -> None:
            if not node.children:
                leaves.append((node, way))
                return
            left, right = node.children
            first = len(leaves)
            visit(left, (*way, id(node)))
            cleared = ((1 << len(leaves)) - 1) ^ ((1 << first) - 1)
            test = left.test
            splits.append((place[test.name], float(test.bound), _STRICT[test.op, right.test.op], int(_ALL) ^ cleared, id(node)))
            visit(right, (*way, id(node)))

        visit(tree, ())
        # A tree of one leaf gets a split that clears nothing, so that every tree has one.
        return sorted(splits) or [(0, 0.0, False, int(_ALL), None)], leaves

    def _values(self, model: Model, leaf: Node) -> list[float]:
        if isinstance(model, BoostedModel) or not model.classes:
            return [float(leaf.value)]
        total = sum(leaf.counts)
        return [c / total for c in leaf.counts]

    @staticmethod
    def _top(model: Model, leaf: Node) -> int:
        if isinstance(model, BoostedModel) or not model.classes:
            return 0
        return model.classes.index(leaf.label) if leaf.label is not None else int(np.argmax([c / sum(leaf.counts) for c in leaf.counts]))

    # --- scoring

    def sums(self, model: np.ndarray, x: np.ndarray, missing: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sums of leaf values over the trees of each row's model, in their order; rows without a score; the last leaf.

        `model` are places in this table; `x` and `missing` have a row per row and a column per field.
        """
        total = np.repeat(self.init[model][:, None], self.value.shape[1], axis=1) if self.shape[0] == "boosted" else np.zeros((len(model), self.value.shape[1]))
        void, last = np.zeros(len(model), bool), np.zeros(len(model), np.int64)
        pairs_of = self.splits_of[self.tree_of[model + 1]] - self.splits_of[self.tree_of[model]]
        # As many rows at a time as the bound on pairs lets in, one at least.
        cuts, at = [0], np.concatenate(([0], np.cumsum(pairs_of)))
        while cuts[-1] < len(model):
            cuts.append(max(cuts[-1] + 1, int(np.searchsorted(at, at[cuts[-1]] + _PAIRS, "right")) - 1))
        for a, b in zip(cuts, cuts[1:]):
            self._some(model[a:b], x[a:b], missing[a:b], total[a:b], void[a:b], last[a:b])
        return total, void, last

    def _some(self, model, x, missing, total, void, last) -> None:
        trees = self.tree_of[model + 1] - self.tree_of[model]
        row = np.repeat(np.arange(len(model)), trees)
        tree = _ranges(self.tree_of[model], trees)
        splits = self.splits_of[tree + 1] - self.splits_of[tree]
        at = _ranges(self.splits_of[tree], splits)
        of = np.repeat(row, splits)
        value, unknown, bound = x[of, self.field[at]], missing[of, self.field[at]], self.bound[at]
        # Larger than everything: what is not a number, as in the compiled form.
        fails = ((value > bound) | np.isnan(value) | (self.strict[at] & (value == bound))) & ~unknown
        starts = np.concatenate(([0], np.cumsum(splits)[:-1])).astype(np.int64)
        left = np.bitwise_and.reduceat(np.where(fails, self.mask[at], _ALL), starts)
        lowest = left & (~left + np.uint64(1))
        leaf = self.leaves_of[tree] + np.log2(lowest.astype(float)).astype(np.int64)
        if unknown.any():
            open_ = np.bitwise_or.reduceat(np.where(unknown, np.uint64(1) << self.bit[at], np.uint64(0)), starts)
            np.logical_or.at(void, row, (open_ & self.path[leaf]) != 0)
        first = np.concatenate(([0], np.cumsum(trees)[:-1])).astype(np.int64)
        # Tree by tree, so that sums are those of the compiled form to the last bit.
        for k in range(int(trees.max(initial=0))):
            has = trees > k
            total[has] += self.value[leaf[first[has] + k]]
        last[:] = leaf[first + trees - 1]

    def results(self, model: np.ndarray, x: np.ndarray, missing: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray | None, np.ndarray]:
        """(value, label, probabilities, rows without a score)."""
        total, void, last = self.sums(model, x, missing)
        kind, names = self.shape[0], self.shape[1]
        if kind == "boosted":
            with np.errstate(over="ignore"):
                one = 1.0 / (1.0 + np.exp(-total[:, 0]))
            labels = np.array(names, object)[(one >= self.shape[2]).astype(int) if len(names) > 1 else np.zeros(len(one), int)]
            return one if len(names) == 2 else np.zeros(len(one)), labels, np.stack([1.0 - one, one], axis=1), void
        trees = self.tree_of[model + 1] - self.tree_of[model]
        shares = total if kind == "tree" else total / trees[:, None]
        if not names:
            return shares[:, 0], np.full(len(model), None, object), None, void
        best = self.top[last] if kind == "tree" else shares.argmax(axis=1)
        spelled = np.array([np.nan if class_value(c) is None else class_value(c) for c in names], float)
        return spelled[best], np.array(names, object)[best], shares, void


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one range after the other."""
    before = np.concatenate(([0], np.cumsum(sizes)[:-1])) if len(sizes) else np.array([], np.int64)
    return np.repeat(starts - before, sizes) + np.arange(sizes.sum())


def tables_of(numbered: Sequence[tuple[int, Model]], more_than: int, limit: int = TABLE_BYTES) -> tuple[list[Table], list[tuple[int, Model]]]:
    """Tables of the ensembles that share a shape, where they are more than `more_than`; and all other models."""
    shapes: dict = {}
    for i, m in numbered:
        shape = shape_of(m)
        if shape is not None:
            shapes.setdefault(shape, []).append((i, m))
    out = []
    for shape, models in shapes.items():
        if len(models) > more_than:
            todo = [models]
            while todo:
                part = todo.pop()
                table = Table(shape, part)
                if table.nbytes > limit and len(part) > 1:
                    todo += [part[:len(part) // 2], part[len(part) // 2:]]
                else:
                    out.append(table)
    held = {int(i) for t in out for i in t.numbers}
    return out, [(i, m) for i, m in numbered if i not in held]


def _lists(n: int, at: np.ndarray, shares: np.ndarray | None, void: np.ndarray, whole: bool) -> pa.Array:
    """Probabilities as lists; where a score is missing, a list of nulls or, if `whole`, no list, as in the compiled form."""
    if shares is None:
        return pa.nulls(n, pa.list_(pa.float64()))
    none = np.ones(n, bool)
    none[at] = void[at] if whole else False
    kept = ~none[at]
    sizes = np.zeros(n, np.int64)
    sizes[at[kept]] = shares.shape[1]
    offsets = pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32(), mask=np.concatenate((none, [False])))
    return pa.ListArray.from_arrays(offsets, pa.array(shares[kept].ravel(), mask=np.repeat(void[at[kept]], shares.shape[1])))


def score_column(df: DataFrame, table: Table, number: str) -> Column:
    """The score of each row whose `number` is one of the table's; null on other rows."""
    shared = df.sparkSession.sparkContext.broadcast(table)

    @F.arrow_udf(_OUTPUTS)
    def score(rows: pa.Array) -> pa.Array:
        own: Table = shared.value
        fields = rows.flatten()
        wanted = np.asarray(fields[0].fill_null(-1))
        order = np.argsort(own.numbers)
        place = np.searchsorted(own.numbers, wanted, sorter=order).clip(max=len(order) - 1)
        model = order[place]
        at = np.flatnonzero(own.numbers[model] == wanted)
        n = len(rows)
        value, void = np.zeros(n), np.ones(n, bool)
        label, shares = np.full(n, None, object), None
        if len(at):
            chosen = [f.take(pa.array(at)) for f in fields[1:]]
            x = np.stack([np.asarray(f.fill_null(0.0), float) for f in chosen], axis=1) if chosen else np.zeros((len(at), 1))
            missing = np.stack([np.asarray(f.is_null()) for f in chosen], axis=1) if chosen else np.zeros((len(at), 1), bool)
            value[at], label[at], shares, void[at] = own.results(model[at], x, missing)
        outside = np.ones(n, bool)
        outside[at] = False
        label[void] = None
        return pa.StructArray.from_arrays(
            [pa.array(value, mask=void | np.isnan(value)), pa.array(label.tolist(), pa.string()), _lists(n, at, shares, void, own.shape[0] == "tree")],
            ["value", "label", "probabilities"], mask=pa.array(outside),
        )

    return score(F.struct(F.col(number).cast("long").alias("number"), *[
        F.col(f"`{field_column(n)}`").cast("double").alias(f"f{i}") for i, n in enumerate(table.fields)
    ]))

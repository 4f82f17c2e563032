"""Array-encoded ensembles against their compiled form, and many versions in one query."""

import random
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from tidemark.scoring import ensembles, score as scoring
from tidemark.scoring.models import BoostedModel, ForestModel, Node, Test as Split, TreeModel
from tidemark.scoring.score import score_by_version, with_score

cloudpickle.register_pickle_by_value(sys.modules[__name__])

NAMES = ("a", "b", "c")


def grown(rng, depth, classes=(), strict=False, test=None):
    """A random tree; bounds are few, so rows lie on them too."""
    if depth == 0 or rng.random() < 0.15:
        return Node(test, value=round(rng.uniform(-1, 1), 3), counts=tuple(float(rng.randint(1, 9)) for _ in classes))
    name, bound = rng.choice(NAMES), rng.randint(0, 6) / 2
    ops = ("lessThan", "greaterOrEqual") if strict else ("lessOrEqual", "greaterThan")
    return Node(test, tuple(grown(rng, depth - 1, classes, strict, Split(name, op, bound)) for op in ops))


def models_of(rng, kind, n, trees=5):
    classes = ("4", "x", "9")
    make = {
        "tree": lambda: TreeModel(grown(rng, 4)),
        "class tree": lambda: TreeModel(grown(rng, 4, classes), classes),
        "forest": lambda: ForestModel(tuple(grown(rng, 4, (), True) for _ in range(rng.randint(1, trees)))),
        "class forest": lambda: ForestModel(tuple(grown(rng, rng.choice([0, 5]), classes) for _ in range(trees)), classes),
        "boosted": lambda: BoostedModel(0.25, tuple(grown(rng, 3) for _ in range(trees)), ("no", "yes"), 0.4),
        "one label": lambda: BoostedModel(0.25, tuple(grown(rng, 3) for _ in range(trees)), ("only",)),
    }[kind]
    return [make() for _ in range(n)]


def full(depth, low, high, test=None):
    if depth == 0:
        return Node(test, value=float(low))
    middle = (low + high) // 2
    return Node(test, (full(depth - 1, low, middle, Split("a", "lessThan", float(middle))), full(depth - 1, middle, high, Split("a", "greaterOrEqual", float(middle)))))


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(4)
    value = lambda: rng.choice([None, float("nan"), float("inf"), 1e-9, *[x / 2 for x in range(8)] * 3])
    made = [(i, rng.randrange(22), value(), value(), value()) for i in range(1500)]
    return spark.createDataFrame(made, "i int, v int, a double, b double, c double").repartition(3).cache()


@pytest.mark.parametrize("kind", ["tree", "class tree", "forest", "class forest", "boosted", "one label"])
def test_arrays_score_like_the_compiled_form(rows, kind, monkeypatch):
    monkeypatch.setattr(ensembles, "_PAIRS", 300)
    models = dict(enumerate(models_of(random.Random(kind), kind, 20)))
    tabled = {r.i: r for r in score_by_version(rows, "v", models, compiled=3).collect()}
    compiled = score_by_version(rows, "v", models, compiled=100).collect()
    assert len(compiled) == len(tabled) == 1500
    for r in compiled:
        got, want = tabled[r.i].score, r.score
        if kind in ("boosted", "one label"):
            assert got.label == want.label and got.value == pytest.approx(want.value, nan_ok=True)
            assert list(got.probabilities or []) == pytest.approx(list(want.probabilities or [])) or want.value is None
        else:
            assert got == want, (r, got)


def test_tables_are_cut_by_size_and_hold_only_plain_splits(rows):
    rng = random.Random(2)
    models = models_of(rng, "forest", 30)
    cut, rest = ensembles.tables_of(list(enumerate(models)), 3, limit=4000)
    assert len(cut) > 1 and not rest and sorted(int(i) for t in cut for i in t.numbers) == list(range(30))
    assert all(t.nbytes <= 4000 or len(t.numbers) == 1 for t in cut)
    words = TreeModel(Node(None, (Node(Split("a", "in", ("x",)), value=1.0), Node(Split("a", "notIn", ("x",)), value=2.0))))
    deep = TreeModel(full(7, 0, 128))
    assert len(deep.root.leaves()) > ensembles.MOST_LEAVES
    one_way = TreeModel(Node(None, (Node(Split("a", "lessOrEqual", 1.0), value=1.0),)))
    assert [ensembles.shape_of(m) for m in (words, deep, one_way)] == [None, None, None]
    mixed = {i: m for i, m in enumerate([*models[:20], deep, one_way])}
    got = {r.i: r.score.value for r in score_by_version(rows, "v", mixed, compiled=3).collect()}
    for v in (20, 21):
        want = with_score(rows.where(F.col("v") == v), mixed[v]).collect()
        assert want and all(got[r.i] == r.score.value for r in want)


def test_largest_trees(spark):
    models = {i: TreeModel(full(6, 0, 64)) for i in range(3)}
    df = spark.range(64).select((F.col("id") % 3).cast("int").alias("v"), F.col("id").cast("double").alias("a"))
    assert len(models[0].root.leaves()) == 64
    assert all(r.score.value == r.a for r in score_by_version(df, "v", models, compiled=1).collect())


class Counted:
    """A scorer of one number that says on files how often it was loaded and cleaned up."""

    def __init__(self, folder, name, broken=False):
        self.folder, self.name, self.broken = folder, name, broken

    def _note(self, what):
        with open(f"{self.folder}/{self.name}", "a") as f:
            f.write(what + "\n")

    def load(self):
        self._note("load")
        if self.broken:
            raise ValueError("cannot be loaded")

    def score(self, batch):
        if batch["a"].isna().any():
            raise ValueError("a missing number")
        return [a * 2 for a in batch["a"]]

    def cleanup(self):
        self._note("cleanup")


def test_versions_that_fail_are_tried_once_and_few_are_held(spark, tmp_path, monkeypatch):
    makers = {f"p{i}": (lambda i=i: Counted(str(tmp_path), f"p{i}", i == 1)) for i in range(6)}
    handlers = {**makers, "m": TreeModel(Node(None, value=7.0))}
    rows = [(i, ["m", "other", None, *makers][i % 9], None if i % 45 == 5 else float(i)) for i in range(900)]
    df = spark.createDataFrame(rows, "i int, v string, a double").coalesce(1)
    got = {r.i: r.score for r in scoring.score_by_any_version(df, "v", handlers, default=-1.0).collect()}
    for i, v, a in rows:
        if v == "m":
            want = (7.0, "")
        elif v not in makers:
            want = (-1.0, "No model for this version")
        elif v == "p1":
            want = (-1.0, "cannot be loaded")
        else:
            want = (-1.0, "a missing number") if a is None else (2 * a, "")
        assert (got[i].value, got[i].errors) == want
    assert [(tmp_path / f"p{i}").read_text().split() for i in (0, 1, 2)] == [["load", "cleanup"], ["load"], ["load", "cleanup"]]
    kept = scoring._ByVersion("v", makers, live=2)
    kept.score_safe(df.where("v LIKE 'p%' AND a IS NOT NULL").toPandas(), -1.0)
    assert len(kept.made) == 2 and list(kept.failed) == ["p1"]

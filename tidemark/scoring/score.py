"""Scoring a table with one model, with many, or with the version each row was given."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from typing import Protocol

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.functions.features import field_column
from tidemark.scoring.ensembles import score_column, tables_of
from tidemark.scoring.models import EXPRESSION_WEIGHTS, LinearModel, Model, NetworkModel, class_value, linear_value
from tidemark.scoring.pmml import parse_pmml
from tidemark.scoring.tables import parse_boosted, parse_network

_OUTPUTS = "value double, label string, probabilities array<double>"
_NONE = "named_struct('value', CAST(NULL AS DOUBLE), 'label', CAST(NULL AS STRING), 'probabilities', CAST(NULL AS ARRAY<DOUBLE>))"


def load_model(model_type: str, data: bytes | None, location: str | None = None) -> Model:
    """The factory of each model type that carries its own numbers; registered types can be added."""
    if model_type not in LOADERS:
        raise ValueError(f"No factory found for model type {model_type}")
    if data is None:
        raise ValueError("the descriptor has no model bytes")
    return LOADERS[model_type](data)


LOADERS: dict[str, Callable[[bytes], Model]] = {
    "PMML": parse_pmml, "H2O": parse_boosted, "TENSORFLOW": parse_network, "TENSORFLOWSAVED": parse_network,
}


def _struct_sql(plan) -> str:
    label = plan.label or "CAST(NULL AS STRING)"
    shares = plan.probabilities or "CAST(NULL AS ARRAY<DOUBLE>)"
    return f"named_struct('value', {plan.value}, 'label', {label}, 'probabilities', {shares})"


def with_score(df: DataFrame, model: Model, out: str = "score", when: str | None = None) -> DataFrame:
    """Add a struct of value, label and probabilities; rows not meeting the SQL condition `when` are left unscored."""
    if isinstance(model, NetworkModel) and model.weight_count > EXPRESSION_WEIGHTS:
        columns = [F.col(f"`{field_column(n)}`").cast("float" if model.single_inputs else "double") for n in model.inputs]
        inputs = F.array(*columns)
        score = network_on_arrays(model)(F.when(F.expr(when), inputs) if when else inputs)
        return df.withColumn(out, score)
    plan = model.plan(f"_{out}_")
    guard = (lambda sql: f"CASE WHEN {when} THEN {sql} END") if when else (lambda sql: sql)
    names = df.columns
    for columns in plan.rounds:
        df = df.select("*", *[F.expr(guard(sql)).alias(name) for name, sql in columns])
    return df.select(*names, F.expr(guard(_struct_sql(plan))).alias(out))


def with_value(df: DataFrame, model: Model, out: str) -> DataFrame:
    """Add only the prediction as a double."""
    names = df.columns
    scored = with_score(df, model, "_s")
    return scored.select(*names, F.col("_s.value").alias(out))


def network_on_arrays(model: NetworkModel) -> Callable[[Column], Column]:
    """The dense network as an Arrow-batched function of one array column of inputs.

    Weights travel once per task with the function; a batch is one matrix product per layer. An array with a missing
    or surplus element gives nulls.
    """
    layers = [(np.array(x.weights).T, np.array(x.bias), x.activation) for x in model.layers]
    classes, softmax = model.classes, model.softmax
    # A label's value is the double it spells, as in the expression form; null where it spells none.
    spelled = np.array([class_value(c) if class_value(c) is not None else np.nan for c in classes], float)
    names = np.array(classes, object)
    width = layers[0][0].shape[0]

    @F.pandas_udf(_OUTPUTS)
    def score(inputs: pd.Series) -> pd.DataFrame:
        values, n = inputs.to_numpy(), len(inputs)
        usable = np.fromiter((x is not None and len(x) == width for x in values), bool, n)
        value, label, shares = np.full(n, np.nan), np.full(n, None, object), np.full(n, None, object)
        if usable.any():
            # One flat buffer for the whole batch, cut into rows of the network's width.
            a = np.concatenate(values[usable]).astype(np.float64, copy=False).reshape(-1, width)
            for weights, bias, activation in layers:
                a = _activate(activation, a @ weights + bias)
            best = a.argmax(axis=1)
            if softmax:
                e = np.exp(a - a.max(axis=1, keepdims=True))
                a = e / e.sum(axis=1, keepdims=True)
            value[usable] = spelled[best] if classes else best
            if classes:
                label[usable] = names[best]
            at = np.flatnonzero(usable)
            for row, own in zip(at, a):
                shares[row] = own
        return pd.DataFrame({"value": pd.Series(value).astype(object).where(~np.isnan(value), None), "label": label, "probabilities": shares})

    return lambda inputs: score(F.when(~F.exists(inputs, lambda x: x.isNull()), inputs))


def _activate(name: str, z: np.ndarray) -> np.ndarray:
    if name == "logistic":
        with np.errstate(over="ignore"):
            return 1.0 / (1.0 + np.exp(-z))
    if name == "tanh":
        return np.tanh(z)
    return np.maximum(z, 0.0) if name == "rectifier" else z


# Linear models or ensembles of one shape beyond this many are scored from tables.
COMPILED_LINEAR = 16


def score_by_version(
    df: DataFrame, version: str, models: Mapping[object, Model], out: str = "score", compiled: int = COMPILED_LINEAR
) -> DataFrame:
    """Each row scored by its own version only; rows with another or no version get nulls.

    `models` is what one catalogue holds. A row's version becomes a number once, by a lookup, and models are told apart by
    it. The helper columns of all models are made in the same few projections, each only on its model's rows. Linear
    models of one shape, if they are many, are no code at all: their coefficients come by a broadcast lookup. So are trees,
    forests and boosted models of one shape: their splits are arrays, scored in Arrow batches.
    """
    names, taken = df.columns, f"_{out}_no"
    keys = list(models)
    tables, rest = _linear_tables([(i, models[k]) for i, k in enumerate(keys)], compiled)
    ensembles, rest = tables_of(rest, compiled)
    lookup = df.sparkSession.createDataFrame(
        [(k if isinstance(k, str) else int(k), i) for i, k in enumerate(keys)],
        T.StructType([T.StructField("_key", df.schema[version].dataType), T.StructField(taken, T.IntegerType())]),
    )
    numbered = df.join(F.broadcast(lookup), df[version] == lookup["_key"], "left").drop("_key")
    scores = []
    for t, (fields, link, rows) in enumerate(tables):
        own = df.sparkSession.createDataFrame(
            [(i, float(m.intercept), [float(w) for _, w in m.terms]) for i, m in rows], f"_of{t} int, _i{t} double, _w{t} array<double>"
        )
        numbered = numbered.join(F.broadcast(own), F.col(taken) == F.col(f"_of{t}"), "left")
        total = " + ".join([f"_i{t}", *[f"_w{t}[{k}] * {_quoted_field(n)}" for k, n in enumerate(fields)]])
        scores.append((f"_of{t} IS NOT NULL", _value_sql(linear_value(link, total))))
    for t, ensemble in enumerate(ensembles):
        numbered = numbered.withColumn(f"_e{t}", score_column(numbered, ensemble, taken))
        scores.append((f"_e{t} IS NOT NULL", f"_e{t}"))
    plans = []
    for i, model in rest:
        when = f"{taken} = {i}"
        if isinstance(model, NetworkModel) and model.weight_count > EXPRESSION_WEIGHTS:
            numbered = with_score(numbered, model, f"_{out}{i}", when)
            scores.append((when, f"_{out}{i}"))
        else:
            plans.append((when, model.plan(f"_{out}{i}_")))
    for r in range(max((len(p.rounds) for _, p in plans), default=0)):
        columns = [(f"CASE WHEN {when} THEN {sql} END", name) for when, p in plans if r < len(p.rounds) for name, sql in p.rounds[r]]
        numbered = numbered.select("*", *[F.expr(sql).alias(name) for sql, name in columns])
    scores += [(when, _struct_sql(p)) for when, p in plans]
    arms = " ".join(f"WHEN {when} THEN {sql}" for when, sql in scores)
    score = F.expr(f"CASE {arms} ELSE {_NONE} END") if scores else F.expr(_NONE)
    return numbered.select(*[f"`{n}`" for n in names], score.alias(out))


def _linear_tables(numbered: Sequence[tuple[int, Model]], compiled: int):
    """Groups of linear models that use the same fields under the same link, where they are many; and all other models."""
    shapes: dict = {}
    for i, m in numbered:
        if isinstance(m, LinearModel):
            shapes.setdefault((tuple(n for n, _ in m.terms), m.link), []).append((i, m))
    tables = [(fields, link, rows) for (fields, link), rows in shapes.items() if len(rows) > compiled]
    held = {i for _, _, rows in tables for i, _ in rows}
    return tables, [(i, m) for i, m in numbered if i not in held]


def _quoted_field(name: str) -> str:
    return f"`{field_column(name)}`"


def _value_sql(value: str) -> str:
    return f"named_struct('value', {value}, 'label', CAST(NULL AS STRING), 'probabilities', CAST(NULL AS ARRAY<DOUBLE>))"


def _literal(key: object) -> str:
    return str(key) if isinstance(key, (int, np.integer)) else "'" + str(key).replace("\\", "\\\\").replace("'", "\\'") + "'"


def score_with_all(df: DataFrame, models: Mapping[str, Model], name: str = "model", value: str = "value") -> DataFrame:
    """Every row with every model: one output row per pair, from a single pass over the input."""
    names = df.columns
    for i, model in enumerate(models.values()):
        df = with_value(df, model, f"_v{i}")
    pairs = ", ".join(f"{_literal(m)}, _v{i}" for i, m in enumerate(models))
    return df.select(*names, F.expr(f"stack({len(models)}, {pairs}) AS ({name}, {value})"))


def missing_error(value: Column, fields: Iterable[str]) -> Column:
    """Why a row has no score: which of the model's fields are missing, or that the model gave nothing."""
    missing = F.concat_ws(", ", *[F.when(F.col(f"`{field_column(f)}`").isNull(), F.lit(f)) for f in sorted(fields)])
    return F.when(
        value.isNull(),
        F.when(missing != "", F.concat(F.lit("Missing value for "), missing)).otherwise(F.lit("No prediction")),
    )


class BatchScorer(Protocol):
    """A user's own model (X15): loaded once per task, scored in Arrow batches, cleaned up at the end."""

    def load(self) -> None: ...

    def score(self, batch: pd.DataFrame) -> Sequence[object]: ...

    def cleanup(self) -> None: ...


def score_batches(
    df: DataFrame,
    make: Callable[[], BatchScorer],
    result: T.DataType,
    default: object,
    clock: Callable[[], int] | None = None,
    out: str = "score",
) -> DataFrame:
    """Run a user's scorer; a row it fails on gets the default and an error text, and the job goes on.

    A failing batch is tried again in halves, so only the rows at fault are affected. Adds a struct
    <result, errors, start_ms, duration_ms>; the duration of a row is its share of the batch's.
    """
    field = T.StructType([
        T.StructField("result", result), T.StructField("errors", T.StringType()),
        T.StructField("start_ms", T.LongType()), T.StructField("duration_ms", T.LongType()),
    ])
    schema = T.StructType([*df.schema.fields, T.StructField(out, field)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import time

        from pyspark.sql.pandas.types import to_arrow_type

        now = clock or (lambda: int(time.time() * 1000))
        scorer, broken = None, None
        try:
            try:
                scorer = make()
                scorer.load()
            except Exception as e:
                broken = str(e)
            for batch in batches:
                frame = batch.to_pandas()
                start = now()
                values, errors = _safe(scorer, frame, broken, default)
                took = (now() - start) // max(len(frame), 1)
                n = len(frame)
                kind = to_arrow_type(field)
                column = pa.StructArray.from_arrays(
                    [pa.array(values, kind[0].type), pa.array(errors), pa.array([start] * n, pa.int64()),
                     pa.array([took] * n, pa.int64())],
                    fields=list(kind),
                )
                yield pa.RecordBatch.from_arrays([*batch.columns, column], names=[*batch.schema.names, out])
        finally:
            if scorer is not None:
                scorer.cleanup()

    return df.mapInArrow(run, schema)


class RemoteScorer:
    """A version that lives at an address: its rows go there in requests, its replies are their values."""

    def __init__(self, send: Callable[[Sequence[dict], str], Sequence[object]], location: str):
        self.send, self.location = send, location

    def load(self) -> None: ...

    def score(self, batch: pd.DataFrame) -> Sequence[object]:
        return self.send(batch.to_dict("records"), self.location)

    def cleanup(self) -> None: ...


# Scorers of versions that a task keeps loaded; the one used longest ago goes first.
LIVE_SCORERS = 256


class _ByVersion:
    """Scores a batch with the scorers of the versions in it; each is loaded when its first row comes.

    A version that cannot be loaded is tried once; its rows get the default and that error. At most `live` scorers are
    held; one that is put aside is cleaned up, and loaded again if it is wanted again.
    """

    def __init__(self, version: str, makers: Mapping[object, Callable[[], BatchScorer]], live: int = LIVE_SCORERS):
        self.version, self.makers, self.live = version, makers, live
        self.made: dict = {}
        self.failed: dict = {}

    def _scorer(self, key):
        scorer = self.made.pop(key, None)
        if scorer is None and key not in self.failed:
            try:
                scorer = self.makers[key]()
                scorer.load()
            except Exception as e:
                self.failed[key] = str(e) or type(e).__name__
                return None
            while len(self.made) >= self.live:
                self.made.pop(next(iter(self.made))).cleanup()
        if scorer is not None:
            self.made[key] = scorer
        return scorer

    def score_safe(self, frame: pd.DataFrame, default: object) -> tuple[list, list]:
        values, errors = [default] * len(frame), [""] * len(frame)
        for key, places in frame.groupby(self.version, sort=False).indices.items():
            own, why = _safe(self._scorer(key), frame.iloc[places], self.failed.get(key), default)
            for place, value, error in zip(places.tolist(), own, why):
                values[place], errors[place] = value, error
        return values, errors

    def cleanup(self) -> None:
        for scorer in self.made.values():
            scorer.cleanup()
        self.made = {}


def score_by_any_version(
    df: DataFrame, version: str, handlers: Mapping[object, Model | Callable[[], BatchScorer]], default: float = 0.0,
    out: str = "score",
) -> DataFrame:
    """Each row scored by its own version, whatever kind that is: a model, or what makes a user's or a remote scorer.

    Adds a struct <value, errors>. The input is read once. Rows of models are scored in generated code and reach Python
    only as nulls; the others go through Arrow batches, grouped by version inside the batch. A version that cannot be
    loaded is tried once a task. Rows without a known version get the default and an error.
    """
    models = {k: h for k, h in handlers.items() if isinstance(h, Model)}
    makers = {k: h for k, h in handlers.items() if not isinstance(h, Model)}
    names, at = df.columns, F.col(f"`{version}`")
    known = F.coalesce(at.isin(*models), F.lit(False)) if models else F.lit(False)
    error = F.when(~known, F.lit("No model for this version")).when(F.col("_s.value").isNull(), F.lit("No prediction")).otherwise("")
    result = F.struct(F.coalesce("_s.value", F.lit(default)).alias("value"), error.alias("errors"))
    if not makers:
        return score_by_version(df, version, models, "_s").select(*[f"`{n}`" for n in names], result.alias(out))
    in_python = F.coalesce(at.isin(*makers), F.lit(False))
    rows = F.when(in_python, F.struct(*[F.col(f"`{n}`") for n in names]))
    batched = df.withColumn("_b", _version_batches(version, makers, default)(rows))
    scored = score_by_version(batched, version, models, "_s")
    value = F.struct(F.coalesce("_b.result", F.lit(default)).alias("value"), F.coalesce("_b.errors", F.lit("")).alias("errors"))
    return scored.select(*[f"`{n}`" for n in names], F.when(in_python, value).otherwise(result).alias(out))


def _version_batches(version: str, makers: Mapping[object, Callable[[], BatchScorer]], default: float):
    """A function of whole rows, null where a row is not to be scored; it is loaded and cleaned up once per task."""

    @F.arrow_udf("struct<result:double,errors:string>")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = _ByVersion(version, makers)
        try:
            for rows in batches:
                wanted = np.flatnonzero(np.asarray(rows.is_valid()))
                result, errors = np.full(len(rows), None, object), np.full(len(rows), None, object)
                if len(wanted):
                    frame = pa.RecordBatch.from_struct_array(rows.take(pa.array(wanted))).to_pandas()
                    values, why = scorer.score_safe(frame, default)
                    result[wanted], errors[wanted] = values, why
                yield pa.StructArray.from_arrays([pa.array(result.tolist(), pa.float64()), pa.array(errors.tolist(), pa.string())], ["result", "errors"])
        finally:
            scorer.cleanup()

    return score


def _safe(scorer, frame: pd.DataFrame, broken: str | None, default: object) -> tuple[list, list]:
    """Halve a failing batch until the rows at fault stand alone; the others are still scored together."""
    values: list = [default] * len(frame)
    errors = [broken or ""] * len(frame)
    todo = [(0, len(frame))] if broken is None and len(frame) else []
    while todo:
        first, last = todo.pop()
        try:
            part = list(scorer.score(frame.iloc[first:last]))
            if len(part) != last - first:
                raise ValueError(f"{last - first} rows got {len(part)} results")
            values[first:last] = part
        except Exception as e:
            if last - first == 1:
                errors[first] = str(e) or type(e).__name__
            else:
                middle = (first + last) // 2
                todo += [(first, middle), (middle, last)]
    return values, errors

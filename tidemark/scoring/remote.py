"""Scoring by a remote service (X10-X12). The transport is given by the user; nothing here opens a connection."""

from __future__ import annotations

import time
from collections import deque
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

# Request texts of a batch and the service's address in; (status code, body) for each out.
Transport = Callable[[Sequence[str], str], Sequence[tuple[int, str]]]

# Status codes by which a service asks to be called again later.
BUSY = (429, 503)

RESPONSE = "outputs struct<`model-version`: array<string>, recommendations: array<array<double>>>"


def recommend_request(user: str = "user", products: str = "products") -> Column:
    """JSON request: one [product] and one [user] per product."""
    pairs = F.struct(
        F.transform(products, lambda p: F.array(p)).alias("products"),
        F.transform(products, lambda p: F.array(F.col(user))).alias("users"),
    )
    return F.to_json(F.struct(F.lit("").alias("signature_name"), pairs.alias("inputs")))


def with_response(df: DataFrame, body: str, out: str, products: str = "products") -> DataFrame:
    """Add a struct of keys and values: first number of each row beside the request's products, cut to the shorter side.

    Null when the body is not such a response. The body is read once, in a projection of its own.
    """
    rows = F.col("_rows")
    n = F.least(F.size(rows), F.size(products))
    values = F.transform(F.slice(rows, F.lit(1), n), lambda row: F.get(row, F.lit(0)))
    keys = F.transform(F.slice(products, F.lit(1), n), lambda p: p.cast("string"))
    pairs = F.when(rows.isNotNull(), F.struct(keys.alias("keys"), values.alias("values")))
    read = df.withColumn("_rows", F.from_json(body, RESPONSE)["outputs"]["recommendations"])
    return read.select(*df.columns, pairs.alias(out))


def call_service(
    df: DataFrame,
    transport: Transport,
    request: str = "request",
    location: str = "location",
    batch_rows: int = 256,
    clock: Callable[[], int] | None = None,
    in_flight: int = 1,
    once: bool = False,
    retries: int = 0,
    backoff_s: float = 0.5,
) -> DataFrame:
    """Add `reply`: struct<code, body, failure, start_ms, duration_ms>, calling the service with batches of requests.

    A failing batch is retried one request at a time, so that one bad request costs only itself. A task has at most
    `in_flight` batches on their way, each in a thread of its own (the transport must allow that), and gives the rows in
    their order; so no more than these are held. With `once`, equal requests of a batch are sent once. What fails or gets
    a BUSY code is asked again up to `retries` times, after a pause that doubles; its duration spans all attempts.
    """
    if in_flight < 1 or batch_rows < 1:
        raise ValueError("in_flight and batch_rows must be 1 at least")
    reply = T.StructType.fromDDL("code int, body string, failure string, start_ms bigint, duration_ms bigint")
    schema = T.StructType([*df.schema.fields, T.StructField("reply", reply)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        now = clock or (lambda: int(time.time() * 1000))
        kind = to_arrow_type(reply)

        def answered(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = batch.column(batch.schema.get_field_index(request)).to_pylist()
            places = batch.column(batch.schema.get_field_index(location)).to_pylist()
            answers: list[tuple | None] = [None] * len(texts)
            for place in dict.fromkeys(places):
                rows = [i for i, p in enumerate(places) if p == place]
                asked = [texts[i] for i in rows]
                sent = list(dict.fromkeys(asked)) if once else asked
                got = _patiently(transport, sent, place, now, retries, backoff_s)
                by_text = dict(zip(sent, got)) if once else {}
                for i, answer in zip(rows, [by_text[t] for t in asked] if once else got):
                    answers[i] = answer
            column = pa.StructArray.from_arrays(
                [pa.array(values, field.type) for values, field in zip(zip(*answers), kind)], fields=list(kind)
            )
            return pa.RecordBatch.from_arrays([*batch.columns, column], names=[*batch.schema.names, "reply"])

        with ThreadPoolExecutor(in_flight) as pool:
            waiting = deque()
            for whole in batches:
                for first in range(0, whole.num_rows, batch_rows):
                    waiting.append(pool.submit(answered, whole.slice(first, batch_rows)))
                    if len(waiting) == in_flight:
                        yield waiting.popleft().result()
            while waiting:
                yield waiting.popleft().result()

    return df.mapInArrow(run, schema)


def _patiently(transport: Transport, texts: list[str], place: str, now, retries: int, backoff_s: float) -> list[tuple]:
    answers = _ask(transport, texts, place, now)
    for attempt in range(retries):
        again = [i for i, (code, _, failure, _, _) in enumerate(answers) if failure is not None or code in BUSY]
        if not again:
            break
        time.sleep(backoff_s * 2**attempt)
        for i, (code, body, failure, _, _) in zip(again, _ask(transport, [texts[i] for i in again], place, now)):
            start = answers[i][3]
            answers[i] = (code, body, failure, start, now() - start)
    return answers


def _ask(transport: Transport, texts: list[str], place: str, now) -> list[tuple]:
    """(code, body, failure, start, duration) per request."""
    start = now()
    try:
        replies = list(transport(texts, place))
        if len(replies) != len(texts):
            raise ValueError(f"{len(texts)} requests got {len(replies)} replies")
        took = (now() - start) // len(texts)
        return [(code, body, None, start, took) for code, body in replies]
    except Exception as e:
        if len(texts) > 1:
            return [answer for t in texts for answer in _ask(transport, [t], place, now)]
        return [(None, None, str(e) or type(e).__name__, start, now() - start)]


def service_error(parsed: Column) -> Column:
    """Null for a usable reply, else the error text: status other than 200, a failed call, or an unreadable body."""
    code, body, failure = F.col("reply.code"), F.col("reply.body"), F.col("reply.failure")
    return (
        F.when(failure.isNotNull(), failure)
        .when(
            code != 200,
            F.concat(F.lit("Error processing serving request - code "), code.cast("string"), F.lit(", error "), body),
        )
        .when(parsed.isNull(), F.concat(F.lit("Unreadable response: "), body))
    )


def recommend(df: DataFrame, transport: Transport, keep: Sequence[str] = (), **options) -> DataFrame:
    """Recommender records (user, products, location) to result envelopes."""
    from tidemark.functions.envelope import key_values_result, metadata

    asked = call_service(df.withColumn("request", recommend_request()), transport, **options)
    usable = asked.withColumn("_body", F.when(F.col("reply.code") == 200, F.col("reply.body")))
    judged = with_response(usable, "_body", "_parsed").withColumn("_error", service_error(F.col("_parsed")))
    model = F.col("modelName") if "modelName" in df.columns else F.lit("Recommender Model")
    return judged.select(
        *keep,
        F.struct("user", "products").alias("inputRecord"),
        key_values_result(F.col("_parsed.keys"), F.col("_parsed.values")).alias("modelResult"),
        metadata(F.col("_error"), F.lit("TENSORFLOWSERVING"), model, F.col("reply.start_ms"), F.col("reply.duration_ms"))
        .alias("modelResultMetadata"),
    )

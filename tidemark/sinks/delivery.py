"""Lines delivered to a store outside Spark, in two phases, with refused lines set aside.

Phase one writes the lines of a batch, cut into chunks, to the shared folder. Phase two gives every chunk to the user's
`send` with a token, and records what was refused. A ledger entry ends each phase. So a batch that is run again, after a
lost task, executor or driver, sends the very same chunks under the same tokens: a store that knows a token again takes
every line once, any other store at least once. Readers see a batch only when all of it was sent.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

# Lines and token in; nothing if all were taken, else for every line the reason of its refusal or None.
Send = Callable[[Sequence[str], str], Sequence[str | None] | None]

CHUNK_LINES = 5_000

_SENT = "chunk bigint, n bigint, refused array<struct<place: bigint, error: string>>"


def _hadoop_path(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), place


def _is_done(spark: SparkSession, folder: str, phase: str, batch_id: int) -> bool:
    files, place = _hadoop_path(spark, f"{folder}/ledger/{phase}/{batch_id}")
    return files.exists(place)


def _set_done(spark: SparkSession, folder: str, phase: str, batch_id: int) -> None:
    files, place = _hadoop_path(spark, f"{folder}/ledger/{phase}/{batch_id}")
    files.create(place, True).close()


def delivered_batches(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the batches of which every chunk was sent."""
    files, place = _hadoop_path(spark, f"{folder}/ledger/sent")
    return sorted(int(s.getPath().getName()) for s in files.listStatus(place)) if files.exists(place) else []


def deliver(
    batch: DataFrame,
    batch_id: int,
    send: Send,
    folder: str,
    line: str = "line",
    chunk_lines: int = CHUNK_LINES,
    retries: int = 3,
    backoff_s: float = 0.5,
    swallow: bool = True,
) -> None:
    """Deliver the column `line` of a batch; a batch that was delivered before is left alone.

    A chunk for which `send` raises is sent again up to `retries` times, after a pause that doubles; if it still fails,
    its lines count as refused with that reason, or, without `swallow`, the batch fails. Null lines are refused unsent.
    """
    if chunk_lines < 1 or retries < 0:
        raise ValueError("chunk_lines must be 1 at least, retries 0")
    if {"chunk", "place", "error", "batch_id"} & set(batch.columns):
        raise ValueError("the columns chunk, place, error and batch_id are taken")
    spark = batch.sparkSession
    if _is_done(spark, folder, "sent", batch_id):
        return
    staged = f"{folder}/staged/batch_id={batch_id}"
    if not _is_done(spark, folder, "staged", batch_id):
        # A row's number holds its task and its place there; written down, it does not change when the batch runs again.
        placed = batch.withColumn("place", F.monotonically_increasing_id())
        task, at = F.shiftright("place", 33), F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
        placed = placed.withColumn("chunk", F.shiftleft(task, 33) + F.floor(at / chunk_lines))
        placed.write.mode("overwrite").parquet(staged)
        _set_done(spark, folder, "staged", batch_id)
    # The stream's session may differ from run to run, what is staged does not.
    lines = spark.read.parquet(staged).select("chunk", "place", F.col(f"`{line}`").alias("line"))
    sent = lines.groupBy("chunk").applyInPandas(_sender(send, batch_id, retries, backoff_s, swallow), _SENT)
    sent.write.mode("overwrite").parquet(f"{folder}/sent/batch_id={batch_id}")
    _set_done(spark, folder, "sent", batch_id)


def _sender(send: Send, batch_id: int, retries: int, backoff_s: float, swallow: bool):
    def patiently(lines: list[str], token: str) -> list[str | None]:
        for attempt in range(retries + 1):
            try:
                reasons = send(lines, token)
                break
            except Exception as e:
                if attempt < retries:
                    time.sleep(backoff_s * 2**attempt)
                elif swallow:
                    return [f"{type(e).__name__}: {e}"] * len(lines)
                else:
                    raise
        if reasons is None:
            return [None] * len(lines)
        if len(reasons) != len(lines):
            raise ValueError(f"{len(lines)} lines were sent, {len(reasons)} answers came")
        return list(reasons)

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        # One chunk, which never has more than `chunk_lines` rows.
        rows = rows.sort_values("place")
        full = rows[rows["line"].notna()]
        token = f"{batch_id}-{rows['chunk'].iloc[0]}"
        reasons = patiently(full["line"].tolist(), token) if len(full) else []
        refused = [(p, r) for p, r in zip(full["place"], reasons) if r is not None]
        refused += [(p, "no line") for p in rows.loc[rows["line"].isna(), "place"]]
        refused = [{"place": int(p), "error": str(r)} for p, r in refused]
        return pd.DataFrame({"chunk": [rows["chunk"].iloc[0]], "n": [len(rows)], "refused": [refused]})

    return run


def outcomes(spark: SparkSession, folder: str) -> DataFrame:
    """The rows of all batches that were sent whole, with batch_id and `error`, null where the line was taken."""
    whole = delivered_batches(spark, folder)
    if not whole:
        raise ValueError(f"no batch was delivered below {folder} yet")
    staged = spark.read.option("basePath", f"{folder}/staged").parquet(*[f"{folder}/staged/batch_id={i}" for i in whole])
    sent = spark.read.schema(_SENT + ", batch_id bigint").option("basePath", f"{folder}/sent").parquet(
        *[f"{folder}/sent/batch_id={i}" for i in whole]
    )
    refused = sent.select("batch_id", F.explode("refused").alias("r")).select("batch_id", "r.place", "r.error")
    staged = staged.withColumn("batch_id", F.col("batch_id").cast("bigint"))
    return staged.join(refused, ["batch_id", "place"], "left").drop("place", "chunk")


def deliver_stream(
    stream: DataFrame,
    lines: Callable[[DataFrame], DataFrame],
    send: Send,
    folder: str,
    checkpoint: str,
    every: str | None = None,
    **options,
) -> StreamingQuery:
    """Deliver what `lines` makes of every micro-batch, such as `line_protocol`; options are those of `deliver`."""

    def write(batch: DataFrame, batch_id: int) -> None:
        deliver(lines(batch), batch_id, send, folder, **options)

    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()

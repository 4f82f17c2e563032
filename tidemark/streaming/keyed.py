"""Serving from keyed state: every server keeps its versions and the records that wait for their time.

Records and descriptors are one stream. Servers are dealt over a fixed number of groups, and a group is a key of the
state, since each call for a key and each access to its state costs about a millisecond, whatever it holds. A group's
state is the current version of each of its servers (a value), the versions ahead of it (a list) and the records whose
time has not come (a list). A timer goes off once the watermark has passed a waiting record: from then on no version for
its time can come any more, so it gets the version of its time, as in the batch form. A descriptor that comes after
records of its time, but within the delay, is thus still used for them; state holds no history beyond the current version.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor

from tidemark.operators.asof import micros

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

_VERSION, _RECORD, _TICK = 0, 1, 2
_COLUMNS = {_VERSION: ["server", "at", "seq", "body"], _RECORD: ["server", "at", "body"]}

# Groups of servers. A group's rows are handled together, so more rows in all ask for more groups.
GROUPS = 256

# Rows are kept as chunks of so many at most, and a list of more chunks than this is put together.
_CHUNK_ROWS = 10_000
_CHUNKS = 64

_HELD = "low long, rows binary"


def _chunks(rows: pd.DataFrame) -> list[tuple]:
    """Rows as entries of a list: the earliest time, and the rows in Arrow's format."""
    made = []
    for start in range(0, len(rows), _CHUNK_ROWS):
        part = rows.iloc[start : start + _CHUNK_ROWS]
        batch, out = pa.RecordBatch.from_pandas(part, preserve_index=False), pa.BufferOutputStream()
        with pa.ipc.new_stream(out, batch.schema) as writer:
            writer.write_batch(batch)
        made.append((int(part["at"].min()), out.getvalue().to_pybytes()))
    return made


def _rows(chunks: Sequence[tuple], columns: Sequence[str]) -> pd.DataFrame:
    frames = [pa.ipc.open_stream(bytes(rows)).read_pandas() for _, rows in chunks]
    return pd.concat(frames, ignore_index=True) if frames else pd.DataFrame({c: pd.Series(dtype="int64" if c in ("at", "seq") else object) for c in columns})


def _last_before(versions: pd.DataFrame, records: pd.DataFrame) -> np.ndarray:
    """For each record the row of the last version at or before its time, -1 if there is none; of versions at one time the last row."""
    n = len(versions)
    server, _ = pd.factorize(pd.concat([versions["server"], records["server"]], ignore_index=True))
    at = np.concatenate([versions["at"].to_numpy(np.int64), records["at"].to_numpy(np.int64)])
    # Stable, and versions stand before records: at one time the version comes first.
    order = np.lexsort((at, server))
    place = np.maximum.accumulate(np.where(order < n, np.arange(len(order)), -1))
    found = np.where(place >= 0, order[place], -1)
    found = np.where((found >= 0) & (server[found] == server[order]), found, -1)
    out = np.empty(len(order), np.int64)
    out[order] = found
    return out[n:]


class _Group(StatefulProcessor):
    """State of a group of servers, or of slots of them."""

    def init(self, handle) -> None:
        self.handle = handle
        self.current = handle.getValueState("current", "body string")
        self.ahead = handle.getListState("ahead", _HELD)
        self.waiting = handle.getListState("waiting", _HELD)
        self.due = handle.getValueState("due", "ms long")

    def handleInputRows(self, key, rows, timerValues):
        first = None
        for frame in rows:
            versions = frame[frame["kind"] == _VERSION]
            if len(versions):
                self.ahead.appendList(_chunks(versions[_COLUMNS[_VERSION]]))
            records = frame[frame["kind"] == _RECORD]
            if len(records):
                self.waiting.appendList(_chunks(records[_COLUMNS[_RECORD]]))
                low = int(records["at"].min())
                first = low if first is None else min(first, low)
        if first is not None:
            self._wake(first)
        return iter(())

    def _wake(self, at: int) -> None:
        """One timer a group, for the earliest record that waits."""
        ms = -(-at // 1000)
        known = self.due.get()[0] if self.due.exists() else None
        if known is None or ms < known:
            if known is not None:
                self.handle.deleteTimer(known)
            self.handle.registerTimer(ms)
            self.due.update((ms,))

    def _take(self, state, kind: int, until: int) -> tuple[pd.DataFrame, int | None]:
        """Take the rows up to a time out of a list; also the earliest time that stays in it."""
        held = [tuple(c) for c in state.get()] if state.exists() else []
        later = [c for c in held if c[0] > until]
        if len(later) > _CHUNKS:
            later = []
        kept = {id(c) for c in later}
        rows = _rows([c for c in held if id(c) not in kept], _COLUMNS[kind])
        passed = rows["at"] <= until
        left = later + _chunks(rows[~passed])
        if not left:
            state.clear()
        elif len(later) < len(held):
            state.put(left)
        return rows[passed], min((c[0] for c in left), default=None)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        # What is at or before the watermark is complete: later arrivals of that time are not let in.
        until = timerValues.getCurrentWatermarkInMs() * 1000
        self.due.clear()
        ready, next_at = self._take(self.waiting, _RECORD, until)
        passed, _ = self._take(self.ahead, _VERSION, until)
        before = json.loads(self.current.get()[0]) if self.current.exists() else []
        versions = pd.concat([pd.DataFrame(before, columns=_COLUMNS[_VERSION]), passed], ignore_index=True) if before else passed
        # The last version at or before the record's time; among those of one time the largest seq is last.
        versions = versions.sort_values(["at", "seq", "body"], ignore_index=True)
        if len(ready):
            bodies = np.append(versions["body"].to_numpy(object), None)
            yield pd.DataFrame({"body": ready["body"].to_numpy(object), "model": pd.Series(bodies[_last_before(versions, ready)], dtype=object)})
        if len(passed):
            last = versions.drop_duplicates("server", keep="last")
            self.current.update((json.dumps(list(zip(*[last[c].tolist() for c in _COLUMNS[_VERSION]])), ensure_ascii=False),))
        if next_at is not None:
            self._wake(next_at)

    def close(self) -> None: ...


def _json(df: DataFrame) -> Column:
    return F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false", "timestampNTZFormat": _NTZ, "timestampFormat": _ZONED})


_NTZ = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
_ZONED = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def serve_keyed(
    records: DataFrame,
    versions: DataFrame,
    *,
    on: str,
    valid_from: str = "valid_from",
    by: Sequence[str] = (),
    seq: str | None = None,
    delay: str = "1 hour",
    slots: int = 1,
    ticks: DataFrame | None = None,
    out: str = "model",
    groups: int = GROUPS,
) -> DataFrame:
    """The records of a stream with the version valid at their time in a struct, null before the first version.

    `versions` are usable descriptors, a stream too; model files stay out of them. A record comes out once the watermark,
    `delay` behind the latest time seen, has passed it; what comes later than that is left out, as in every watermarked
    stream. `ticks` (a stream with a timestamp column `at`) moves the watermark on while nothing else comes, for instance
    at the end of the input. A server with more records than one task should handle is dealt over `slots`: its versions
    go to each of them. `groups` is how many keys the state has, whatever the number of servers; a checkpoint stays with
    its number. Values travel as JSON, so columns are of types that JSON gives back. Records and versions without a time
    are left out.
    """
    spark = records.sparkSession
    if spark.conf.get(_PROVIDER, "") != _ROCKS:
        spark.conf.set(_PROVIDER, _ROCKS)
    carried = versions.select([f.name for f in versions.schema.fields if not isinstance(f.dataType, T.BinaryType)])
    # A server is a key of text, so that servers of any type, null ones and several columns are alike.
    server = lambda: F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in by])) if by else F.lit("")

    def group(slot: Column) -> Column:
        return F.pmod(F.xxhash64(server(), slot), F.lit(groups)).cast("int")

    def shaped(df: DataFrame, kind: int, time: str, number: Column, place: Column, body: Column) -> DataFrame:
        return df.where(F.col(time).isNotNull()).select(
            server().alias("server") if kind != _TICK else F.lit(None).cast("string").alias("server"),
            place.alias("group"), F.col(time).cast("timestamp").alias("time"), micros(time).alias("at"),
            F.lit(kind).alias("kind"), number.cast("long").alias("seq"), body.alias("body"),
        )

    zero, nothing = F.lit(0), F.lit("")
    number = F.coalesce(F.col(seq).cast("long"), F.lit(-(2**63))) if seq else zero
    dealt = F.pmod(F.xxhash64(_json(records)), F.lit(slots)).cast("int")
    # A group that has several slots of a server gets its versions once.
    every = F.explode(F.array_distinct(F.transform(F.sequence(F.lit(0), F.lit(slots - 1)), group)))
    both = shaped(records, _RECORD, on, zero, group(dealt), _json(records))
    both = both.unionByName(shaped(carried.select("*", every.alias("_every")), _VERSION, valid_from, number, F.col("_every"), _json(carried)))
    if ticks is not None:
        both = both.unionByName(shaped(ticks, _TICK, "at", zero, zero, nothing))
    served = (
        both.withWatermark("time", delay).groupBy("group")
        .transformWithStateInPandas(_Group(), "body string, model string", "append", "eventtime")
    )
    how = {"timestampNTZFormat": _NTZ, "timestampFormat": _ZONED}
    record = F.from_json("body", T.StructType(records.schema.fields), how)
    model = F.from_json("model", T.StructType(carried.schema.fields), how)
    return served.select(record.alias("_r"), model.alias(out)).select("_r.*", out)

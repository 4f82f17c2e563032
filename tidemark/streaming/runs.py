"""A store of keyed rows that come in batches: runs with a manifest, merged as they grow, and the last row of every key.

Every batch adds a run. When a level has `fan_in` runs they are merged into one run of the next level, in order; when the
second level is full, its runs also go into the base, which holds the last row of every key up to a cut. So a reader of
recent rows opens the base and fewer than 2 * fan_in runs, however many batches there were, and each row is written again
only once a level. The manifest names the runs with the least and the greatest value of their order column; older runs
are opened only for times before the cut, and only those that can hold rows of the time asked for.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.descriptors import check_descriptors
from tidemark.operators.asof import assign_models, micros

FAN_IN = 8

# Runs of this level and above are in the base.
_IN_BASE = 2


class RunStore:
    """Rows with key columns `by` and an order column (a timestamp or a whole number); `seq` decides between equal ones.

    Without `history` only the last row of each key can be asked for, and what the base has taken in is dropped.
    """

    def __init__(
        self, spark: SparkSession, folder: str, schema: T.StructType | str, by: Sequence[str], order: str, seq: str | None = None,
        fan_in: int = FAN_IN, history: bool = True,
    ):
        if fan_in < 2:
            raise ValueError("a merge takes two runs at least")
        self.spark, self.folder = spark, folder.rstrip("/")
        self.schema = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
        self.by, self.order, self.seq, self.fan_in, self.history = list(by), order, seq, fan_in, history

    # --- files

    def _path(self, name: str):
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}" if name else self.folder)
        return path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()), path

    def manifest(self) -> dict:
        """What the store holds: the newest manifest that was finished."""
        files, place = self._path("manifest")
        numbers = [int(s.getPath().getName()) for s in files.listStatus(place) if s.getPath().getName().isdigit()] if files.exists(place) else []
        if not numbers:
            return {"number": 0, "batch": -1, "base": None, "cut": None, "runs": [], "old": []}
        files, place = self._path(f"manifest/{max(numbers)}")
        stream = files.open(place)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _save(self, manifest: dict) -> None:
        """A manifest counts once it has its name; whoever still reads by the one before finds its files."""
        manifest["number"] += 1
        files, draft = self._path(f"manifest/draft-{uuid.uuid4().hex}")
        stream = files.create(draft, True)
        stream.write(json.dumps(manifest).encode())
        stream.close()
        files.rename(draft, self._path(f"manifest/{manifest['number']}")[1])
        files.delete(self._path(f"manifest/{manifest['number'] - 2}")[1], False)

    def _read(self, names: Sequence[str]) -> DataFrame:
        if not names:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.folder}/{n}" for n in names])

    def _write(self, df: DataFrame, kind: str) -> str:
        name = f"{kind}/{uuid.uuid4().hex}"
        df.write.parquet(f"{self.folder}/{name}")
        return name

    # --- adding

    def _number(self):
        """The order column as a whole number."""
        return micros(self.order) if isinstance(self.schema[self.order].dataType, (T.TimestampType, T.TimestampNTZType)) else F.col(self.order).cast("long")

    def add(self, batch: DataFrame, batch_id: int) -> bool:
        """Add a batch as a run. A batch that is already in, as after a failure, is left out: False.

        Rows without an order value can never be the last of their key and are left out.
        """
        manifest = self.manifest()
        if batch_id <= manifest["batch"]:
            return False
        name = self._write(batch.select(*self.schema.names).where(F.col(self.order).isNotNull()), "runs")
        low, high, rows = self._read([name]).agg(F.min(self._number()), F.max(self._number()), F.count(F.lit(1))).first()
        manifest["batch"] = batch_id
        gone = manifest["old"]
        manifest["old"] = []
        if rows:
            manifest["runs"].append({"name": name, "low": low, "high": high, "rows": rows, "level": 0})
            self._merge(manifest)
        else:
            manifest["old"].append(name)
        self._save(manifest)
        # Replaced two batches ago: no reader that began before the last one can still want them.
        for name in gone:
            files, place = self._path(name)
            files.delete(place, True)
        return True

    def _merge(self, manifest: dict) -> None:
        level = 0
        while True:
            full = [r for r in manifest["runs"] if r["level"] == level]
            if len(full) < self.fan_in:
                if level >= _IN_BASE or not full:
                    return
                level += 1
                continue
            names = [r["name"] for r in full]
            if level == _IN_BASE - 1:
                held = [manifest["base"]] if manifest["base"] else []
                manifest["base"] = self._write(self._last(self._read(held + names)), "base")
                manifest["cut"] = max([r["high"] for r in full] + [manifest["cut"]] * bool(held))
                manifest["old"] += held
            manifest["runs"] = [r for r in manifest["runs"] if r["level"] != level]
            manifest["old"] += names
            if self.history or level < _IN_BASE - 1:
                rows = self._read(names).repartitionByRange(self.order).sortWithinPartitions(self.order)
                manifest["runs"].append({
                    "name": self._write(rows, "runs"), "low": min(r["low"] for r in full), "high": max(r["high"] for r in full),
                    "rows": sum(r["rows"] for r in full), "level": level + 1,
                })
            level += 1

    def _last(self, rows: DataFrame) -> DataFrame:
        """The last row of every key: by order, then `seq`, then the whole row."""
        rest = [c for c in self.schema.names if c not in self.by]
        value = F.struct(*rest)
        newest = rows.groupBy(*self.by).agg(F.max_by(value, F.struct(self.order, *([self.seq] if self.seq else []), value)).alias("_v"))
        return newest.select(*self.by, "_v.*").select(*self.schema.names)

    # --- reading

    def parts(self, low: int | None = None, high: int | None = None) -> list[str]:
        """What has to be opened to know the last rows before and all rows within [low, high] of the order column."""
        manifest = self.manifest()
        based = manifest["base"] is not None and (not self.history or low is None or low >= manifest["cut"])
        runs = [r for r in manifest["runs"] if not (based and r["level"] >= _IN_BASE) and (high is None or r["low"] <= high)]
        return ([manifest["base"]] if based else []) + [r["name"] for r in runs]

    def rows(self, low: int | None = None, high: int | None = None) -> DataFrame:
        """Rows that decide what is valid at any time in [low, high]: those within, and the last one of each key before.

        More rows may come along; none that was the last at a time asked for is missing.
        """
        found = self._read(self.parts(low, high))
        return found if high is None else found.where(self._number() <= high)

    def latest(self) -> DataFrame:
        """The last row of every key."""
        return self._last(self.rows())


def collect_runs(descriptors: DataFrame, supported: Sequence[str], store: RunStore, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Add the usable descriptors of a stream to a store of versions; refused ones go to a folder of their own."""
    from tidemark.streaming.serving import _start

    def write(batch: DataFrame, batch_id: int) -> None:
        judged = check_descriptors(batch, supported)
        refused = judged.where("error IS NOT NULL").drop(*[f.name for f in judged.schema.fields if isinstance(f.dataType, T.BinaryType)])
        refused.write.mode("overwrite").parquet(f"{store.folder}/refused/batch_id={batch_id}")
        store.add(judged.where("error IS NULL"), batch_id)

    return _start(descriptors, checkpoint, every, write)


def serve_from_runs(
    records: DataFrame, store: RunStore, score: Callable[[DataFrame], DataFrame], folder: str, checkpoint: str, *, on: str, every: str | None = None
) -> StreamingQuery:
    """Score a stream of records with a store's versions: each batch opens only what its own time range needs."""
    from tidemark.streaming.serving import _start

    def write(batch: DataFrame, batch_id: int) -> None:
        low, high = batch.agg(F.min(micros(on)), F.max(micros(on))).first()
        versions = store.rows(low, high) if low is not None else store.rows(0, -1)
        scored = score(assign_models(batch, versions, on=on, valid_from=store.order, by=store.by, seq=store.seq))
        scored.write.mode("overwrite").parquet(f"{folder}/batch_id={batch_id}")

    return _start(records, checkpoint, every, write)


def keep_latest_runs(stream: DataFrame, store: RunStore, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Keep the last state of every key of an updating stream; the store's order column gets the batch number."""
    from tidemark.streaming.serving import _start

    def write(batch: DataFrame, batch_id: int) -> None:
        store.add(batch.withColumn(store.order, F.lit(batch_id).cast(store.schema[store.order].dataType)), batch_id)

    return _start(stream, checkpoint, every, write, "update")

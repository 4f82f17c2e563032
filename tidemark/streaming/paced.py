"""Records played back at a pace: a number of records per trigger, whatever the files they lie in.

Spark's own rate source counts record numbers and keeps the place in the checkpoint; a batch reads the records with its
numbers from a table that is laid out in blocks of numbers, so it opens the files of those blocks only.
"""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

# Records of a block: one task writes it, and a batch reads the blocks that its numbers touch.
BLOCK = 1_000_000

_BLOCK_OF = "_block_of_numbers"


def lay_out(records: DataFrame, folder: str, seq: str = "seq", block: int = BLOCK) -> None:
    """Write records numbered 1, 2, 3, ... in blocks of numbers. Rows without a number are an error."""
    if _BLOCK_OF in records.columns:
        raise ValueError(f"the column {_BLOCK_OF} is taken")
    number = F.coalesce(F.col(seq), F.raise_error(F.lit("a record without a number")).cast("bigint"))
    placed = records.withColumn(_BLOCK_OF, F.floor((number - 1) / block))
    placed.repartition(_BLOCK_OF).sortWithinPartitions(_BLOCK_OF, seq).write.partitionBy(_BLOCK_OF).parquet(folder)


def _has_blocks(spark: SparkSession, folder: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return any(s.getPath().getName().startswith(f"{_BLOCK_OF}=") for s in files.listStatus(place))


class Playback:
    """A running playback: its streaming query (None without any record), and the end of the records."""

    def __init__(self, query: StreamingQuery | None, ended: threading.Event):
        self.query, self._ended = query, ended

    def await_end(self, timeout: float | None = None) -> bool:
        """Wait until all records are played, then stop; whether that was so in time. A failure of the query is raised."""
        waited = 0.0
        while not self._ended.is_set():
            # Raises what the query failed with, and tells whether it was stopped.
            if self.query.awaitTermination(0.2):
                return False
            waited += 0.2
            if timeout is not None and waited >= timeout:
                return False
        if self.query:
            self.query.stop()
        return True


def play(
    spark: SparkSession,
    folder: str,
    per_trigger: int,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    *,
    every: str = "0 seconds",
    seq: str = "seq",
    block: int = BLOCK,
) -> Playback:
    """Hand `write(rows, batch number)` the next `per_trigger` records at each trigger, one trigger in `every` interval.

    A batch that is run again after a failure gets the same records under the same number, and a new start with the same
    checkpoint goes on behind the last finished batch, with another pace too. The last batch may be smaller; after it
    nothing is written. `block` must be that of `lay_out`. Without records the playback ends at once.
    """
    if per_trigger < 1:
        raise ValueError("per_trigger must be 1 at least")
    ended = threading.Event()
    if not _has_blocks(spark, folder):
        ended.set()
        return Playback(None, ended)
    # Listed once; a batch's filter on the block leaves the other files out.
    records = spark.read.parquet(folder)
    last = records.agg(F.max(seq)).first()[0]

    def take(ticks: DataFrame, batch_id: int) -> None:
        low, high = ticks.agg(F.min("value") + 1, F.max("value") + 1).first()
        if low is None:
            return
        if low > last:
            # The batch before this one is finished, so nothing is left to do.
            ended.set()
            return
        blocks = F.col(_BLOCK_OF).between((low - 1) // block, (high - 1) // block)
        write(records.where(blocks & F.col(seq).between(low, high)).drop(_BLOCK_OF), batch_id)

    ticks = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", per_trigger).option("numPartitions", 1).load()
    query = ticks.writeStream.option("checkpointLocation", checkpoint).foreachBatch(take).trigger(processingTime=every).start()
    return Playback(query, ended)

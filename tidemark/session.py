"""Session settings and the shared working folder."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F


# The JVM interprets methods larger than this instead of compiling them.
_JIT_METHOD_BYTES = 8000


def build_session(app: str = "tidemark", master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.codegen.hugeMethodLimit", str(_JIT_METHOD_BYTES))
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings the queries rely on, for a session made elsewhere.

    Zone-less timestamps count as UTC. Wide parsers and models would generate methods the JVM refuses to compile;
    above its limit Spark's split-up code is several times faster.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", str(_JIT_METHOD_BYTES))
    return spark


def spread(df: DataFrame) -> DataFrame:
    """Use all cores for costly per-row work on a scan that comes in fewer pieces than there are cores.

    A large table has more pieces than cores and is left as it is. Meant for scans only: counting the pieces of a plan
    with a shuffle would run it.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def shared_base(spark: SparkSession) -> str:
    """The folder that driver and executors share: the checkpoint folder of the context, else of the configuration.

    Only a session on one machine may do without: it gets a local folder. On a cluster that would lose files.
    """
    context = spark.sparkContext
    current = context._jsc.sc().getCheckpointDir()
    base = current.get() if current.isDefined() else spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return os.path.join(tempfile.gettempdir(), "tidemark")


_made: list[tuple] = []


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared one; it is removed when the program ends, or by `remove_dir`."""
    path = f"{shared_base(spark)}/{name}-{uuid.uuid4().hex}"
    _made.append((spark._jvm, spark._jsparkSession.sessionState().newHadoopConf(), path))
    return path


def remove_dir(path: str) -> None:
    for made in [m for m in _made if m[2] == path]:
        _made.remove(made)
        jvm, conf, place = made
        at = jvm.org.apache.hadoop.fs.Path(place)
        at.getFileSystem(conf).delete(at, True)


@atexit.register
def _remove_all() -> None:
    for _, _, path in list(_made):
        try:
            remove_dir(path)
        except Exception:  # the JVM may be gone by now
            return


def settle(df: DataFrame) -> DataFrame:
    """Compute a small helper table once and keep it in reliable storage."""
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(f"{shared_base(df.sparkSession)}/checkpoints")
    return df.checkpoint(eager=True)


# Rows a helper table may have and still be sent to every executor. Such tables hold a few numbers per row.
BROADCAST_ROWS = 1_000_000


def broadcast_if_small(df: DataFrame, rows: int | None = None, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast a settled table once its row count is known to be small; otherwise leave the join to AQE."""
    if rows is None:
        rows = df.count()
    return F.broadcast(df) if rows <= limit else df

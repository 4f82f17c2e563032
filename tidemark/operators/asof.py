"""Give every record the model version that was valid at its time (M4), and the validity intervals themselves (M5).

Both forms return the records with one more struct column, null before the first version. A version and a record at
the same time: the version comes first. Two versions of a key at the same time: the larger `seq` wins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tidemark.operators.ordering import TARGET_ROWS, following, row_hash, running

# Version tables up to this size are sent to every executor instead of moving the records.
FEW_VERSIONS = 500
_TIE_RANGE = 2**31


def micros(time: str | Column) -> Column:
    """Epoch microseconds of a timestamp column (zone-less ones count as session time)."""
    return F.unix_micros((F.col(time) if isinstance(time, str) else time).cast("timestamp"))


def single_versions(
    versions: DataFrame, by: Sequence[str], valid_from: str, seq: str | None, carry: Sequence[str] | None = None
) -> DataFrame:
    """One row per key and start: key columns, `_from` in microseconds, `_version` struct of the carried columns."""
    if carry is None:
        carry = [f.name for f in versions.schema.fields if not isinstance(f.dataType, T.BinaryType)]
    everything = F.struct(*carry)
    return (
        versions.where(F.col(valid_from).isNotNull())
        .groupBy(*by, micros(valid_from).alias("_from"))
        .agg(F.max_by(everything, F.struct(seq, everything) if seq else everything).alias("_version"))
    )


def assign_models(
    records: DataFrame,
    versions: DataFrame,
    *,
    on: str,
    valid_from: str = "valid_from",
    by: Sequence[str] = (),
    seq: str | None = None,
    out: str = "model",
    form: str = "auto",
    carry: Sequence[str] | None = None,
    few: int = FEW_VERSIONS,
    target_rows: int = TARGET_ROWS,
) -> DataFrame:
    """As-of join of records with versions on time `on`, per key `by`.

    Up to `few` versions no records move: form "auto" reads at most few + 1 version starts to decide. More versions, or
    form "window", take a window that cuts hot keys and hot times into slices. The results are the same. `carry` names the
    version columns that go along, by default all but binary ones: model files stay in the registry.
    """
    by = list(by)
    single = single_versions(versions, by, valid_from, seq, carry)
    if form != "window":
        starts = [r["_from"] for r in single.select("_from").limit(few + 1).collect()]
        if len(starts) <= few:
            return _broadcast_form(records, single, sorted(set(starts)), on, by, out)
    return _window_form(records, single, on, by, out, target_rows)


def _search(time: str, starts: Sequence[int], first: int = 0) -> str:
    """SQL text of a balanced search: how many of the sorted starts are at or before `time`, plus `first`."""
    if not starts:
        return str(first)
    middle = len(starts) // 2
    right = _search(time, starts[middle + 1 :], first + middle + 1)
    left = _search(time, starts[:middle], first)
    return f"CASE WHEN {time} >= {starts[middle]}L THEN {right} ELSE {left} END"


def _broadcast_form(
    records: DataFrame, single: DataFrame, starts: Sequence[int], on: str, by: list[str], out: str
) -> DataFrame:
    names = list(records.columns)
    until = F.lead("_from").over(Window.partitionBy(*by).orderBy("_from"))
    # Without a key, the place of a time among the sorted starts is an equality to join on.
    place = F.expr(_search("_from", starts))
    ranges = single.select(*[F.col(k).alias(f"_k_{k}") for k in by], "_from", until.alias("_until"), "_version", place.alias("_place"))
    timed = records.withColumn("_at", micros(on))
    if by:
        match = F.lit(True)
        for k in by:
            match = match & timed[k].eqNullSafe(ranges[f"_k_{k}"])
        match = match & (timed["_at"] >= ranges["_from"])
        match = match & (ranges["_until"].isNull() | (timed["_at"] < ranges["_until"]))
    else:
        timed = timed.withColumn("_place_of", F.expr(_search("_at", starts)))
        match = timed["_place_of"] == ranges["_place"]
    joined = timed.join(F.broadcast(ranges), match, "left")
    return joined.select(*[timed[n] for n in names], F.col("_version").alias(out))


def _window_form(
    records: DataFrame, single: DataFrame, on: str, by: list[str], out: str, target_rows: int
) -> DataFrame:
    # Rows alike in key and time may be told apart by anything; the hash only lets a hot moment be cut up.
    record_rows = records.select(
        *by,
        micros(on).alias("_at"),
        F.lit(1).alias("_kind"),
        F.pmod(row_hash(records), F.lit(_TIE_RANGE)).alias("_tie"),
        F.struct(*records.columns).alias("_record"),
        F.lit(None).cast(single.schema["_version"].dataType).alias("_version"),
    )
    version_rows = single.select(
        *by,
        F.col("_from").alias("_at"),
        F.lit(0).alias("_kind"),
        F.lit(0).cast("bigint").alias("_tie"),
        F.lit(None).cast(record_rows.schema["_record"].dataType).alias("_record"),
        "_version",
    )
    both = record_rows.unionByName(version_rows)
    found = running(both, by, ["_at", "_kind", "_tie"], {"_model": ("last", "_version")}, target_rows)
    return found.where("_kind = 1").select("_record.*", F.col("_model").alias(out))


def version_intervals(
    versions: DataFrame,
    *,
    by: Sequence[str] = (),
    valid_from: str = "valid_from",
    seq: str | None = None,
    until: str = "valid_to",
    target_rows: int = TARGET_ROWS,
) -> DataFrame:
    """Each version with the start of the next version of its key; the current version has a null end."""
    timed = versions.withColumn("_at", micros(valid_from))
    order = ["_at"] + ([seq] if seq else [])
    return following(timed, list(by), order, valid_from, until, target_rows).drop("_at")

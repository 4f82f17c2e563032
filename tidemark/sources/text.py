"""Scan of delimited text over many files, with the line number of every line in its file."""

from __future__ import annotations

import bz2
import io
import logging
import zipfile
from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidemark.session import broadcast_if_small, settle
from tidemark.sources.archives import FAULTS, UNREADABLE, Opener, archive_lines, fault_of, is_local, open_local, text_lines

_ARCHIVES = r"\.(zip|bzip2)$"
_BATCH_LINES = 20_000

_LINES = "file string, at bigint, value string"


_log = logging.getLogger(__name__)


class MissingInput(ValueError):
    """Some of the requested files are not there, or none were requested."""


def _statuses(spark: SparkSession, paths: Sequence[str]) -> dict[str, bool]:
    """Those of the paths that are there, and whether each is a folder; one listing for all paths of one parent."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path
    families: dict[str, list] = {}
    for path in dict.fromkeys(paths):
        place = hadoop_path(path)
        files = place.getFileSystem(conf)
        place = files.makeQualified(place)
        parent = place.getParent()
        families.setdefault(parent.toString() if parent is not None else "", []).append((path, place, files))
    found = {}
    for family in families.values():
        if len(family) == 1:
            path, place, files = family[0]
            if files.exists(place):
                found[path] = files.getFileStatus(place).isDirectory()
            continue
        files, parent = family[0][2], family[0][1].getParent()
        listed = {s.getPath().getName(): s.isDirectory() for s in files.listStatus(parent)} if files.exists(parent) else {}
        found |= {path: listed[place.getName()] for path, place, _ in family if place.getName() in listed}
    return found


def existing_paths(spark: SparkSession, paths: Sequence[str], fail_if_missing: bool = True) -> dict[str, bool]:
    """Check every requested path; report all missing ones at once, or go on with those present.

    Gives the paths that are there, in their order, and whether each is a folder.
    """
    if not paths:
        if fail_if_missing:
            raise MissingInput("no paths were given to read from")
        return {}
    present = _statuses(spark, paths)
    missing = [p for p in paths if p not in present]
    if missing and fail_if_missing:
        raise MissingInput(f"not there: {', '.join(missing)}")
    for path in missing:
        _log.warning("not there, left out: %s", path)
    return {p: present[p] for p in paths if p in present}


def _literal(path: str) -> str:
    """Escape glob characters, so that a listed path is that file and no other."""
    return "".join("\\" + c if c in "*?[]{}\\" else c for c in path)


def _plain_text(column: str) -> Column:
    """File metadata columns are percent-encoded; a literal plus sign is not."""
    return F.url_decode(F.replace(F.col(column), F.lit("+"), F.lit("%2B")))


def _name() -> Column:
    return _plain_text("_metadata.file_name")


def _unpack(name: str, content: bytes) -> Iterator[str]:
    """Lines of a zip (all entries in order) or bzip2 file, decoded as they stream out."""
    if name.endswith(".zip"):
        with zipfile.ZipFile(io.BytesIO(content)) as archive:
            for entry in archive.infolist():
                if not entry.is_dir():
                    with archive.open(entry) as raw:
                        yield from text_lines(raw)
    else:
        with bz2.open(io.BytesIO(content)) as raw:
            yield from text_lines(raw)


def _archive_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def out(name, start, lines):
        return pa.RecordBatch.from_arrays(
            [
                pa.array([name] * len(lines), pa.string()),
                pa.array(range(start, start + len(lines)), pa.int64()),
                pa.array(lines, pa.string()),
            ],
            names=["file", "at", "value"],
        )

    for batch in batches:
        for name, content in zip(batch.column(0), batch.column(1)):
            lines, start = [], 0
            try:
                for line in _unpack(name.as_py(), content.as_py()):
                    lines.append(line)
                    if len(lines) == _BATCH_LINES:
                        yield out(name.as_py(), start, lines)
                        start, lines = start + len(lines), []
            except FAULTS as e:
                # What could be read stays; the fault itself is a line that no parser takes for a record.
                lines.append(f"{UNREADABLE}{fault_of(e)}")
            if lines:
                yield out(name.as_py(), start, lines)


def _plain_lines(spark: SparkSession, locations: Sequence[str], regex: str) -> tuple[DataFrame, DataFrame]:
    """Lines Spark's own text source can read, numbered per file, and the names of the files.

    A large file is read in splits, so a line's number is the lines of the file's earlier splits plus its place in
    its own. The counts per split come from one extra scan that keeps one row per split. Both scans must cut the files
    alike: the setting below keeps a growing cluster from cutting them finer, and a line that does not fit its split's
    count fails the job rather than getting a wrong number.
    """
    if spark.conf.get("spark.sql.files.minPartitionNum", None) is None:
        spark.conf.set("spark.sql.files.minPartitionNum", str(spark.sparkContext.defaultParallelism))
    scan = spark.read.text(list(locations)).where(~_name().rlike(_ARCHIVES))
    if regex.strip():
        scan = scan.where(_name().rlike(regex))
    # Rows of a split are consecutive within one task, which this id counts.
    lines = scan.select(
        F.col("_metadata.file_path").alias("_path"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"),
        "value",
    )
    before = Window.partitionBy("_path").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    splits = settle(
        lines.groupBy("_path", "_block")
        .agg(F.count(F.lit(1)).alias("_lines"), F.min("_row").alias("_first"))
        .select(
            F.col("_path").alias("_of_path"),
            F.col("_block").alias("_of_block"),
            _plain_text("_path").alias("file"),
            F.coalesce(F.sum("_lines").over(before), F.lit(0)).alias("_before"),
            "_lines",
            "_first",
        )
    )
    # One row per split, that is per 128 MB by default.
    joined = lines.join(
        broadcast_if_small(splits),
        (F.col("_path") == F.col("_of_path")) & (F.col("_block") == F.col("_of_block")),
        "left",
    )
    place = F.col("_row") - F.col("_first")
    changed = F.raise_error(F.lit("The files were cut differently in two scans; read them again.")).cast("bigint")
    at = F.when((place >= 0) & (place < F.col("_lines")), F.col("_before") + place).otherwise(changed)
    numbered = joined.select("file", at.alias("at"), "value")
    return numbered, splits.select("file").distinct()


def _archived_lines(
    spark: SparkSession, locations: Sequence[str], regex: str, opener: Opener | None
) -> tuple[DataFrame, DataFrame]:
    files = spark.read.format("binaryFile").load(list(locations)).where(_name().rlike(_ARCHIVES))
    if regex.strip():
        files = files.where(_name().rlike(regex))
    names = files.select(F.col("path").alias("file"))
    if opener:
        return archive_lines(names, opener), names
    # Only Spark can open these: a whole archive comes as one value.
    return files.select(F.col("path").alias("file"), "content").mapInArrow(_archive_batches, _LINES), names


def read_lines(
    spark: SparkSession,
    paths: Sequence[str] = (),
    *,
    dirs: Sequence[str] = (),
    name_regex: str = "",
    drop_first: int = 0,
    fail_if_missing: bool = True,
    open_archive: Opener | None = None,
) -> DataFrame:
    """Lines as (file, file_idx, line_no, value); line_no starts at 0 after the `drop_first` lines of each file.

    Explicit paths win over directories; `name_regex` selects files of directories by a search in their names. A path
    may be a folder too: then all its files are read. file_idx is the place of the file in the listed order, within a
    folder in path order; a path listed twice gives its lines twice. Missing folders are left out with a warning; if
    nothing at all is found, that is an error unless `fail_if_missing` is off. A corrupt archive gives the lines that
    can be read and one more that begins with UNREADABLE.

    Zip and bzip2 archives are read as streams, a zip one task per entry, where the workers can open them: on mounted file
    systems, or anywhere with `open_archive`, which opens a path as Spark lists it. Else they come whole, below 2 GB each.
    """
    if paths:
        present, name_regex = existing_paths(spark, paths, fail_if_missing), ""
    elif dirs:
        present = existing_paths(spark, dirs, False)
    else:
        raise MissingInput("Neither paths nor directories were given.")
    found = [p for p in paths or dirs if p in present]
    files = list(present)
    folders = {p for p in files if present[p]}
    # Folders may hold both kinds; each scan leaves out what the other reads.
    plain = [_literal(p) for p in files if p in folders or not p.endswith((".zip", ".bzip2"))]
    packed = [_literal(p) for p in files if p in folders or p.endswith((".zip", ".bzip2"))]
    if fail_if_missing and not _any_file(spark, files, name_regex):
        raise MissingInput(f"no file found in {', '.join(paths or dirs)}" + (f" for the pattern {name_regex}" if name_regex else ""))
    parts = []
    if plain:
        parts.append(_plain_lines(spark, plain, name_regex))
    if packed:
        opener = open_archive or (open_local if all(is_local(qualified(spark, p)) for p in files) else None)
        parts.append(_archived_lines(spark, packed, name_regex, opener))
    if not parts:
        return spark.createDataFrame([], "file string, file_idx int, line_no bigint, value string")
    lines = reduce(DataFrame.unionByName, [part for part, _ in parts])
    lines = lines.where(F.col("at") >= drop_first).withColumn("line_no", F.col("at") - drop_first)
    # One row per file, from the split counts and the archive listing rather than the lines. The driver's file listing
    # holds as many, so numbering them in one task is no further bound.
    names = reduce(DataFrame.unionByName, [own for _, own in parts]).distinct()
    ancestors = F.transform(F.sequence(F.lit(1), F.size("_steps")), lambda i: F.array_join(F.slice("_steps", F.lit(1), i), "/"))
    places = spark.createDataFrame([(qualified(spark, p).rstrip("/"), i) for i, p in enumerate(found)], "_place string, _at int")
    placed = (
        names.withColumn("_steps", F.split("file", "/")).select("file", F.explode(ancestors).alias("_place"))
        .join(F.broadcast(places), "_place").select("file", "_at")
    )
    order = settle(placed.select("file", (F.row_number().over(Window.orderBy("_at", "file")) - 1).alias("file_idx")))
    order = broadcast_if_small(order.withColumnRenamed("file", "_named"))
    return lines.join(order, F.col("file") == F.col("_named"), "left").select("file", "file_idx", "line_no", "value")


def qualified(spark: SparkSession, path: str) -> str:
    """The path the way file listings show it, with the scheme of its file system."""
    here = spark._jvm.org.apache.hadoop.fs.Path(path)
    return here.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(here).toString()


def _any_file(spark: SparkSession, paths: Sequence[str], regex: str) -> bool:
    """Whether there is any file, empty ones included; only the listing is read."""
    if not paths:
        return False
    listing = spark.read.format("binaryFile").load([_literal(p) for p in paths]).select("path")
    return not (listing.where(_name().rlike(regex)) if regex.strip() else listing).isEmpty()

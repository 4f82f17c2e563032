"""Lines of zip and bzip2 archives, read as streams: one task per zip entry, with nothing held in memory.

The workers open the archives themselves, at any place. Entries come from the central directory, which takes a few reads
at the end of the file; they are dealt out over tasks, and each is unpacked on its own. A bzip2 file is one entry.
"""

from __future__ import annotations

import bz2
import io
import zipfile
import zlib
from collections.abc import Callable, Iterator
from typing import BinaryIO
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.session import broadcast_if_small, settle

# Begins the line that stands for what could not be read of an archive.
UNREADABLE = "\x00unreadable archive: "

# What corrupt, encrypted and strange archives raise.
FAULTS = (zipfile.BadZipFile, zlib.error, OSError, EOFError, NotImplementedError, RuntimeError)

# A path as Spark lists it in, a file open for reading at any place out.
Opener = Callable[[str], BinaryIO]

_BATCH_LINES = 20_000
_TASKS_PER_CORE = 4
_LINES = "file string, entry int, at bigint, value string"


def open_local(path: str) -> BinaryIO:
    """Opens paths of file systems that are mounted everywhere under the same name."""
    return open("/" + path.removeprefix("file:").lstrip("/"), "rb")


def is_local(path: str) -> bool:
    return urlsplit(path).scheme in ("", "file")


def fault_of(e: Exception) -> str:
    """What is wrong with an archive; trouble in reaching it is none of its faults, and the task is to be tried again."""
    if isinstance(e, OSError) and e.errno is not None:
        raise e
    return str(e)


def text_lines(raw) -> Iterator[str]:
    for line in io.TextIOWrapper(raw, encoding="utf-8", errors="replace", newline=None):
        yield line[:-1] if line.endswith("\n") else line


def _entries_of(path: str, opener: Opener) -> list[int]:
    """Places of the entries with content in the archive's list."""
    if not path.endswith(".zip"):
        return [0]
    with opener(path) as raw, zipfile.ZipFile(raw) as archive:
        return [i for i, entry in enumerate(archive.infolist()) if not entry.is_dir()]


def _entry_lines(path: str, entry: int, opener: Opener) -> Iterator[str]:
    with opener(path) as raw:
        if not path.endswith(".zip"):
            with bz2.open(raw) as text:
                yield from text_lines(text)
            return
        with zipfile.ZipFile(raw) as archive, archive.open(archive.infolist()[entry]) as text:
            yield from text_lines(text)


def _list(opener: Opener):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for path in batch.column(0).to_pylist():
                try:
                    places, fault = _entries_of(path, opener), None
                except FAULTS as e:
                    places, fault = [-1], fault_of(e)
                rows += [(path, p, p == places[-1], fault) for p in places]
            columns = [list(c) for c in zip(*rows)] or [[], [], [], []]
            kinds = (pa.string(), pa.int32(), pa.bool_(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["file", "entry", "last", "fault"])

    return run


def _unpack(opener: Opener):
    def part(path, entry, start, lines):
        n = len(lines)
        return pa.RecordBatch.from_arrays(
            [pa.array([path] * n, pa.string()), pa.array([entry] * n, pa.int32()), pa.array(range(start, start + n), pa.int64()),
             pa.array(lines, pa.string())], names=["file", "entry", "at", "value"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, entry, fault in zip(*(batch.column(i).to_pylist() for i in range(3))):
                lines, start = [], 0
                try:
                    for line in [f"{UNREADABLE}{fault}"] if fault is not None else _entry_lines(path, entry, opener):
                        lines.append(line)
                        if len(lines) == _BATCH_LINES:
                            yield part(path, entry, start, lines)
                            start, lines = start + len(lines), []
                except FAULTS as e:
                    # What could be read stays; the fault itself is a line that no parser takes for a record.
                    lines.append(f"{UNREADABLE}{fault_of(e)}")
                if lines:
                    yield part(path, entry, start, lines)

    return run


def archive_lines(files: DataFrame, opener: Opener = open_local) -> DataFrame:
    """(file, at, value) of the archives in the column `file`; `at` counts an archive's lines from 0, entry by entry.

    Where an archive has several entries, all but its last one are unpacked once more to count their lines. An entry that
    cannot be read gives the lines before the fault and one that begins with UNREADABLE; the other entries are read.
    """
    listed = files.select("file").mapInArrow(_list(opener), "file string, entry int, last boolean, fault string")
    entries = settle(listed)
    cores = files.sparkSession.sparkContext.defaultParallelism
    tasks = max(1, min(entries.count(), _TASKS_PER_CORE * cores))

    def lines_of(some: DataFrame) -> DataFrame:
        return some.select("file", "entry", "fault").repartition(tasks).mapInArrow(_unpack(opener), _LINES)

    lines = lines_of(entries)
    inner = entries.where("NOT last")
    if inner.isEmpty():
        return lines.select("file", "at", "value")
    counted = lines_of(inner).groupBy("file", "entry").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("file").orderBy("entry").rowsBetween(Window.unboundedPreceding, -1)
    # One row per entry. An entry without lines has no count.
    starts = settle(
        entries.join(counted, ["file", "entry"], "left").select("file", "entry", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    )
    return lines.join(broadcast_if_small(starts), ["file", "entry"]).select("file", (F.col("start") + F.col("at")).alias("at"), "value")

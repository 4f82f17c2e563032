"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

A test item gives windows of 13 consecutive words (a shorter item one window). Windows of one length make a searcher.
It slides a window over the words of a document; the last two words under it are the block. The block shift table tells
how far the window may move because no test window has the block nearer to its end. Where the shift is zero, the block's
bucket holds the candidate windows, and a direct comparison of words confirms an occurrence.

Rules for odd input: null, empty and wordless texts have no words and are never contaminated; a null item id counts as
an empty string; items repeated under one id count once; an item without words has no window; an empty benchmark hits
nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import arrow_schema, col, pieces, struct_with, text_of, with_columns

WINDOW = 13

# Test texts that are searched for in one pass, in characters; more are searched in several passes of this size.
PASS_CHARS = 4_000_000

# Bytes that are no part of a word become spaces; A-Z become small letters; bytes of other characters stay.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


class Searcher:
    """All windows of one length, with their shift table and the buckets of their last blocks."""

    def __init__(self, length: int):
        self.length = length
        self.block = min(2, length)
        self.shift: dict = {}
        self.buckets: dict = {}
        self._seen: dict = {}

    def add(self, window: tuple[bytes, ...], item: int) -> None:
        if window in self._seen:
            self._seen[window].add(item)
            return
        items = self._seen[window] = {item}
        b = self.block
        for end in range(b, self.length + 1):
            block = window[end - 1] if b == 1 else (window[end - 2], window[end - 1])
            away = self.length - end
            if away < self.shift.get(block, self.length):
                self.shift[block] = away
            if not away:
                self.buckets.setdefault(block, []).append((list(window), items))

    def find(self, words: list[bytes]) -> Iterator[tuple[int, set[int]]]:
        """Starts of all occurrences with the items they belong to."""
        length, b, get, n = self.length, self.block, self.shift.get, len(words)
        free = length - b + 1
        at = length
        while at <= n:
            block = words[at - 1] if b == 1 else (words[at - 2], words[at - 1])
            move = get(block, free)
            if move:
                at += move
                continue
            start = at - length
            for window, items in self.buckets[block]:
                if words[start:at] == window:
                    yield start, items
            at += 1


class Patterns:
    """Windows of test items, one searcher for each window length."""

    def __init__(self, items: Sequence[tuple[str, str]], window: int = WINDOW):
        self.ids = sorted({str(i) for i, _ in items})
        place = {i: k for k, i in enumerate(self.ids)}
        by_length: dict[int, Searcher] = {}
        for item, text in items:
            words = words_of(text)
            length = min(window, len(words))
            if not length:
                continue
            searcher = by_length.setdefault(length, Searcher(length))
            for start in range(len(words) - length + 1):
                searcher.add(tuple(words[start:start + length]), place[str(item)])
        self.searchers = list(by_length.values())

    def search(self, text: str | None) -> tuple[int, list[tuple[int, int]], list[str]]:
        """Number of words, covered stretches of words (start, end), and ids of the items found."""
        words = words_of(text)
        found: list[tuple[int, int]] = []
        items: set[int] = set()
        for searcher in self.searchers:
            for start, of in searcher.find(words):
                found.append((start, start + searcher.length))
                items |= of
        return len(words), merged(found), [self.ids[i] for i in sorted(items)]


def merged(stretches: Sequence[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for start, end in sorted(stretches):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(a, b) for a, b in out]


# The searchers of the running pass, built once in each Python worker.
_BUILT: dict[str, Patterns] = {}


def _built(name: str, items, window: int) -> Patterns:
    if name not in _BUILT:
        _BUILT.clear()
        _BUILT[name] = Patterns(items.value, window)
    return _BUILT[name]


def _passes(benchmark: DataFrame, item: str, text: str, pass_chars: int) -> Iterator[list[tuple[str, str]]]:
    """The test items in parts of bounded size; the driver holds one part at a time."""
    light = benchmark.select(
        F.coalesce(col(benchmark, item).cast("string"), F.lit("")).alias("i"), text_of(benchmark, text).alias("t")
    )
    part: list[tuple[str, str]] = []
    size = 0
    for row in light.toLocalIterator():
        if part and size + len(row.t) > pass_chars:
            yield part
            part, size = [], 0
        part.append((row.i, row.t))
        size += len(row.t) + 16
    yield part


def search(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",),
    item: str = "item_id", item_text: str = "text", window: int = WINDOW, pass_chars: int = PASS_CHARS,
) -> DataFrame:
    """Per document: the kept columns, n_words, hits (covered stretches of words) and items (ids, sorted as strings).

    The kept columns must not bear the new names. A large benchmark is searched for in several passes; each adds its
    findings to those of the passes before it, in the same task, so the documents are never shuffled.
    """
    context, n = docs.sparkSession.sparkContext, len(keep)
    found = "n_words long, hits array<struct<start:int,end:int>>, items array<string>"
    with_text = struct_with(docs, keep, f"{found}, _text string")
    out = docs.select(
        *[col(docs, c) for c in keep], F.lit(0).cast("long").alias("n_words"),
        F.array().cast("array<struct<start:int,end:int>>").alias("hits"), F.array().cast("array<string>").alias("items"),
        col(docs, text).cast("string").alias("_text"),
    )
    for items in _passes(benchmark, item, item_text, pass_chars):
        out = out.mapInArrow(_pass(context.broadcast(items), uuid.uuid4().hex, window, n, arrow_schema(with_text)), with_text)
    return out.drop("_text")


def _pass(items, name: str, window: int, n: int, schema: pa.Schema):
    def run(batches):
        patterns = _built(name, items, window)
        for batch in pieces(batches):
            rows = [patterns.search(t) for t in batch.column(n + 3).to_pylist()]
            before = zip(batch.column(n + 1).to_pylist(), batch.column(n + 2).to_pylist())
            hits, ids = [], []
            for (_, mine, own), (had, known) in zip(rows, before):
                all_hits = merged(mine + [(h["start"], h["end"]) for h in had]) if had else mine
                hits.append([{"start": a, "end": b} for a, b in all_hits])
                ids.append(sorted({*own, *known}) if known else own)
            yield with_columns(batch, n, schema, [r[0] for r in rows], hits, ids, batch.column(n + 3))

    return run


def n_hit(hits: str = "hits"):
    return F.aggregate(hits, F.lit(0).cast("long"), lambda total, h: total + h["end"] - h["start"])


def contaminated(hits: str = "hits", n_words: str = "n_words"):
    return (n_hit(hits) > 0) & (n_hit(hits) * 20 >= F.col(n_words))


def without_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id") -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    names = docs.columns
    inner = docs.toDF(*[f"c{i}" for i in range(len(names))])
    place = names.index(text)
    found = search(inner, benchmark, f"c{place}", inner.columns, item)
    return found.where(~contaminated()).drop("n_words", "hits", "items").toDF(*names)

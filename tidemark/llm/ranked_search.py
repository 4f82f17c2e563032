"""Ranked lexical search over bags: documents that no item can tell apart are scored once.

Documents are restricted to the vocabulary of the items. Two documents with the same term counts over that vocabulary and
the same length figure m have the same score for every item; such a bag is found by its hash and verified by comparing
counts and m. Each class of bags is scored once, for all items, in integers. The best classes of an item give its best
documents: a class is taken by its score and its smallest doc_id, and its members follow by ascending doc_id.

Items are taken in blocks of a bounded vocabulary, so what is sent to the workers has a size of its own; every block is
held against all documents.

Rules for odd input: null texts have no terms; a document without any term counts nowhere; each row is a document, so
repeated rows are ranked one after the other; null doc_ids come after all others among equal scores. Items that share an
item_id, null included, are one item with the terms of all of them; an item without terms or without any document gets
no rows; empty tables give none.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.common import Shelf, col, pieces
from tidemark.session import broadcast_if_small

TOP = 10

# Term occurrences (item, term) and bytes of terms that one block of items may have; an item is never split.
BLOCK_TERMS = 500_000
BLOCK_BYTES = 16 << 20

# Every byte that is no part of a term becomes a space, capitals become small; bytes of other letters stay.
_TERMS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)

# Bags scored together, and (bag, item) cells of one such batch.
_BAGS = 512
_CELLS = 4_000_000

# Stands for a missing doc_id in comparisons.
_LAST = 2**63 - 1

_BAG = "doc_id long, n long, terms array<int>, counts array<int>"
_CANDIDATE = "item int, score long, bag long, m long, first long"


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_TERMS).split()


def _item_blocks(items: DataFrame, item_id: str, text: str, terms: int, size: int) -> Iterator[tuple[list, list[bytes], list[np.ndarray]]]:
    """(item ids, vocabulary, term numbers of each item) of one block after the other."""
    kind = items.select(col(items, item_id).alias("i"), col(items, text).cast("string").alias("t"))
    rows = kind.groupBy("i").agg(F.concat_ws(" ", F.collect_list("t")).alias("t")).orderBy("i")
    ids, vocabulary, own, n_terms, n_bytes = [], {}, [], 0, 0
    for r in rows.toLocalIterator():
        words = sorted(set(terms_of(r.t)))
        new = [w for w in words if w not in vocabulary]
        if ids and (n_terms + len(words) > terms or n_bytes + sum(map(len, new)) > size):
            yield ids, list(vocabulary), own
            ids, vocabulary, own, n_terms, n_bytes, new = [], {}, [], 0, 0, words
        for w in new:
            vocabulary[w] = len(vocabulary)
        ids.append(r.i)
        own.append(np.array([vocabulary[w] for w in words], np.int64))
        n_terms, n_bytes = n_terms + len(words), n_bytes + sum(map(len, new))
    if ids:
        yield ids, list(vocabulary), own


def bags(docs: DataFrame, vocabulary: Sequence[bytes], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n (all terms of the text) and the counts of the terms in the vocabulary, of every document with a term."""
    shared = docs.sparkSession.sparkContext.broadcast({w: i for i, w in enumerate(vocabulary)})

    def run(batches: Iterable[pa.RecordBatch]):
        number = shared.value.get
        for batch in pieces(batches, rows=512, size=8 << 20):
            ids, sizes, terms, counts, ends = [], [], [], [], [0]
            for i, text_ in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = terms_of(text_.as_py())
                if not words:
                    continue
                # All numbers of one document, those without one left out.
                found = np.array([x for x in map(number, words) if x is not None], np.int32)
                own, times = np.unique(found, return_counts=True)
                ids.append(i)
                sizes.append(len(words))
                terms.append(own)
                counts.append(times.astype(np.int32))
                ends.append(ends[-1] + len(own))
            lists = [
                pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(x) if x else np.array([], np.int32), pa.int32()))
                for x in (terms, counts)
            ]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), *lists], names=["doc_id", "n", "terms", "counts"])

    rows = docs.select(col(docs, doc_id).cast("long").alias("doc_id"), col(docs, text).cast("string").alias("t"))
    return rows.mapInArrow(run, _BAG)


def _totals(bags_: DataFrame) -> tuple[int, int]:
    r = bags_.agg(F.count(F.lit(1)).alias("N"), F.sum("n").alias("L")).first()
    return r.N, r.L or 0


def _weights(bags_: DataFrame, n_docs: int, size: int) -> np.ndarray:
    """w of every term of the vocabulary; terms in no document have none to score."""
    df = bags_.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    w = F.floor(1000 * F.log((2 * F.lit(n_docs) + 2).cast("double") / (2 * F.col("df") + 1))).cast("long")
    weights = np.zeros(size, np.int64)
    for r in df.select("term", w.alias("w")).toLocalIterator():
        weights[r.term] = r.w
    return weights


def _scorer(postings, weights, n_items: int, top: int):
    """Score classes of bags against all items of a block, and keep the best classes of each item in the task."""

    def run(batches):
        starts, of_item, w = postings.value[0], postings.value[1], weights.value
        rows = max(1, min(_BAGS, _CELLS // max(1, n_items)))
        best = [np.array([], np.int64) for _ in range(5)]
        for batch in pieces(batches, rows=rows, size=8 << 20):
            # A class whose members have no doc_id comes after all others.
            bag, m, first = (pc.fill_null(batch.column(i), _LAST).to_numpy() for i in range(3))
            lists, tf = batch.column(3), batch.column(4)
            sizes = np.diff(lists.offsets.to_numpy())
            terms = lists.flatten().to_numpy().astype(np.int64)
            tf = tf.flatten().to_numpy().astype(np.int64)
            row = np.repeat(np.arange(batch.num_rows), sizes)
            share = w[terms] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[row]))
            # Every term's share goes to each item that has the term.
            times = starts[terms + 1] - starts[terms]
            at = np.repeat(starts[terms] - np.concatenate(([0], np.cumsum(times)[:-1])), times) + np.arange(times.sum())
            score = np.zeros(batch.num_rows * n_items, np.int64)
            np.add.at(score, np.repeat(row, times) * n_items + of_item[at], np.repeat(share, times))
            hit = np.flatnonzero(score > 0)
            r = hit // n_items
            joined = [np.concatenate(x) for x in zip(best, (hit % n_items, score[hit], bag[r], m[r], first[r]))]
            best = _best(joined, top)
        items, score, bag, m, first = best
        yield pa.RecordBatch.from_arrays([pa.array(items, pa.int32()), *(pa.array(x, pa.int64()) for x in (score, bag, m, first))],
                                         names=["item", "score", "bag", "m", "first"])

    return run


def _best(columns: list[np.ndarray], top: int) -> list[np.ndarray]:
    """The `top` rows of every item by score, then smallest first member, then bag."""
    items, score, bag, m, first = columns
    order = np.lexsort((m, bag, first, -score, items))
    items = items[order]
    new = np.concatenate(([True], items[1:] != items[:-1])) if len(items) else np.array([], bool)
    start = np.maximum.accumulate(np.where(new, np.arange(len(items)), 0)) if len(items) else np.array([], np.int64)
    kept = order[np.arange(len(items)) - start < top]
    return [c[kept] for c in columns]


def _search_block(docs: DataFrame, ids: list, vocabulary: list, own: list, item_kind, doc_id: str, text: str, top: int, shelf: Shelf):
    spark = docs.sparkSession
    with Shelf(spark) as helpers:
        kept = helpers.put(bags(docs, vocabulary, doc_id, text), "bags")
        n_docs, length = _totals(kept)
        if not length:
            return None
        weights = _weights(kept, n_docs, len(vocabulary))
        m = F.lit(10) + F.expr(f"(90L * n * {n_docs}L) div {length}L")
        rows = kept.where(F.size("terms") > 0).select("doc_id", "terms", "counts", m.cast("long").alias("m"))
        rows = rows.withColumn("bag", F.xxhash64("m", "terms", "counts"))
        # Grouping by the hash and by what it stands for: equal hashes of different bags stay apart.
        classes = helpers.put(rows.groupBy("bag", "m", "terms", "counts").agg(F.min("doc_id").alias("first")), "classes")
        numbers = np.concatenate(own) if own else np.array([], np.int64)
        items = np.repeat(np.arange(len(own)), [len(x) for x in own])
        order = np.argsort(numbers, kind="stable")
        starts = np.searchsorted(numbers[order], np.arange(len(vocabulary) + 1))
        context = spark.sparkContext
        scored = classes.select("bag", "m", "first", "terms", "counts").mapInArrow(
            _scorer(context.broadcast((starts, items[order])), context.broadcast(weights), len(ids), top), _CANDIDATE
        )
        rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), "first", "bag", "m"))
        best = helpers.put(scored.withColumn("r", rank).where(F.col("r") <= top).drop("r"), "best")
        # At most `top` classes an item. Their members come from the bags, compared in full once more.
        sure = F.coalesce(F.col("c.first"), F.lit(_LAST))
        chosen = classes.alias("c").join(
            broadcast_if_small(best.select("bag", "m", "first").distinct(), len(ids) * top).alias("b"),
            (F.col("c.bag") == F.col("b.bag")) & (F.col("c.m") == F.col("b.m")) & (sure == F.col("b.first")),
        ).select("c.*")
        chosen = helpers.put(chosen.select("bag", "m", "terms", "counts", F.coalesce("first", F.lit(_LAST)).alias("first")), "chosen")
        same = ["bag", "m", "terms", "counts"]
        members = rows.join(broadcast_if_small(chosen, len(ids) * top), same).select("bag", "m", "first", "doc_id")
        each = F.row_number().over(Window.partitionBy("bag", "m", "first").orderBy(F.asc_nulls_last("doc_id")))
        members = members.withColumn("r", each).where(F.col("r") <= top).drop("r")
        ranked = best.join(members, ["bag", "m", "first"])
        final = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
        names = spark.createDataFrame(list(enumerate(ids)), f"item int, item_id {item_kind}")
        out = ranked.withColumn("rank", final).where(F.col("rank") <= top)
        out = out.join(broadcast_if_small(names, len(ids)), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
        return shelf.put(out, "ranked")


def search(
    docs: DataFrame, items: DataFrame, *, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
    top: int = TOP, block_terms: int = BLOCK_TERMS, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """item_id, rank, doc_id, score: each item's `top` documents of highest score above 0."""
    spark = docs.sparkSession
    shelf = Shelf(spark)
    kind = items.schema[item_id].dataType.simpleString()
    out = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    for ids, vocabulary, own in _item_blocks(items, item_id, item_text, block_terms, block_bytes):
        found = _search_block(docs, ids, vocabulary, own, kind, doc_id, text, top, shelf) if vocabulary else None
        if found is not None:
            out = out.unionByName(found)
    return out

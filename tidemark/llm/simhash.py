"""SimHash near-duplicates by multi-index hashing.

A fingerprint is cut into segments; a table holds every fingerprint under each of its segments. If two fingerprints
differ in at most r bits and there are m segments, with r = m * q + e and e < m, then one of the first e + 1 segments
differs in at most q bits or one of the others in at most q - 1 (none of them where q = 0). So each fingerprint
enumerates the small Hamming ball of that radius around each of its segments, fetches the table's matches, and the
complete distances are verified.

Only distinct fingerprints are compared. In a bucket full of near copies nearly all pairs are links, and only what they
connect is wanted. So matches are fetched twice. First every bucket offers a few of its members: that joins most near
copies to one component. Then all members are fetched, but only across components: the members of a bucket's
largest component meet the others, never one another. No link between components is lost, and what a bucket costs grows
with its size times the number of its stragglers.

Rules for odd input: null, empty and blank texts have fingerprint zero and are linked like any other; a text of fewer
words than a shingle is one shingle; rows with a null id keep their place and get the smallest id of their component,
null where no row of it has one; repeated rows count once in a comparison and all appear in the result.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.llm.common import LOWER, Shelf, arrow_schema, col, fresh, light, pieces, row_key, struct_with, texts_of
from tidemark.llm.components import components

BITS = 64
SHINGLE = 4
MOST_BITS = 4
SEED = 42

# Members that a bucket offers in the first fetch.
_OFFERED = 6


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    words = (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = [0, *(ends[: n - 1] + 1).tolist()]
    stops = ends[shingle - 1:].tolist() if len(words) >= shingle else [len(joined)]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[i:j], SEED) for i, j in zip(starts, stops)), np.uint64, n)
    total = np.zeros(BITS, np.int64)
    for at in range(0, n, 65536):
        some = hashes[at:at + 65536].astype(">u8").view(np.uint8).reshape(-1, 8)
        total += np.unpackbits(some, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > n).tobytes(), "big")


def fingerprints(docs: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",), shingle: int = SHINGLE) -> DataFrame:
    """The kept columns and fp, the fingerprint as a signed 64-bit number."""
    schema, n = struct_with(docs, keep, "fp long"), len(keep)
    out = arrow_schema(schema)

    def run(batches):
        for batch in pieces(batches):
            fps = np.array([fingerprint(t, shingle) for t in texts_of(batch)], np.uint64).view(np.int64)
            kept = [batch.column(i).cast(out.field(i).type) for i in range(n)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(fps)], schema=out)

    return light(docs, keep, text).mapInArrow(run, schema)


class Segments:
    """How a fingerprint is cut and what radius each segment is searched with."""

    def __init__(self, count: int, most_bits: int = MOST_BITS):
        small, wide = divmod(BITS, count)
        self.widths = [small + 1] * wide + [small] * (count - wide)
        q, e = divmod(most_bits, count)
        self.radii = [q if i <= e else q - 1 for i in range(count)]
        self.shifts = [sum(self.widths[i + 1:]) for i in range(count)]

    @property
    def probes(self) -> int:
        return sum(len(self.masks(i)) for i in range(len(self.widths)))

    def masks(self, i: int) -> list[int]:
        """What to flip in segment i to reach every value within its radius; none where the radius is negative."""
        return [
            sum(1 << b for b in bits)
            for r in range(self.radii[i] + 1)
            for bits in combinations(range(self.widths[i]), r)
        ]

    def cost(self, n: int) -> float:
        """Rows to move, and a twentieth for every distance to check by chance, per fingerprint of n evenly spread ones."""
        return sum(len(self.masks(i)) * (1 + n / 2 ** w / 20) for i, w in enumerate(self.widths))

    def value(self, fp: Column, i: int) -> Column:
        return F.shiftrightunsigned(fp, self.shifts[i]).bitwiseAND(F.lit((1 << self.widths[i]) - 1))

    def table(self, fp: Column) -> Column:
        """The places of a fingerprint in the table."""
        return F.array(*[
            F.struct(F.lit(i).alias("seg"), self.value(fp, i).alias("val"))
            for i in range(len(self.widths)) if self.radii[i] >= 0
        ])

    def balls(self, fp: Column) -> Column:
        """The places in which the fingerprint looks for others."""
        return F.flatten(F.array(*[self._ball(fp, i) for i in range(len(self.widths)) if self.radii[i] >= 0]))

    def _ball(self, fp: Column, i: int) -> Column:
        masks = F.array(*[F.lit(m).cast("long") for m in self.masks(i)])
        return F.transform(masks, lambda m: F.struct(F.lit(i).alias("seg"), self.value(fp, i).bitwiseXOR(m).alias("val")))


def segments_for(n: int, most_bits: int = MOST_BITS) -> Segments:
    """The cut that costs least for n fingerprints. The links found are the same with any."""
    return min((Segments(m, most_bits) for m in range(2, 9)), key=lambda s: s.cost(max(1, n)))


def distance(a: Column | str, b: Column | str) -> Column:
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    return F.bit_count(a.bitwiseXOR(b))


def _at(df: DataFrame, places: Column, *columns: str) -> DataFrame:
    return df.select(*columns, F.explode(places).alias("p")).select(*columns, "p.seg", "p.val")


def classes(prints: DataFrame, shelf: Shelf, most_bits: int = MOST_BITS, fp: str = "fp") -> DataFrame:
    """(fp, root): the distinct fingerprints, each with the smallest one reachable over links of few bits."""
    with Shelf(prints.sparkSession) as own:
        return shelf.put(_classes(prints, own, most_bits, fp), "classes")


def _classes(prints: DataFrame, own: Shelf, most_bits: int, fp: str) -> DataFrame:
    distinct = own.put(prints.select(F.col(fp).alias("fp")).distinct())
    cut = segments_for(distinct.count(), most_bits)
    places = cut.table(F.col("fp"))

    # First fetch: a few members of each bucket, picked by hash.
    offers = own.put(
        _at(distinct, places, "fp").groupBy("seg", "val").agg(
            F.array_distinct(F.array(*[
                F.min_by("fp", F.xxhash64("fp", F.lit(i), "seg")) for i in range(_OFFERED)
            ])).alias("some"), F.count(F.lit(1)).alias("size"),
        ).where("size > 1").drop("size")
    )
    near = (
        _at(distinct, places, "fp").join(offers, ["seg", "val"])
        .select("fp", F.explode(F.filter("some", lambda o: (o != F.col("fp")) & (distance(o, "fp") <= most_bits))).alias("other"))
    )
    labels = components(near, own, "fp", "other")
    labelled = own.put(
        distinct.join(labels.select(F.col("node").alias("fp"), "root"), "fp", "left")
        .select("fp", F.coalesce("root", "fp").alias("root"))
    )

    # Second fetch: everything, across components only.
    held = own.put(_at(labelled, places, "fp", "root"))
    largest = own.put(
        held.groupBy("seg", "val", "root").agg(F.count(F.lit(1)).alias("n"))
        .groupBy("seg", "val").agg(F.max_by("root", F.struct("n", "root")).alias("main"), F.max("n").alias("n"))
        .where("n > 1").drop("n")
    )
    marked = own.put(held.join(largest, ["seg", "val"], "left").select("*", F.coalesce(F.col("root") == F.col("main"), F.lit(False)).alias("in_main")))
    seekers = _at(labelled, cut.balls(F.col("fp")), "fp", "root").join(largest, ["seg", "val"], "left")
    seekers = seekers.select(
        "seg", "val", F.col("fp").alias("x"), F.col("root").alias("rx"),
        F.coalesce(F.col("root") != F.col("main"), F.lit(False)).alias("to_main"),
    )
    found = marked.select("seg", "val", F.col("fp").alias("y"), F.col("root").alias("ry"), "in_main")
    linked = (F.col("rx") != F.col("ry")) & (distance("x", "y") <= most_bits)
    across = (
        seekers.join(found.where("NOT in_main"), ["seg", "val"]).where(linked).select("rx", "ry")
        .unionAll(seekers.where("to_main").join(found.where("in_main"), ["seg", "val"]).where(linked).select("rx", "ry"))
        .distinct()
    )
    joined = components(across, own, "rx", "ry")
    return (
        labelled.join(joined.select(F.col("node").alias("root"), F.col("root").alias("top")), "root", "left")
        .select("fp", F.coalesce("top", "root").alias("root"))
    )


def near_duplicates(
    docs: DataFrame, text: str = "text", id_: str = "doc_id", shingle: int = SHINGLE, most_bits: int = MOST_BITS
) -> DataFrame:
    """One row per document: its id, fingerprint (16 hex digits) and component_id (smallest id of its component)."""
    shelf = Shelf(docs.sparkSession)
    prints = shelf.put(fingerprints(docs.select(col(docs, id_).alias("id"), col(docs, text).alias("text")), "text", ["id"], shingle))
    by_fp = classes(prints, shelf, most_bits)
    least = shelf.put(prints.groupBy("fp").agg(F.min("id").alias("id")))
    tops = shelf.put(by_fp.join(least, "fp").groupBy("root").agg(F.min("id").alias("component_id")))
    known = shelf.put(by_fp.join(tops, "root").select("fp", "component_id"))
    return prints.join(known, "fp").select(
        F.col("id").alias(id_), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def one_of_each(docs: DataFrame, text: str = "text", id_: str = "doc_id", shingle: int = SHINGLE, most_bits: int = MOST_BITS) -> DataFrame:
    """The documents with the smallest id of each component, with all their columns.

    Among rows that share that id one is kept, picked by a hash of all columns; of rows alike in every column, one.
    """
    shelf, names = Shelf(docs.sparkSession), docs.columns
    k1, k2, fp, id_copy = fresh(docs, "_k1", "_k2", "fp", "id")
    keys = row_key(docs, names)
    light = docs.select(col(docs, id_).alias("id"), keys[0].alias("k1"), keys[1].alias("k2"), col(docs, text).alias("text"))
    prints = shelf.put(fingerprints(light, "text", ["id", "k1", "k2"], shingle))
    by_fp = classes(prints, shelf, most_bits)
    # Smallest id first, rows without one last, then the hashes.
    best = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "k1", "k2"))
    per_fp = shelf.put(prints.groupBy("fp").agg(best.alias("best")))
    chosen = shelf.put(
        by_fp.join(per_fp, "fp").groupBy("root").agg(F.min("best").alias("best"))
        .select(F.col("best.k1").alias(k1), F.col("best.k2").alias(k2))
    )
    times = shelf.put(prints.groupBy(F.col("k1").alias(k1), F.col("k2").alias(k2)).agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    keyed = docs.select("*", keys[0].alias(k1), keys[1].alias(k2))
    repeated = shelf.put(chosen.join(times, [k1, k2], "left_semi"))
    single = keyed.join(chosen.join(repeated, [k1, k2], "left_anti"), [k1, k2], "left_semi")
    if repeated.isEmpty():
        kept = single
    else:
        kept = single.unionByName(keyed.join(repeated, [k1, k2], "left_semi").dropDuplicates([k1, k2]))
    return kept.select(*[F.col(f"`{c}`") for c in names])

"""Prefix trie of conversations by union-find over the common prefixes of sorted neighbours.

Sequences of turns are sorted, so the members of every trie node are neighbours and the prefix that two neighbours share
is an edge between them. Edges are taken in descending depth: joining two components makes the branching node of that
depth, and the unary nodes between a component's old node and the new one come with it. The sorted table is worked on in
blocks. A block's forest is contracted to its two outer sequences, the only ones whose nodes other blocks can share; the
contracted forests are merged across the block boundaries in the same way, and give their nodes' totals.

Sequences hold 128-bit digests of turns, not texts. Equal sequences are one class with its number of members.

Rules for odd input: null roles and texts count as empty; a null turn number comes first; turns alike in number are in
the order of their digests, whatever order the rows come in, and repeated rows are turns of their own; rows without a
conversation id belong to no conversation and are left out; an empty table gives no nodes, not even a root. A
conversation's digests (20 bytes a turn) and the ids of identical conversations, whose list is hashed as one, go through
one task each, as a stream of ids in the second case.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import Shelf, arrow_schema, col
from tidemark.session import broadcast_if_small

# Classes of identical sequences per block.
BLOCK = 50_000

NO_ENDS = hashlib.sha256(b"").hexdigest()

_SEQ = "array<struct<k1:bigint,k2:bigint,n:int>>"
_NODE = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
    "ends_sha256 string, "
)
_HANG = "array<struct<depth:int,n:bigint,low:bigint,children:bigint,leaves:bigint,saved:bigint,ends:string>>"
_LEVEL = f"block long, side int, seq {_SEQ}, hang {_HANG}, {_NODE} parent_side int"
_MOST_TURNS = 2**31 - 1


def turn_digests(turns: DataFrame, role: str = "role", text: str = "text") -> Column:
    """Two hashes of role and text, and the text's code points."""
    parts = [F.coalesce(col(turns, c).cast("string"), F.lit("")) for c in (role, text)]
    return F.struct(F.xxhash64(*parts).alias("k1"), F.xxhash64(F.lit(1), *parts).alias("k2"), F.char_length(parts[1]).alias("n"))


def sequences(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(id, seq) of every conversation: the digests of its turns in order."""
    at = col(turns, turn)
    rows = turns.where(col(turns, conv).isNotNull()).select(
        col(turns, conv).cast("long").alias("id"),
        F.struct(at.isNotNull().alias("known"), at.alias("at"), turn_digests(turns, role, text).alias("d")).alias("t"),
    )
    return rows.groupBy("id").agg(F.sort_array(F.collect_list("t"))["d"].alias("seq"))


def rebuilt(seqs: DataFrame, shelf: Shelf, group: int = 100, heads: int = 6) -> DataFrame:
    """Each conversation with the first h turns of the first id of its group of `group` ids in place of its own first h.

    h is the unsigned crc32 of the decimal id modulo `heads`. A head has fewer turns where the conversation it comes from
    has, and none where that is absent.
    """
    kept = shelf.put(seqs, "sequences")
    first = F.col("id") - F.col("id") % group
    sources = kept.where(F.col("id") == first).select(F.col("id").alias("of"), F.slice("seq", 1, max(1, heads - 1)).alias("head"))
    h = (F.crc32(F.col("id").cast("string").cast("binary")) % heads).cast("int")
    own = F.slice("seq", h + 1, F.lit(_MOST_TURNS))
    head = F.coalesce(F.slice("head", F.lit(1), h), F.array().cast(_SEQ))
    return kept.join(sources, first == F.col("of"), "left").select("id", F.concat(head, own).alias("seq"))


def _ends(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of every class's ids; rows come sorted by class and id, and only the hash under way is held."""
    now, running = None, None

    def row(key, h):
        return pa.RecordBatch.from_arrays([pa.array([k], pa.int64()) for k in key] + [pa.array([h.hexdigest()])], names=["d1", "d2", "ends"])

    for batch in batches:
        d1, d2, ids = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
        cuts = np.flatnonzero((d1[1:] != d1[:-1]) | (d2[1:] != d2[:-1])) + 1
        texts = batch.column(2).cast(pa.string()).to_pylist()
        done = ([], [], [])
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(ids)]):
            if a == b:
                continue
            key = int(d1[a]), int(d2[a])
            if key != now:
                if running is not None:
                    for values, x in zip(done, (*now, running.hexdigest())):
                        values.append(x)
                now, running = key, hashlib.sha256()
            else:
                running.update(b",")
            running.update(",".join(texts[a:b]).encode())
        if done[0]:
            yield pa.RecordBatch.from_arrays([pa.array(done[0], pa.int64()), pa.array(done[1], pa.int64()), pa.array(done[2])], names=["d1", "d2", "ends"])
    if running is not None:
        yield row(now, running)


class _Node:
    """What is known of the node a component stands at: totals over its members and over the children below it."""

    __slots__ = ("n", "low", "children", "leaves", "saved", "ends", "waiting", "places")

    def __init__(self, n=0, low=None, children=0, leaves=0, saved=0, ends=None, places=()):
        self.n, self.low, self.children, self.leaves, self.saved, self.ends = n, low, children, leaves, saved, ends
        # Rows of children that wait for this node's smallest member, and the outer places that stand for this node.
        self.waiting, self.places = [], list(places)

    def add(self, other: "_Node") -> None:
        self.n += other.n
        self.low = other.low if self.low is None else self.low if other.low is None else min(self.low, other.low)
        self.children += other.children
        self.leaves += other.leaves
        self.saved += other.saved
        self.ends = self.ends or other.ends
        if len(other.waiting) > len(self.waiting):
            self.waiting, other.waiting = other.waiting, self.waiting
        self.waiting += other.waiting
        self.places += other.places


class Forest:
    """The trie of one block of sorted, different sequences.

    `sizes[i]` are the code points of sequence i's turns, `shared[i]` is the depth that sequences i and i + 1 share, and
    `hang[i]` has by depth what is known at the nodes of sequence i. With `outer`, nodes of the first and the last
    sequence are left open: what hangs at them is in `open_hang`, by side and depth.
    """

    def __init__(self, sizes: list, shared: list[int], hang: list[dict[int, _Node]], outer: bool):
        self.sizes, self.m = sizes, len(sizes)
        self.columns = tuple([] for _ in range(9))
        self.found: dict = {}
        self.up = list(range(self.m))
        self.depth = [len(s) for s in sizes]
        self.side = [None] * self.m
        self.open_hang: list[dict[int, _Node]] = [{}, {}]
        if outer and self.m:
            self.side[-1], self.side[0] = 1, 0
            self.open_hang[0] = hang[0]
            if self.m > 1:
                self.open_hang[1] = hang[-1]
        self.node = [None if self.side[i] is not None else hang[i].pop(self.depth[i]) for i in range(self.m)]
        self.rest = [None if self.side[i] is not None else hang[i] for i in range(self.m)]
        for i in np.argsort(-np.array(shared, np.int64), kind="stable").tolist() if self.m > 1 else ():
            self._join(i, i + 1, shared[i])
        if self.m:
            root = self._find(0)
            if self.side[root] is None:
                self._raise(root, 0)
                self._emit(root)

    def _find(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def _emit(self, r: int) -> int:
        """The row of the node that a component stands at; its parent is filled in later."""
        node, d = self.node[r], self.depth[r]
        node.leaves = node.leaves or 1
        if d:
            node.saved += (node.n - 1) * int(self.sizes[r][d - 1])
        place = len(self.columns[0])
        for values, x in zip(self.columns, (node.low, d, None, node.n, node.children, node.leaves, node.saved, node.ends or NO_ENDS, None)):
            values.append(x)
        parents = self.columns[2]
        for w in node.waiting:
            parents[w] = node.low
        for p in node.places:
            self.found[p] = node.low
        return place

    def _raise(self, r: int, depth: int) -> None:
        """Move a component up to `depth`, with the nodes on the way."""
        if self.side[r] is None:
            rest = self.rest[r]
            while self.depth[r] > depth:
                place = self._emit(r)
                old = self.node[r]
                node = self.node[r] = _Node(old.n, old.low, 1, old.leaves, old.saved)
                node.waiting.append(place)
                self.depth[r] -= 1
                if rest and self.depth[r] in rest:
                    node.add(rest.pop(self.depth[r]))
        self.depth[r] = depth

    def _join(self, i: int, j: int, depth: int) -> None:
        a, b = self._find(i), self._find(j)
        self._raise(a, depth)
        self._raise(b, depth)
        if self.side[a] is None and self.side[b] is None:
            self.node[a].add(self.node[b])
            self.node[b] = None
            small, large = sorted((self.rest[a] or {}, self.rest[b] or {}), key=len)
            for d, node in small.items():
                if d <= depth:
                    large[d].add(node) if d in large else large.__setitem__(d, node)
            self.rest[a], self.rest[b] = large, None
            self.up[b] = a
            return
        if self.side[a] is None or self.side[b] == 0:
            a, b = b, a
        # The first is open now. What the other knows of the common node hangs at that node.
        here = self.open_hang[self.side[a]]
        if self.side[b] is None:
            node, self.node[b] = self.node[b], None
            for w in node.waiting:
                self.columns[2][w], self.columns[8][w] = None, (self.side[a], depth)
        else:
            node = self.open_hang[1].pop(depth, None)
            for w in node.waiting if node else ():
                self.columns[8][w] = (0, depth)
        if node:
            node.waiting = []
            here[depth].add(node) if depth in here else here.__setitem__(depth, node)
        self.up[b] = a


def _shared(keys1: np.ndarray, keys2: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many turns each sequence shares with the next one, depth by depth over the pairs still alike."""
    sizes, starts = np.diff(offsets), offsets[:-1]
    most = np.minimum(sizes[:-1], sizes[1:])
    out, alive, d = np.zeros(max(0, len(sizes) - 1), np.int64), np.arange(max(0, len(sizes) - 1)), 0
    while len(alive):
        alive = alive[most[alive] > d]
        a, b = starts[alive] + d, starts[alive + 1] + d
        alive = alive[(keys1[a] == keys1[b]) & (keys2[a] == keys2[b])]
        d += 1
        out[alive] = d
    return out


def _hang_row(hang: dict[int, _Node]) -> list[dict]:
    return [
        {"depth": d, "n": x.n, "low": x.low, "children": x.children, "leaves": x.leaves, "saved": x.saved, "ends": x.ends}
        for d, x in sorted(hang.items())
    ]


def _blocks(batches: Iterable[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    held, n = [], 0
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            part = batch.slice(at, rows - n)
            held.append(part)
            n, at = n + part.num_rows, at + part.num_rows
            if n == rows:
                yield pa.Table.from_batches(held)
                held, n = [], 0
    if n:
        yield pa.Table.from_batches(held)


def _level(rows: int, out: pa.Schema):
    """Blocks of sorted classes to their closed nodes and their outer sequences."""

    def run(batches):
        from pyspark import TaskContext

        for number, table in enumerate(_blocks(batches, rows)):
            block = (TaskContext.get().partitionId() << 32) + number
            seqs = table.column("seq").combine_chunks()
            offsets = seqs.offsets.to_numpy().astype(np.int64)
            k1, k2, n = (seqs.values.field(i).to_numpy(zero_copy_only=False) for i in range(3))
            sizes = [n[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            hang = [
                {len(s): _Node(count, low, ends=ends)}
                for s, count, low, ends in zip(sizes, *(table.column(c).to_pylist() for c in ("n", "low", "ends")))
            ]
            forest = Forest(sizes, _shared(k1, k2, offsets).tolist(), hang, outer=True)
            *node, wait = forest.columns
            count, names = len(wait), out.names
            closed = dict.fromkeys(names, [None] * count)
            # A waiting child's parent lies one turn up on that side.
            closed |= dict(zip(names[4:12], node)) | {"block": [block] * count, "parent_side": [w[0] if w else None for w in wait]}
            yield pa.RecordBatch.from_pydict(closed, schema=out)
            sides = [0] if len(sizes) == 1 else [0, len(sizes) - 1]
            outer = dict.fromkeys(names, [None] * len(sides))
            outer |= {
                "block": [block] * len(sides), "side": list(range(len(sides))), "seq": [seqs[i].as_py() for i in sides],
                "hang": [_hang_row(forest.open_hang[s]) for s in range(len(sides))],
            }
            yield pa.RecordBatch.from_pydict(outer, schema=out)

    return run


def _merge(spines: list) -> Forest:
    """The contracted forests as one: two sequences a block at most, in sorted order."""
    spines = sorted(spines, key=lambda r: [(t.k1, t.k2) for t in r.seq])
    shared = []
    for a, b in zip(spines, spines[1:]):
        d = 0
        for x, y in zip(a.seq, b.seq):
            if (x.k1, x.k2) != (y.k1, y.k2):
                break
            d += 1
        shared.append(d)
    hang = [
        {h.depth: _Node(h.n, h.low, h.children, h.leaves, h.saved, h.ends, [(r.block, r.side, h.depth)]) for h in r.hang}
        for r in spines
    ]
    return Forest([[t.n for t in r.seq] for r in spines], shared, hang, outer=False)


def trie(seqs: DataFrame, block: int = BLOCK) -> DataFrame:
    """The nodes of the trie of (id, seq) rows, the root included.

    conv_id (smallest member), depth, parent_conv_id (null for the root), n_convs, n_children, n_leaves, saved_tokens
    and ends_sha256, as the digest of the ids that end at the node.
    """
    spark, outer = seqs.sparkSession, Shelf(seqs.sparkSession)
    with Shelf(spark) as own:
        kept = own.put(seqs.select("id", "seq", F.xxhash64("seq").alias("d1"), F.xxhash64(F.lit(1), "seq").alias("d2")))
        ends = (
            kept.select("d1", "d2", "id").repartition("d1", "d2").sortWithinPartitions("d1", "d2", "id")
            .mapInArrow(_ends, "d1 long, d2 long, ends string")
        )
        classes = kept.groupBy("d1", "d2", "seq").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("low"))
        sorted_ = own.put(classes.join(ends, ["d1", "d2"]).select("seq", "n", "low", "ends"))
        sorted_ = sorted_.repartitionByRange("seq").sortWithinPartitions("seq")
        schema = spark.createDataFrame([], _LEVEL).schema
        level = outer.put(sorted_.mapInArrow(_level(block, arrow_schema(schema)), schema), "trie")
        top = _merge(list(level.where("side IS NOT NULL").select("block", "side", "seq", "hang").toLocalIterator()))
    places = spark.createDataFrame([(*p, low) for p, low in top.found.items()], "b long, s int, d int, parent long")
    names = level.columns[4:12]
    closed = level.where("side IS NULL")
    here = (F.col("block") == F.col("b")) & (F.col("parent_side") == F.col("s")) & (F.col("depth") - 1 == F.col("d"))
    closed = closed.join(broadcast_if_small(places, len(top.found)), here, "left").select(
        *[F.coalesce("parent_conv_id", "parent").alias(c) if c == "parent_conv_id" else F.col(c) for c in names]
    )
    upper = spark.createDataFrame(list(zip(*top.columns[:8])), _NODE.rstrip(", "))
    return closed.unionByName(upper)

"""Byte-level BPE encoding and decoding with a two-tier lookup.

Tier one is a minimal perfect hash over the vocabulary (hash, displace): it resolves a whole pre-token that is itself a
token with two array reads and one comparison. What it misses goes to tier two: the bytes of the pre-token form a doubly
linked list, a heap holds the ranks of neighbouring pairs, and the lowest rank merges first (leftmost among equals).

A worker remembers pre-tokens in two generations: when the young one is full it becomes the old one, and what is found in
the old one moves up. So memory is bounded, and pre-tokens that keep coming are never worked out again.

Rules for odd input: null and empty texts give no tokens; a text that cannot be encoded as UTF-8 cannot be in a Spark
string; control characters and special-token strings are ordinary text. The pieces of a text are encoded one by one, as
the pattern cuts them.
"""

from __future__ import annotations

import base64
from collections.abc import Sequence
from heapq import heapify, heappop as pop, heappush as push, heapreplace as replace
from struct import pack

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import arrow_schema, col, light, pieces, struct_with, texts_of

# Keys of the perfect hash per bucket, on average.
_BUCKET_KEYS = 1

# Bytes of pre-tokens and ids that one of the two generations holds, and what an entry takes besides. Bounds memory,
# never a result.
REMEMBERED = 80 << 20
_ENTRY = 200

# Tokens decoded at once.
_DECODED = 1 << 17


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: base64 of the token's bytes and its rank on every line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, lines))}


class PerfectHash:
    """Minimal perfect hash: every key has a slot of its own among as many slots as there are keys."""

    def __init__(self, keys: Sequence[bytes]):
        n = self.n = max(1, len(keys))
        self.n_buckets = max(1, n // _BUCKET_KEYS)
        hashes = [xxhash.xxh3_64_intdigest(k) for k in keys]
        buckets: dict[int, list[int]] = {}
        for place, h in enumerate(hashes):
            buckets.setdefault(h % self.n_buckets, []).append(place)
        self.displace = [0] * self.n_buckets
        self.slots = [-1] * n
        free = None
        for b, members in sorted(buckets.items(), key=lambda x: (-len(x[1]), x[0])):
            if len(members) > 1:
                d = 1
                while True:
                    places = {self._mix(hashes[m], d) for m in members}
                    if len(places) == len(members) and all(self.slots[p] < 0 for p in places):
                        break
                    d += 1
                self.displace[b] = d
                for m in members:
                    self.slots[self._mix(hashes[m], d)] = m
            else:
                # Buckets of one key take the free slots in turn; a negative displacement is the slot itself.
                free = free or iter([p for p in range(n) if self.slots[p] < 0])
                place = next(free)
                self.displace[b] = -place - 1
                self.slots[place] = members[0]

    def _mix(self, h: int, d: int) -> int:
        return ((h >> 20) ^ (d * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF) ^ ((h >> 7) * d & 0xFFFFFFFFFFFF)) % self.n

    def slot(self, key: bytes) -> int:
        """The slot that `key` has if it is one of the keys; some slot otherwise."""
        h = xxhash.xxh3_64_intdigest(key)
        d = self.displace[h % self.n_buckets]
        return -d - 1 if d < 0 else self._mix(h, d) if d else 0


class Encoder:
    """Encodes pre-tokens and texts by a table of ranks."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        if not all(bytes([b]) in ranks for b in range(256)):
            raise ValueError("a byte-level vocabulary needs all 256 single bytes")
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        tokens = list(ranks)
        self.hash = PerfectHash(tokens)
        self.key_in = [tokens[s] if s >= 0 else b"" for s in self.hash.slots]
        self.id_in = [ranks[k] if k else -1 for k in self.key_in]
        self.token = {rank: token for token, rank in ranks.items()}
        # Ranks in the upper half of a number, so that a place can be added to make a heap entry.
        self.high = {token: rank << 32 for token, rank in ranks.items()}
        self.pair_high = [self.high.get(bytes([a, b]), -1) for a in range(256) for b in range(256)]
        self._young: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}
        self._held = 0
        by_rank = [self.token.get(i, b"") for i in range(max(self.token) + 1)]
        self._sizes = np.array([len(t) for t in by_rank], np.int64)
        self._starts = np.cumsum(self._sizes) - self._sizes
        self._bytes = np.frombuffer(b"".join(by_rank), np.uint8)

    def whole(self, piece: bytes) -> int:
        """Tier one: the id of a piece that is a token, or -1."""
        slot = self.hash.slot(piece)
        return self.id_in[slot] if self.key_in[slot] == piece else -1

    def merged(self, piece: bytes) -> list[int]:
        """Tier two: merges by rank over a linked list of bytes.

        A heap entry is rank * 2**32 + place, so the lowest rank comes first and the leftmost place among equals.
        An entry is out of date where the pair at its place has got another rank since.
        """
        n, high_of = len(piece), self.high.get
        after, before = list(range(1, n + 1)), list(range(-1, n))
        pair_high = self.pair_high
        pair = [pair_high[a << 8 | b] for a, b in zip(piece, piece[1:])]
        pair.append(-1)
        heap = [high + i for i, high in enumerate(pair) if high >= 0]
        heapify(heap)
        while heap:
            entry = heap[0]
            i = entry & 0xFFFFFFFF
            if pair[i] + i != entry:
                pop(heap)
                continue
            right = after[i]
            end = after[i] = after[right]
            pair[right] = -1
            high = -1
            if end < n:
                before[end] = i
                high = high_of(piece[i:after[end]], -1)
            pair[i] = high
            # The new pair takes the place of the one just merged where there is one.
            if high >= 0:
                replace(heap, high + i)
            else:
                pop(heap)
            left = before[i]
            if left >= 0:
                high = pair[left] = high_of(piece[left:end], -1)
                if high >= 0:
                    push(heap, high + left)
        out, i, ranks = [], 0, self.ranks
        while i < n:
            end = after[i]
            out.append(ranks[piece[i:end]])
            i = end
        return out

    def piece_ids(self, piece: str) -> list[int]:
        data = piece.encode()
        one = self.whole(data)
        return [one] if one >= 0 else self.merged(data)

    def packed(self, text: str) -> bytes:
        """The ids of a text as 32-bit numbers."""
        found = self.pattern.findall(text)
        if self._held > REMEMBERED:
            self._old, self._young, self._held = self._young, {}, 0
        young, old = self._young, self._old
        for piece in set(found).difference(young):
            ids = old.pop(piece, None)
            if ids is None:
                own = self.piece_ids(piece)
                ids = pack(f"={len(own)}i", *own)
            young[piece] = ids
            self._held += _ENTRY + len(piece) + len(ids)
        return b"".join(map(young.__getitem__, found))

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.packed(text), np.int32).tolist()

    def decode(self, ids: Sequence[int]) -> bytes:
        ids, out = np.asarray(ids, np.int64), []
        for at in range(0, len(ids), _DECODED):
            own = ids[at:at + _DECODED]
            sizes = self._sizes[own]
            first = self._starts[own] - (np.cumsum(sizes) - sizes)
            out.append(self._bytes[np.repeat(first, sizes) + np.arange(sizes.sum())].tobytes())
        return b"".join(out)


_ENCODERS: dict[str, Encoder] = {}


def _encoder(name: str, ranks, pattern: str) -> Encoder:
    if name not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[name] = Encoder(ranks.value, pattern)
    return _ENCODERS[name]


def round_trip(
    docs: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text", keep: Sequence[str] = ("doc_id",)
) -> DataFrame:
    """The kept columns, ids array<int> and decoded binary (the bytes that the ids stand for).

    `ranks` is a vocabulary, so its size is fixed whatever the data; it is sent to the workers once.
    """
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    name = f"{len(ranks)}-{xxhash.xxh3_64_hexdigest(repr((sorted(ranks.items())[:1000], pattern)).encode())}"
    n = len(keep)
    schema = struct_with(docs, keep, "ids array<int>, decoded binary")
    out = arrow_schema(schema)

    def run(batches):
        encoder = _encoder(name, shared, pattern)
        for batch in pieces(batches, rows=256, size=4 << 20):
            packed = [encoder.packed(t) for t in texts_of(batch)]
            decoded = [encoder.decode(np.frombuffer(x, np.int32)) for x in packed]
            sizes = np.cumsum([0] + [len(x) // 4 for x in packed])
            values = np.frombuffer(b"".join(packed), np.int32)
            lists = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(values))
            kept = [batch.column(i).cast(out.field(i).type) for i in range(n)]
            yield pa.RecordBatch.from_arrays(
                [*kept, lists.cast(out.field(n).type), pa.array(decoded, out.field(n + 1).type)], schema=out
            )

    return light(docs, keep, text).mapInArrow(run, schema)


def digests(encoded: DataFrame, keep: Sequence[str] = ("doc_id",), ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """n_tokens, ids_sha256 (of decimal ids joined by one space) and decoded_sha256 of encoded rows."""
    return encoded.select(
        *[col(encoded, c) for c in keep],
        F.size(ids).cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col(ids).cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col(decoded), 256).alias("decoded_sha256"),
    )

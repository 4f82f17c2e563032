"""Token counts of whole texts, with overlap resynchronisation for huge ones.

A text longer than a chunk is encoded in overlapping chunks. Each chunk's pieces give offsets into the normalised text;
two neighbours are spliced at a boundary that both have and that is proven stable: no piece of the vocabulary holds the
two characters around it side by side, so no merge can ever cross it, and what stands on either side of it is encoded
alike in a chunk and in the whole text. Where an overlap has no such boundary it is widened, at last to the end of the
text; so counts are those of the whole text, and memory is that of a chunk wherever texts have stable boundaries.

Made for pair-merging models whose normaliser only marks spaces and sets one mark in front; others are refused.

Rules for odd input: null and empty texts have no tokens and no bytes; rows with null or repeated ids are kept; strings
of special tokens inside texts are ordinary text, as the library takes them by default.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import arrow_schema, light, pieces, struct_with, texts_of

# Characters of a chunk, and those it shares with the next one to begin with.
CHUNK = 1 << 14
OVERLAP = 128

MARK = "▁"


def read_model(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


class Counter:
    """Counts the tokens of texts with one sentencepiece model."""

    def __init__(self, model: bytes):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as kinds

        spec = kinds.ModelProto.FromString(model)
        rules = spec.normalizer_spec
        if (
            spec.trainer_spec.model_type != kinds.TrainerSpec.BPE or rules.precompiled_charsmap or rules.remove_extra_whitespaces
            or not (rules.add_dummy_prefix and rules.escape_whitespaces) or spec.trainer_spec.treat_whitespace_as_suffix
        ):
            raise ValueError("only pair-merging models that mark spaces and change nothing else can be spliced")
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        piece = kinds.ModelProto.SentencePiece
        # A character not in the vocabulary becomes its bytes; the first of them stands for the character.
        self.width = np.array([
            0 if p.type == piece.BYTE and 0x80 <= int(p.piece[1:-1], 16) < 0xC0 else 1 if p.type in (piece.BYTE, piece.UNKNOWN)
            else len(p.piece) for p in spec.pieces
        ], np.int64)
        merging = [p.piece for p in spec.pieces if p.type in (piece.NORMAL, piece.USER_DEFINED, piece.UNUSED)]
        self.inside = {p[i:i + 2] for p in merging for i in range(len(p) - 1)}

    def counts(self, texts: Sequence[str], chunk: int = CHUNK, overlap: int = OVERLAP) -> list[int]:
        out = [0] * len(texts)
        short = [i for i, t in enumerate(texts) if len(t) <= chunk]
        for i, ids in zip(short, self.processor.encode([texts[i] for i in short], num_threads=1)):
            out[i] = len(ids)
        for i, t in enumerate(texts):
            if len(t) > chunk:
                out[i] = self.spliced(t, chunk, overlap)
        return out

    def spliced(self, text: str, chunk: int, overlap: int) -> int:
        """The count of a huge text from its chunks."""
        # One mark is set in front of a text; marks and spaces are the same to the model.
        whole = MARK + text
        start, total, at = 0, 0, 0
        ends = self._ends(whole, 0, min(chunk, len(whole)))
        end = min(chunk, len(whole))
        while end < len(whole):
            shared = overlap
            while True:
                following = max(start + 1, end - shared)
                stop = min(following + chunk, len(whole))
                ahead = self._ends(whole, following, stop)
                seam = self._seam(whole, following, end, ends, ahead, at)
                if seam or end == len(whole):
                    break
                # No boundary to rely on: take more of the text into this chunk, twice as much every time.
                shared *= 2
                end = min(end + shared, len(whole))
                ends = self._ends(whole, start, end)
            if not seam:
                break
            total += np.searchsorted(ends, seam, "right") - np.searchsorted(ends, at, "right")
            start, end, ends, at = following, stop, ahead, seam
        return int(total + len(ends) - np.searchsorted(ends, at, "right"))

    def _ends(self, whole: str, start: int, end: int) -> np.ndarray:
        """Where in the whole text each piece of the chunk ends."""
        if start == 0:
            return np.cumsum(self.width[self.processor.encode(whole[1:end])])
        # The chunk gets a mark of its own in front; it lies before the chunk.
        return start - 1 + np.cumsum(self.width[self.processor.encode(whole[start:end])])

    def _seam(self, whole: str, start: int, end: int, left: np.ndarray, right: np.ndarray, after: int) -> int:
        """The first common, proven boundary strictly inside the overlap and after the last seam; 0 if there is none."""
        first = max(start, after)
        common = np.intersect1d(left[(left > first) & (left < end)], right)
        return next((p for p in common.tolist() if whole[p - 1:p + 1].replace(" ", MARK) not in self.inside), 0)


_COUNTERS: dict[str, Counter] = {}


def _counter(name: str, model) -> Counter:
    if name not in _COUNTERS:
        _COUNTERS.clear()
        _COUNTERS[name] = Counter(model.value)
    return _COUNTERS[name]


def count_tokens(
    docs: DataFrame, model: bytes, text: str = "text", keep: Sequence[str] = ("doc_id",), chunk: int = CHUNK, overlap: int = OVERLAP
) -> DataFrame:
    """The kept columns, n_bytes (of UTF-8) and n_tokens, for every row.

    `model` is a model file's content, of a size that does not depend on the data; it is sent to the workers once.
    """
    if chunk < 2 or not 0 < overlap < chunk:
        raise ValueError("an overlap lies inside a chunk")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    name, n = xxhash.xxh3_64_hexdigest(model), len(keep)
    schema = struct_with(docs, keep, "n_bytes long, n_tokens long")
    out = arrow_schema(schema)

    def run(batches: Iterable[pa.RecordBatch]):
        counter = _counter(name, shared)
        for batch in pieces(batches, rows=256, size=4 << 20):
            kept = [batch.column(i).cast(out.field(i).type) for i in range(n)]
            sizes = pc.fill_null(pc.binary_length(batch.column(n)), 0).cast(pa.int64())
            tokens = pa.array(counter.counts(texts_of(batch), chunk, overlap), pa.int64())
            yield pa.RecordBatch.from_arrays([*kept, sizes, tokens], schema=out)

    return light(docs, keep, text).mapInArrow(run, schema)


def over_limit(limit: int, tokens: str = "n_tokens"):
    return F.col(tokens) > limit

"""Language identification with string kernels.

The kernel of two texts counts the character n-grams (1 to 3, one blended spectrum) that both hold, presence only,
divided by the square root of the numbers that each holds. A bounded sample of labelled rows is learnt from, of every
language that has any; some of them are Nyström landmarks. Their kernel matrix gives a feature map, in which one kernel
ridge regression per language is solved. A batch of texts is scored by two matrix products: presence by landmark
incidence, and kernel by coefficients.

Rules for odd input: texts that are null or have no letter are `und` with score 0; rows with a null id or language are
not learnt from; equal texts of a language are learnt from once, however many rows hold them; a language that has only
long texts is learnt from those; with no labelled rows every text is `und`.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.common import Shelf, arrow_schema, bucket, col, light, pieces, struct_with, text_of, texts_of

# Learning bounds: rows of a language, and of all together, which is shared among the languages; but every language has
# LEAST rows. Landmarks of a language, and of all together. Longer texts than LONG characters are learnt from, whole, only
# for languages that have too few shorter ones.
SAMPLE = 300
ROWS = 6_000
LEAST = 4
LANDMARKS = 24
ALL_LANDMARKS = 1_200
LONG = 20_000

FOLDS = 3
_RIDGE = 1e-2
_BLOCK = 64
# n-grams whose incidence is unpacked at a time.
_GRAMS = 8_192


def grams(text: str) -> np.ndarray:
    """The distinct n-grams of a text as numbers: up to three code points plus one, 21 bits each.

    Letters are small; everything between words is one gap.
    """
    words = "".join(c if c.isalpha() else " " for c in text.lower()).split() if not text.isascii() else None
    if words is None:
        words = text.lower().translate(_ASCII_GAPS).split()
    if not words:
        return np.empty(0, np.uint64)
    points = np.frombuffer(f" {' '.join(words)} ".encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(1)
    two = points[:-1] << np.uint64(21) | points[1:]
    three = two[:-1] << np.uint64(21) | points[2:]
    return np.unique(np.concatenate([points, two, three]))


_ASCII_GAPS = {c: " " for c in range(128) if not chr(c).isalpha()}


@dataclass
class Classifier:
    vocabulary: np.ndarray  # sorted n-grams of the landmarks
    incidence: np.ndarray  # n-gram by landmark, eight landmarks a byte
    norms: np.ndarray  # square roots of the landmarks' numbers of n-grams
    coefficients: np.ndarray  # landmark by language
    languages: list[str]

    def kernel(self, sets: Sequence[np.ndarray]) -> np.ndarray:
        """Kernel of texts, given by their n-grams, and landmarks.

        Only the n-grams that the texts hold take part in the product, a block of them at a time.
        """
        rows, places, size = [], [], np.ones(len(sets), np.float32)
        for i, own in enumerate(sets):
            if len(own):
                at = np.searchsorted(self.vocabulary, own)
                at[at == len(self.vocabulary)] = 0
                at = at[self.vocabulary[at] == own]
                rows.append(np.full(len(at), i))
                places.append(at)
                size[i] = len(own)
        shared = np.zeros((len(sets), len(self.norms)), np.float32)
        if rows:
            row = np.concatenate(rows)
            used, column = np.unique(np.concatenate(places), return_inverse=True)
            present = np.zeros((len(sets), len(used)), np.float32)
            present[row, column] = 1
            for start in range(0, len(used), _GRAMS):
                block = np.unpackbits(self.incidence[used[start:start + _GRAMS]], axis=1, count=len(self.norms))
                shared += present[:, start:start + _GRAMS] @ block.astype(np.float32)
        return shared / (np.sqrt(size)[:, None] * self.norms)

    def predict(self, texts: Sequence[str]) -> list[tuple[str, float]]:
        out: list[tuple[str, float]] = []
        for at in range(0, len(texts), _BLOCK):
            sets = [grams(t) for t in texts[at:at + _BLOCK]]
            if not self.languages:
                out += [("und", 0.0)] * len(sets)
                continue
            value = self.kernel(sets).astype(float) @ self.coefficients
            best = value.argmax(axis=1)
            for i, own in enumerate(sets):
                top = float(np.clip(value[i, best[i]], 0, 1))
                out.append((self.languages[best[i]], top) if len(own) else ("und", 0.0))
        return out


def learn(texts: Sequence[str], languages: Sequence[str], landmarks: int = LANDMARKS) -> Classifier:
    return learn_sets([grams(t) for t in texts], languages, landmarks)


def learn_sets(sets: Sequence[np.ndarray], languages: Sequence[str], landmarks: int = LANDMARKS) -> Classifier:
    """Nyström features over the first landmarks of each language, then ridge regression for each language.

    The landmarks are taken from all languages in turn until there are ALL_LANDMARKS.
    """
    usable = [i for i, s in enumerate(sets) if len(s)]
    sets, languages = [sets[i] for i in usable], [languages[i] for i in usable]
    names = sorted(set(languages))
    if not names:
        return Classifier(np.zeros(1, np.uint64), np.zeros((1, 0), np.uint8), np.ones(0, np.float32), np.zeros((0, 0)), [])
    number, rows_of = {name: k for k, name in enumerate(names)}, np.zeros(len(names))
    turns = []
    for i, name in enumerate(languages):
        turns.append((int(rows_of[number[name]]), i))
        rows_of[number[name]] += 1
    chosen = sorted((i for _, i in sorted(x for x in turns if x[0] < landmarks)[:ALL_LANDMARKS]), key=lambda i: (languages[i], i))
    vocabulary = np.unique(np.concatenate([sets[i] for i in chosen]))
    incidence = np.zeros((len(vocabulary), (len(chosen) + 7) // 8), np.uint8)
    for j, i in enumerate(chosen):
        incidence[np.searchsorted(vocabulary, sets[i]), j // 8] |= np.uint8(128 >> j % 8)
    norms = np.sqrt(np.array([len(sets[i]) for i in chosen], np.float32))
    model = Classifier(vocabulary, incidence, norms, np.zeros((len(chosen), len(names))), names)
    kernel = np.concatenate([model.kernel(sets[at:at + _BLOCK]) for at in range(0, len(sets), _BLOCK)]).astype(float)
    among = kernel[chosen]
    values, vectors = np.linalg.eigh((among + among.T) / 2)
    good = values > 1e-8 * max(values.max(), 1e-12)
    project = vectors[:, good] / np.sqrt(values[good])
    features = kernel @ project
    # Every language counts alike, however many rows it has.
    own = np.array([number[x] for x in languages])
    weighted = features * (1 / rows_of[own] / len(names))[:, None]
    gram = features.T @ weighted + _RIDGE * np.eye(features.shape[1]) / len(languages)
    goals = np.zeros((len(names), features.shape[1]))
    np.add.at(goals, own, weighted)
    model.coefficients = project @ np.linalg.solve(gram, goals.T)
    return model


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", id_: str = "doc_id", folds: int = FOLDS) -> Classifier:
    """Learn from rows with a language whose crc32 of the id modulo `folds` is not 1.

    Of each language the different texts first by hash, shorter ones before long ones: SAMPLE of them, or an equal share
    of ROWS, and never fewer than LEAST. Texts stay with the executors; the driver gets the n-grams of the chosen ones,
    which are at most ROWS texts, or LEAST of each language if that is more.
    """
    labelled = docs.select(
        col(docs, id_).alias("id"), col(docs, lang).cast("string").alias("lang"), text_of(docs, text).alias("t")
    ).where(F.col("id").isNotNull() & F.col("lang").isNotNull() & (F.length("t") > 0) & (bucket(F.col("id"), folds) != 1))
    labelled = labelled.select("lang", "t", F.xxhash64("t").alias("place"), (F.length("t") > LONG).alias("long"))
    with Shelf(docs.sparkSession) as shelf:
        texts = shelf.put(labelled.select("lang", "long", "place").distinct(), "languages")
        sizes = texts.groupBy("lang").agg(F.count_if(~F.col("long")).alias("short_n"), F.count_if("long").alias("long_n"))
        sizes = shelf.put(sizes, "sizes")
        per = max(LEAST, min(SAMPLE, ROWS // max(1, sizes.count())))
        # More by a hash threshold than are wanted, so that the ranks below are those of a small table.
        some = F.lit(float(2 * per + 32))
        share = F.when(~F.col("long"), some / F.col("short_n")).when(F.col("short_n") < per, some / F.col("long_n"))
        small = texts.join(sizes, "lang").where(F.pmod("place", F.lit(1 << 30)) < share * F.lit(float(1 << 30)))
        first = Window.partitionBy("lang").orderBy("long", F.pmod("place", F.lit(1 << 30)), "place")
        wanted = shelf.put(
            small.select("lang", "place", F.row_number().over(first).alias("nth")).where(F.col("nth") <= per), "wanted"
        )
        # No more rows than the bound above.
        picked = labelled.join(F.broadcast(wanted), ["lang", "place"]).groupBy("lang", "nth").agg(F.min("t").alias("t"))
        rows = picked.select("lang", "nth", "t").mapInArrow(_grams_of, "lang string, nth int, grams binary").collect()
    rows.sort(key=lambda r: (r.lang, r.nth))
    return learn_sets([np.frombuffer(r.grams, np.uint64) for r in rows], [r.lang for r in rows])


def _grams_of(batches):
    for batch in pieces(batches, rows=_BLOCK):
        sets = [grams(t).tobytes() for t in texts_of(batch)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1).cast(pa.int32()), pa.array(sets, pa.binary())], names=["lang", "nth", "grams"]
        )


def identify(docs: DataFrame, model: Classifier, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The kept columns, lang_pred and score (the winning regression's value, held to 0 to 1)."""
    shared, n = docs.sparkSession.sparkContext.broadcast(model), len(keep)
    schema = struct_with(docs, keep, "lang_pred string, score double")
    out = arrow_schema(schema)

    def run(batches):
        for batch in pieces(batches, rows=_BLOCK):
            found = shared.value.predict(texts_of(batch))
            kept = [batch.column(i).cast(out.field(i).type) for i in range(n)]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array([x for x, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())], schema=out
            )

    return light(docs, keep, text).mapInArrow(run, schema)

"""Toxicity scoring with noisy-channel deobfuscation.

A character trigram model is counted over all documents. Where a text shows leetspeak, letters set apart or repeated
letters, the stretch becomes a lattice: every position may stand for some letters, for a gap or for nothing, each at a
channel cost. The Viterbi path under the character model restores the stretch; where the noise is not plain to see, only
if that path is likelier than the text as it stands. A word without any letter is a number and stays. A logistic model over the words of the
restored text and their character n-grams gives the score.

Rules for odd input: null, empty and letterless texts are scored like a text without features; rows with a null label
are not learnt from; of rows that share an id one text is learnt from; without labels of both kinds every score is 0.
Learning uses at most SAMPLE rows of each label, picked by a hash of the id, with texts of at most SAMPLE_CHARS.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import arrow_schema, bucket, col, light, pieces, struct_with, text_of, texts_of

# Learning bounds: rows of each label, characters of a text, features kept for the model.
SAMPLE = 1_500
SAMPLE_CHARS = 50_000
FEATURES = 4_000
LEAST_ROWS = 3
# With very many n-grams to choose from, weaker ones are chance; without any strong one the best few must do.
LEAST_CHI_SQUARE = 15.0
FEW_FEATURES = 20

THRESHOLD = 0.5
FOLDS = 5

# Letters that a sign may stand for, with natural logs of the channel's chances.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "£": "l", "¡": "i", "(": "c", "&": "a",
}
_SWAP, _AS_GAP, _DROP, _KEEP, _REPEAT = -1.5, -9.0, -0.7, -2.0, -1.0
# A sign that is meant as one; exclamation marks at the end of a word are free.
_MEANT = -4.0

# Classes of the character model: 0 gap, 1-26 letters, 27 any other letter.
CLASSES = 28
_LATIN = np.zeros(0x250, np.uint8)
for _c in range(0x250):
    if chr(_c).isalpha():
        _low = chr(_c).lower()[0]
        _LATIN[_c] = ord(_low) - 96 if "a" <= _low <= "z" else 27

_REPEATED = re.compile(r"([^\W\d_])\1\1", re.IGNORECASE)
_SIGNS = "".join(LEET)
_SIGN = re.compile(f"[{re.escape(_SIGNS)}]")
_LETTER = re.compile(r"[^\W\d_]")
# Letters and signs set apart by runs of anything else; those that need no comparison have no signs but digits.
_APART = rf"(?:[^\w{re.escape(_SIGNS)}]|_)++"
_SEPARATORS = re.compile(_APART)
_SPACED = re.compile(rf"(?<!\S)(?:[^\W_]|{_SIGN.pattern})(?:{_APART}(?:[^\W_]|{_SIGN.pattern})){{2,}}(?!\w)")
_SURELY_SPACED = re.compile(r"[^\W_](?:[ .*_-]{1,2}[^\W_]){3,}")
_MIXED = re.compile(rf"[^\W\d_][{re.escape(_SIGNS)}]+[^\W\d_]|(?<!\S)[{re.escape(_SIGNS)}]{{1,2}}[^\W\d_]{{2}}")
_OUTER = ".,;:?\"'()[]{}<>*#%&~`"
_WORD = re.compile(r"[^\W\d_]+")


def class_of(ch: str) -> int:
    return int(_LATIN[ord(ch)]) if ord(ch) < 0x250 else 27 if ch.isalpha() else 0


def classes_of(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    out = _LATIN[np.minimum(points, 0x24F)]
    for place in np.flatnonzero(points >= 0x250):
        out[place] = 27 if chr(points[place]).isalpha() else 0
    return out


def count_trigrams(texts: Sequence[str]) -> np.ndarray:
    total = np.zeros(CLASSES**3, np.int64)
    for text in texts:
        c = np.concatenate([[0, 0], classes_of(text), [0]]).astype(np.int32)
        total += np.bincount((c[:-2] * CLASSES + c[1:-1]) * CLASSES + c[2:], minlength=CLASSES**3)
    return total


def trigram_counts(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Character trigram counts over all documents: one row per task and trigram seen, at most CLASSES**3 at the end."""

    def run(batches):
        total = np.zeros(CLASSES**3, np.int64)
        for batch in pieces(batches):
            total += count_trigrams(texts_of(batch))
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(total[seen])], names=["gram", "n"])

    counts = docs.select(col(docs, text).cast("string")).mapInArrow(run, "gram int, n long")
    out = np.zeros(CLASSES**3, np.int64)
    for row in counts.groupBy("gram").agg(F.sum("n").alias("n")).collect():
        out[row.gram] = row.n
    return out


@dataclass
class Decoder:
    """Viterbi decoding of noisy stretches under a trigram model of character classes."""

    counts: np.ndarray
    table: list = field(init=False)

    def __post_init__(self):
        n = self.counts.reshape(CLASSES, CLASSES, CLASSES).astype(float)
        pairs, singles = n.sum(axis=2, keepdims=True), n.sum(axis=(0, 1)) + 1
        bi = n.sum(axis=0)
        prior = singles / singles.sum()
        low = (bi + 5 * prior) / (bi.sum(axis=1, keepdims=True) + 5)
        self.table = np.log((n + 5 * low[None, :, :]) / (pairs + 5)).tolist()

    @staticmethod
    def lattice(noisy: str) -> list[list[tuple[str, float]]]:
        """What every position may stand for; a run of one letter is one position."""
        out, i, s = [], 0, noisy.lower()
        while i < len(s):
            ch, j = s[i], i + 1
            while j < len(s) and s[j] == ch:
                j += 1
            run = j - i
            if ch.isalpha():
                choices = [(ch, 0.0 if run == 1 else _REPEAT)]
                if run >= 2:
                    choices.append((ch * 2, 0.0 if run == 2 else _REPEAT))
            elif ch in LEET:
                choices = [(letter * k, _SWAP * min(run, 2)) for letter in LEET[ch] for k in range(1, min(run, 2) + 1)]
                choices.append((" ", _AS_GAP))
            elif ch in " .*_-":
                choices = [("", _DROP), (" ", _KEEP)]
            else:
                choices = [(" ", 0.0)]
            out.append(choices)
            i = j
        return out

    def decode(self, noisy: str) -> str:
        """The likeliest reading of a stretch."""
        return self.best(noisy)[1]

    def best(self, noisy: str) -> tuple[float, str]:
        """The likeliest reading of a stretch and its score."""
        table = self.table
        paths = {(0, 0): (0.0, None)}
        for choices in self.lattice(noisy):
            new: dict = {}
            for (a, b), (score, path) in paths.items():
                for letters, cost in choices:
                    x, y, total = a, b, score + cost
                    for ch in letters:
                        c = class_of(ch)
                        total += table[x][y][c]
                        x, y = y, c
                    old = new.get((x, y))
                    if old is None or total > old[0]:
                        new[x, y] = (total, (path, letters))
            paths = new
        total, _, _, path = max(((score + table[a][b][0], a, b, path) for (a, b), (score, path) in paths.items()), key=lambda p: p[:3])
        out = []
        while path:
            path, letters = path
            out.append(letters)
        return total, "".join(reversed(out))

    def plain(self, text: str) -> float:
        """The score of a stretch that means what it says: its signs are no letters."""
        total, a, b = _MEANT * len(_SIGN.findall(text.rstrip("!"))), 0, 0
        for c in [*classes_of(text).tolist(), 0]:
            total += self.table[a][b][c]
            a, b = b, c
        return total

    def likelier(self, noisy: str) -> str | None:
        """The likeliest reading, if it is likelier than the stretch as it stands."""
        score, reading = self.best(noisy)
        return reading if score > self.plain(noisy) else None

    def restore(self, text: str) -> str:
        """The text with its noisy stretches restored, in small letters where they were."""
        return " ".join(map(self.word, self.joined(text).split()))

    def joined(self, text: str) -> str:
        """Letters set apart are put together; the rest of the text stays."""
        return _SPACED.sub(self._together, text)

    def _together(self, m: re.Match) -> str:
        apart = m.group()
        evenly = _SEPARATORS.sub(" ", apart)
        if _SURELY_SPACED.fullmatch(apart):
            return self.decode(evenly)
        return (self.likelier(evenly) if _LETTER.search(apart) else None) or apart

    def word(self, word: str) -> str:
        core = word.strip(_OUTER)
        repeated = _REPEATED.search(core)
        if not repeated and (not core or core.isalpha() or not _SIGN.search(core)):
            return word
        letters = sum(map(str.isalpha, core))
        if letters >= 2 and 3 * letters >= len(core) and (repeated or _MIXED.search(core)):
            return self.decode(core)
        # Numbers are not words in disguise; of addresses, keys and last signs the character model tells.
        return (self.likelier(core) if letters else None) or word


def features_of(word: str) -> list[str]:
    """The word itself and the 4- and 5-grams of it between marks."""
    w = f"^{word}$"
    return ["=" + word, *[w[i:i + n] for n in (4, 5) for i in range(len(w) - n + 1)]]


def words_in(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


@dataclass
class Model:
    decoder: Decoder
    weights: dict[str, float]
    bias: float
    _known: dict = field(default_factory=dict)

    def score(self, text: str | None) -> float:
        if not self.weights:
            return 0.0
        present: set[str] = set()
        known = self._known
        for token in set(self.decoder.joined(text or "").split()):
            own = known.get(token)
            if own is None:
                if len(known) >= 200_000:
                    known.clear()
                own = known[token] = self._features(token)
            if own:
                present.update(own)
        z = self.bias + math.fsum(map(self.weights.__getitem__, present))
        return 1 / (1 + math.exp(-max(-50.0, min(50.0, z))))

    def _features(self, token: str) -> tuple[str, ...]:
        found = {f for w in words_in(self.decoder.word(token)) for f in features_of(w) if f in self.weights}
        return tuple(sorted(found))


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", id_: str = "doc_id", label: str = "toxic", folds: int = FOLDS) -> Model:
    """Learn from the labelled rows whose crc32 of the id modulo `folds` is not 0."""
    decoder = Decoder(trigram_counts(docs, text))
    marked = (
        labels.select(col(labels, id_).alias("id"), col(labels, label).cast("int").alias("y"))
        .where(F.col("id").isNotNull() & F.col("y").isin(0, 1) & (bucket(F.col("id"), folds) != 0))
        # However many rows say so, an id has a label once.
        .distinct()
    )
    sizes = {r.y: r.n for r in marked.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(sizes) < 2:
        return Model(decoder, {}, 0.0)
    # Half as many again as wanted, as some rows have no document or a long text; then exactly the bound.
    share = F.element_at(F.create_map(*[x for y, n in sizes.items() for x in (F.lit(y), F.lit(min(1.0, 1.5 * SAMPLE / n)))]), F.col("y"))
    picked = marked.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < share * (1 << 30))
    most = [picked.where(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(2 * SAMPLE) for y in (0, 1)]
    wanted = F.broadcast(most[0].unionByName(most[1]))
    texts = docs.select(col(docs, id_).alias("id"), text_of(docs, text).alias("t")).where(F.length("t") <= SAMPLE_CHARS)
    # One text per id and label: an id that very many rows share must not bring them all to the driver.
    rows = texts.join(wanted, "id").groupBy("id", "y").agg(F.min("t").alias("t")).mapInArrow(_featured(decoder), "id string, y int, words array<string>").collect()
    rows.sort(key=lambda r: (zlib.crc32(r.id.encode()), r.id, r.y))
    kept = [[r for r in rows if r.y == y][:SAMPLE] for y in (0, 1)]
    return Model(decoder, *_logistic([(r.y, r.words) for part in kept for r in part]))


def _featured(decoder: Decoder):
    def run(batches):
        for batch in pieces(batches, rows=128):
            ids = [str(x) for x in batch.column("id").to_pylist()]
            words = [sorted(words_in(decoder.restore(t or ""))) for t in batch.column("t").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids), batch.column("y").cast(pa.int32()), pa.array(words, pa.list_(pa.string()))], names=["id", "y", "words"]
            )

    return run


def _logistic(rows: Sequence[tuple[int, list[str]]]) -> tuple[dict[str, float], float]:
    """Features by their log odds, then a logistic model over the presence of the strongest ones."""
    n = [sum(1 for r in rows if r[0] == y) for y in (0, 1)]
    if not all(n):
        return {}, 0.0
    # Rows of the label come first: only features with enough of them can be chosen, so only those are counted further.
    seen: tuple[Counter, Counter] = (Counter(), Counter())
    for y, words in rows:
        if y:
            seen[1].update({f for w in words for f in features_of(w)})
    known = {f for f, a in seen[1].items() if a >= 2}
    seen = (Counter(), Counter({f: seen[1][f] for f in known}))
    for y, words in rows:
        if not y:
            seen[0].update({f for w in words for f in features_of(w) if f in known})
    scored = []
    for f in known:
        a, b = seen[1][f], seen[0][f]
        if a + b >= LEAST_ROWS:
            p, q = a / n[1], b / n[0]
            both = (a + b) / (n[0] + n[1])
            # The chi-square statistic of the feature and the label, for features that speak for the label.
            if p > q:
                scored.append((-((p - q) ** 2) / (both * (1 - both) + 1e-9) * n[0] * n[1] / (n[0] + n[1]), f))
    strong = sorted(x for x in scored if x[0] <= -LEAST_CHI_SQUARE)[:FEATURES]
    chosen = [f for _, f in strong or sorted(scored)[:FEW_FEATURES]]
    place = {f: i for i, f in enumerate(chosen)}
    rows_x, x_at = [], []
    for r, (_, words) in enumerate(rows):
        present = sorted({place[f] for w in words for f in features_of(w) if f in place})
        rows_x += [r] * len(present)
        x_at += present
    r_at, x_at = np.array(rows_x, np.int64), np.array(x_at, np.int64)
    y = np.array([r[0] for r in rows], float)
    weight = np.where(y > 0, len(y) / (2 * n[1]), len(y) / (2 * n[0]))
    w, b, gw, gb = np.zeros(len(chosen)), 0.0, np.full(len(chosen), 1e-8), 1e-8
    for _ in range(400):
        z = np.bincount(r_at, w[x_at], len(y)) + b
        g = weight * (1 / (1 + np.exp(-np.clip(z, -50, 50))) - y) / len(y)
        dw, db = np.bincount(x_at, g[r_at], len(w)) + 1e-4 * w, g.sum()
        gw, gb = gw + dw**2, gb + db**2
        w, b = w - 0.3 * dw / np.sqrt(gw), b - 0.3 * db / np.sqrt(gb)
    return {f: round(float(v), 9) for f, v in zip(chosen, w)}, round(float(b), 9)


def score(docs: DataFrame, model: Model, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The kept columns and score, 0 to 1."""
    shared, n = docs.sparkSession.sparkContext.broadcast(model), len(keep)
    schema = struct_with(docs, keep, "score double")
    out = arrow_schema(schema)

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            kept = [batch.column(i).cast(out.field(i).type) for i in range(n)]
            scores = [shared.value.score(t) for t in texts_of(batch)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(scores, pa.float64())], schema=out)

    return light(docs, keep, text).mapInArrow(run, schema)


def predicted(score_: Column) -> Column:
    return (score_ >= THRESHOLD).cast("int")


def without_toxic(docs: DataFrame, labels: DataFrame, text: str = "text", id_: str = "doc_id") -> DataFrame:
    """The documents that the model does not reject, with all their columns."""
    names = docs.columns
    inner = docs.toDF(*[f"c{i}" for i in range(len(names))])
    t = f"c{names.index(text)}"
    model = fit(docs, labels, text, id_)
    return score(inner, model, t, inner.columns).where(F.col("score") < THRESHOLD).drop("score").toDF(*names)

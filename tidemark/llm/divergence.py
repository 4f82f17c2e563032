"""Quality rules by distribution divergence.

Every document has two histograms: of character classes, and of the common words of its language with one bin for all
other words. The Jensen-Shannon distance of each to the language's reference, taken over all documents of that language,
must stay within a limit that loosens for short texts; below a minimum length a histogram says nothing and does not
count. A document that fails the base rules is not kept in any case.

Rules for odd input: null and empty texts have no words and fail the base rules; a null language is a language of its
own, named by an empty string; repeated rows count as often as they occur.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.common import arrow_schema, col, pieces, struct_with, texts_of

# Base rules.
LEAST_WORDS = 50
SYMBOLS = "#*$%&|<>"

# Common words of a language; languages whose references are made and sent to all executors at once.
COMMON_WORDS = 150
LANGUAGES = 500
OTHERS = "\0"

# Different words a task holds before it emits their counts; the kinds of counts besides the character classes.
_HELD_WORDS = 200_000
WORDS, ALL_WORDS = -1, -2
COUNTS = "lang string, kind int, word binary, n long"

# Limits of the two distances for long texts, what a short one may have more (over the square root of its size), and the
# sizes from which they count.
CHARACTER_LIMIT, CHARACTER_SLACK, LEAST_CHARACTERS = 0.20, 2.0, 200
WORD_LIMIT, WORD_SLACK, LEAST_COUNTED = 0.35, 3.0, 50

# Character classes by byte of UTF-8, so that a text is classed in one pass: 0 small letter, 1 capital, 2 digit,
# 3 space, 4 line break and other white space, 5 sentence mark, 6 symbol, 7 other sign, 8 other character (its first
# byte), 9 following byte, which is not counted.
_CLASS = bytearray(256)
for _b in range(256):
    _c = chr(_b)
    if _b >= 128:
        _CLASS[_b] = 8 if _b >= 192 else 9
    elif _c.isalpha():
        _CLASS[_b] = 0 if _c.islower() else 1
    elif _c.isdigit():
        _CLASS[_b] = 2
    elif _c == " ":
        _CLASS[_b] = 3
    elif _c.isspace():
        _CLASS[_b] = 4
    elif _c in ".,;:!?'\"-()":
        _CLASS[_b] = 5
    elif _c in SYMBOLS:
        _CLASS[_b] = 6
    else:
        _CLASS[_b] = 7
CLASSES = 9
_FOLD = bytes(b + 32 if 65 <= b <= 90 else 32 if _CLASS[b] in (5, 6, 7) else b for b in range(256))


def character_histogram(data: bytes) -> np.ndarray:
    classes = np.frombuffer(data.translate(bytes(_CLASS)), np.uint8)
    return np.bincount(classes, minlength=10)[:CLASSES]


def counted_words(data: bytes) -> list[bytes]:
    """Words in small letters; signs part words."""
    return data.translate(_FOLD).split()


def _utf8(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")


def jensen_shannon(a: np.ndarray, b: np.ndarray) -> float:
    """Distance between two histograms: the root of the divergence in bits, 0 to 1."""
    p, q = a / max(1, a.sum()), b / max(1, b.sum())
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        parts = np.where(p > 0, p * np.log2(p / m), 0) + np.where(q > 0, q * np.log2(q / m), 0)
    return float(np.sqrt(max(0.0, parts.sum() / 2)))


def base_figures(data: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of a text in UTF-8."""
    words = data.split()
    n = len(words)
    joined = b"".join(words)
    chars = len(joined) - len(joined.translate(None, _STARTS))
    symbols = len(data) - len(data.translate(None, SYMBOLS.encode()))
    dup = 0
    if b"\n" in data:
        lines = [line for line in data.split(b"\n") if line.strip()]
        dup = len(lines) - len(set(lines))
    repeated = 0
    if n > 3:
        windows = list(zip(words, words[1:], words[2:]))
        if len(set(windows)) < len(windows):
            times = Counter(windows)
            hit = bytearray(n)
            for i, w in enumerate(windows):
                if times[w] > 1:
                    hit[i] = hit[i + 1] = hit[i + 2] = 1
            repeated = sum(hit)
    return n, chars, symbols, dup, repeated


# Bytes that begin a character.
_STARTS = bytes(b for b in range(256) if b < 128 or b >= 192)


def base_failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < LEAST_WORDS or 100 * n_repeat_words > 50 * n_words


def own_languages(docs: DataFrame, lang: str = "lang", most: int | None = LANGUAGES) -> list[str]:
    """The most frequent languages, or all of them."""
    names = docs.select(F.coalesce(col(docs, lang).cast("string"), F.lit("")).alias("lang"))
    top = names.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang")
    top = top if most is None else top.limit(most)
    return sorted(r.lang for r in top.collect())


def _texts_by_language(docs: DataFrame, text: str, lang: str) -> DataFrame:
    return docs.select(F.coalesce(col(docs, lang).cast("string"), F.lit("")).alias("lang"), col(docs, text).cast("string").alias("t"))


def references(docs: DataFrame, text: str = "text", lang: str = "lang", common: int = COMMON_WORDS) -> dict[str, "Reference"]:
    """One reference per language, and one under OTHERS for the languages without their own.

    One pass over all documents. A task emits every word it holds when it holds many and at its end, so the sums are
    the exact counts however the documents are dealt out. What reaches the driver is bounded by LANGUAGES and `common`.
    """
    known = frozenset(own_languages(docs, lang))
    light = _texts_by_language(docs, text, lang)

    def count(batches):
        words: dict[str, Counter] = {}
        classes: dict[str, np.ndarray] = {}
        totals: Counter = Counter()
        for batch in pieces(batches):
            for name, t in zip(batch.column(0).to_pylist(), texts_of(batch)):
                name, data = name if name in known else OTHERS, _utf8(t)
                own = counted_words(data)
                words.setdefault(name, Counter()).update(own)
                totals[name] += len(own)
                classes[name] = classes.get(name, 0) + character_histogram(data)
            if sum(map(len, words.values())) > _HELD_WORDS:
                yield _counts(words, {}, {})
                words = {}
        yield _counts(words, classes, totals)

    order = [F.desc("n"), F.asc("word")]
    sums = light.mapInArrow(count, COUNTS).groupBy("lang", "kind", "word").agg(F.sum("n").alias("n"))
    salted = sums.withColumn("salt", F.pmod(F.xxhash64("word"), F.lit(64)))
    best = (
        salted.withColumn("r", F.row_number().over(Window.partitionBy("lang", "kind", "salt").orderBy(*order))).where(F.col("r") <= max(1, common))
        .withColumn("r", F.row_number().over(Window.partitionBy("lang", "kind").orderBy(*order))).where(F.col("r") <= max(1, common))
    )
    found: dict[str, list] = {}
    for r in best.collect():
        found.setdefault(r.lang, []).append(r)
    out = {}
    for name, own in found.items():
        top = sorted(((r.n, bytes(r.word)) for r in own if r.kind == WORDS), key=lambda x: (-x[0], x[1]))[:common]
        single = {r.kind: r.n for r in own if r.kind != WORDS}
        out[name] = Reference([single.get(k, 0) for k in range(CLASSES)], [w for _, w in top], [n for n, _ in top], single[ALL_WORDS])
    return out


def _counts(words: dict[str, Counter], classes: dict[str, np.ndarray], totals: dict[str, int]) -> pa.RecordBatch:
    """Rows of counts, of kind WORDS, ALL_WORDS (how many words in all) or a character class."""
    rows = [(name, WORDS, w, n) for name, own in words.items() for w, n in own.items()]
    rows += [(name, k, b"", int(n)) for name, own in classes.items() for k, n in enumerate(own)]
    rows += [(name, ALL_WORDS, b"", n) for name, n in totals.items()]
    columns = list(zip(*rows)) or [[], [], [], []]
    kinds = (pa.string(), pa.int32(), pa.binary(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["lang", "kind", "word", "n"])


class Reference:
    def __init__(self, classes: Sequence[int], words: Sequence[bytes], counts: Sequence[int], all_words: int):
        self.classes = np.array(classes, float)
        self.place = {w: i for i, w in enumerate(words)}
        self.words = np.array([*counts, all_words - sum(counts)], float)

    def distances(self, data: bytes) -> tuple[float, float, int, int]:
        """Distances of characters and words, and the numbers of both."""
        chars = character_histogram(data)
        own = counted_words(data)
        hist = np.zeros(len(self.words))
        for w, n in Counter(map(self.place.get, own)).items():
            hist[-1 if w is None else w] += n
        return jensen_shannon(chars, self.classes), jensen_shannon(hist, self.words), int(chars.sum()), len(own)


def pooled(refs: dict[str, "Reference"]) -> "Reference | None":
    """The sum of all references, for a language that has none of its own."""
    if not refs:
        return None
    counts: Counter = Counter()
    for ref in refs.values():
        counts.update({w: int(ref.words[i]) for w, i in ref.place.items()})
    most = max(len(ref.place) for ref in refs.values())
    top = sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:most]
    return Reference(sum(ref.classes for ref in refs.values()), [w for w, _ in top], [n for _, n in top], int(sum(ref.words.sum() for ref in refs.values())))


def judge_documents(docs: DataFrame, text: str = "text", lang: str = "lang", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Every document against the reference of its own language, whatever the number of languages.

    References are made and used for LANGUAGES languages at a time, so what is held at once is bounded.
    """
    names = own_languages(docs, lang, None)
    if len(names) <= LANGUAGES:
        return judge(docs, references(docs, text, lang), text, lang, keep)
    parts = []
    for at in range(0, len(names), LANGUAGES):
        block = F.broadcast(docs.sparkSession.createDataFrame([(n,) for n in names[at:at + LANGUAGES]], "_name string"))
        own = docs.join(block, F.coalesce(col(docs, lang).cast("string"), F.lit("")) == F.col("_name"), "left_semi")
        parts.append(judge(own, references(own, text, lang), text, lang, keep))
    return reduce(DataFrame.unionByName, parts)


def verdict(char_js: float, word_js: float, n_chars: int, n_counted: int) -> bool:
    if n_chars >= LEAST_CHARACTERS and char_js > CHARACTER_LIMIT + CHARACTER_SLACK / n_chars**0.5:
        return False
    return not (n_counted >= LEAST_COUNTED and word_js > WORD_LIMIT + WORD_SLACK / n_counted**0.5)


FIGURES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
    "kept boolean, char_js double, word_js double"
)


def judge(
    docs: DataFrame, refs: dict[str, Reference], text: str = "text", lang: str = "lang", keep: Sequence[str] = ("doc_id",)
) -> DataFrame:
    """The kept columns with the base figures, the verdict and both distances.

    A language without a reference is held against the sum of all; without any reference both distances are 0.
    """
    n, rest = len(keep), refs.get(OTHERS) or pooled(refs)
    schema = struct_with(docs, keep, FIGURES)
    out = arrow_schema(schema)
    shared = docs.sparkSession.sparkContext.broadcast((refs, rest))
    light = docs.select(
        *[col(docs, c).alias(f"c{i}") for i, c in enumerate(keep)], F.coalesce(col(docs, lang).cast("string"), F.lit("")).alias("_lang"),
        col(docs, text).cast("string").alias("_text"),
    )

    def run(batches):
        known, rest_of_all = shared.value
        for batch in pieces(batches):
            rows = []
            for name, t in zip(batch.column(n).to_pylist(), texts_of(batch)):
                data = _utf8(t)
                base = base_figures(data)
                failed = base_failed(base[0], base[4])
                reference = known.get(name, rest_of_all)
                d = reference.distances(data) if reference else (0.0, 0.0, 0, 0)
                rows.append((*base, failed, not failed and verdict(*d), d[0], d[1]))
            kept = [batch.column(i).cast(out.field(i).type) for i in range(n)]
            columns = list(zip(*rows)) or [[]] * 9
            yield pa.RecordBatch.from_arrays([*kept, *[pa.array(c, out.field(n + i).type) for i, c in enumerate(columns)]], schema=out)

    return light.mapInArrow(run, schema)

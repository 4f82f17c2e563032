"""Personal data, with information-theoretic sanitisation, in built-in functions only.

Base spans are found by pattern; their values are the protected entities. Over the whole corpus, the words near an
entity give co-occurrence counts in documents. With p(c|t) the share of a term's documents that hold entity c close by,
and IC(c) = log2(N / documents of c), the term tells IC(c) + log2 p(c|t) bits of c. Divided by IC(c) this is its
disclosure. A term at or above REMOVE is removed near that entity, one at or above GENERALISE is replaced by a general
word. Base spans always stay; in sanitised text they are replaced by the name of their kind.

Rules for odd input: null and empty texts have no spans; rows alike in id and text count as one document and get the
same spans; a term needs LEAST_SUPPORT documents with the entity, as one meeting proves nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import Shelf, col, fresh, row_key, text_of
from tidemark.llm.spans import SPAN, matches

KINDS = ["email", "ip", "card", "phone"]
ADDED = ["generalise", "remove"]

# The base patterns. A match can only begin where a run of its first characters begins or where the match
# before ended; saying so keeps the search linear on long runs. Possessive repeats keep it off the stack.
_EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
_IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
_IP_PARTS = r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})(?:\.|$)){4}$"
_CARD = r"[0-9](?:[\x20-]?[0-9])++"
_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

# How far around an entity a term counts as near, in characters; the least length of a term.
NEAR = 60
_TERM = r"(?<=[^\p{L}])\p{L}{3,}+(?=[^\p{L}])"
LEAST_TERM = 3

# Disclosure thresholds and the documents a term needs together with an entity.
REMOVE, GENERALISE, LEAST_SUPPORT = 0.9, 0.75, 3

# Terms near entities that are sent to all executors for counting; more are counted by a shuffle of all words.
BROADCAST_TERMS = 500_000


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """From the right, every second digit is doubled, less 9 where that has two digits; the sum must end in 0."""

    def add(total: Column, i: Column) -> Column:
        d = F.substring(F.reverse(digits), i + 1, F.lit(1)).cast("int") * F.when(i % 2 == 1, 2).otherwise(1)
        return total + F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add) % 10 == 0


def base_spans(text: Column) -> Column:
    number = text.rlike("[0-9]")
    cards = F.filter(
        matches(text, _CARD, "card", text.rlike(r"[0-9](?:[\x20-]?[0-9]){13}")),
        lambda s: F.length(_digits(s["value"])).between(14, 19) & luhn(_digits(s["value"])),
    )
    return F.concat(
        matches(text, _EMAIL, "email", F.contains(text, F.lit("@"))),
        F.filter(matches(text, _IP, "ip", number), lambda s: s["value"].rlike(_IP_PARTS)),
        cards,
        F.filter(matches(text, _PHONE, "phone", F.contains(text, F.lit("+"))), lambda s: F.length(_digits(s["value"])).between(10, 15)),
    )


def _near(text: Column, base: Column) -> Column:
    """Per base span its entity and the terms near it, with their places; a term inside a base span is none."""
    padded = F.concat(F.lit(" "), text, F.lit(" "))  # one place further right

    def terms(start: Column, length: Column) -> Column:
        found = matches(F.substring(padded, start + 1, length), _TERM, "term")
        return F.transform(
            found, lambda t: F.struct(F.lower(t["value"]).alias("term"), (t["start"] + start - 1).alias("start"), (t["end"] + start - 1).alias("end"))
        )

    def around(s: Column) -> Column:
        left = F.greatest(s["start"] - NEAR, F.lit(0).cast("long"))
        both = F.concat(terms(left, s["start"] - left + 2), terms(s["end"], F.lit(NEAR + 2).cast("long")))
        free = F.filter(both, lambda t: ~F.exists(base, lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])))
        return F.struct(F.concat(s["kind"], F.lit(":"), s["value"]).alias("entity"), free.alias("terms"))

    return F.transform(base, around)


def _documents_of(docs: DataFrame, wanted: DataFrame, text: str, keys: Sequence[Column]) -> DataFrame:
    """(term, df_t): in how many documents each wanted term occurs, over the whole corpus; rows of one key are one document."""
    words = F.array_distinct(F.split(F.lower(text_of(docs, text)), r"[^\p{L}]+"))
    occurring = docs.select(keys[0].alias("k1"), keys[1].alias("k2"), F.explode(words).alias("term"))
    small = wanted.count() <= BROADCAST_TERMS
    return (
        occurring.join(F.broadcast(wanted) if small else wanted, "term")
        .distinct().groupBy("term").agg(F.count(F.lit(1)).alias("df_t"))
    )


def disclosing_terms(docs: DataFrame, shelf: Shelf, text: str = "text", id_: str = "doc_id") -> DataFrame:
    """(k1, k2, added): for each document, by its key, the terms that tell too much of an entity near them."""
    keys = row_key(docs, [id_, text])
    light = docs.select(keys[0].alias("k1"), keys[1].alias("k2"), text_of(docs, text).alias("t"))
    spans = light.select("k1", "k2", "t", base_spans(F.col("t")).alias("base")).where(F.size("base") > 0)
    near = shelf.put(
        spans.select("k1", "k2", F.explode(_near(F.col("t"), F.col("base"))).alias("n"))
        .select("k1", "k2", F.sha2(F.col("n.entity").cast("binary"), 256).alias("entity"), "n.terms").distinct(), "near",
    )
    n_docs = docs.select(keys[0].alias("k1"), keys[1].alias("k2")).distinct().count()
    in_docs = near.groupBy("entity", "k1", "k2").agg(F.lit(1).alias("one")).groupBy("entity").agg(F.count(F.lit(1)).alias("df_c"))
    placed = near.select("k1", "k2", "entity", F.explode("terms").alias("x")).select("k1", "k2", "entity", "x.*")
    together = shelf.put(
        placed.select("entity", "term", "k1", "k2").distinct().groupBy("entity", "term").agg(F.count(F.lit(1)).alias("df_tc"))
        .where(F.col("df_tc") >= LEAST_SUPPORT), "together",
    )
    ic = F.log2(F.lit(float(max(1, n_docs))) / F.col("df_c"))

    def tells(in_documents: str) -> Column:
        return F.when(ic > 0, (ic + F.log2(F.col("df_tc") / F.greatest(in_documents, "df_tc"))) / ic)

    # A term is in no fewer documents than those that have it near an entity. With that number its disclosure is an upper
    # bound, and what stays below the threshold even so, such as any common word, need not be looked for in the corpus.
    df_near = placed.select("term", "k1", "k2").distinct().groupBy("term").agg(F.count(F.lit(1)).alias("df_near"))
    possible = shelf.put(
        together.join(shelf.put(df_near, "near_df"), "term").join(shelf.put(in_docs, "entities"), "entity")
        .where(tells("df_near") >= GENERALISE), "possible",
    )
    df_t = shelf.put(_documents_of(docs, shelf.put(possible.select("term").distinct(), "terms"), text, keys), "df")
    kind = F.when(tells("df_t") >= REMOVE, "remove").when(tells("df_t") >= GENERALISE, "generalise")
    verdicts = shelf.put(
        possible.join(df_t, "term").select("entity", "term", kind.alias("kind")).where("kind IS NOT NULL"), "verdicts",
    )
    return shelf.put(
        placed.join(verdicts, ["entity", "term"]).groupBy("k1", "k2", "start", "end", "term").agg(F.max("kind").alias("kind"))
        .groupBy("k1", "k2").agg(F.collect_list(F.struct("kind", "start", "end", F.col("term").alias("value"))).alias("added")), "added",
    )


def find(docs: DataFrame, text: str = "text", id_: str = "doc_id", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The kept columns, base (spans) and added (spans of kinds generalise and remove)."""
    shelf = Shelf(docs.sparkSession)
    added = disclosing_terms(docs, shelf, text, id_)
    keys = row_key(docs, [id_, text])
    spans = docs.select(*[col(docs, c) for c in keep], keys[0].alias("k1"), keys[1].alias("k2"), base_spans(text_of(docs, text)).alias("base"))
    return spans.join(added, ["k1", "k2"], "left").select(*keep, "base", F.coalesce("added", F.array().cast(f"array<{SPAN}>")).alias("added"))


def sanitised(text: Column, spans: Column) -> Column:
    """The text with base spans named, removed terms left out and generalised ones replaced; overlaps become one."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"), s["value"].alias("value"))))

    def piece(at: Column, end: Column) -> Column:
        return F.substring(text, at + 1, F.greatest(end - at, F.lit(0).cast("long")))

    def word(s: Column) -> Column:
        return F.when(s["kind"] == "remove", "").when(s["kind"] == "generalise", "[TERM]").otherwise(F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))

    def step(acc: Column, s: Column) -> Column:
        parts = F.when(
            s["start"] >= acc["at"], F.concat(acc["parts"], F.array(piece(acc["at"], s["start"]), word(s)))
        ).otherwise(acc["parts"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), parts.alias("parts"))

    whole = F.aggregate(
        ordered, F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("parts")), step,
        lambda acc: F.array_join(F.concat(acc["parts"], F.array(piece(acc["at"], F.length(text).cast("long")))), ""),
    )
    return F.when(F.size(spans) > 0, whole).otherwise(text)


def sanitise(docs: DataFrame, text: str = "text", id_: str = "doc_id", n_chars: str | None = "n_chars") -> DataFrame:
    """The documents with sanitised texts, and all their columns; a column of text lengths follows.

    Only documents with personal data are shuffled, to meet their added spans; all others pass as they are.
    """
    shelf, names = Shelf(docs.sparkSession), docs.columns
    added = disclosing_terms(docs, shelf, text, id_)
    k1, k2, base, more, new = fresh(docs, "_k1", "_k2", "_base", "_more", "_new")
    keys = row_key(docs, [id_, text])
    held = docs.select("*", base_spans(text_of(docs, text)).alias(base))
    clean = held.where(F.size(base) == 0).drop(base)
    dirty = held.where(F.size(base) > 0).select("*", keys[0].alias(k1), keys[1].alias(k2)).join(
        added.select(F.col("k1").alias(k1), F.col("k2").alias(k2), F.col("added").alias(more)), [k1, k2], "left"
    )
    spans = F.concat(F.col(base), F.coalesce(F.col(more), F.array().cast(f"array<{SPAN}>")))
    dirty = dirty.withColumn(new, sanitised(col(dirty, text), spans))
    out = []
    for c in names:
        if c == text:
            out.append(F.col(new).alias(c))
        elif c == n_chars:
            out.append(F.length(new).cast(docs.schema[c].dataType).alias(c))
        else:
            out.append(col(dirty, c))
    return clean.unionByName(dirty.select(*out))

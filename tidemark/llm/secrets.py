"""Secret scans with corpus-wide ownership frequency, in built-in functions only.

Base candidates are found by pattern. Long mixed tokens that no pattern names are candidates too. All candidates are
hashed, and over the whole corpus each hash gets the number of distinct repositories and owners that hold it. What one
owner alone holds, in few repositories, with varied characters, looks live; what many owners hold is a copied example;
the rest is shared. A live-looking token that lies in no base span becomes a span of kind `owned`. Base spans always stay.

A repository is a column, or, without one, each document stands for a repository of its own.

Rules for odd input: null and empty texts have no spans; a null owner or repository counts as one owner or repository
without a name; repeated rows add no owner or repository; rows alike in owner, repository and text get the same spans.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import Shelf, col, row_key, text_of
from tidemark.llm.spans import SPAN, matches

KINDS = ["assign", "access", "hex"]
ADDED = "owned"

# The base patterns.
_ASSIGN = (
    r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
_ACCESS = r"AKIA[A-Z0-9]{12,}"
_HEX = r"[0-9a-f]{32,}"

# A token that may be a secret: this long, with a digit and a letter, and this many different characters.
LEAST_LENGTH, LEAST_VARIED = 20, 10
_TOKEN = r"(?:\G|(?<![A-Za-z0-9+/_=-]))[A-Za-z0-9+/_=-]{20,}+"

# A hash is a copied example from this many owners on; it looks live with one owner and at most this many repositories.
COPIED_OWNERS = 3
LIVE_REPOSITORIES = 20
VERDICTS = ("live", "copied", "shared")


def base_spans(text: Column) -> Column:
    """Spans of the base kinds. Runs of one character class match from their start or not at all, so the least length
    may stand in the pattern; an assignment's value is checked after it matched."""
    assign = F.filter(
        matches(text, _ASSIGN, "assign", F.contains(text, F.lit(":")) | F.contains(text, F.lit("="))),
        lambda s: F.length(F.regexp_extract(s["value"], _ASSIGN, 1)) >= 8,
    )
    return F.concat(assign, matches(text, _ACCESS, "access", F.contains(text, F.lit("AKIA"))), matches(text, _HEX, "hex"))


def candidates(text: Column) -> Column:
    """Tokens beyond the base kinds that may be secrets."""

    def varied(s: Column) -> Column:
        return F.size(F.array_distinct(F.split(s["value"], ""))) >= LEAST_VARIED

    return F.filter(
        matches(text, _TOKEN, ADDED), lambda s: s["value"].rlike("[0-9]") & s["value"].rlike("[A-Za-z]") & varied(s)
    )


def _secret(span: Column) -> Column:
    """What is hashed: of an assignment its value, else the whole match."""
    return F.when(span["kind"] == "assign", F.regexp_extract(span["value"], _ASSIGN, 1)).otherwise(span["value"])


def ownership(found: DataFrame, hash_: str, repository: str, owner: str) -> DataFrame:
    """(hash, repositories, owners, verdict) over all rows: counts of distinct values, pre-aggregated in every task."""
    named = found.select(
        F.col(hash_).alias("hash"), F.coalesce(F.col(repository).cast("string"), F.lit("")).alias("repository"),
        F.coalesce(F.col(owner).cast("string"), F.lit("")).alias("owner"),
    )
    counts = named.groupBy("hash").agg(
        F.countDistinct("repository").alias("repositories"), F.countDistinct("owner").alias("owners")
    )
    verdict = (
        F.when(F.col("owners") >= COPIED_OWNERS, "copied")
        .when((F.col("owners") == 1) & (F.col("repositories") <= LIVE_REPOSITORIES), "live").otherwise("shared")
    )
    return counts.withColumn("verdict", verdict)


def scan(
    docs: DataFrame, text: str = "text", owner: str = "source", repository: str | None = None, keep: Sequence[str] = ("doc_id",)
) -> DataFrame:
    """The kept columns, base (spans), added (spans of kind owned), and n_live, n_copied, n_shared (candidates by verdict).

    A document's text is read once and goes no further than its task; only candidates are shuffled.
    """
    shelf, columns = Shelf(docs.sparkSession), [owner, text, *([repository] if repository else []), *keep]
    k1, k2 = row_key(docs, columns)
    repo = col(docs, repository).cast("string") if repository else F.concat_ws(":", k1, k2)
    light = docs.select(
        *[col(docs, c) for c in keep], k1.alias("_k1"), k2.alias("_k2"), repo.alias("_repo"),
        col(docs, owner).cast("string").alias("_owner"), text_of(docs, text).alias("_t"),
    )
    spans = light.select("*", base_spans(F.col("_t")).alias("base"), candidates(F.col("_t")).alias("_more")).drop("_t")
    outside = F.filter(
        "_more", lambda m: ~F.exists("base", lambda b: (b["start"] < m["end"]) & (m["start"] < b["end"]))
    )
    spans = shelf.put(spans.withColumn("_more", outside), "secrets")
    found = shelf.put(
        spans.select("_k1", "_k2", "_repo", "_owner", F.explode(F.concat("base", "_more")).alias("span"))
        .withColumn("hash", F.sha2(_secret(F.col("span")).cast("binary"), 256)), "candidates",
    )
    verdicts = shelf.put(ownership(found, "hash", "_repo", "_owner").select("hash", "verdict"), "verdicts")
    judged = shelf.put(
        found.select("_k1", "_k2", "span", "hash").distinct().join(verdicts, "hash").groupBy("_k1", "_k2").agg(
            F.collect_list(F.when((F.col("span.kind") == ADDED) & (F.col("verdict") == "live"), F.col("span"))).alias("added"),
            *[F.sum((F.col("verdict") == v).cast("long")).alias(f"n_{v}") for v in VERDICTS],
        ), "judged",
    )
    return spans.select(*keep, "_k1", "_k2", "base").join(judged, ["_k1", "_k2"], "left").select(
        *keep, "base", F.coalesce("added", F.array().cast(f"array<{SPAN}>")).alias("added"),
        *[F.coalesce(f"n_{v}", F.lit(0)).cast("long").alias(f"n_{v}") for v in VERDICTS],
    )

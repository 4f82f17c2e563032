"""Places of pattern matches in a text, with built-in functions only.

A text is split at the matches and the matches are extracted; both go through the text the same way, so the lengths of
gaps and matches, added up in turn, give every match its place. Lengths are in code points. The sums run in blocks, so a
text with very many matches costs little more than its matches.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

SPAN = "struct<kind:string,start:bigint,end:bigint,value:string>"
_BLOCK = 256


def matches(text: Column, pattern: str, kind: str, hint: Column | None = None) -> Column:
    """Array of (kind, start, end, value) of the leftmost non-overlapping matches; `hint` tells cheaply that there may be some."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), lambda g: F.length(g).cast("long"))
    # One step per match: the gap before it and the match itself.
    steps = F.transform(F.arrays_zip(F.slice(gaps, F.lit(1), F.size(found)), found), lambda s: F.struct(s["0"].alias("gap"), s["1"].alias("value")))

    def step(acc: Column, s: Column) -> Column:
        start = acc["at"] + s["gap"]
        end = start + F.length(s["value"])
        span = F.struct(F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"), s["value"].alias("value"))
        return F.struct(end.alias("at"), F.concat(acc["spans"], F.array(span)).alias("spans"))

    def block(acc: Column, b: Column, all_steps: Column) -> Column:
        inner = F.aggregate(
            F.slice(all_steps, b * _BLOCK + 1, F.lit(_BLOCK)),
            F.struct(acc["at"].alias("at"), F.array().cast(f"array<{SPAN}>").alias("spans")), step,
        )
        # Named once, so that it is worked out once.
        return F.transform(
            F.array(inner), lambda i: F.struct(i["at"].alias("at"), F.concat(acc["spans"], i["spans"]).alias("spans"))
        )[0]

    placed = F.transform(
        F.array(steps),
        lambda all_steps: F.aggregate(
            F.sequence(F.lit(0), F.floor((F.size(all_steps) - 1) / _BLOCK).cast("int")),
            F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(f"array<{SPAN}>").alias("spans")),
            lambda acc, b: block(acc, b, all_steps),
            lambda acc: acc["spans"],
        ),
    )[0]
    some = text.rlike(pattern) if hint is None else hint & text.rlike(pattern)
    return F.when(some, placed).otherwise(F.array().cast(f"array<{SPAN}>"))


def in_order(spans: Column, kinds: list[str]) -> Column:
    """Spans by start, then by the kinds' order."""
    rank = F.create_map(*[x for i, k in enumerate(kinds) for x in (F.lit(k), F.lit(i))])
    keyed = F.transform(
        spans, lambda s: F.struct(s["start"].alias("start"), F.element_at(rank, s["kind"]).alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"))
    )
    return F.array_sort(keyed)


def joined(spans: Column, kinds: list[str]) -> Column:
    """kind:start:end, comma-joined in order."""
    return F.array_join(
        F.transform(
            in_order(spans, kinds),
            lambda s: F.concat(s["kind"], F.lit(":"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string")),
        ), ",",
    )


def number(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")

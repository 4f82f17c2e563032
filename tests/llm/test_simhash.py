"""Fingerprints, links and components against plain loops."""

import random
from itertools import combinations

import pytest
import xxhash

from tidemark.llm import simhash
from tidemark.llm.common import Shelf
from tidemark.llm.components import components


def plain_fingerprint(text, k=4):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in low).split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_roots(values, most_bits=4):
    root = {v: v for v in values}

    def top(v):
        while root[v] != v:
            v = root[v]
        return v

    for a, b in combinations(sorted(values), 2):
        if (a ^ b).bit_count() <= most_bits:
            x, y = sorted((top(a), top(b)))
            root[y] = x
    return {v: top(v) for v in values}


@pytest.mark.parametrize("text", [None, "", " \n", "One", "one two three", "A b C d", "é É a A b B", "a b c d " * 300, "x\x85y z\xa0w a b c"])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def signed(v):
    return v - (1 << 64) if v >> 63 else v


@pytest.mark.parametrize("count", [2, 3, 4, 5, 6, 8])
def test_segments_reach_every_close_pair(count):
    cut = simhash.Segments(count)
    assert sum(cut.widths) == 64
    rng = random.Random(count)
    for _ in range(300):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), rng.randint(0, 4)):
            b ^= 1 << bit
        value = lambda x, i: x >> cut.shifts[i] & ((1 << cut.widths[i]) - 1)
        assert any(value(a, i) ^ m == value(b, i) for i in range(count) for m in cut.masks(i))


def test_classes_of_dense_and_sparse_fingerprints(spark):
    rng = random.Random(7)
    values = {rng.getrandbits(64) for _ in range(150)} | {0, (1 << 64) - 1}
    for size, most in ((120, 5), (60, 3), (30, 8)):
        centre = rng.getrandbits(64)
        for _ in range(size):
            v = centre
            for bit in rng.sample(range(64), rng.randint(0, most)):
                v ^= 1 << bit
            values.add(v)
    chain = rng.getrandbits(64)
    for i in range(12):
        chain ^= sum(1 << b for b in rng.sample(range(64), 4))
        values.add(chain)
    by_signed = {signed(v): v for v in values}
    df = spark.createDataFrame([(s,) for s in by_signed], "fp long")
    got = {r.fp: r.root for r in simhash.classes(df, Shelf(spark)).collect()}
    want = plain_roots(values)
    groups_want, groups_got = {}, {}
    for s, v in by_signed.items():
        groups_want.setdefault(want[v], set()).add(s)
        groups_got.setdefault(got[s], set()).add(s)
    assert sorted(map(sorted, groups_got.values())) == sorted(map(sorted, groups_want.values()))
    assert all(root == min(g) for root, g in groups_got.items())


@pytest.mark.parametrize("count", [2, 3, 8])
def test_any_cut_gives_the_same_classes(spark, monkeypatch, count):
    rng = random.Random(count)
    base = [rng.getrandbits(64) for _ in range(6)]
    values = sorted({signed(b ^ sum(1 << i for i in rng.sample(range(64), rng.randint(0, 4)))) for b in base for _ in range(8)})
    df = spark.createDataFrame([(v,) for v in values], "fp long")
    want = sorted(map(tuple, simhash.classes(df, Shelf(spark)).collect()))
    monkeypatch.setattr(simhash, "segments_for", lambda n, most_bits: simhash.Segments(count, most_bits))
    assert sorted(map(tuple, simhash.classes(df, Shelf(spark)).collect())) == want


def test_components(spark):
    rng = random.Random(3)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(i, i + 1) for i in range(1000, 1060)] + [(5000, 5000 + i) for i in range(40)]
    df = spark.createDataFrame(links, "a long, b long")
    root = {n: n for pair in links for n in pair if pair[0] != pair[1]}
    for _ in range(400):
        for a, b in links:
            if a != b:
                root[a] = root[b] = min(root[a], root[b])
    assert {r.node: r.root for r in components(df, Shelf(spark)).collect()} == root
    assert components(df.limit(0), Shelf(spark)).count() == 0


def test_documents(spark, make_docs, odd_docs, no_docs):
    rng = random.Random(1)
    words = [f"w{i}" for i in range(500)]
    long = [" ".join(rng.choices(words, k=200)) for _ in range(8)]
    near = [t.replace(t.split()[50], "changed", 1) for t in long for _ in range(2)]
    docs = make_docs([*long, *near, *long[:3], None, "", "a", "a"])
    rows = docs.collect()
    fps = {r.doc_id: plain_fingerprint(r.text) for r in rows}
    roots = plain_roots(set(fps.values()))
    least = {}
    for i, f in fps.items():
        least[roots[f]] = min(least.get(roots[f], i), i)
    got = {r.doc_id: r for r in simhash.near_duplicates(docs).collect()}
    assert {i: (r.fingerprint, r.component_id) for i, r in got.items()} == {i: (f"{f:016x}", least[roots[f]]) for i, f in fps.items()}
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(least.values()))

    assert simhash.near_duplicates(odd_docs).count() == odd_docs.count()
    one = simhash.one_of_each(odd_docs)
    groups = simhash.near_duplicates(odd_docs).select("component_id").distinct().count()
    assert one.columns == odd_docs.columns and one.count() == groups
    assert simhash.near_duplicates(no_docs).count() == 0 and simhash.one_of_each(no_docs).count() == 0


def test_repeated_rows_keep_one(make_docs):
    rows = [(7, "the very same row of text", "en", "a")] * 5 + [(7, "the very same row of text", "de", "b")] * 2
    assert simhash.one_of_each(make_docs(rows)).count() == 1
    none = [(None, "x y z", "en", "a"), (None, "x y z", "en", "a")]
    assert [r.component_id for r in simhash.near_duplicates(make_docs(none)).collect()] == [None, None]



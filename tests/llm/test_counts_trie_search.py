"""Token counts, the prefix trie and ranked search against the library and against loops."""

import collections
import functools
import hashlib
import math
import random
import re
import zlib

import public_tokenizers
import pytest
import sentencepiece

from tidemark.llm import prefix_trie, queries, ranked_search, token_counts
from tidemark.llm.common import Shelf

FOLDER = "/root/testdata/sf0.001"


# --- token counts

@pytest.fixture(scope="module")
def model():
    return token_counts.read_model(public_tokenizers.path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def library(model):
    return sentencepiece.SentencePieceProcessor(model_proto=model)


@pytest.mark.parametrize("chunk, overlap", [(64, 4), (50, 49), (2, 1), (1000, 30)])
def test_spliced_counts_like_the_library(model, library, chunk, overlap):
    rng = random.Random(1)
    texts = [
        "z" * 6000, "ab " * 2000, " " * 5000, "漢字😀" * 900, "▁" * 333 + " x" * 500, "\x00" * 700, "<s></s><unk>" * 300, "á" * 800,
        " lead " + "q" * 3000 + " tail", "end " * 40 + "z" * 500, "",
    ] + ["".join(rng.choices("ab \n▁é漢😀zs<>", k=rng.randint(0, 3000))) for _ in range(20)]
    counter = token_counts.Counter(model)
    assert counter.counts(texts, chunk, overlap) == [len(x) for x in library.encode(texts)]


def test_overlaps_widen_where_nothing_is_stable(model, library):
    counter, seen = token_counts.Counter(model), []
    counter._seam = lambda *a, own=counter._seam: seen.append(own(*a)) or seen[-1]
    text = "word " * 30 + "z" * 2000 + " word" * 3000
    assert counter.spliced(text, 100, 8) == len(library.encode(text))
    # Some overlaps hold no boundary, and splicing goes on after them.
    assert 0 in seen and seen[-1]


def test_models_that_cannot_be_spliced_are_refused(model):
    from sentencepiece import sentencepiece_model_pb2 as kinds

    spec = kinds.ModelProto.FromString(model)
    spec.normalizer_spec.remove_extra_whitespaces = True
    with pytest.raises(ValueError):
        token_counts.Counter(spec.SerializeToString())


def test_token_count_query(spark, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    got = queries.op11_token_counts(spark, FOLDER).collect()
    assert len(got) == len(texts)
    for r in got:
        n = len(library.encode(texts[r.doc_id] or ""))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len((texts[r.doc_id] or "").encode()), n, n > 4096)


def test_token_counts_of_odd_input(odd_docs, no_docs, model, library):
    got = token_counts.count_tokens(odd_docs, model, chunk=500, overlap=20, keep=("doc_id", "FP", "text")).collect()
    assert len(got) == odd_docs.count()
    for r in got:
        assert (r.n_bytes, r.n_tokens) == (len((r.text or "").encode()), len(library.encode(r.text or "")))
    assert token_counts.count_tokens(no_docs, model).collect() == []


# --- prefix trie

def plain_trie(rows):
    own = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    members, ends, children = collections.defaultdict(list), collections.defaultdict(list), collections.defaultdict(list)
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        s = own.get(c - c % 100, [])[:h] + own[c][h:]
        for d in range(len(s) + 1):
            members[tuple(s[:d])].append(c)
        ends[tuple(s)].append(c)
    for p in members:
        if p:
            children[p[:-1]].append(p)

    @functools.cache
    def below(p):
        parts = [below(k) for k in children[p]]
        mine = (len(members[p]) - 1) * len(p[-1][1]) if p else 0
        return sum(x for x, _ in parts) or 1, sum(y for _, y in parts) + mine

    return sorted(
        (min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children[p]), *below(p),
         hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest())
        for p, m in members.items()
    )


def trie_of(spark, rows, block=prefix_trie.BLOCK):
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    return sorted(map(tuple, prefix_trie.trie(prefix_trie.rebuilt(prefix_trie.sequences(turns), Shelf(spark)), block).collect()))


@pytest.mark.parametrize("n, block", [(300, 7), (200, 1), (120, 100_000), (40, 3)])
def test_trie_against_loops(spark, n, block):
    rng = random.Random(n)
    rows = [
        (c, None if t == 0 and rng.random() < 0.1 else t, rng.choice(["u", "a", None]), rng.choice(["x", "yy", "é", None]) if rng.random() < 0.5 else "x")
        for c in rng.sample(range(600), n) for t in range(rng.randint(1, 7))
    ]
    assert trie_of(spark, rows, block) == plain_trie(rows)


@pytest.mark.parametrize("block", [50, 100_000])
def test_trie_with_copies_and_a_long_conversation(spark, block):
    # Copies of one conversation, prefixes of each other, and one conversation far longer than the others.
    rows = [(c, t, "u", f"t{t}") for c in range(300, 500) for t in range(3)]
    rows += [(c, t, "u", f"t{t}") for c in range(50) for t in range(c % 9 + 1)] + [(77, t, "a", "again") for t in range(900)]
    assert trie_of(spark, rows, block) == plain_trie(rows)


def test_trie_of_odd_input(spark):
    # Without an id there is no conversation; repeated rows are turns; a conversation may lose all its turns.
    rows = [(None, 1, "u", "x"), (5, None, None, None), (5, None, None, None), (205, 3, "u", "z" * 50_000), (100, 1, "u", "")]
    assert trie_of(spark, rows) == plain_trie(rows)
    assert trie_of(spark, []) == []
    clash = spark.createDataFrame([(1, 2, "u", "x", 7, 8)], "conv_id long, turn long, role string, text string, id long, seq long")
    assert prefix_trie.trie(prefix_trie.sequences(clash)).count() == 2


# --- ranked search

def plain_terms(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def plain_ranking(docs, items, top=10):
    bags = [(i, words, collections.Counter(words)) for i, words in ((i, plain_terms(t)) for i, t in docs) if words]
    n_docs, length = len(bags), sum(len(w) for _, w, _ in bags)
    df = collections.Counter(term for _, _, c in bags for term in c)
    queries_ = collections.defaultdict(set)
    for i, t in items:
        queries_[i].update(plain_terms(t))
    out = []
    for item, terms in queries_.items():
        found = []
        for i, words, c in bags:
            m = 10 + 90 * len(words) * n_docs // length
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
                for t in terms if c[t]
            )
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        found.sort(key=lambda x: x[:3])
        out += [(item, r, i, -s) for r, (s, _, _, i) in enumerate(found[:top], 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("block_terms", [ranked_search.BLOCK_TERMS, 3])
def test_ranking_against_loops(spark, block_terms):
    rng = random.Random(5)
    words = ["a", "B", "c1", "é", "dd", "漢", "x9", "q", "zz", "w"]
    docs = [(i, " ".join(rng.choices(words, k=rng.randint(0, 6)))) for i in range(300)]
    # Groups of copies, repeated ids, no id, no text, no term.
    docs += [(1000 - i, "copy of q") for i in range(40)] + [(None, "a b"), (None, None), (7, "a b"), (7, "a b"), (900, "?!")]
    items = [(i, ", ".join(rng.choices(words, k=rng.randint(0, 3)))) for i in range(9)]
    items += [(3, "zz"), (None, "q w"), (50, None), (51, "nothere"), (52, "copy")]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(6)
    i = spark.createDataFrame(items, "item_id long, text string")
    got = ranked_search.search(d, i, block_terms=block_terms)
    assert sorted(map(tuple, got.collect()), key=str) == plain_ranking(docs, items)


def test_equal_hashes_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(ranked_search.F, "xxhash64", lambda *c: ranked_search.F.lit(1).cast("long"))
    docs, items = [(i, "ab " * (i % 4 + 1) + "cd") for i in range(40)], [(0, "ab"), (1, "ab cd")]
    got = ranked_search.search(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(map(tuple, got.collect()), key=str) == plain_ranking(docs, items)


def test_ranking_of_odd_input(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, "same a ab"), (2, "zzz É")], "item_id long, text string")
    want = plain_ranking([(r.doc_id, r.text) for r in odd_docs.collect()], [(1, "same a ab"), (2, "zzz É")])
    assert sorted(map(tuple, ranked_search.search(odd_docs, items).collect()), key=str) == want
    assert ranked_search.search(no_docs, items).collect() == []
    assert ranked_search.search(odd_docs, items.limit(0)).collect() == []

"""Decontamination, tokens, quality, ring, WARC, language and toxicity against brute force, round trips and held-out rows."""

import base64
import collections
import hashlib
import html.parser
import json
import math
import random
import re
import time
import uuid
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F

from tidemark.llm import bpe, decontamination, deobfuscation, divergence, queries, ring, string_kernel, warc

FOLDER = "/root/testdata/sf0.001"
LARGER = "/root/testdata/sf0.01"
LARGEST = "/root/testdata/sf0.1"


# --- decontamination

def plain_words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def plain_hits(text, items):
    words, hit, ids = plain_words(text), set(), set()
    for item, t in items:
        own = plain_words(t)
        k = min(13, len(own))
        windows = {tuple(own[i:i + k]) for i in range(len(own) - k + 1)} if k else set()
        for i in range(len(words) - k + 1) if k else ():
            if tuple(words[i:i + k]) in windows:
                hit.update(range(i, i + k))
                ids.add(str(item))
    return len(words), len(hit), sorted(ids)


@pytest.mark.parametrize("pass_chars", [10**9, 40])
def test_hits_against_loops(spark, make_docs, pass_chars):
    rng = random.Random(2)
    vocabulary = ["a", "b", "c1", "é", "D"]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(1, 18)))) for i in range(25)] + [(3, "a b"), (99, ""), (98, None), (97, "?!")]
    texts = [" ".join(rng.choices(vocabulary, k=rng.randint(0, 60))) for _ in range(60)] + [None, "", items[0][1] + "!" + items[1][1]]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: r for r in decontamination.search(make_docs(texts), benchmark, pass_chars=pass_chars).collect()}
    for i, t in enumerate(texts):
        n, hit, ids = plain_hits(t, items)
        assert (got[i].n_words, sum(h.end - h.start for h in got[i].hits), list(got[i]["items"])) == (n, hit, ids)


def test_decontamination_query(spark):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    for r in queries.op5_benchmark_decontamination(spark, FOLDER).collect():
        n, hit, ids = plain_hits(docs[r.doc_id], items)
        assert (r.n_words, r.n_hit, r.n_items) == (n, hit, len(ids))
        assert r.items_sha256 == hashlib.sha256(",".join(ids).encode()).hexdigest()
        assert r.contaminated == (hit > 0 and 20 * hit >= n)


def test_decontamination_odd_input(spark, odd_docs, no_docs):
    benchmark = spark.createDataFrame([(1, "a b c"), (None, "same text here")], "item_id long, text string")
    kept = decontamination.without_contaminated(odd_docs, benchmark)
    assert kept.columns == odd_docs.columns
    assert kept.count() == odd_docs.where("text IS NULL OR text != 'same text here'").count()
    assert decontamination.without_contaminated(odd_docs, benchmark.limit(0)).count() == odd_docs.count()
    assert decontamination.search(no_docs, benchmark).count() == 0


# --- tokens

@pytest.fixture(scope="module")
def ranks():
    return queries.ranks()


@pytest.fixture(scope="module")
def reference(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_perfect_hash(ranks):
    hashed = bpe.PerfectHash(list(ranks))
    slots = [hashed.slot(k) for k in ranks]
    assert sorted(slots) == list(range(len(ranks)))
    encoder = bpe.Encoder(ranks, public_tokenizers.PATTERN)
    assert all(encoder.whole(k) == v for k, v in list(ranks.items())[::50]) and encoder.whole(b"no such token here") == -1
    assert all(encoder.merged(k) == [v] for k, v in list(ranks.items())[::50])


def test_encoding_like_the_library(ranks, reference, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 50)
    encoder = bpe.Encoder(ranks, public_tokenizers.PATTERN)
    rng = random.Random(5)
    parts = ["a", "b", " ", "  ", "\n", "é", "日", "0", "1", "!", "😀", "\t", "’", "'s", "the", "\x00", "ß", "<|endoftext|>", " "]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 80))) for _ in range(400)] + ["a" * 5000 + "ab" * 5000, " " * 3000]
    for t in texts:
        ids = encoder.encode(t)
        assert ids == reference.encode_ordinary(t)
        assert encoder.decode(ids) == t.encode()


def test_memory_of_pre_tokens_is_bounded(ranks, reference, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 20_000)
    encoder, worked_out = bpe.Encoder(ranks, public_tokenizers.PATTERN), collections.Counter()
    encoder.piece_ids = lambda p, own=encoder.piece_ids: worked_out.update([p]) or own(p)
    for i in range(2_000):
        text = f"common words come in every text, zq{i}x rare{i * 7919}ones do not"
        assert encoder.encode(text) == reference.encode_ordinary(text)
        # Two full generations at most, and what one text adds.
        assert len(encoder._young) + len(encoder._old) < 2 * 20_000 / bpe._ENTRY + 40
    # Rare ones went through many times the memory; the common ones were worked out once.
    assert len(worked_out) > 2_000 and worked_out[" common"] == 0 and worked_out["common"] == worked_out[" every"] == 1


def test_token_query(spark, reference, odd_docs, no_docs, ranks):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    got = queries.op9_bpe_round_trip(spark, FOLDER).collect()
    assert len(got) == len(docs)
    for r in got:
        ids = reference.encode_ordinary(docs[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()
    odd = bpe.round_trip(odd_docs, ranks, public_tokenizers.PATTERN, keep=odd_docs.columns)
    assert all(bytes(r.decoded) == (r.text or "").encode() for r in odd.collect())
    assert bpe.round_trip(no_docs, ranks, public_tokenizers.PATTERN).count() == 0
    with pytest.raises(ValueError):
        bpe.Encoder({b"a": 0}, "a")


def test_rank_file(tmp_path):
    path = tmp_path / "r"
    path.write_bytes(base64.b64encode(b"ab") + b" 3\n\n")
    assert bpe.read_ranks(str(path)) == {b"ab": 3}


# --- quality

def plain_figures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = collections.Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    hit = {i + j for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for j in range(3)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(hit)


def js(p, q):
    p, q = [x / max(1, sum(p)) for x in p], [x / max(1, sum(q)) for x in q]
    total = 0.0
    for a, b in zip(p, q):
        m = (a + b) / 2
        total += (a * math.log2(a / m) if a else 0) + (b * math.log2(b / m) if b else 0)
    return math.sqrt(max(0, total / 2))


def test_figures_and_distances(spark, odd_docs, no_docs):
    docs = spark.read.parquet(f"{LARGER}/documents.parquet").unionByName(
        odd_docs.select("doc_id", "text", "lang", "source", "n_chars").where("doc_id IS NOT NULL").withColumn("doc_id", F.col("doc_id") + 10**6))
    refs = divergence.references(docs)
    rows = {r.doc_id: r for r in docs.collect()}
    words, classes = collections.defaultdict(collections.Counter), collections.defaultdict(lambda: np.zeros(9))
    for r in docs.collect():
        data = (r.text or "").encode()
        words[r.lang or ""].update(divergence.counted_words(data))
        classes[r.lang or ""] += divergence.character_histogram(data)
    for lang, ref in refs.items():
        top = sorted(words[lang].items(), key=lambda x: (-x[1], x[0]))[:divergence.COMMON_WORDS]
        assert [int(n) for n in ref.words[:-1]] == [n for _, n in top] and list(ref.place) == [w for w, _ in top]
        assert ref.words[-1] == sum(words[lang].values()) - sum(n for _, n in top)
        assert list(ref.classes) == list(classes[lang])
    for r in divergence.judge(docs, refs).collect():
        row = rows[r.doc_id]
        n, chars, symbols, dup, rep = plain_figures(row.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, dup, rep)
        assert r.base_failed == (n < 50 or 100 * rep > 50 * n)
        data, ref = (row.text or "").encode(), refs[row.lang or ""]
        own, hist = divergence.character_histogram(data), [0] * len(ref.words)
        for w in divergence.counted_words(data):
            hist[ref.place.get(w, -1)] += 1
        assert r.char_js == pytest.approx(js(own, ref.classes)) and r.word_js == pytest.approx(js(hist, ref.words))
        assert r.kept == (not r.base_failed and divergence.verdict(r.char_js, r.word_js, int(own.sum()), sum(hist)))
    assert divergence.judge(no_docs, divergence.references(no_docs)).count() == 0


def test_common_words_of_a_language_spread_thinly(spark):
    """Many different words in every task, over and under what a task holds; a second language with one text in each."""
    thin = [f"w{i}" for i in range(divergence.COMMON_WORDS + 30)]
    rows = [[(" ".join(f"t{task}x{i}" for i in range(n)) + " often", "en"), (" ".join(thin[: len(thin) - task]), "xx")]
            for task, n in enumerate((21_000, 21_000, 30_000, 210_000))]
    docs = spark.createDataFrame(spark.sparkContext.parallelize([r for part in rows for r in part], 4), "text string, lang string")
    assert docs.rdd.getNumPartitions() == 4
    refs = divergence.references(docs)
    counts = collections.Counter(w.encode() for part in rows for w in part[1][0].split())
    top = sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:divergence.COMMON_WORDS]
    assert list(refs["xx"].place) == [w for w, _ in top] and list(refs["xx"].words[:-1]) == [n for _, n in top]
    assert refs["xx"].words[-1] == sum(counts.values()) - sum(n for _, n in top)
    assert next(iter(refs["en"].place)) == b"often" and refs["en"].words[0] == 4 and refs["en"].words.sum() == 282_004
    again = divergence.references(docs.repartition(1))
    assert all(list(again[k].place) == list(refs[k].place) and list(again[k].words) == list(refs[k].words) for k in refs)


def test_languages_without_a_reference_and_more_than_fit(spark, make_docs, monkeypatch):
    words = ["der", "die", "und", "the", "of", "le", "la", "uno"]
    rows = [(i, " ".join(words[(i + k * k) % (3 + i % 5)] for k in range(80)), f"l{i % 7}", "s") for i in range(140)] + [(999, "x y z " * 30, None, "s")]
    docs = make_docs(rows)
    want = sorted(map(str, divergence.judge_documents(docs).collect()))
    monkeypatch.setattr(divergence, "LANGUAGES", 3)
    assert sorted(map(str, divergence.judge_documents(docs).collect())) == want
    monkeypatch.undo()
    # A language that the references do not know is held against all of them together, and none at all is no fault.
    refs = divergence.references(docs.where("lang != 'l0'"))
    got = divergence.judge(docs.where("lang = 'l0'"), refs).collect()
    whole = divergence.pooled(refs)
    for r in got:
        d = whole.distances(rows[r.doc_id][1].encode())
        assert (r.char_js, r.word_js) == (d[0], d[1])
    assert len(got) == 20 and sum(whole.classes) == sum(sum(x.classes) for x in refs.values())
    assert all((r.char_js, r.word_js, r.kept) == (0.0, 0.0, not r.base_failed) for r in divergence.judge(docs, {}).collect())


def test_clean_documents_are_kept(spark):
    labels = spark.read.parquet(f"{LARGER}/labels.parquet")
    got = queries.op4_quality_divergence(spark, LARGER).where("NOT base_failed").join(labels, "doc_id").collect()
    good = [r.kept for r in got if r.quality == 1]
    bad = [r.kept for r in got if r.quality == 0]
    assert sum(good) >= 0.99 * len(good) and sum(bad) <= 0.6 * len(bad)


# --- ring

def check_shards(rows, n, shards):
    counts = collections.Counter(r.shard for r in rows)
    assert len(rows) == n and all(0 <= s < shards for s in counts)
    if n >= shards:
        assert max(counts.values()) - min(counts.get(s, 0) for s in range(shards)) <= 1
    for s in counts:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(counts[s]))


@pytest.mark.parametrize("group_rows", [100_000, 7])
def test_ring_against_walk(spark, group_rows):
    docs = spark.read.parquet(f"{LARGER}/documents.parquet").select("doc_id", "text")
    rows = ring.assign(docs, group_rows=group_rows).collect()
    check_shards(rows, docs.count(), ring.SHARDS)
    texts = {r.doc_id: r.text for r in docs.collect()}
    nodes = ring.ring(spark, ring.SHARDS)
    placed = {r.doc_id: r.p for r in docs.select("doc_id", ring._place(F.col("doc_id")).alias("p")).collect()}
    counts = collections.Counter(r.shard for r in rows)
    for r in rows:
        data = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32) == (len(data) + 1, zlib.crc32(data))
        # Walk clockwise from the key's place; only full shards may have been passed.
        after = [s for p, s in nodes if p >= placed[r.doc_id]] + [s for p, s in nodes if p < placed[r.doc_id]]
        order = list(dict.fromkeys(after))
        assert r.home_shard == order[0] and order[r.hops] == r.shard
        assert all(counts[s] == len(texts) // 16 + (s < len(texts) % 16) for s in order[:r.hops])


def test_ring_moves_little_with_slack(spark):
    docs = spark.read.parquet(f"{LARGER}/documents.parquet").select("doc_id", "text")
    before = {r.doc_id: r.shard for r in ring.assign(docs, slack=0.25).collect()}
    after = {r.doc_id: r.shard for r in ring.assign(docs, slack=0.25, shards=17).collect()}
    assert max(collections.Counter(before.values()).values()) <= math.ceil(1.25 * len(before) / 16)
    assert sum(before[i] != after[i] for i in before) < 0.3 * len(before)


def test_ring_odd_input(spark, odd_docs, no_docs, make_docs):
    check_shards(ring.assign(odd_docs).collect(), odd_docs.count(), 16)
    same = make_docs([(5, "same", "en", "s")] * 100 + [(None, None, None, None)] * 50)
    check_shards(ring.assign(same, group_rows=3).collect(), 150, 16)
    assert ring.assign(no_docs).count() == 0
    got = queries.op7_bounded_ring(spark, FOLDER)
    assert {"doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"} <= set(got.columns)


# --- WARC

def test_page_text():
    page = ('<!DOCTYPE html><html><head><title>A &amp; B</title><style>p{x}</style><script>var t="<p>no</p>";</script></head>'
            '<body><!-- <p>hidden</p> --><p>One  two<br>three</p><ul><li><a href="/x?a=1&amp;b=2">li&nbsp;nk</a></li></ul><b>bo</b>ld &#233;')
    assert warc.page_text(page) == "A & B\nOne two\nthree\nli nk\nbold é"
    assert warc.page_title(page) == "A & B" and warc.page_links(page) == ["/x?a=1&b=2"]
    assert warc.page_text("text <script>never closed <p>x") == "text" and warc.page_text("a < b <!-- open") == "a < b"
    assert warc.page_text("") == "" and warc.page_links("") == []
    assert warc.headers_of("HTTP/1.1 200 OK\r\nA: 1\r\nA: 2\r\nbad") == {"status": "HTTP/1.1 200 OK", "fields": {"A": "1, 2"}}


class PlainPage(html.parser.HTMLParser):
    """A page read by the standard library's parser."""

    BREAKS = set(
        "address article aside blockquote br dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr "
        "li main nav ol option p pre section table tbody td tfoot th thead title tr ul".split()
    )

    def __init__(self, page):
        super().__init__(convert_charrefs=True)
        self.out, self.title, self.links, self.hidden, self.in_title = [], [], [], None, False
        self.feed(page)
        self.close()

    def handle_starttag(self, tag, attrs):
        if self.hidden:
            return
        if tag in ("script", "style", "template", "noscript"):
            self.hidden = tag
            self.out.append(" ")
        self.in_title |= tag == "title"
        self.out.append("\n" if tag in self.BREAKS else "")
        self.links += [v.strip() for k, v in attrs if tag == "a" and k == "href"]

    def handle_endtag(self, tag):
        if tag == self.hidden:
            self.hidden = None
        elif not self.hidden:
            self.in_title &= tag != "title"
            self.out.append("\n" if tag in self.BREAKS else "")

    def handle_data(self, data):
        if not self.hidden:
            self.out.append(data)
            self.title += [data] if self.in_title else []

    def handle_comment(self, data):
        self.out.append(" ")

    def text(self):
        lines = (re.sub(r"[ \t\r\f\v\xa0]+", " ", x).strip() for x in "".join(self.out).split("\n"))
        return "\n".join(x for x in lines if x)


def test_derivatives_against_the_standard_parser(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{LARGER}/pages.parquet").collect()}
    rows = queries.op6_warc_derivatives(spark, LARGER).collect()
    assert len(rows) == 2 * len(pages)
    for r in rows:
        page = PlainPage(pages[r.page_id].html)
        source = f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, chr(10).join(['response', pages[r.page_id].url, warc.DATE, r.source_digest]))}>"
        assert r.refers_to == source and r.record_id == f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, r.record_type + chr(10) + source)}>"
        if r.record_type == "conversion":
            assert r.block == page.text()
        else:
            about = json.loads(r.block)
            assert (about["title"], about["links"]) == (" ".join("".join(page.title).split()), page.links)
            assert about["http"]["fields"] == {"Content-Type": "text/html; charset=utf-8"} and about["refers-to"] == source


@pytest.mark.parametrize("part", ["<a ", "<script ", "<title>", '<a href="', "<!--", "<script>", "<a href href ", "</script ", "<a href='x' ", "<", "<a><b"])
def test_broken_pages_take_linear_time(part):
    page = part * (1_000_000 // len(part))
    start = time.process_time()
    warc.read_page(page)
    assert time.process_time() - start < 5


def test_derivatives(spark, tmp_path):
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet")
    source = {r.page_id: r for r in pages.collect()}
    responses = {r.page_id: r for r in warc.as_responses(pages).collect()}
    records = warc.derive(warc.as_responses(pages))
    rows = records.collect()
    assert collections.Counter(r.record_type for r in rows) == {"metadata": len(source), "conversion": len(source)}
    assert len({r.record_id for r in rows}) == len(rows)
    for r in rows:
        page, response = source[r.page_id], responses[r.page_id]
        assert (r.refers_to, r.target_uri) == (response.record_id, page.url)
        assert r.source_digest == response.payload_digest == "sha1:" + base64.b32encode(hashlib.sha1(page.html.encode()).digest()).decode()
        assert r.block_digest == warc.digest(r.block.encode()) and r.content_length == len(r.block.encode())
        if r.record_type == "conversion":
            assert r.block == warc.page_text(page.html) and "<p>" not in r.block
        else:
            assert "text/html" in r.block and r.refers_to in r.block
    warc.write_records(records.where("page_id < 5"), str(tmp_path / "out"))
    raw = b"".join(p.read_bytes() for p in sorted((tmp_path / "out").glob("part-*")))
    found = 0
    while raw:
        head, _, rest = raw.partition(b"\r\n\r\n")
        length = int(re.search(rb"Content-Length: (\d+)", head).group(1))
        assert head.startswith(b"WARC/1.1\r\n") and rest[length:length + 4] == b"\r\n\r\n"
        raw, found = rest[length + 4:], found + 1
    assert found == 10


def test_warc_odd_input(spark):
    pages = spark.createDataFrame([(None, None, None, 1), (1, "u", "", 2), (1, "u", "", 2)], "page_id long, url string, html string, block int")
    rows = warc.derive(warc.as_responses(pages)).collect()
    assert len(rows) == 6 and all(r.block == "" for r in rows if r.record_type == "conversion")
    assert warc.derive(warc.as_responses(pages.limit(0))).count() == 0


# --- language

def test_language_held_out(spark):
    docs = spark.read.parquet(f"{LARGER}/documents.parquet").select("doc_id", "lang")
    got = queries.op8_language_identification(spark, LARGER).join(docs, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    held = [r.lang == r.lang_pred for r in got if r.held_out]
    assert sum(held) >= 0.97 * len(held) and all(0 <= r.score <= 1 for r in got)


def test_kernel_by_sets():
    texts = ["hello world", "hallo Welt", "ciao", "Hello, WORLD"]
    sets = [string_kernel.grams(t) for t in texts]
    plain = []
    for t in texts:
        s = " " + " ".join(re.findall(r"[^\W\d_]+", t.lower())) + " "
        plain.append({s[i:i + n] for n in (1, 2, 3) for i in range(len(s) - n + 1)})
    assert [len(s) for s in sets] == [len(p) for p in plain]
    model = string_kernel.learn(texts[:3], ["en", "de", "it"], landmarks=1)
    kernel = model.kernel(sets)
    for i, p in enumerate(plain):
        for j, name in enumerate(model.languages):
            other = plain[["en", "de", "it"].index(name)]
            assert kernel[i, j] == pytest.approx(len(p & other) / math.sqrt(len(p) * len(other)), rel=1e-5)
    assert [x for x, _ in model.predict(texts)] == ["en", "de", "it", "en"]


def plain_languages(rows):
    """(id, text, lang) to {id: (language, score)} by sets of n-grams and the primal normal equations."""
    def spectrum(text):
        words = re.findall(r"[^\W\d_]+", text.lower())
        joined = f" {' '.join(words)} "
        return {joined[i:i + n] for n in (1, 2, 3) for i in range(len(joined) - n + 1)} if words else set()

    def kernel(a, b):
        return len(a & b) / math.sqrt(len(a) * len(b)) if a else 0.0

    seen = {(lang, text) for i, text, lang in rows if text and zlib.crc32(str(i).encode()) % 3 != 1}
    def place(text):
        return xxhash.xxh64_intdigest(text.encode(), 42) % (1 << 30)
    sample = sorted((lang, place(text), text) for lang, text in seen if spectrum(text))
    names = sorted({lang for lang, _, _ in sample})
    assert all(len([1 for lang, _, _ in sample if lang == name]) <= string_kernel.SAMPLE for name in names)
    marks = [x for name in names for x in [x for x in sample if x[0] == name][:string_kernel.LANDMARKS]]
    marks = [spectrum(text) for _, _, text in marks]
    among = np.array([[kernel(a, b) for b in marks] for a in marks])
    values, vectors = np.linalg.eigh(among)
    good = values > 1e-8 * values.max()
    project = vectors[:, good] / np.sqrt(values[good])
    sets = [spectrum(text) for _, _, text in sample]
    features = np.array([[kernel(s, m) for m in marks] for s in sets]) @ project
    coefficients = []
    for name in names:
        weight = np.array([1 / sum(y == lang for y, _, _ in sample) / len(names) for lang, _, _ in sample])
        left = features.T @ (weight[:, None] * features) + 1e-2 / len(sample) * np.eye(features.shape[1])
        coefficients.append(project @ np.linalg.solve(left, features.T @ (weight * [lang == name for lang, _, _ in sample])))
    out = {}
    for i, text, _ in rows:
        own = spectrum(text or "")
        values = np.array([kernel(own, m) for m in marks]) @ np.array(coefficients).T
        out[i] = (names[values.argmax()], min(1.0, max(0.0, values.max()))) if own else ("und", 0.0)
    return out


def test_languages_against_plain_form(spark):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text", "lang").collect()
    want = plain_languages([tuple(r) for r in rows if r.lang is not None])
    got = {r.doc_id: r for r in queries.op8_language_identification(spark, FOLDER).collect() if r.doc_id in want}
    assert len(got) == len(want) > 100
    for i, (name, score) in want.items():
        assert got[i].lang_pred == name and got[i].score == pytest.approx(score, abs=2e-3)


def test_many_languages_and_long_texts_are_learnt(spark):
    """More languages than any bound on classes, one of them with long texts only, another held by most rows."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    codes = [letters[k // 26 % 26] + letters[k % 26] for k in range(150)]
    rows = [(f"{k}-{j}", f"{code}q{code}x {code}{code} " * (j + 1), code) for k, code in enumerate(codes) for j in range(12)]
    rows += [(f"long-{j}", "ölü büyük " * 3_000 + "güneş" * j, "long") for j in range(8)]
    rows += [(f"copy-{j}", "the same copied line", "copies") for j in range(4_000)]
    docs = spark.createDataFrame(rows, "doc_id string, text string, lang string").repartition(4)
    model = string_kernel.fit(docs)
    assert set(model.languages) == {*codes, "long", "copies"} and len(model.norms) <= string_kernel.ALL_LANDMARKS
    asked = ["ölü büyük güneş", "the same copied line", *[f"{c}q{c}x {c}{c}" for c in codes]]
    assert [name for name, _ in model.predict(asked)] == ["long", "copies", *codes]


def test_language_odd_input(odd_docs, no_docs, make_docs):
    model = string_kernel.fit(odd_docs)
    got = string_kernel.identify(odd_docs, model, keep=["text"]).collect()
    assert all(r.lang_pred == "und" and r.score == 0 for r in got if not any(map(str.isalpha, r.text or "")))
    assert string_kernel.identify(no_docs, string_kernel.fit(no_docs)).count() == 0
    assert [r.lang_pred for r in string_kernel.identify(make_docs(["abc"]), string_kernel.fit(no_docs)).collect()] == ["und"]


# --- toxicity

def test_toxicity_held_out(spark):
    labels = spark.read.parquet(f"{LARGEST}/labels.parquet").select("doc_id", "toxic")
    got = queries.op10_toxicity(spark, LARGEST).join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.5) for r in got)
    pairs = [(a.score > b.score) + (a.score == b.score) / 2 for a in got if a.toxic and a.held_out for b in got if not b.toxic and b.held_out]
    assert sum(pairs) >= 0.97 * len(pairs)
    clean = [r.predicted for r in got if not r.toxic]
    assert sum(clean) <= 0.01 * len(clean)


def plain_toxicity(docs, labels):
    """Scores by id: trigrams in a dictionary, the chi-square statistic of the two-by-two table, a dense logistic model.

    Only the Viterbi decoder, which has a test of its own, is the operator's.
    """
    counts = np.zeros(deobfuscation.CLASSES**3, np.int64)
    for text in docs.values():
        kinds = [0, 0, *[deobfuscation.class_of(c) for c in text or ""], 0]
        for a, b, c in zip(kinds, kinds[1:], kinds[2:]):
            counts[(a * deobfuscation.CLASSES + b) * deobfuscation.CLASSES + c] += 1
    decoder = deobfuscation.Decoder(counts)

    def features(text):
        out = set()
        for word in re.findall(r"[^\W\d_]+", decoder.restore(text or "").lower()):
            out |= {"=" + word} | {f"^{word}$"[i:i + n] for n in (4, 5) for i in range(len(word) + 3 - n)}
        return out

    own = {i: features(t) for i, t in docs.items()}
    learnt = sorted((i, y) for i, y in labels.items() if y in (0, 1) and i in docs and zlib.crc32(str(i).encode()) % 5 != 0)
    assert all(len(docs[i] or "") <= deobfuscation.SAMPLE_CHARS for i, _ in learnt) and len(learnt) <= deobfuscation.SAMPLE
    held = [collections.Counter(f for i, y in learnt if y == k for f in own[i]) for k in (0, 1)]
    n = [sum(y == k for _, y in learnt) for k in (0, 1)]
    strength = {}
    for f, a in held[1].items():
        b = held[0][f]
        c, d = n[1] - a, n[0] - b
        if a >= 2 and a + b >= deobfuscation.LEAST_ROWS and a * n[0] > b * n[1]:
            strength[f] = sum(n) * (a * d - b * c) ** 2 / ((a + b) * max(c + d, 1e-9) * n[0] * n[1])
    chosen = [f for f in strength if strength[f] >= deobfuscation.LEAST_CHI_SQUARE]
    assert 0 < len(chosen) <= deobfuscation.FEATURES
    x = np.array([[f in own[i] for f in chosen] for i, _ in learnt], float)
    y = np.array([k for _, k in learnt], float)
    weight = np.where(y > 0, len(y) / (2 * n[1]), len(y) / (2 * n[0]))
    w, b, gw, gb = np.zeros(len(chosen)), 0.0, np.full(len(chosen), 1e-8), 1e-8
    for _ in range(400):
        g = weight * (1 / (1 + np.exp(-(x @ w + b))) - y) / len(y)
        dw, db = x.T @ g + 1e-4 * w, g.sum()
        gw, gb = gw + dw**2, gb + db**2
        w, b = w - 0.3 * dw / np.sqrt(gw), b - 0.3 * db / np.sqrt(gb)
    weights = dict(zip(chosen, w))
    return {i: 1 / (1 + math.exp(-b - sum(v for f, v in weights.items() if f in own[i]))) for i in docs}


def test_toxicity_against_plain_form(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{LARGER}/documents.parquet").select("doc_id", "text").collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{LARGER}/labels.parquet").select("doc_id", "toxic").collect()}
    want = plain_toxicity(docs, labels)
    got = queries.op10_toxicity(spark, LARGER).collect()
    assert len(got) == len(want) == len(docs) > 500
    for r in got:
        assert r.score == pytest.approx(want[r.doc_id], abs=1e-5) and r.predicted == int(r.score >= 0.5)


def test_viterbi_finds_the_best_path():
    texts = ["the idiot is a moron and the loser is stupid", "a stupid idiot was the scum of trash and of the clown"] * 20
    decoder = deobfuscation.Decoder(deobfuscation.count_trigrams(texts))

    def best(noisy):
        def paths(parts):
            if not parts:
                yield "", 0.0
                return
            for letters, cost in parts[0]:
                for rest, more in paths(parts[1:]):
                    yield letters + rest, cost + more

        def total(text, cost):
            a = b = 0
            for ch in text:
                c = deobfuscation.class_of(ch)
                cost += decoder.table[a][b][c]
                a, b = b, c
            return cost + decoder.table[a][b][0]

        return max(total(t, c) for t, c in paths(decoder.lattice(noisy))), total

    for noisy in ("1d10t", "m0r0n", "st.u.p!d", "l o s e r", "scuuum", "tr@sh", "c1own", "$cum"):
        value, total = best(noisy)
        decoded = decoder.decode(noisy)
        costs = [0.0]
        for choices in decoder.lattice(noisy):
            costs = [c + cost for c in costs for _, cost in choices]
        assert any(abs(total(decoded, c) - value) < 1e-9 for c in costs), noisy
    assert decoder.restore("the 1d10t and a s t u p i d m0r0n") == "the idiot and a stupid moron"


def test_noise_of_any_shape_is_restored(spark):
    texts = [r.text or "" for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("text").collect()]
    texts += ["the idiot is a moron", "garbage and scum of an idiot", "a stupid idiot"] * 300
    decoder = deobfuscation.Decoder(deobfuscation.count_trigrams(texts))
    noisy = {
        "id" + "i" * 50 + "ot": "idiot", "idio7": "idiot", "garbag3": "garbage", "1d107": "idiot", "i d ! o t": "idiot", "$ c u m": "scum",
        "i/d/i/o/t": "idiot", "i   d   i   o   t": "idiot", "i\nd\ni\no\nt": "idiot", "1-d-!-0-t": "idiot", "i . . d / i,o - t": "idiot",
    }
    for text, wanted in noisy.items():
        assert decoder.restore(f"the {text} is").split() == ["the", wanted, "is"], text
    chain = "/".join(["m0r0n"] * 12)
    assert set(decoder.restore(chain).replace("/", " ").split()) == {"moron"}
    for text in ("the idiot! is", "the garbage! and", "moron2 is", "a 2024 b", "1 2 3 and 5 + 3", "the 10107 is"):
        assert decoder.restore(text) == text, text


def test_repeated_labels_count_once(spark, make_docs):
    docs = make_docs([(i, f"you are {'an idiot and scum' if i % 3 == 0 else 'kind and clever'} today {i}", "en", "s") for i in range(400)])
    labels = [(i, 0, int(i % 3 == 0)) for i in range(400)]
    kind = "doc_id long, quality int, toxic int"
    once = deobfuscation.fit(docs, spark.createDataFrame(labels, kind))
    # The id that is picked first, as often as many samples hold.
    first = next(r.id for r in spark.range(400).where(F.crc32(F.col("id").cast("string").cast("binary")) % 5 != 0).orderBy(F.xxhash64("id")).collect())
    many = deobfuscation.fit(docs, spark.createDataFrame(labels + [labels[first]] * 5 * deobfuscation.SAMPLE, kind))
    assert once.weights and many.weights == once.weights and many.bias == once.bias


def test_toxicity_odd_input(spark, odd_docs, no_docs, make_docs):
    labels = spark.createDataFrame([(0, None), (None, 1), (1, 1), (2, 0), (2, 0)], "doc_id long, toxic int")
    kept = deobfuscation.without_toxic(odd_docs, labels)
    assert kept.columns == odd_docs.columns and kept.count() <= odd_docs.count()
    model = deobfuscation.fit(no_docs, labels.limit(0))
    assert [r.score for r in deobfuscation.score(make_docs(["a", None]), model).collect()] == [0.0, 0.0]
    assert deobfuscation.without_toxic(no_docs, labels).count() == 0

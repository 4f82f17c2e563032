"""Every stage of the corpus pipeline against a plain version of it, on what the stage before left."""

import hashlib

import public_tokenizers
import pytest
import tiktoken
from test_secrets_pii import pii_spans
from test_simhash import plain_fingerprint, plain_roots
from test_text_queries import plain_hits

import corpus_pipeline
from tidemark.llm import deobfuscation, queries

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Rows before the first stage and after each."""
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = [docs]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, out[-1], FOLDER).write.parquet(str(folder / str(i)))
        out.append(spark.read.parquet(str(folder / str(i))))
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_columns_and_names(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "personal_data", "tokens"]
    assert all(df.columns == stages[0].columns for df in stages[:-1])


def test_toxic_documents_go(spark, stages):
    model = deobfuscation.fit(stages[0], spark.read.parquet(f"{FOLDER}/labels.parquet"))
    assert texts(stages[1]) == {i: t for i, t in texts(stages[0]).items() if model.score(t) < 0.5}


def test_one_of_each_group_stays(stages):
    before = texts(stages[1])
    prints = {i: plain_fingerprint(t) for i, t in before.items()}
    roots, least = plain_roots(set(prints.values())), {}
    for i in sorted(before):
        least.setdefault(roots[prints[i]], i)
    assert texts(stages[2]) == {i: before[i] for i in least.values()}


def test_contaminated_documents_go(spark, stages):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    kept = {}
    for i, t in texts(stages[2]).items():
        n, hit, _ = plain_hits(t, items)
        if not (hit and 20 * hit >= n):
            kept[i] = t
    assert texts(stages[3]) == kept


def test_personal_data_is_replaced(stages):
    before, after = texts(stages[3]), texts(stages[4])
    assert set(before) == set(after)
    held = [i for i, t in before.items() if pii_spans(t)]
    assert held
    for i, t in before.items():
        if i not in held:
            assert after[i] == t
        else:
            assert all(value not in after[i] for *_, value in pii_spans(t))
    assert stages[4].where("n_chars != length(text)").count() == 0


def test_tokens_round_trip(stages):
    encoder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=queries.ranks(), special_tokens={})
    before = texts(stages[4])
    rows = stages[5].collect()
    assert sorted(r.doc_id for r in rows) == sorted(before)
    for r in rows:
        ids = encoder.encode_ordinary(before[r.doc_id])
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(before[r.doc_id].encode()).hexdigest()


def test_run_gives_the_last_stage(spark, stages):
    assert sorted(map(tuple, corpus_pipeline.run(spark, FOLDER).collect())) == sorted(map(tuple, stages[5].collect()))


def test_stages_take_odd_and_empty_tables(spark, odd_docs, no_docs):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd_docs, FOLDER).count() <= odd_docs.count()
        assert stage(spark, no_docs, FOLDER).count() == 0

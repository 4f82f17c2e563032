import pytest
from pyspark.sql import types as T

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from texts or from (doc_id, text, lang, source) rows."""

    def make(rows, extra=""):
        rows = [r if isinstance(r, tuple) else (i, r, "en", f"src{i % 3}") for i, r in enumerate(rows)]
        rows = [(*r[:4], len(r[1] or ""), *r[4:]) for r in rows]
        return spark.createDataFrame(rows, T._parse_datatype_string(DOCUMENTS + extra))

    return make


# Texts that every operator must take: null, empty, blank, odd characters, one very long word, very many short ones.
ODD_TEXTS = [
    None, "", "   \n\t ", "a", "ÀÉ ñ 漢字 😀   x\x00y", "z" * 60_000, "ab " * 20_000, "1" * 30_000, "a@" * 5_000, "+1 " * 5_000,
    "1.2.3.4." * 3_000, "\x01\x02\n\n\n", "same text here", "same text here",
]


@pytest.fixture(scope="session")
def odd_docs(make_docs):
    """Odd texts with null ids, languages and sources, repeated rows, and extra columns whose names clash."""
    rows = [(i, t, "en", "s1", 1, "x") for i, t in enumerate(ODD_TEXTS)]
    rows += [(None, "no id here", None, None, None, None), (None, None, None, None, None, None)]
    rows += [(3, "a", "en", "s1", 1, "x")] * 2
    return make_docs(rows, ", FP int, _text string")


@pytest.fixture(scope="session")
def no_docs(make_docs):
    return make_docs([])

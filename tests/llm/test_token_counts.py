"""Token counts against the library on whole texts."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from placewise.llm import token_counts
from tests.conftest import SF_DIR

PARTS = ["a", "B", "foo", "Bar", " ", "  ", "\n", "\t", "\xa0", "é", "é", "12", "'s", "'LL", "'", "!", "!!", "<|endoftext|>",
         "<|startoftext|>", "　", "日", "\x1c", "\r\n", "_", "\x85", "ß", "İ", "ı", "Σ", "ς", "ǅ", "½", "²", "ª", "µ", "#", "€", "́",
         "ẞ", "-", "]", "^", "\\", "\x00", "Å", "ſ", "ŉ", "<|", "|>"]


def library_counts(texts):
    made = token_counts.library(token_counts.default_path()).encode_batch([t or "" for t in texts], add_special_tokens=False)
    return [len(x.ids) for x in made]


@pytest.fixture(scope="module")
def proof():
    return token_counts.prove(token_counts.default_path())


def test_counts_match_library(odd, rows):
    got = token_counts.count_tokens(odd)
    expected = Counter((r[0], len((r[1] or "").encode()), n, n > 2048) for r, n in zip(rows, library_counts([r[1] for r in rows])))
    assert Counter(map(tuple, got.select("row.doc_id", "n_bytes", "n_tokens", "over_limit").collect())) == expected
    assert got.where("n_direct > n_tokens").count() == 0 and got.agg(F.sum("n_direct")).first()[0] > 0


def test_documents_match_library(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    got = {r[0]: r[1] for r in token_counts.count_tokens(docs, row=["doc_id"]).select("row.doc_id", "n_tokens").collect()}
    assert got == dict(zip((r[0] for r in rows), library_counts([r[1] for r in rows])))


def test_odd_texts_match_library(proof):
    rng = np.random.default_rng(0)
    texts = ["".join(rng.choice(PARTS, rng.integers(0, 25))) for _ in range(4000)]
    texts += [chr(c) + x + chr(c) for c in range(0x20, 0x500) for x in ("", "s", "9")]
    own = token_counts.Counter(proof, token_counts.default_path())
    assert own.count([t.encode() for t in texts])[0] == library_counts(texts)


def test_a_full_memory_changes_nothing(proof, monkeypatch):
    monkeypatch.setattr(token_counts, "MEMORY", 3)
    own, texts = token_counts.Counter(proof, token_counts.default_path()), ["one two three", "four five", "one six"] * 3
    assert [own.count([t.encode()])[0][0] for t in texts] == library_counts(texts)


def test_proven_strings_are_one_token(proof):
    some = sorted(proof.whole)[::7]
    assert len(some) > 3000 and library_counts(some) == [1] * len(some)


def test_limit_and_other_column(spark):
    docs = spark.createDataFrame([(1, "one two three"), (2, None)], "doc_id bigint, n_tokens string")
    got = token_counts.count_tokens(docs, text="n_tokens", row=["doc_id"], limit=2).orderBy("row.doc_id").collect()
    assert [(r.n_bytes, r.n_tokens, r.over_limit) for r in got] == [(13, 3, True), (0, 0, False)]


def test_empty_table(none):
    assert token_counts.count_tokens(none).count() == 0

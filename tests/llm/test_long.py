"""Texts longer than any chunk."""

import numpy as np
import public_tokenizers
import pytest

from sonalyze.llm import text as X
from sonalyze.llm.bytespans import dedup_bytes
from sonalyze.llm.contamination import find_passages
from sonalyze.llm.jaccard import similar_groups
from sonalyze.llm.langid import document_rows, identify, train
from sonalyze.llm.packing import pack
from sonalyze.llm.substrings import dedup_substrings
from sonalyze.llm.suffix_tree import score
from sonalyze.llm.tokenfile import read_ids, write_ids

PATH = public_tokenizers.path("byte_bpe_50k.json")
WORDS = [f"w{i * 7919 % 100_003}" for i in range(100_000)]
TEXT = " ".join(WORDS)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(1, TEXT, "en", "s"), (2, TEXT, "en", "s"), (3, "tail " + " ".join(WORDS[50_000:]), "en", "s"), (4, None, None, None), (5, "x" * 1_000_000, "en", "s")], "doc_id long, text string, lang string, source string").cache()


def test_words_and_bytes(docs):
    got = {r.doc_id: (r.n_words, r.n_removed) for r in dedup_substrings(docs).collect()}
    assert got == {1: (100_000, 0), 2: (100_000, 100_000), 3: (50_001, 50_000), 4: (0, 0), 5: (1, 0)}
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans) for r in dedup_bytes(docs).collect()}
    tail = len(" ".join(WORDS[50_000:]))
    # the space before the tail is also in the first text
    assert got == {1: (len(TEXT), 0, 0), 2: (len(TEXT), len(TEXT), 1), 3: (tail + 5, tail + 1, 1), 4: (0, 0, 0), 5: (1_000_000, 999_999, 1)}


def test_groups_passages_and_scores(spark, docs):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in similar_groups(docs).collect()}
    assert got == {1: (99_996, 1), 2: (99_996, 1), 3: (49_997, 3), 4: (0, 4), 5: (1, 5)}
    items = spark.createDataFrame([(9, " ".join(WORDS[70_000:70_040]))], "item_id long, text string")
    assert sorted((r.doc_id, r.start) for r in find_passages(docs, items).collect()) == [(1, 70_000), (2, 70_000), (3, 20_001)]
    assert {r.doc_id: r.n_tokens for r in score(docs).collect()} == {1: 100_001, 2: 100_001, 3: 50_002, 4: 1, 5: 2}
    assert {r.id: r.n_grams for r in identify(document_rows(docs), train(docs)).collect()}[4] == 0


def test_tokens(spark, docs, tmp_path):
    write_ids(docs, f"{tmp_path}/ids", PATH)
    sizes = {r.doc_id: r.n_tokens for r in read_ids(spark, f"{tmp_path}/ids").collect()}
    pieces = pack(docs, PATH).groupBy("doc_id").agg({"length": "sum", "doc_tokens": "max"}).collect()
    assert {r.doc_id: r["sum(length)"] for r in pieces} == sizes == {r.doc_id: r["max(doc_tokens)"] for r in pieces}


def test_anchors_beyond_the_bits_of_a_place(monkeypatch):
    monkeypatch.setattr(X, "PLACE", X.U64(63))
    grams = np.random.default_rng(1).integers(0, 1 << 12, 300, np.uint64) << X.U64(6)
    for n in (9, 10, 63, 64, 65, 118, 119, 300):
        assert X.anchors(grams[:n], 10).tolist() == [i + int(np.argmin(grams[i : i + 10])) for i in range(n - 9)]

import random
import re

import pytest

from sonalyze.llm.components import components
from sonalyze.llm.jaccard import similar_groups

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(docs):
    sets = {k: shingles(t) for k, t in docs}
    parent = {k: k for k in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {k: (len(sets[k]), root(k)) for k in keys}


def corpus():
    rng = random.Random(3)
    line = " ".join(f"c{i}" for i in range(12))
    docs = []
    for base in range(25):
        words = [f"b{base}w{rng.randrange(200)}" for _ in range(rng.randrange(1, 120))] + line.split()
        for _ in range(rng.randrange(1, 8)):
            copy = list(words)
            for _ in range(rng.randrange(0, 4)):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(1000)}"
            docs.append(" ".join(copy[rng.randrange(3) :]))
    docs += [docs[0].upper(), docs[0], docs[1] + " ", "one two", "One  two", "two one", "", None, " \t", "solo"]
    rng.shuffle(docs)
    return [(i * 7, t) for i, t in enumerate(docs)]


@pytest.mark.parametrize("bits", [62, 8])
def test_against_brute_force(spark, bits):
    docs = corpus()
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("doc_id", "text", "1 n", "'x' component_id").repartition(4)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in similar_groups(df, max_bits=bits).collect()} == brute(docs)


def test_null_ids_repeated_rows_and_no_rows(spark):
    df = spark.createDataFrame([(None, "a b"), (3, "a b"), (4, "c"), (4, "c")], "doc_id long, text string")
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in similar_groups(df).collect()) == [(0, 0), (3, 0), (4, 4), (4, 4)]
    assert similar_groups(df.limit(0)).count() == 0


def test_components_of_a_long_path(spark):
    df = spark.range(50).selectExpr("id a", "id + 1 b").union(spark.createDataFrame([(100, 99), (7, 7)], "a long, b long"))
    assert {r.id: r.component for r in components(df).collect()} == {**{i: 0 for i in range(51)}, 99: 99, 100: 99}


def test_tiles_pair_all_sets_of_a_frequent_ngram(spark, monkeypatch):
    import sonalyze.llm.jaccard as J

    monkeypatch.setattr(J, "TILE_ROWS", 2)
    prefixes = spark.createDataFrame([(v, 10, 5, 1) for v in range(9)], "v long, n long, g long, at int")
    got = [tuple(r[:4]) for r in J.candidates(prefixes, spark.createDataFrame([(1, 0), (0, 0)], "id long, component long"), 75, True).collect()]
    assert sorted(got) == [(a, b, 10, 10) for a in range(9) for b in range(a + 1, 9) if (a, b) != (0, 1)]


def test_texts_that_share_a_doc_id_are_documents_of_their_own(spark):
    one, two = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(40))
    df = spark.createDataFrame([(5, one), (5, two), (3, two), (9, one + " "), (9, None)], "doc_id long, text string")
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in similar_groups(df).collect())
    assert got == [(3, 36, 3), (5, 26, 5), (5, 36, 3), (9, 0, 9), (9, 26, 5)]

import re

import pytest

from sonalyze.llm.sketch import packed, unpacked
from sonalyze.llm.substrings import dedup_substrings

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(docs, window):
    seen, out = {}, {}
    for key, text in sorted(docs, key=lambda d: d[0]):
        words = WORD.findall(text or "")
        gone = set()
        for i in range(len(words) - window + 1):
            if seen.setdefault(tuple(words[i : i + window]), (key, i)) != (key, i):
                gone.update(range(i, i + window))
        out[key] = (len(words), len(gone), None if text is None else " ".join(w for i, w in enumerate(words) if i not in gone))
    return out


def corpus():
    import random

    rng = random.Random(5)
    passage = " ".join(f"p{i}" for i in range(60))
    docs = []
    for i in range(120):
        words = [f"w{rng.randrange(40 if i % 3 else 3)}" for _ in range(rng.randrange(0, 200))]
        at = rng.randrange(0, len(words) + 1)
        if i % 4 == 0:
            words[at:at] = passage.split()[rng.randrange(20) :]
        if i % 10 == 9:
            words = ["same"] * i
        docs.append((i * 3, rng.choice([" ", "\n", " \t "]).join(words) + rng.choice(["", " ", "é"])))
    docs += [(1000 + i, t) for i, (_, t) in enumerate(docs[:20])]
    return [*docs, (5000, None), (5001, ""), (5002, " \x0b ")]


@pytest.mark.parametrize("window, bits", [(20, 62), (5, 62), (20, 7)])
def test_against_brute_force(spark, window, bits):
    docs = corpus()
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("doc_id", "text", "'x' block", "1 part", "2 n_words").repartition(5)
    got = dedup_substrings(df, window, bits).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.text) for r in got} == brute(docs, window)
    assert all(r.block == "x" for r in got)


def test_repeated_rows_and_null_ids(spark):
    text = " ".join(map(str, range(30)))
    df = spark.createDataFrame([(7, text), (7, text), (None, text), (1, text)], "doc_id long, text string")
    got = sorted((r.doc_id is not None, r.doc_id or 0, r.n_removed) for r in dedup_substrings(df).collect())
    assert got == [(False, 0, 0), (True, 1, 30), (True, 7, 30), (True, 7, 30)]


def test_empty(spark):
    assert dedup_substrings(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_packed_cells():
    import numpy as np

    for cells in ([5], [1, 1, 2, 70000], [0, 4_000_000_000]):
        assert unpacked(packed(np.array(cells, np.uint32))).tolist() == cells

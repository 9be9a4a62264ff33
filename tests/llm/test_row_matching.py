"""Row patterns against a backtracking matcher, with blocks of all sizes."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from sonalyze.llm import patterns as P
from sonalyze.llm.row_matching import Condition, match_rows

A, B, C, X = map(P.Letter, "ABCX")
LAZY = P.Seq((A, P.Many(P.Either((B, C)), lazy=True), X))
GREEDY = P.Seq((A, P.Many(P.Either((B, P.Seq((C, B)))))))
MIXED = P.Seq((P.Either((P.Seq((A, B)), A)), P.Many(P.Seq((P.Many(B), C))), P.Either((X, B))))


def prefixes(pattern, fits, at, n):
    """Ends of the pattern's matches from row `at`, in the order in which backtracking tries them."""
    if isinstance(pattern, P.Letter):
        if at < n and pattern.name in fits(at):
            yield at + 1
    elif isinstance(pattern, P.Either):
        for p in pattern.parts:
            yield from prefixes(p, fits, at, n)
    elif isinstance(pattern, P.Seq):
        if not pattern.parts:
            yield at
        else:
            for mid in prefixes(pattern.parts[0], fits, at, n):
                yield from prefixes(P.Seq(pattern.parts[1:]), fits, mid, n)
    else:
        if pattern.lazy:
            yield at
        for mid in prefixes(pattern.body, fits, at, n):
            if mid > at:
                yield from prefixes(pattern, fits, mid, n)
        if not pattern.lazy:
            yield at


def brute(rows, pattern):
    """rows: (key, at, id, letters, value); X needs the first row's value or more."""
    out, by = [], {}
    for r in sorted({r for r in rows if r[0] is not None and r[1] is not None}, key=lambda r: r[:3]):
        by.setdefault(r[0], []).append(r)
    for key, own in by.items():
        at, number = 0, 0
        while at < len(own):
            fits = lambda i: set() if own[i][4] is None else {x for x in own[i][3] if x != "X" or own[i][4] >= own[at][4]} if own[at][4] is not None else set()
            end = next(prefixes(pattern, fits, at, len(own)), None)
            if end is None:
                at += 1
                continue
            number += 1
            m = own[at:end]
            out.append((key, number, m[0][2], m[-1][2], len(m), sum(r[4] for r in m)))
            at = end
    return sorted(out)


def letters():
    has = lambda k: lambda now, before, has_before: (now["bits"].astype(np.int64) >> k & 1) > 0
    return {x: Condition(has(k), x == "X") for k, x in enumerate("ABCX")}


def found(spark, rows, pattern, parts):
    df = spark.createDataFrame([(k, at, i, sum(1 << "ABCX".index(x) for x in ls), v, "clash") for k, at, i, ls, v in rows], "key string, at int, id long, bits int, value long, mask string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        out = match_rows(df, "key", ["at", "id"], "id", F.col("value"), {"bits": F.col("bits")}, letters(), pattern).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    for r in out:
        assert len(r.labels) == r.n_rows and re.fullmatch("[ABCX]+", r.labels)
    return sorted(tuple(r)[:6] for r in out)


def some_rows(seed, n, hot=0.5, stop=0.1):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if r.random() < hot else r.choice([None, "a", "b", "c", *map(str, range(9))])
        ls = "".join(x for x in "ABCX" if r.random() < (0.15 if x == "X" else 0.6)) if r.random() >= stop else ""
        rows.append((key, r.choice([None, *range(n)]) if r.random() < 0.1 else i // 2, i, ls, r.choice([None, *range(20)]) if r.random() < 0.3 else r.randint(0, 9)))
    return rows + r.choices(rows, k=n // 8)


@pytest.mark.parametrize("pattern", [LAZY, GREEDY, MIXED])
@pytest.mark.parametrize("n,parts", [(400, 37), (120, 3)])
def test_matches_equal_backtracking(spark, pattern, n, parts):
    rows = some_rows(n, n)
    want = brute(rows, pattern)
    assert want and found(spark, rows, pattern, parts) == want


def test_matches_over_many_blocks(spark):
    """One sequence without a stop: starts walk on through blocks until a row exceeds them."""
    rows = [("hot", i, i, "ABC" if i % 50 else "ABCX", 100 - i % 60) for i in range(300)] + [("hot", 300, 300, "X", 1000), ("z", 0, 301, "A", 1), ("z", 1, 302, "X", 1)]
    want = brute(rows, LAZY)
    assert max(w[4] for w in want) > 100 and found(spark, rows, LAZY, 12) == want


def test_empty_and_single_rows(spark):
    assert found(spark, [], LAZY, 4) == []
    assert found(spark, [(None, 1, 1, "A", 1), ("a", None, 1, "A", 1), ("a", 1, 5, "AX", 3)], LAZY, 4) == []
    assert found(spark, [("a", 1, 5, "AX", 3)], GREEDY, 4) == [("a", 1, 5, 5, 1, 3)]


def test_labels_are_the_preferred_ones():
    bits = lambda *rows: np.array([sum(1 << "ABCX".index(x) for x in r) for r in rows], np.uint16).tobytes()
    assert P.spelled(LAZY, tuple("ABCX"), bits("AB", "BCX", "CX")) == "ABX"
    assert P.spelled(P.Seq((A, P.Either((P.Seq((B, C)), P.Seq((C, B)))))), tuple("ABCX"), bits("A", "BC", "BC")) == "ABC"


def test_groups_of_long_walks_are_the_same(monkeypatch):
    r = random.Random(5)
    for trial in range(60):
        n = r.randint(1, 60)
        stops = sorted({n, *r.choices(range(1, n + 1), k=2)})
        masks = np.array([sum(1 << k for k in range(4) if r.random() < (0.7, 0.6, 0.6, 0.2)[k]) for _ in range(n)])
        rows = P.Rows(masks, np.array([r.randint(0, 9) for _ in range(n)]), np.array([next(s for s in stops if s > i) for i in range(n)]), 8)
        pattern = (LAZY, GREEDY, MIXED)[trial % 3]
        got = []
        for together in (0, 3, 1000):
            monkeypatch.setattr(P, "TOGETHER", together)
            dfa = P.Dfa(pattern, list("ABCX"))
            best, state = P.walk(dfa, rows, np.arange(n), np.ones(n, np.int32), rows.values, np.full(n, -1))
            got.append((best.tolist(), [dfa.states[s] for s in state]))
        assert got[0] == got[1] == got[2]


def test_a_pattern_of_no_rows_is_an_error():
    with pytest.raises(ValueError):
        P.Dfa(P.Many(A), ["A"])

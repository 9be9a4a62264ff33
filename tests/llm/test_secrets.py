"""Secrets against brute force in Python, and against DuckDB."""

import math
import random
import re
from collections import Counter

import duckdb
import pytest

from sonalyze.llm import sql
from sonalyze.llm.secrets import ALLOWED, CLASSES, FORMS, find_secrets, in_order, listed

KINDS = [*(n for n, _ in FORMS), *(c.name for c in CLASSES)]
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def brute(text: str) -> tuple[list, list]:
    base = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    base += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    base += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    more = []
    for c in CLASSES:
        for m in re.finditer(c.chars + "+", text):
            x = m[0]
            if len(x) < c.window or not all(re.search(p, x) for p in c.holds) or any(re.search(p, x) for p in ALLOWED):
                continue
            covered = set()
            for i in range(len(x) - c.window + 1):
                n = Counter(x[i : i + c.window])
                if sum(round(v * math.log2(v) * 2**20) for v in n.values()) <= c.most:
                    covered.update(range(i, i + c.window))
            starts = [i for i in sorted(covered) if i - 1 not in covered]
            ends = [i + 1 for i in sorted(covered) if i + 1 not in covered]
            more += [(c.name, m.start() + a, m.start() + b) for a, b in zip(starts, ends)]
    more = [x for x in more if not any(b[1] <= x[1] and x[2] <= b[2] for b in base)]
    key = lambda x: (x[1], KINDS.index(x[0]))
    return sorted(base, key=key), sorted([*base, *more], key=key)


def shown(spans: list) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def odd_texts() -> list:
    r = random.Random(7)
    some = lambda chars, n: "".join(r.choice(chars) for _ in range(n))
    b64, hexa = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", "0123456789abcdef"
    texts = [None, "", " ", "\x00 \t", "password=", "password: abcde", "password: abcdef", 'PassWord" : "x.y/z=_-+"', "token=api_key=abcdefgh", "password=token : abcdefgh", "apikey='12345678'", "secret==x======"]
    texts += ["AKIA" + some("ABCDEFGH0123", n) + "!" for n in (0, 1, 15, 16, 40)] + ["AKIAAKIA" + some("ABCD", 12), "xAKIA" + some("ABCD", 16) + "x"]
    texts += [some(hexa, n) + "g" + some(hexa, 30) for n in (0, 23, 24, 25)] + ["é😀" + some(hexa, 30) + "😀 token='" + some(b64, 30) + "' ü", "KKey toKen=abcdefg api_Key=abcdefgh ſecret=abcdefgh"]
    texts += [some(b64, n) for n in (19, 20, 21, 60)] + ["a" * 30 + some(b64, 40) + "b" * 50 + some(b64, 25), "9233A8ECF7C5B09FE5949719B6B82BC439E9329B", "sha512-" + some(b64, 60), some(b64, 20) + "EXAMPLE" + some(b64, 20), "x" * 5000, some(b64, 3000)]
    texts += [" ".join(some(b64, r.randint(1, 40)) + r.choice(["", " é", "\n"]) for _ in range(40)) for _ in range(20)]
    return texts + ["token=abcdef " * 700, "deadbeef" * 3 + " " + "deadbeef" * 3]


@pytest.fixture(scope="module")
def rows(spark):
    texts = odd_texts()
    held = [(i if i % 7 else None, t, "clash", i) for i, t in enumerate(texts)] + [(1, "token=repeated1", "clash", 0)] * 2
    return held, spark.createDataFrame(held, "doc_id long, text string, base string, t int").repartition(3)


def test_spans_equal_brute_force(rows):
    held, df = rows
    got = find_secrets(df).select("doc_id", listed("base").alias("b"), listed(in_order("base", "added")).alias("s"), "base", "added").collect()
    want = []
    for doc_id, text, *_ in held:
        base, spans = brute(text or "")
        want.append((doc_id or -1, shown(base), shown(spans)))
    assert sorted((r[0] or -1, r[1], r[2]) for r in got) == sorted(want)
    texts = {text for _, text, *_ in held}
    for r in got:  # the secrets themselves are what stands there
        assert all(any(t and t[x.start : x.end] == x.secret for t in texts) for x in [*r.base, *r.added])


def test_long_repeats_cost_no_square(spark):
    text = "token=abcdef " * 20_000
    got = find_secrets(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert len(got.base) == 20_000 and got.base[-1].end == len(text) - 1


def test_an_empty_table(spark):
    assert find_secrets(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_no_python_in_the_plan(spark, rows):
    plan = find_secrets(rows[1])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and plan.count("Exchange") == 1  # the fixture's own repartition


def test_sql_says_the_same(spark, rows):
    held, df = rows
    con = duckdb.connect()
    own = [(i, t.replace("\x00", "") if t else t) for i, (_, t, *_) in enumerate(held)]
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", own)
    want = con.execute(sql.secrets()).fetchall()
    found = find_secrets(spark.createDataFrame(own, "doc_id long, text string"))
    got = {r[0]: r[1] for r in found.select("doc_id", listed(in_order("base", "added")).alias("s")).collect()}
    assert {w[0]: w[5] for w in want} == got

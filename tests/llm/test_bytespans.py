import random

import numpy as np
import pytest

from sonalyze.llm import suffixes as S
from sonalyze.llm import text as X
from sonalyze.llm.bytespans import dedup_bytes, later_windows


@pytest.mark.parametrize("text", [b"banana", b"a" * 50, b"ab" * 40 + b"c" + b"ab" * 40, bytes(range(256)) * 3, b"x", b"\0\0\0a\0\0"])
def test_suffix_array_and_common_prefixes(text):
    data = np.frombuffer(text, np.uint8)
    keys = S.words8(data)
    sa = S.suffix_array(keys, len(data)).tolist()
    assert sa == sorted(range(len(text)), key=lambda i: text[i:])

    def common(a, b):
        k = 0
        while max(a, b) + k < len(text) and text[a + k] == text[b + k]:
            k += 1
        return k

    assert S.common_prefixes(data, keys, np.array(sa)).tolist() == [0, *(common(a, b) for a, b in zip(sa, sa[1:]))]


def brute(docs, window):
    seen, out = {}, {}
    for key, text in sorted(docs, key=lambda d: d[0]):
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for i in range(len(data) - window + 1):
            if seen.setdefault(data[i : i + window], (key, i)) != (key, i):
                gone[i : i + window] = True
        spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        out[key] = (len(data), int(gone.sum()), spans, bytes(b for b, g in zip(data, gone) if not g))
    return out


def corpus():
    rng = random.Random(2)
    passage = "".join(rng.choice("abcdé ") for _ in range(300))
    docs = []
    for i in range(80):
        t = "".join(rng.choice("ab\0é\n" if i % 3 else "xyzw vut") for _ in range(rng.randrange(0, 500)))
        if i % 3 == 0:
            at, cut = rng.randrange(len(t) + 1), rng.randrange(150)
            t = t[:at] + passage[cut : cut + rng.randrange(90, 200)] + t[at:]
        if i % 13 == 5:
            t = "z" * i * 3
        docs.append((i * 5, t))
    docs += [(1000 + i, t) for i, (_, t) in enumerate(docs[:15])]
    return [*docs, (5000, None), (5001, "")]


@pytest.mark.parametrize("window, bits, hot", [(100, 62, 7), (30, 62, 7), (100, 7, 9), (100, 62, 1), (30, 7, 1)])
def test_against_brute_force(spark, window, bits, hot):
    docs = corpus()
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("doc_id", "text", "'x' kept", "1 part").repartition(5)
    got = dedup_bytes(df, window, bits, hot).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got} == brute(docs, window)


def test_shards_of_one_anchor_are_merged():
    rng = np.random.default_rng(1)
    base = rng.integers(97, 100, 40).astype(np.uint8)
    bodies, docs = [], []
    for d in range(200):
        bodies.append(np.concatenate([rng.integers(97, 99, 4), base, rng.integers(97, 99, 4)]).astype(np.uint8))
        docs.append(d)
    window, n = 44, 5
    body = np.concatenate(bodies)
    code = np.arange(200, dtype=np.uint64)
    got = set()
    for doc, start, count in later_windows(np.array(docs), np.array(docs), np.zeros(200, np.uint32), np.full(200, n, np.uint32), np.zeros(200, np.uint64), code, code, body, window, shard_bytes=1500):
        got |= {(int(d), int(s) + k) for d, s, m in zip(doc, start, count) for k in range(m)}
    seen, want = {}, set()
    for d, b in enumerate(bodies):
        for i in range(n):
            if seen.setdefault(b[i : i + window].tobytes(), (d, i)) != (d, i):
                want.add((d, i))
    assert got == want


def test_repeated_rows_and_no_rows(spark):
    text = "".join(map(str, range(60)))
    df = spark.createDataFrame([(7, text), (7, text), (None, text), (1, text)], "doc_id long, text string")
    got = sorted((r.doc_id is not None, r.doc_id or 0, r.n_removed) for r in dedup_bytes(df).collect())
    assert got == [(False, 0, 0), (True, 1, 110), (True, 7, 110), (True, 7, 110)]
    assert dedup_bytes(df.limit(0)).count() == 0

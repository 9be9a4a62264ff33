"""Divergence of sources against brute force, and radix tries against plain counts."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from sonalyze.llm import divergence as D
from sonalyze.llm.tries import Trie, by_prefix, shared_depths

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
LOWERED = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows: list, least: int, top: int) -> list:
    docs, counts, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source, *_ in rows:
        words = TERM.findall((text or "").translate(LOWERED))
        groups.add((lang or "", source or ""))
        counts[lang or "", source or ""].update(words)
        docs[lang or ""].update(set(words))
    out = []
    share = lambda c, n, v: 1 + 10**9 * (c + 5) // (n + 5 * v)
    for lang in {g for g, _ in groups}:
        kept = sorted((w for w, n in docs[lang].items() if n >= least), key=str.encode)
        sources = sorted(s for g, s in groups if g == lang)
        n = {s: sum(counts[lang, s][w] for w in kept) for s in sources}
        p = {s: [share(counts[lang, s][w], n[s], len(kept)) for w in kept] for s in sources}
        q = [share(sum(counts[lang, s][w] for s in sources), sum(n.values()), len(kept)) for w in kept]
        for s in sources:
            pairs = [(t, sum(abs(a - b) for a, b in zip(p[s], p[t]))) for t in sources if t != s]
            terms = [(w, a - b) for w, a, b in zip(kept, p[s], q) if counts[lang, s][w] and a > b]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                order = sorted(found, key=lambda x: (-x[1], x[0].encode()))[:most]
                out += [(lang, s, part, item, value, k + 1) for k, (item, value) in enumerate(order)]
    return sorted(out)


@pytest.fixture(scope="module")
def rows():
    r = random.Random(3)
    vocabulary = ["a", "A", "ab", "abc", "abcd", "abcde", "abcdf", "ABCDE", "é", "éa", "日本", "日", "ｘ", "ſ", "É", "zz" * 300, "zz" * 300 + "y"] + ["w" + "abcd"[k % 4] * (k % 9 + 1) for k in range(40)]
    out = [(None, None, None), ("", "en", "s0"), ("12 34 \x00\x7f", "xx", "alone"), (" ".join(["abc"] * 5000), "en", "s1"), (None, "en", "never")]
    for _ in range(400):
        lang = r.choice(["en", "en", "fr", None])
        source = r.choice(["s0", "s0", "s0", "s1", "ß", None])
        out.append((r.choice(" ,1\n").join(r.choice(vocabulary[: r.choice([5, 57])]) for _ in range(r.randint(0, 60))), lang, source))
    return out + out[10:20] * 3


def test_all_rows_equal_brute_force(spark, rows):
    df = spark.createDataFrame([(*x, "clash", 1) for x in rows], "text string, lang string, source string, item string, lang_id int").repartition(5)
    for least, top in ((30, 50), (3, 4)):
        got = sorted(tuple(x) for x in D.divergence(df, least, top).select("lang", "source", "part", "item", "value", "rank").collect())
        assert got == brute(rows, least, top)
        assert got


def test_small_steps_change_nothing(spark, rows, monkeypatch):
    batch = lambda k: pa.RecordBatch.from_pydict({"lang_id": [hash(x[1]) for x in rows[k::2]], "group_id": [hash(x[1:]) for x in rows[k::2]], "text": [x[0] for x in rows[k::2]]}, pa.schema([("lang_id", pa.int64()), ("group_id", pa.int64()), ("text", pa.string())]))

    def walked() -> dict:
        made = pa.Table.from_batches(list(D.counted(iter([batch(0), batch(1)])))).sort_by("prefix")
        out = defaultdict(Counter)
        for row in (r for b in D.kept_terms(5)(iter(made.to_batches(max_chunksize=7))) for r in b.to_pylist()):
            at = 0
            assert row["terms"] == sorted(row["terms"])
            for term, size in zip(row["terms"], row["sizes"]):
                for g, n in zip(row["groups"][at : at + size], row["counts"][at : at + size]):
                    out[row["lang_id"], term][g] += n
                at += size
        return out

    want = walked()
    for name, value in (("TEXT_BYTES", 50), ("LEAVES", 5), ("STEP", 2)):
        monkeypatch.setattr(D, name, value)
    assert want and walked() == want


def test_empty_tables_and_languages_without_terms(spark):
    empty = spark.createDataFrame([], "text string, lang string, source string")
    assert D.divergence(empty).collect() == []
    few = spark.createDataFrame([("a b", "en", "x"), (None, "en", "y"), ("c", "de", "x")], "text string, lang string, source string")
    assert sorted(map(tuple, D.divergence(few).collect())) == [("en", "x", "pair", "y", 0, 1), ("en", "y", "pair", "x", 0, 1)]


def test_shares_of_very_large_counts_are_exact():
    counts, totals = np.array([10**15, 7, 0]), np.array([3 * 10**15, 10**12, 9])
    assert D.shares(counts, totals, 1000).tolist() == [1 + 10**9 * (c + 5) // (t + 5000) for c, t in zip(counts.tolist(), totals.tolist())]


def test_subtries_hold_all_leaves():
    r = random.Random(1)
    terms = [bytes(r.choice(b"ab\xc3\xa9") for _ in range(r.randint(1, 9))) for _ in range(3000)]
    half = lambda ts: Trie.counted(pa.array(ts, pa.binary()), np.arange(len(ts)) % 50, np.arange(50) % 2, np.arange(50) % 6)
    tries = [half(terms[:1000]), half(terms[1000:])]
    rows = pa.Table.from_batches([t.subtries() for t in tries]).sort_by("prefix")
    back = list(by_prefix(rows.to_batches(max_chunksize=3), 100))
    assert len(back) > 3
    got = Counter({(t.terms[int(leaf)].as_py(), g): n for t in back for leaf, g, n in zip(t.leaf, t.group.tolist(), t.n.tolist())})
    want = Counter((t, (k % 1000 if k < 1000 else (k - 1000)) % 50 % 6) for k, t in enumerate(terms))
    assert got == want
    assert [x.as_py() for t in back for x in t.terms] == sorted(set(terms))


def test_depths_are_common_prefixes():
    terms = sorted([b"a", b"ab", b"abc", b"abd", b"b" * 50, b"b" * 51])
    offsets = np.append(0, np.cumsum([len(t) for t in terms]))
    assert shared_depths(np.frombuffer(b"".join(terms), np.uint8), offsets).tolist() == [0, 1, 2, 2, 0, 50]

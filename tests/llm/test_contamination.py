import random
import re
from collections import Counter

from sonalyze.llm.contamination import find_passages

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(words):
    return [tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))] if words else []


def split(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items):
    out = {}
    for d, t in docs:
        w = split(t)
        for i, q in items:
            item = split(q)
            if not w or not item:
                continue
            b = Counter(shingles(item))
            for s in range(max(1, len(w) - len(item) + 1)):
                a = Counter(shingles(w[s : s + len(item)]))
                sim = sum((a & b).values()) / sum((a | b).values())
                if sim >= 0.75 and sim > out.get((d, i), (0, 0))[1]:
                    out[d, i] = (s, sim)
    return out


def test_against_brute_force(spark):
    rng = random.Random(8)
    items = [(i, " ".join(f"q{rng.randrange(60)}" for _ in range(rng.randrange(1, 50)))) for i in range(30)] + [(90, None), (91, " ")]
    docs = []
    for d in range(200):
        words = [f"w{rng.randrange(300)}" for _ in range(rng.randrange(0, 120))]
        for _ in range(rng.randrange(3)):
            passage = split(rng.choice(items)[1])
            for _ in range(rng.randrange(3)):
                if passage:
                    k = rng.randrange(len(passage))
                    passage[k : k + rng.randrange(2)] = ["edit"] * rng.randrange(2)
            at = rng.randrange(len(words) + 1)
            words[at:at] = [p.upper() for p in passage]
        docs.append((d, rng.choice([" ", "\n"]).join(words)))
    docs += [(900, None), (901, ""), (902, items[3][1]), (903, " ".join(items[4][1].split()[:-1]))]
    a = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 h", "'x' item")
    b = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "2 at")
    got = {(r.doc_id, r.item_id): (r.start, r.similarity) for r in find_passages(a, b).collect()}
    want = brute(docs, items)
    assert len(want) > 50 and got == want


def test_null_ids_repeated_rows_and_no_rows(spark):
    text = " ".join(map(str, range(20)))
    docs = spark.createDataFrame([(None, text), (1, text), (1, text), (1, "x " + text)], "doc_id long, text string")
    items = spark.createDataFrame([(5, text), (5, text)], "item_id long, text string")
    assert sorted((r.doc_id or 0, r.item_id, r.start) for r in find_passages(docs, items).collect()) == [(0, 5, 0), (1, 5, 0)]
    assert find_passages(docs.limit(0), items).count() == find_passages(docs, items.limit(0)).count() == 0


def test_plan_has_no_python(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    plan = find_passages(docs, docs.withColumnRenamed("doc_id", "item_id"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_the_whole_plan_is_native(spark, monkeypatch):
    """With nothing stored in between."""
    import sonalyze.llm.contamination as C

    monkeypatch.setattr(C, "stored", lambda df, name: df)
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    plan = C.find_passages(docs, docs.withColumnRenamed("doc_id", "item_id"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and plan.count("SortMergeJoin") + plan.count("HashJoin") > 4


def test_probing_meets_each_pair_within_the_radius_once(spark):
    import sonalyze.llm.contamination as C
    from pyspark.sql import functions as F

    rng = random.Random(9)
    pairs = []
    for k in range(300):
        a, b = rng.getrandbits(64), 0
        for place in rng.sample(range(64), rng.choice([0, 5, 15, 22, 23, 23, 24, 32])):
            b |= 1 << place
        pairs.append(tuple(x - (1 << 64) if x >> 63 else x for x in (a, a ^ b)))
    df = spark.createDataFrame([(k, *p) for k, p in enumerate(pairs)], "k int, a long, b long")
    one = df.select("k", "a", F.expr(C.block_of("a", ["IF(false, struct(-1 AS block, 0L AS bits), NULL)"])))
    two = df.select("k", "b", F.expr(C.near_blocks("b", 23 // C.BLOCKS, ["IF(false, struct(-1 AS block, 0L AS bits), NULL)"])))
    met = one.join(two, ["k", "block", "bits"])
    once = Counter(r.k for r in met.where(f"bit_count(a ^ b) <= 23 AND block = {C.first_block('(a ^ b)', 23 // C.BLOCKS)}").collect())
    assert once == Counter(k for k, (a, b) in enumerate(pairs) if bin((a ^ b) & (2**64 - 1)).count("1") <= 23)


def test_runs_of_equal_words(spark):
    own = " ".join(f"w{i}" for i in range(604))
    items = spark.createDataFrame([(k, own + f" {mark}" * 100) for k, mark in enumerate("-*~", 1)], "item_id long, text string")
    docs = spark.createDataFrame([(k, own + f" {mark}" * 100) for k, mark in enumerate("=_.", 1)], "doc_id long, text string")
    got = {(r.doc_id, r.item_id, r.start, r.similarity) for r in find_passages(docs, items).collect()}
    assert got == {(i, k, 0, 0.75) for i in (1, 2, 3) for k in (1, 2, 3)}


def test_long_texts_with_many_hits_in_bounded_steps(spark, monkeypatch):
    import sonalyze.llm.contamination as C

    rng = random.Random(6)
    items = [(i, " ".join(f"q{rng.randrange(400)}" for _ in range(n))) for i, n in enumerate((12, 30, 30, 55, 140, 300))]
    words = []
    for _ in range(60):
        passage = split(rng.choice(items)[1])
        k = rng.randrange(len(passage))
        passage[k : k + 2] = ["edit"] * rng.randrange(3)
        words += passage + [f"w{rng.randrange(50)}" for _ in range(rng.randrange(30))]
    docs = [(1, " ".join(words)), (2, items[5][1] + " " + items[5][1][:300]), (3, " ".join(split(items[4][1])[3:]))]
    a, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = brute(docs, items)
    for step in (1024, 64):
        monkeypatch.setattr(C, "STEP", step)
        assert {(r.doc_id, r.item_id): (r.start, r.similarity) for r in find_passages(a, b).collect()} == want
    assert len(want) >= 6


def test_packed_fingerprints_are_those_of_the_definition(spark):
    import sonalyze.llm.contamination as C
    from pyspark.sql import functions as F

    rng = random.Random(7)
    for n in (3, 40, 127, 128, 700):
        lanes, width = C.packing(n)
        rows = [([rng.getrandbits(64) - (1 << 63) for _ in range(n + 5)],) for _ in range(3)]
        df = spark.createDataFrame(rows, "s array<long>")
        df = C.computed(df, "counters", F.expr("array(" + ", ".join(f"transform(s, h -> {C.spread('h', k, lanes, width)})" for k in range(64 // lanes)) + ")"))
        got = df.select("s", F.expr(C.packed_print("counters", "2", str(n), lanes, width)).alias("a"), F.expr(f"slice(s, 3, {n})").alias("w")).select("a", F.expr(C.fingerprint("w")).alias("b"), "w").collect()
        for r in got:
            bits = [sum(h >> k & 1 for h in r.w) * 2 > n for k in range(64)]
            value = sum(1 << k for k, x in enumerate(bits) if x)
            assert r.a == r.b == value - (value >> 63 << 64)

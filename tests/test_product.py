import datetime as dt

import pytest
from pyspark.sql import functions as F

from sonalyze.operators import news as N
from sonalyze.operators import product as P
from sonalyze.sources import ledger
from sonalyze.streaming.ingest import ingest


def test_safety_cases(spark):
    m = {(r.parent_tier, r.age_tier, r.safety): (r.admit, r.hint) for r in P.safety_matrix(spark).collect()}
    assert len(m) == 18
    rank = P.ADMISSIONS.index
    assert rank(m["open", "primary", "sensitive"][0]) <= rank(m["standard", "junior", "sensitive"][0])
    assert all(v[0] == "none" for k, v in m.items() if k[2] == "redline") and all(v[0] == "normal" for k, v in m.items() if k[2] == "default")
    assert m["conservative", "primary", "sensitive"] == ("none", "none") and m["open", "junior", "sensitive"] == ("normal", "weak")
    items = spark.createDataFrame([(1, "sensitive", None, "junior"), (2, "odd", "open", "junior"), (3, "sensitive", "conservative", "primary")], "id int, safety string, parent_tier string, age_tier string")
    got = {r.id: (r.admit, r.heavy, r.review) for r in P.decide(items, P.safety_matrix(spark)).collect()}
    assert got == {1: ("normal", True, False), 2: ("none", False, True), 3: ("none", False, False)}


def test_scripts(spark, tmp_path):
    (tmp_path / "a.md").write_text("# x\n爸爸：不算\n## 正文\n**爸爸**：（笑）为什么**呢**？\n\n**孩子**： 不知道。\n旁白没有\n## 自检\n**爸爸**：不算\n", encoding="utf-8")
    found = ledger.scripts(spark, str(tmp_path), newest=True)
    got = [(r.speaker, r.text) for r in P.script_lines(found).collect()]
    assert got == [("爸爸", "为什么呢？"), ("孩子", "不知道。")]
    lint = P.lint(P.script_lines(found), ["path"], F.lit("primary")).first()
    assert (lint.questions, lint.conclusions, lint.asks_more, lint.didactic, lint.length_ok) == (1, 0, True, 0, False)


def test_tiers_and_publishing(spark):
    df = spark.createDataFrame([(6, 0), (6, 5), (7, -1), (7, 0), (4, -3), (None, 0)], "g int, n int")
    assert [r[0] for r in df.select(P.age_tier(F.col("g"), F.col("n"))).collect()] == ["primary", "junior", "primary", "junior", "primary", None]
    assert [r[0] for r in df.select(P.age_tier(F.col("g"))).limit(1).collect()] == ["primary"]


def test_overrides_are_stricter_only(spark):
    tiers = N.TIERS
    df = spark.createDataFrame([(a, b) for a in tiers for b in tiers], "a string, b string").withColumn("o", N.override(F.col("a"), F.col("b")))
    assert all(tiers.index(r.o) == max(tiers.index(r.a), tiers.index(r.b)) for r in df.collect())


def test_listening(spark):
    day = lambda d: dt.datetime(2026, 1, d, 8)
    e = spark.createDataFrame([(1, day(1)), (1, day(1)), (1, day(2)), (1, day(4)), (2, day(2))], "user_id int, ts timestamp_ntz")
    days = P.days_of(e)
    assert sorted((r.user_id, r.days) for r in P.streaks(days).collect()) == [(1, 1), (1, 2), (2, 1)]
    assert sorted((r.day.day, r.listeners, r.returned) for r in P.next_day_return(days).collect()) == [(1, 1, 1), (2, 2, 0), (4, 1, 0)]


@pytest.mark.parametrize("url, key", [("http://www.A.com/x/?q=1#f", "a.com/x"), ("https://m.a.com", "a.com"), (None, None)])
def test_urls(spark, url, key):
    assert spark.createDataFrame([(url,)], "u string").select(N.normalized_url(F.col("u"))).first()[0] == key


def test_logs(spark, tmp_path):
    (tmp_path / "a.log").write_text('{"correlation_id": "t1", "m": 1}\nnot json t1\n')
    (tmp_path / "a.log.1").write_text('{"correlation_id": "t2"}\n{"correlation_id": "t1"}\n')
    got = ledger.logs(spark, [str(tmp_path / "a.log"), str(tmp_path / "a.log.1")], "t1")
    assert sorted(r.file for r in got.collect()) == ["a.log", "a.log.1"]


def test_ingestion_runs_again_without_change(spark, tmp_path):
    source, target, state = (f"{tmp_path}/{n}" for n in ("in", "out", "state"))
    add = lambda ids: spark.createDataFrame([(i, f"t{i}") for i in ids], "id int, t string").write.mode("append").parquet(source)
    run = lambda: ingest(spark, source, "id int, t string", target, state, "id")
    add([1, 2, 2])
    assert run() == 2 and run() == 0
    add([2, 3])
    assert run() == 1 and sorted(r.id for r in spark.read.parquet(target).collect()) == [1, 2, 3]


def test_ledger_round_trip(spark, tmp_path):
    spark.createDataFrame([], ledger.TASK).write.parquet(f"{tmp_path}/t")
    assert ledger.tasks(spark, f"{tmp_path}/t").count() == 0 and "workflow" in ledger.tasks(spark, f"{tmp_path}/t").columns
    spark.createDataFrame([], ledger.STAGE).write.parquet(f"{tmp_path}/s")
    assert ledger.stages(spark, f"{tmp_path}/s").schema["routes"].dataType.simpleString() == "map<string,bigint>"


def test_articles_of_the_same_words_are_near_duplicates(spark):
    from sonalyze.operators import news as N

    docs = [(3, "Rain, again: rain in Spain!"), (1, "in SPAIN again rain"), (2, "rain in spain"), (4, None), (5, None), (6, "..."), (7, "")]
    got = {r.doc_id: r.kept for r in N.near_dedup(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {1: True, 2: True, 3: False, 4: True, 5: True, 6: True, 7: False}


def test_picks_equal_all_scores(spark):
    import random

    from sonalyze.operators import product as P

    r = random.Random(3)
    topics = [(f"t{k:02}", r.choice(["lower", "upper"]), r.randrange(20)) for k in range(30)] + [(None, "lower", 99), ("t98", None, 99), ("t99", "upper", None)]
    families = [(k, r.choice(["lower", "upper", None])) for k in range(25)] + [(None, "lower")]
    history = [(r.choice([*range(25), 77, None]), r.choice([t[0] for t in topics])) for _ in range(300)]
    want = []
    for f, tier in families:
        if f is not None and tier:
            scores = sorted(((-(b + 5 * min(4, history.count((f, t)))), t) for t, g, b in topics if t and g == tier and b is not None))[:3]
            want += [(f, t, -s, k) for k, (s, t) in enumerate(scores, 1)]
    df = lambda rows, schema: spark.createDataFrame(rows, schema)
    got = P.recommend(df(topics, "topic string, tier string, base long"), df(families, "family long, tier string"), df(history, "family long, topic string"))
    assert sorted(tuple(x[c] for c in ("family", "topic", "score", "place")) for x in got.collect()) == sorted(want)

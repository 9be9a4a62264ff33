import random

import corpus_pipeline as P
from sonalyze.llm.shared import stored


def words(rng, n):
    return " ".join(rng.choice(["the", "of", "and"]) if rng.random() < 0.3 else "".join(rng.choice(["ther", "tion", "ing", "and", "of"]) for _ in range(3)) for _ in range(n))


def test_stages(spark, tmp_path):
    rng = random.Random(6)
    passage, item = words(rng, 60), words(rng, 30)
    docs = [(i, words(rng, 80), "en", f"s{i % 3}", 0) for i in range(30)]
    docs += [(100, docs[0][1], "en", "s", 0), (101, docs[1][1] + " end", "en", "s", 0)]
    docs += [(200 + i, words(rng, 50) + " " + passage + " " + words(rng, 50), "en", "s", 0) for i in range(3)]
    docs += [(300, words(rng, 40) + " " + item + " " + words(rng, 40), "en", "s", 0), (400, None, "en", "s", 0), (401, "zxq jqz xwv " * 20, None, None, 0)]
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    df.write.parquet(f"{tmp_path}/documents.parquet")
    all_, before = [], df
    for name, stage in P.STAGES:
        before = stored(stage(spark, before, str(tmp_path)), name)
        all_.append({r.doc_id: r for r in before.collect()} if name != "packing" else before.collect())
        assert name == "packing" or before.columns == df.columns
    ids = {d[0] for d in docs}
    assert set(all_[0]) == ids - {400, 401}
    assert set(all_[1]) == set(all_[0]) - {100, 101}
    texts = {d[0]: d[1] for d in docs}
    for k, r in all_[2].items():
        assert r.text == (texts[k].replace(passage + " ", "") if k in (201, 202) else texts[k]) and r.n_chars == len(r.text)
    assert set(all_[3]) == set(all_[2]) - {300}
    assert {r.doc_id for r in all_[4]} == set(all_[3])
    assert {(r.doc_id, r.doc_tokens) for r in P.run(spark, str(tmp_path)).collect()} == {(r.doc_id, r.doc_tokens) for r in all_[4]}


def test_no_rows(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert P.run(spark, str(tmp_path)).count() == 0


def test_odd_rows_and_clashing_columns(spark, tmp_path):
    rng = random.Random(7)
    passage = words(rng, 40)
    long = " ".join(f"the{i % 977}ther{i}" for i in range(60_000))
    docs = [(i, words(rng, 60), "en", "s", 0) for i in range(12)]
    docs += [(None, docs[0][1], "en", None, 0), (None, None, None, None, None), (3, words(rng, 30) + " " + passage, "en", "s", 0), (3, words(rng, 30) + " " + passage, "en", "s", 0)]
    docs += [(50, long, "en", "s", 0), (51, long, "en", "s", 0), (52, words(rng, 20) + " " + passage, "en", "s", 0), (6, docs[6][1], "en", "s", 0), (60, "", "en", "s", 0)]
    extra = "CAST(1 AS INT) AS n_words, 'x' AS component_id, 2L AS start, 'k' AS key0, 'b' AS block0, array(1) AS block, 3 AS n_removed"
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").selectExpr("*", extra.split(", ")[0], *extra.split(", ")[1:]).repartition(3)
    df.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, None), (None, ""), (2, words(rng, 30))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    before, seen = df, []
    for name, stage in P.STAGES[:-1]:
        before = stored(stage(spark, before, str(tmp_path)), name)
        assert before.columns == df.columns or name == "repeated_passages" and set(before.columns) <= set(df.columns)
        seen.append(sorted((-1 if r.doc_id is None else r.doc_id, r.text or "") for r in before.collect()))
    packed = P.STAGES[-1][1](spark, before, str(tmp_path))
    ids = [[k for k, _ in rows] for rows in seen]
    assert ids[0].count(-1) == 2 and ids[0].count(3) == 3 and 60 not in ids[0]  # empty, and without a language
    assert 51 not in ids[1] and ids[1].count(-1) == 2 and 0 not in ids[1] and ids[1].count(6) == 2  # the null id comes first
    texts = [t for k, t in seen[2] if k in (3, 52)]
    assert sum(passage in t for t in texts) == 2 and len(texts) == 4  # both rows of id 3 start it at one word
    assert ids[3] == ids[2] and {-1 if r.doc_id is None else r.doc_id for r in packed.collect()} == {*ids[3]}

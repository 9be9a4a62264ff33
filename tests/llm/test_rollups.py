import random
from collections import Counter

import pytest

from sonalyze.llm.rollups import EVENTS, Rollup, byte_count, word_count


def test_totals_follow_batches(spark, tmp_path):
    rng = random.Random(4)
    rollup, want, sent = Rollup(spark, str(tmp_path)), Counter(), []
    for b in range(6):
        events = []
        for _ in range(rng.randrange(0, 40)):
            key = (rng.choice(["s", "t", None]), rng.choice(["en", None]), rng.choice(["v1", "v2"]))
            op, n, old = rng.choice(["insert", "delete", "revise"]), rng.choice([0, 5, 9, None]), rng.choice([2, None])
            events += [(op, *key, n, old)] * rng.choice([1, 2])
        df = spark.createDataFrame(events, EVENTS)
        assert rollup.commit(f"batch/{b} é", df)
        sent.append(df)
        for op, s, lang, t, n, old in events:
            want[s, lang, t, 0] += {"insert": 1, "delete": -1, "revise": 0}[op]
            want[s, lang, t, 1] += {"insert": n or 0, "delete": -(n or 0), "revise": (n or 0) - (old or 0)}[op]
        again = rng.randrange(b + 1)
        assert not rollup.commit(f"batch/{again} é", sent[again])
        if b in (2, 3):
            rollup.compact()
        keys = {k[:3] for k in want}
        assert {(r.source, r.lang, r.tokenizer): (r.docs, r.tokens) for r in rollup.totals().collect()} == {k: (want[*k, 0], want[*k, 1]) for k in keys if want[*k, 0] or want[*k, 1]}


ONE = ("insert", "s", "en", "v", 3, None)


def sums(rollup):
    return [(r.docs, r.tokens) for r in rollup.totals().collect()]


def test_a_batch_whose_writer_died_starts_over(spark, tmp_path):
    rollup, one = Rollup(spark, str(tmp_path)), spark.createDataFrame([ONE], EVENTS)
    rollup.commit("a", one)
    (tmp_path / "claims" / "b-a").unlink()  # as if it had died before the claim
    assert rollup.totals().count() == 0 and rollup.commit("a", one)
    assert sums(rollup) == [(1, 3)]


def test_two_writers_of_one_batch_count_once(spark, tmp_path, monkeypatch):
    rollup, one = Rollup(spark, str(tmp_path)), spark.createDataFrame([ONE], EVENTS)
    from sonalyze.llm import rollups

    plain, inner = rollups.signed, []

    def signed(events):
        if not inner:
            inner.append(True)
            inner.append(rollup.commit("a~b", one))  # the other writer commits first
        return plain(events)

    monkeypatch.setattr(rollups, "signed", signed)
    assert not rollup.commit("a~b", one) and inner[1] and sums(rollup) == [(1, 3)]
    rollup.compact()
    assert sums(rollup) == [(1, 3)] and not rollup.commit("a~b", one)


def test_a_batch_committed_while_a_snapshot_is_summed_counts_once(spark, tmp_path, monkeypatch):
    rollup, one = Rollup(spark, str(tmp_path)), spark.createDataFrame([ONE], EVENTS)
    rollup.commit("a", one)
    plain = rollup._pending
    monkeypatch.setattr(rollup, "_pending", lambda folded: (plain(folded), rollup.commit("b", one))[0])
    rollup.compact()
    monkeypatch.undo()
    for step in (lambda: None, rollup.compact, rollup.vacuum, lambda: rollup.commit("c", one), rollup.compact, rollup.vacuum):
        step()
        assert sums(rollup) in ([(2, 6)], [(3, 9)])
    assert sums(rollup) == [(3, 9)] and len(list((tmp_path / "deltas").iterdir())) == 0


def test_nothing_and_unknown_ops(spark, tmp_path):
    rollup = Rollup(spark, str(tmp_path))
    assert rollup.totals().count() == 0
    with pytest.raises(Exception, match="unknown op"):
        rollup.commit("x", spark.createDataFrame([("drop", "s", "en", "v", 3, None)], EVENTS))
    assert rollup.totals().count() == 0


def test_counts(spark):
    df = spark.createDataFrame([(" a\tb  c\n",), (None,), ("é",)], "text string")
    assert [tuple(r) for r in df.select(word_count(), byte_count()).collect()] == [(3, 9), (0, 0), (1, 2)]


def test_query_equals_its_sql(spark):
    import duckdb

    from sonalyze.llm import queries

    at = "/root/testdata/sf0.001"
    db = duckdb.connect()
    for t in ("documents", "labels"):
        db.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{at}/{t}.parquet')")
    got = queries.word_rollup(spark, at)
    assert sorted(map(tuple, got.collect())) == sorted(db.sql(f"SELECT {', '.join(got.columns)} FROM ({queries.ROLLUP_SQL})").fetchall())


def test_query_counts_the_ids_of_the_library(spark):
    import pyarrow.parquet as pq
    from tokenizers import Tokenizer

    from sonalyze.llm import queries

    at, library = "/root/testdata/sf0.001", Tokenizer.from_file(queries.BYTE_BPE)
    labels = {}
    for r in pq.read_table(f"{at}/labels.parquet").to_pylist():
        toxic, quality = labels.get(r["doc_id"], (0, 1))
        labels[r["doc_id"]] = max(toxic, r["toxic"]), min(quality, r["quality"])
    want = Counter()
    for r in pq.read_table(f"{at}/documents.parquet").to_pylist():
        toxic, quality = labels.get(r["doc_id"], (0, 1))
        if toxic == 1:
            continue
        n = len(library.encode(r["text"] or "", add_special_tokens=False).ids)
        for version, tokens in (("byte_bpe_50k-1", n + (quality == 0)), ("byte_bpe_50k-2", n + 1)):
            want[r["source"], r["lang"], version, 0] += 1
            want[r["source"], r["lang"], version, 1] += tokens
    got = {(r.source, r.lang, r.tokenizer): (r.docs, r.tokens) for r in queries.op4_token_counts(spark, at).collect()}
    assert got == {k[:3]: (want[*k[:3], 0], want[*k[:3], 1]) for k in want}


def test_ids_of_null_empty_and_repeated_texts(spark):
    from sonalyze.llm import queries
    from sonalyze.llm.rollups import id_count

    df = spark.createDataFrame([(1, None, "s", None, 9), (None, "", None, "en", 9), (2, "a b", "s", "en", 9), (2, "a b", "s", "en", 9)], "doc_id long, text string, source string, lang string, n_tokens long")
    got = sorted((r.n_tokens, r.doc_id or 0) for r in id_count(df, queries.BYTE_BPE).collect())
    assert got == [(0, 0), (0, 1), (2, 2), (2, 2)]


def test_events_with_clashing_columns(spark, tmp_path):
    rollup = Rollup(spark, str(tmp_path))
    rollup.commit("a", spark.createDataFrame([(*ONE, 7, 8, "x")], EVENTS + ", docs long, tokens long, batch string"))
    assert sums(rollup) == [(1, 3)]

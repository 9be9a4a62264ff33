import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from sonalyze.llm import tokenfile
from sonalyze.llm.coder import BLOCK, decode_blocks, encode_blocks

PATH = public_tokenizers.path("byte_bpe_50k.json")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 300) | st.integers(0, 2**32 - 1), max_size=200), st.integers(1, 40))
def test_blocks_come_back(ids, times):
    ids = np.array(ids * times, "<u4")
    assert decode_blocks(encode_blocks(ids)).tolist() == ids.tolist()


@pytest.mark.parametrize("kind", ["constant", "random", "skewed", "repeats"])
def test_whole_blocks_come_back(kind):
    rng = np.random.default_rng(3)
    n = 5 * BLOCK + 17
    ids = {"constant": np.full(n, 50256), "random": rng.integers(0, 1 << 16, n), "skewed": (rng.pareto(1, n) * 20).astype(int) % 50000, "repeats": np.tile(rng.integers(0, 50000, 300), n // 300 + 1)[:n]}[kind].astype("<u4")
    data = encode_blocks(ids)
    assert (decode_blocks(data) == ids).all()
    assert len(data) < {"constant": 0.05, "random": 2.2, "skewed": 1.5, "repeats": 0.5}[kind] * n
    broken = bytearray(data)
    broken[-100] ^= 1
    if kind == "random":
        with pytest.raises(ValueError):
            decode_blocks(bytes(broken))
        with pytest.raises(ValueError):
            decode_blocks(data[:-5])


def test_files_hold_whole_documents_in_order(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tokenfile, "ROW_IDS", 300)
    library = Tokenizer.from_file(PATH)
    docs = [(i * 13 % 101, f"word{i} <|endoftext|> é\n" * (i % 30) if i % 9 else [None, ""][i % 2]) for i in range(101)] + [(500, "x " * 5000), (None, "none")]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 part", "2 ids").repartition(3)
    tokenfile.write_ids(df, f"{tmp_path}/a", PATH)
    got = {r.doc_id: r for r in tokenfile.read_ids(spark, f"{tmp_path}/a").collect()}
    at = 0
    for key, text in sorted(docs, key=lambda d: -1 if d[0] is None else d[0]):
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        assert (got[key].start, got[key].n_tokens, zlib.crc32(got[key].ids)) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    assert len(got) == len(docs)


def test_no_rows_and_repeated_rows(spark, tmp_path):
    df = spark.createDataFrame([(3, "a b"), (3, "a b")], "doc_id long, text string")
    tokenfile.write_ids(df.limit(0), f"{tmp_path}/b", PATH)
    assert tokenfile.read_ids(spark, f"{tmp_path}/b").count() == 0
    tokenfile.write_ids(df, f"{tmp_path}/c", PATH)
    assert sorted((r.doc_id, r.start, r.n_tokens) for r in tokenfile.read_ids(spark, f"{tmp_path}/c").collect()) == [(3, 0, 3), (3, 3, 3)]


def test_rows_of_one_id_have_an_order(spark, tmp_path):
    rows = [(7, "b " * k) for k in range(9)] + [(None, "x"), (None, "y z"), (1, "q")]
    seen = []
    for n in (1, 5):
        df = spark.createDataFrame(rows[::-1] if n == 5 else rows, "doc_id long, text string").repartition(n)
        tokenfile.write_ids(df, f"{tmp_path}/d{n}", PATH)
        seen.append(sorted((r.start, r.doc_id or 0, r.n_tokens) for r in tokenfile.read_ids(spark, f"{tmp_path}/d{n}").collect()))
    assert seen[0] == seen[1] and [r[1] for r in seen[0]] == [0, 0, 1] + [7] * 9


@pytest.mark.parametrize("most", [100_000, 0])
def test_offsets(spark, monkeypatch, most):
    monkeypatch.setattr(tokenfile, "GROUP_PARTS", 3)
    monkeypatch.setattr(tokenfile, "BROADCAST_ROWS", most)
    sizes = {p: p * p + 1 for p in (0, 1, 2, 4, 5, 9, 10)}
    df = spark.createDataFrame(list(sizes.items()), "part int, n long")
    assert {r.part: r.before for r in tokenfile.offsets(df).collect()} == {p: sum(n for q, n in sizes.items() if q < p) for p in sizes}


def test_equal_predictions_add_up_and_counters_hold():
    from sonalyze.llm.coder import ONE, Models

    m = Models(1, 2)
    two, one, x = np.array([5]), np.array([6]), np.array([7])
    for _ in range(4):
        m.predict(one, two)
        m.learn(x, m.id2 == x, (m.id1 == x) & (m.id2 != x))
    m.predict(one, two)
    assert m.id2[0] == m.id1[0] == 7 and m.same[0] and m.f1[0] == 0 and m.p2[0] > ONE // 3
    m.learn(np.array([9]), np.array([False]), np.array([False]))  # one other id doesn't displace what was counted
    m.predict(one, two)
    assert m.id2[0] == 7 and m.p2[0] + m.f1[0] < ONE


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.integers(0, 700) | st.integers(0, 2**16 - 1), max_size=150), min_size=1, max_size=8), st.sampled_from([2, 3]))
def test_ids_that_no_order_names_are_a_stream_of_their_own(lanes, n_bytes):
    from sonalyze.llm.coder import decode_others, encode_others

    lanes = [np.array(x, "<u4") for x in lanes]
    back = decode_others(encode_others(lanes, n_bytes), np.array([len(x) for x in lanes]), n_bytes)
    assert [x.tolist() for x in back] == [x.tolist() for x in lanes]


def test_damage_in_either_stream_is_an_error():
    rng = np.random.default_rng(4)
    ids = np.where(rng.random(3 * BLOCK) < 0.5, 77, rng.integers(0, 1 << 16, 3 * BLOCK)).astype("<u4")
    data = encode_blocks(ids)
    for at in range(len(data) // 50, len(data), len(data) // 50):
        broken = bytearray(data)
        broken[at] ^= 0x10
        try:
            found = decode_blocks(bytes(broken))
        except ValueError:
            continue
        assert (found == ids).all()  # the last bits of a stream may not matter

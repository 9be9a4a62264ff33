import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from sonalyze.llm import packing
from sonalyze.llm.packing import Mixture, pack

PATH = public_tokenizers.path("byte_bpe_50k.json")


def check(rows, docs, window):
    library = Tokenizer.from_file(PATH)
    got = sorted(rows, key=lambda r: (r.doc_id, r.start))
    for key, _, text, *_ in docs:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        own = [r for r in got if r.doc_id == key]
        at = 0
        for r in own:
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert sorted(by) == list(range(len(by)))
    for w, parts in by.items():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == window or w == len(by) - 1


DOCS = [(i, f"s{i % 3}" if i % 7 else None, f"word{i} and the <|endoftext|> more " * (1 + i * 7 % 40) if i % 5 else None, "x") for i in range(60)]


def test_pieces_fill_windows(spark):
    df = spark.createDataFrame(DOCS, "doc_id long, source string, text string, length string").repartition(3)
    for shares in (None, {"s0": 0.7, "s1": 0.2, "s2": 0.1}):
        check(pack(df, PATH, 64, shares=shares).collect(), DOCS, 64)
    check(pack(df, PATH, 64, most_queues=2).collect(), DOCS, 64)


def test_shares_hold_in_every_window():
    m = Mixture([5000, 3000, 2000], [5, 3, 2], 100)
    taken = np.diff(m.served(np.arange(101)), axis=0)
    assert (taken.sum(1) == 100).all() and abs(taken - [50, 30, 20]).max() <= 1


def test_empty(spark):
    assert pack(spark.createDataFrame([], "doc_id long, source string, text string"), PATH).count() == 0


def test_more_sources_than_queues_keep_their_shares(spark, monkeypatch):
    docs = [(i, f"s{i % 12:02}", f"word{i} and more " * (8 + i % 12), "x") for i in range(96)]
    df = spark.createDataFrame(docs, "doc_id long, source string, text string, length string").repartition(3)
    monkeypatch.setattr(packing, "BLOCK_TOKENS", 500)
    for shares in (None, {"s03": 0.5, "s07": 0.3, "s00": 0.01}):
        served = []
        for most in (1024, 4):
            got = pack(df, PATH, 64, shares=shares, most_queues=most).collect()
            check(got, docs, 64)
            n = np.zeros((1 + max(r.sequence_id for r in got), 12), int)
            for r in got:
                n[r.sequence_id, int(r.source[1:])] += r.length
            served.append(np.cumsum(n, 0))
        assert abs(served[0] - served[1]).max() <= 1


def test_the_query_holds_its_targets_in_every_window(spark):
    from sonalyze.llm.queries import MIXTURE_ALPHA, op6_packing

    got = op6_packing(spark, "/root/testdata/sf0.001").collect()
    sizes, taken = {}, {}
    for r in got:
        sizes[r.source] = sizes.get(r.source, 0) + r.length
        taken.setdefault(r.sequence_id, {})[r.source] = taken.get(r.sequence_id, {}).get(r.source, 0) + r.length
    total, seen = sum(n**MIXTURE_ALPHA for n in sizes.values()), dict.fromkeys(sizes, 0)
    all_open = 0
    for w in sorted(taken):
        for source, n in taken[w].items():
            seen[source] += n
        if any(seen[s] == sizes[s] for s in sizes):
            break
        all_open += 1
        for s, n in sizes.items():  # within a token, carried across windows
            assert abs(seen[s] - 2048 * (w + 1) * n**MIXTURE_ALPHA / total) <= 1.5
    assert all_open > 5 and max(abs(n / sum(sizes.values()) - n**MIXTURE_ALPHA / total) for n in sizes.values()) > 0.01


def test_a_rare_source_is_served_in_bounded_steps(monkeypatch):
    import pyarrow as pa

    mixture = Mixture([1_000_000, 300, 500_000, 40], [1e6, 300, 5e5, 40], 64)
    rows = [(q, at, n) for q, at, n in ((0, 5000, 700), (1, 0, 250), (1, 250, 50), (2, 1000, 1), (3, 0, 40))]
    ids = [np.arange(at, at + n, dtype="<u2").tobytes() for _, at, n in rows]
    batch = pa.RecordBatch.from_arrays([pa.array(range(5), pa.int64()), pa.array(list("abbcd")), pa.array([r[0] for r in rows], pa.int32()), *(pa.array([r[k] for r in rows], pa.int64()) for k in (1, 2)), pa.array([2] * 5, pa.int32()), pa.array(ids, pa.binary())], [f"c{i}" for i in range(7)])
    places = []
    for cells in (1 << 30, 100, 1):
        monkeypatch.setattr(packing, "SERVED", cells)
        found, least = {}, []
        monkeypatch.setattr(mixture, "served", lambda w: (least.append(len(w)), Mixture.served(mixture, w))[1])
        for b in packing.pieces(batch, mixture):
            for doc, start, length, _, _, window, offset, _ in zip(*(c.to_pylist() for c in b.columns)):
                for k in range(length):
                    assert (doc, start + k) not in found
                    found[doc, start + k] = window, offset + k
        places.append(found)
        assert cells > 100 or max(least) <= 64
    assert places[0] == places[1] == places[2] and len(places[0]) == 1041


def test_null_ids(spark):
    df = spark.createDataFrame([(None, None, "a b"), (None, "s", None), (3, "s", "a b"), (3, "s", "a b")], "doc_id long, source string, text string")
    got = pack(df, PATH, 8).collect()
    assert sum(r.length for r in got) == 10 and sum(r.length for r in got if r.doc_id is None) == 4

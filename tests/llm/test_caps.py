import numpy as np
import pytest

from sonalyze.llm import caps


def rows():
    rng = np.random.default_rng(4)
    out = []
    for g in range(40):
        base = rng.standard_normal(16)
        for _ in range(int(rng.integers(1, 12))):
            out.append(((base + rng.standard_normal(16) * rng.choice([0.02, 0.05, 0.08])).astype(np.float32).tolist(), int(g % 3)))
    out += [(out[0][0], out[0][1])] * 3 + [([2 * x for x in out[5][0]], out[5][1])]
    out += [([0.0] * 16, 1), (None, 1), (out[3][0], None), ([float("nan")] * 16, 0), ([None, *[1.0] * 15], 0), ([float("inf"), *[1.0] * 15], 0), ([1.0, 2.0], 0), ([2.0, 4.0], 0), ([], 0)]
    order = rng.permutation(len(out))
    return [(i * 2, *out[k]) for i, k in enumerate(order)]


def brute(data):
    ok = {i: np.array(e, float) for i, e, lab in data if e and lab is not None and None not in e and np.isfinite(e).all() and any(e)}
    label = {i: lab for i, _, lab in data}
    links, parent = {i: 0 for i, *_ in data}, {i: i for i, *_ in data}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    keys = sorted(ok)
    for k, a in enumerate(keys):
        for b in keys[k + 1 :]:
            x, y = ok[a], ok[b]
            if label[a] == label[b] and len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.98:
                links[a] += 1
                links[b] += 1
                lo, hi = sorted((root(a), root(b)))
                parent[hi] = lo
    return {i: (links[i], root(i), root(i) == i) for i in links}


@pytest.mark.parametrize("tile", [1024, 3])
def test_against_brute_force(spark, monkeypatch, tile):
    monkeypatch.setattr(caps, "TILE_ROWS", tile)
    data = rows()
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>, label int").selectExpr("*", "1 filter", "'x' rep").repartition(3)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in caps.similar_vectors(df).collect()}
    want = brute(data)
    assert set(got) == set(want) and all(got[k][0] <= want[k][0] for k in want)
    assert sum(v[0] for v in got.values()) >= 0.99 * sum(v[0] for v in want.values())
    assert sum(got[k] == want[k] for k in want) >= 0.97 * len(want)


def test_null_ids_and_no_rows(spark):
    df = spark.createDataFrame([(None, [1.0, 0.0], 1), (4, [1.0, 0.0], 1), (4, [1.0, 0.0], 1)], "vec_id long, embedding array<float>, label int")
    assert sorted((r.vec_id or 0, r.n_links, r.component_id, r.kept) for r in caps.similar_vectors(df).collect()) == [(0, 2, None, True), (4, 2, None, False), (4, 2, None, False)]
    assert caps.similar_vectors(df.limit(0)).count() == 0


def pairs_at(rng, n, dim, cosine):
    x = rng.standard_normal((n, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = rng.standard_normal((n, dim))
    y -= (x * y).sum(1, keepdims=True) * x
    return x, cosine * x + np.sqrt(1 - cosine**2) * y / np.linalg.norm(y, axis=1, keepdims=True)


@pytest.mark.parametrize("dim, words, n, least", [(16, 112, 1000, 0.98), (64, 112, 1000, 0.98), (768, 112, 500, 0.98), (16, 1732, 300, 0.9), (64, 1732, 300, 0.95), (768, 1732, 200, 0.95), (64, 16384, 60, 0.85)])
def test_recall_at_the_threshold(dim, words, n, least):
    x, y = pairs_at(np.random.default_rng(1), n, dim, 0.98)
    code = caps.Code(dim, words)
    one, two = list(code.decode(x)), list(code.decode(y))
    assert np.mean([len(np.intersect1d(a, b)) > 0 for a, b in zip(one, two)]) > least
    sizes = [len(a) for a in one]
    assert 6 <= np.mean(sizes) < 30 and np.mean(np.array(sizes) > caps.LEAST_FILTERS) > 0.2  # caps, no nearest words
    scores, right = code.scores(x[:10])
    for k in range(10 if words < 2000 else 0):
        want = np.flatnonzero((scores[k][:, None] + right[k]).ravel() >= code.height)
        assert len(want) < caps.LEAST_FILTERS or one[k].tolist() == want.tolist()


@pytest.mark.parametrize("dim, words", [(2, 16384), (8, 1732), (8, 16384), (16, 5477), (16, 16384), (64, 5477), (64, 16384), (768, 5477)])
def test_recall_holds_at_every_size(dim, words):
    """Pairs that the calibration hasn't seen."""
    x, y = pairs_at(np.random.default_rng(11), 200, dim, 0.98)
    code = caps.Code.fitting(dim, words, 0.98)
    assert code.recall(x, y) >= 0.9 and LEAST <= code.words <= words
    assert np.mean([len(a) for a in code.decode(x[:50])]) < 80


LEAST = caps.LEAST_WORDS


def test_common_before():
    import pyarrow as pa

    rng = np.random.default_rng(5)
    lists = [sorted(rng.choice(30, rng.integers(0, 9), replace=False).tolist()) for _ in range(40)]
    i, j = np.nonzero(np.triu(np.ones((40, 40)), 1))
    for f in (0, 7, 30):
        want = [bool({x for x in lists[a] if x < f} & {*lists[b]}) for a, b in zip(i, j)]
        assert caps.common_before(pa.array([[], *lists], pa.list_(pa.int32())).slice(1), f, i, j).tolist() == want


def test_vectors_of_doubles_and_ids_that_repeat(spark):
    a, b = [1.0, 1e200, 0.0], [1.0, 1e200, 1e199]
    df = spark.createDataFrame([(4, a, "x"), (4, b, "x"), (4, [3.0, 0.0, 0.0], "x"), (9, b, "y"), (7, [2.0, 2e200, 0.0], "x")], "vec_id long, embedding array<double>, label string")
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in caps.similar_vectors(df).collect())
    assert got == [(4, 0, 4), (4, 2, 4), (4, 2, 4), (7, 2, 4), (9, 0, 9)]

"""Near-duplicate vectors by spherical-cap filters.

The filters are the words of a structured random product code: after a fixed rotation a vector's two
halves are scored against one random code each, and a filter is a pair of half words, whose score is the
sum. A list decoder gives each vector all filters whose score exceeds the cap's height, without scoring
all pairs, and at least its best few. The height is calibrated on random vectors so that they have MEAN_FILTERS on average, or
as many more as it takes until RECALL of random pairs at the threshold share a filter, whatever the dimension and the number of
words. Where none of these means is enough, the code has fewer words. Vectors that share a filter are compared exactly, in
double precision.

Filters are joined by the vectors' ids; the vectors follow only into filters that hold two or more. A pair
counts in the first filter that both have, so n_links is exact for the pairs found, and of the links within a
filter only a spanning forest leaves the task. Large filters are dealt out as pairs of tiles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sonalyze.llm import text as X
from sonalyze.llm.components import components
from sonalyze.llm.shared import n_buckets, stored

#: Filters a vector has on average, of which the first that is enough is taken, and at least; vectors a filter is made for; rows of a tile.
MEAN_FILTERS, LEAST_FILTERS, FILTER_ROWS, TILE_ROWS = (10, 14, 20, 28, 40), 6, 64, 1024
MOST_WORDS, LEAST_WORDS = 1 << 14, 8
#: Random vectors on whose scores a cap's height is calibrated; random pairs at the threshold, and the part of them that must share a filter.
SAMPLE, PAIRS, RECALL = 48, 256, 0.96
#: Bytes of rows that a part is made for, at most.
PART_BYTES = 64 << 20
SALTS, BRANCHES = 16, 4
#: row tells classes apart whose least vec_id is the same. vector: the components as they are given, in 4 or 8 bytes each; filters: sorted.
ROWS = "label string, dim int, rep long, row long, copies long, vector binary, filters array<int>"
FOUND = "rep long, row long, links long, other long"


class Code:
    """The product code for vectors of one dimension, with caps of a height at which a vector has `mean` filters."""

    def __init__(self, dim: int, words: int, height: float | None = None, seed: int = 7, mean: int = MEAN_FILTERS[0]):
        rng = np.random.default_rng(seed)
        self.rotation = np.linalg.qr(rng.standard_normal((dim, dim)))[0] if dim > 1 else np.eye(1)
        self.cut, self.words, self.mean = (dim + 1) // 2, words, mean
        halves = [rng.standard_normal((words, max(n, 1))) for n in (self.cut, dim - self.cut)]
        self.halves = [h / np.linalg.norm(h, axis=1, keepdims=True) / np.sqrt(2) for h in halves]
        self.height = self.calibrated(rng.standard_normal((SAMPLE, dim)), mean) if height is None else height

    @staticmethod
    def fitting(dim: int, words: int, least: float) -> Code:
        """The code of at most so many words, and the least mean, by which RECALL of the pairs whose cosine is `least` share a filter."""
        x, y = random_pairs(np.random.default_rng(3), dim, least)
        words = min(words, LEAST_WORDS << min(dim, 16))  # few dimensions have no room for more
        while True:
            for mean in MEAN_FILTERS:
                code = Code(dim, words, mean=mean)
                if code.recall(x[:32], y[:32]) >= RECALL - 0.1 and code.recall(x, y) >= RECALL:
                    return code
            if words <= LEAST_WORDS:
                return code
            words = max(LEAST_WORDS, words // 2)

    def recall(self, x: np.ndarray, y: np.ndarray) -> float:
        step = max(16, (1 << 22) // self.words)
        shared = [len(np.intersect1d(a, b, assume_unique=True)) > 0 for lo in range(0, len(x), step) for a, b in zip(self.decode(x[lo : lo + step]), self.decode(y[lo : lo + step]))]
        return float(np.mean(shared))

    def scores(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x = unit @ self.rotation
        right = x[:, self.cut :] if x.shape[1] > self.cut else np.zeros((len(x), 1))
        return x[:, : self.cut] @ self.halves[0].T, right @ self.halves[1].T

    def calibrated(self, sample: np.ndarray, wanted: int) -> float:
        one, two = self.scores(sample / np.linalg.norm(sample, axis=1, keepdims=True))
        two.sort(1)
        low, high = -2.0, 2.0
        for _ in range(40):
            middle = (low + high) / 2
            mean = np.mean([(self.words - np.searchsorted(b, middle - a)).sum() for a, b in zip(one, two)])
            low, high = (middle, high) if mean > wanted else (low, middle)
        return high

    def decode(self, unit: np.ndarray) -> Iterator[np.ndarray]:
        """Each vector's filters, sorted."""
        one, two = self.scores(unit)
        by = np.argsort(-two, axis=1)
        two = -np.take_along_axis(two, by, 1)
        for i in range(len(unit)):
            found = self.above(one[i], two[i], by[i], self.height)
            if len(found) < LEAST_FILTERS:
                best = np.argsort(-one[i])[:LEAST_FILTERS]
                scores = one[i][best][:, None] - two[i][:LEAST_FILTERS]
                top = np.argsort(-scores.ravel(), kind="stable")[:LEAST_FILTERS]
                found = best[top // scores.shape[1]] * self.words + by[i][top % scores.shape[1]]
            yield np.sort(found).astype(np.int32)

    def above(self, one: np.ndarray, two: np.ndarray, by: np.ndarray, height: float) -> np.ndarray:
        left = np.flatnonzero(one - two[0] >= height)
        count = np.searchsorted(two, one[left] - height, "right")
        begin = np.cumsum(count) - count
        return np.repeat(left, count) * self.words + by[np.arange(count.sum()) - np.repeat(begin, count)]


def random_pairs(rng: np.random.Generator, dim: int, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors, and others of this cosine with them."""
    x = unit(rng.standard_normal((PAIRS, dim)))
    if dim == 1:
        return x, x
    y = rng.standard_normal((PAIRS, dim))
    y -= (x * y).sum(1, keepdims=True) * x
    return x, cosine * x + np.sqrt(max(0.0, 1 - cosine**2)) * unit(y)


def similar_vectors(vectors: DataFrame, least: float = 0.98) -> DataFrame:
    """vec_id, n_links, component_id, kept for each row of vectors (vec_id, embedding, label).

    Vectors link when their labels are equal, their dimensions are equal and their cosine is at least
    `least`. A null label, a null or zero vector, and a vector with a null or non-finite component link with
    nothing. Equal vectors of a label are one class with as many copies; all of them link. A null vec_id
    comes before all others (component_id is null in its component, and kept is true for it). Rows that
    share a vec_id are one vertex of the component and a link each. An empty table gives no rows.
    """
    spark, given = vectors.sparkSession, vectors.schema["embedding"].dataType.simpleString()
    size = 4 if given == "array<float>" else 8
    own = vectors.select(F.coalesce(F.col("vec_id").cast("long"), F.lit(X.NULL_ID)).alias("vec_id"), F.col("embedding").cast(f"array<{'float' if size == 4 else 'double'}>").alias("embedding"), F.col("label").cast("string").alias("label"))
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    sound = F.col("label").isNotNull() & F.coalesce(F.forall("embedding", finite) & F.exists("embedding", lambda x: x != 0), F.lit(False))
    classes = stored(own.where(sound).groupBy("label", "embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies")), "caps-classes")
    sizes = classes.groupBy("label", F.size("embedding").alias("dim")).count().groupBy("dim").agg(F.max("count").alias("n"), F.count("*").alias("labels")).collect()
    codes = {r["dim"]: Code.fitting(r["dim"], int(min(MOST_WORDS, max(LEAST_WORDS, (r["n"] * MEAN_FILTERS[0] / FILTER_ROWS) ** 0.5))), least) for r in sizes}
    words, heights, means = ({dim: getattr(c, name) for dim, c in codes.items()} for name in ("words", "height", "mean"))
    del codes

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes: dict[int, Code] = {}
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                flat, vector, filters = part.column(1), [b""] * part.num_rows, [None] * part.num_rows
                dims = np.diff(np.asarray(flat.offsets))
                for d in np.unique(dims):
                    rows = np.flatnonzero(dims == d)
                    x = np.stack([flat[int(i)].values.to_numpy() for i in rows])
                    code = codes.setdefault(int(d), Code(int(d), words[int(d)], heights[int(d)]))
                    for i, v, own in zip(rows.tolist(), x, code.decode(unit(x))):
                        vector[i], filters[i] = v.tobytes(), own
                columns = [part.column(0), pa.array(dims, pa.int32()), part.column(2), part.column(3), part.column(4), pa.array(vector, pa.binary()), pa.array(filters, pa.list_(pa.int32()))]
                yield pa.RecordBatch.from_arrays(columns, ROWS.replace(",", "").split()[::2])

    rows = stored(classes.select("label", "embedding", "rep", F.xxhash64("embedding").alias("row"), "copies").mapInArrow(decoded, ROWS), "caps-rows")
    ids = rows.select("label", "dim", "rep", "row", F.explode("filters").alias("filter"))
    full = ids.groupBy("label", "dim", "filter").count().where("count > 1").withColumn("tiles", F.ceil(F.col("count") / TILE_ROWS).cast("int")).drop("count")
    full = full.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt"))
    ids = ids.withColumn("salt", F.pmod(F.xxhash64("rep", "row"), F.lit(SALTS))).join(full, ["label", "dim", "filter", "salt"]).withColumn("tile", F.pmod(F.xxhash64("rep", "row", "filter"), F.col("tiles")).cast("int"))
    # an id goes to the pairs of tiles (a, b), a <= b, that its own tile is in
    with_ = F.transform(F.sequence(F.lit(0), F.col("tiles") - 1), lambda t: F.struct(F.least(t, F.col("tile")).alias("a"), F.greatest(t, F.col("tile")).alias("b")))
    places = ids.groupBy("label", "dim", "rep", "row").agg(F.collect_list(F.struct("filter", "tiles", "tile")).alias("places"))
    dealt = rows.join(places, ["label", "dim", "rep", "row"]).select("label", "dim", "rep", "row", "copies", "vector", "filters", F.inline("places"))
    dealt = dealt.select("label", "dim", "rep", "row", "copies", "vector", "filters", "filter", "tile", F.inline(with_))
    parts = 4 * n_buckets(spark, sum(r["n"] * r["labels"] * means[r["dim"]] * (size * r["dim"] + 4 * means[r["dim"]]) for r in sizes), PART_BYTES)

    def linked(table: pa.Table) -> pa.Table:
        out: list[list[np.ndarray]] = [[], [], [], []]
        keys = table.select(["label", "dim", "filter", "a", "b"]).to_pandas()
        groups = keys.groupby(["label", "dim", "filter", "a", "b"], sort=False).indices
        rep, row, copies, tile = (table.column(c).to_numpy() for c in ("rep", "row", "copies", "tile"))
        vectors, filters = X.plain(table.column("vector")), X.plain(table.column("filters"))
        for (_, _, f, a, b), at in groups.items():
            if len(at) < 2:
                continue
            x = unit(np.frombuffer(b"".join(vectors[i].as_buffer() for i in at.tolist()), "<f4" if size == 4 else "<f8").reshape(len(at), -1))
            i, j = np.nonzero(np.triu(x @ x.T >= least, 1))
            if a != b:
                across = tile[at[i]] != tile[at[j]]
                i, j = i[across], j[across]
            if not len(i):
                continue
            member, branch = forest(i, j, len(at))
            for o, v in zip(out, (rep[at[member]], row[at[member]], np.zeros(len(member), np.int64), rep[at[branch]])):
                o.append(v)
            # of the links, those whose first common filter this is
            new = ~common_before(filters.take(pa.array(at)), f, i, j)
            i, j = i[new], j[new]
            counts = np.bincount(i, copies[at[j]], len(at)) + np.bincount(j, copies[at[i]], len(at))
            some = np.flatnonzero(counts)
            for o, v in zip(out, (rep[at[some]], row[at[some]], counts[some].astype(np.int64), rep[at[some]])):
                o.append(v)
        return pa.table([np.concatenate([np.empty(0, np.int64), *o]) for o in out], ["rep", "row", "links", "other"])

    key = F.pmod(F.xxhash64("label", "dim", "filter", "a", "b"), F.lit(parts))
    found = stored(dealt.groupBy(key).applyInArrow(linked, FOUND), "caps-links")
    counts = found.groupBy("rep", "row").agg(F.sum("links").alias("links"))
    labels = components(found.where("rep <> other").select(F.col("rep").alias("a"), F.col("other").alias("b")))
    known = classes.withColumn("row", F.xxhash64("embedding")).join(counts, ["rep", "row"], "left").join(labels.withColumnRenamed("id", "rep"), "rep", "left")
    known = known.select("label", "embedding", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "rep").alias("c"))
    out = own.join(known, ["label", "embedding"], "left")
    c = F.coalesce("c", "vec_id")
    null = F.lit(X.NULL_ID)
    return out.select(F.nullif("vec_id", null).alias("vec_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"), F.nullif(c, null).alias("component_id"), (F.col("vec_id") == c).alias("kept"))


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length one, in double precision; scaled first, so that no square overflows."""
    x = x.astype(np.float64)
    x /= np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def common_before(filters: pa.ListArray, f: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether the rows i and j have a filter below f in common. Lists are sorted; one is looked up in the other,
    place by place, so memory follows the pairs."""
    flat, offsets = filters.values.to_numpy().astype(np.int64), np.asarray(filters.offsets).astype(np.int64)
    row = np.repeat(np.arange(len(filters)), np.diff(offsets))
    lower = flat < f
    n = np.bincount(row[lower], minlength=len(filters))
    begin = np.cumsum(n) - n
    code = (row[lower] << 32) | flat[lower]
    out = np.zeros(len(i), bool)
    for k in range(int(n[i].max(initial=0))):
        open_ = np.flatnonzero(~out & (n[i] > k))
        wanted = (j[open_] << 32) | (code[begin[i[open_]] + k] & 0xFFFFFFFF)
        at = np.minimum(np.searchsorted(code, wanted), len(code) - 1)
        out[open_] = code[at] == wanted
    return out


def forest(i: np.ndarray, j: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that span the same components, as trees of few branches a member, so that none is in many links."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    by = np.argsort(label, kind="stable")
    edges = X.group_starts(label[by])
    first = np.repeat(edges[:-1], np.diff(edges))
    place = np.arange(n) - first
    own = np.flatnonzero(place > 0)
    return by[own], by[first[own] + (place[own] - 1) // BRANCHES]

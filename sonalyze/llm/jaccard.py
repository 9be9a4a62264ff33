"""Groups of documents with similar sets of word n-grams, found exactly.

1. A count-min sketch of all n-grams, dealt by range of cells, tells each block of texts which of its n-grams may
   be in two documents, and in about how many. A document links only if three quarters (the threshold) of its
   n-grams are shared, so all others are set apart.
2. Equal sets are one class, and only its first row goes on.
3. Prefix filter over the global order (rarest first, by the sketch): two similar sets share an n-gram of their
   first n - ceil(t n) + 1, at places that leave room for the overlap they need.
4. Candidate pairs are counted by vertical partitioning: the order of the n-grams' hashes is cut into
   fragments, each fragment's overlap of a pair is counted by itself, and the counts are summed per pair.

Large groups of near copies make no square of pairs: two rounds link sets to one leader for each shared
n-gram; after them only pairs that aren't known to be connected remain, and all of those are counted, those of a
frequent n-gram dealt out as pairs of tiles. Joins on n-grams and on sets are salted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sonalyze.llm import text as X
from sonalyze.llm.components import components
from sonalyze.llm.shared import cut, discard, stored
from sonalyze.llm.sketch import Blocks, Sketch, text_bytes

FRAGMENTS, SALTS = 8, 16
#: Bytes of text of a block, whose sets a task holds; sets of one n-gram that a task pairs.
BLOCK_BYTES = 4 << 20
TILE_ROWS = 500
SETS = "doc_id long, row long, n long, s1 long, s2 long, before int, prefix array<long>, grams array<long>"


def shingle_sets(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct hashes of each text's shingles; with fewer words, of the whole sequence."""
    for c in X.chunks(column):
        w = X.words(c, lower=True)
        grams = X.windows(w.codes, size, X.BASE_WORD)
        for i in range(c.n):
            a, b = int(w.bounds[i]), int(w.bounds[i + 1])
            if b - a >= size:
                found = np.sort(grams[a : b - size + 1])
                yield found[np.append(True, found[1:] != found[:-1])]
            elif b > a:
                yield X.mix(X.windows(w.codes[a:b], b - a, X.BASE_ALT) + np.uint64(b - a))
            else:
                yield np.empty(0, np.uint64)


def similar_sets(docs: DataFrame, size: int, percent: int, max_bits: int) -> DataFrame:
    """A row for each document, by which row differs from others (row). Where it may link and is the first of its set
    in its block, its n-grams by hash (grams) and its prefix, which begins behind `before` n-grams of its own."""
    n_bytes = text_bytes(docs)
    blocks = Blocks(docs.select("doc_id", "text"), n_bytes, BLOCK_BYTES)

    def keys(column: pa.Array) -> np.ndarray:
        return np.concatenate([np.empty(0, np.uint64), *shingle_sets(column, size)])

    sketch = Sketch(blocks, keys, n_bytes // 6, max_bits=max_bits)

    def run(key: tuple, table: pa.Table, answers: pa.Table) -> pa.Table:
        X.trim()
        (ids, texts), number, repeats = blocks.distinct(table), blocks.ranks(table)[1], sketch.heard(answers)
        begun, sent, out = key[0].as_py() << 32, set(), []
        for i, found in enumerate(shingle_sets(texts, size)):
            s1, s2 = (int(X.mix(found ^ np.uint64(base)).sum(dtype=np.uint64)) for base in (X.BASE_BYTE, X.BASE_ALT))
            n, before, prefix, grams = len(found), None, None, None
            if n and (s1, s2) not in sent:
                level = repeats.level(found)
                shared = int((level > 0).sum())
                if 100 * shared >= percent * n:
                    sent.add((s1, s2))
                    order = np.argsort(level, kind="stable")  # by count and hash; what occurs once comes first
                    before = n - shared
                    prefix, grams = found[order[before : n - -(-n * percent // 100) + 1]].view(np.int64), found.view(np.int64)
            out.append((int(ids[i]), begun + i, n, s1 - (s1 >> 63 << 64), s2 - (s2 >> 63 << 64), before, prefix, grams))
        held = {i: out[i] for i in range(len(out))}
        rows, seen = [], set()
        for i in number.tolist():  # equal rows: the first alone has n-grams
            rows.append(held[i] if i not in seen else (*held[i][:5], None, None, None))
            seen.add(i)
        columns = list(zip(*rows))
        kinds = [*[pa.int64()] * 5, pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64())]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], SETS.replace(",", "").split()[::2])

    return blocks.grouped().cogroup(sketch.answers().groupBy("block")).applyInArrow(run, SETS)


def counted(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of pairs (a, b, na, nb), those that are similar: overlaps by fragment, summed per pair."""
    needed = pairs.select(F.explode(F.array("a", "b")).alias("v"))
    split = F.transform(F.sequence(F.lit(0), F.lit(FRAGMENTS - 1)), lambda f: F.struct(f.alias("fragment"), F.filter("grams", lambda g: F.shiftrightunsigned(g, 61) == f).alias("part")))
    pieces = sets.select("v", "grams").join(needed, "v", "left_semi").select("v", F.inline(split)).where(F.size("part") > 0)
    # leaders, which are in very many pairs, are b: those pairs are dealt by fragment too
    a = pieces.select(F.col("v").alias("a"), "fragment", F.col("part").alias("part_a"))
    b = pieces.select(F.col("v").alias("b"), "fragment", F.col("part").alias("part_b"))
    overlaps = pairs.join(a, "a").join(b, ["b", "fragment"]).select("a", "b", "na", "nb", F.size(F.array_intersect("part_a", "part_b")).alias("shared"))
    common = F.col("shared")
    return overlaps.groupBy("a", "b", "na", "nb").agg(F.sum("shared").alias("shared")).where(100 * common >= percent * (F.col("na") + F.col("nb") - common)).select("a", "b")


def candidates(prefixes: DataFrame, labels: DataFrame | None, percent: int, last: bool) -> DataFrame:
    """Pairs (a, b, na, nb, low, high) of sets in different components that share an n-gram early enough: with the leader (b) of
    each n-gram, or, in the last round, with all."""
    # a similar pair shares at least `common` n-grams, so the first they share stands this early in both
    common = F.ceil(percent * (F.col("na") + F.col("nb")) / (100 + percent))
    fits = (100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")) & (F.col("pa") <= F.col("na") - common + 1) & (F.col("pb") <= F.col("nb") - common + 1)
    labelled = prefixes.withColumn("component", F.col("v"))
    if labels is not None:
        labelled = prefixes.join(labels.withColumnRenamed("id", "v"), "v", "left").withColumn("component", F.coalesce("component", "v"))
    mixed = labelled.groupBy("g").agg(F.min(F.struct("component", "at", "v", "n")).alias("lead"), F.max("component").alias("most"), F.ceil(F.count("*") / TILE_ROWS).cast("int").alias("tiles")).where("lead.component <> most")
    salted = labelled.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)))
    mixed = mixed.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt"))
    open_ = salted.join(mixed, ["g", "salt"])
    if last:
        # a row goes to the pairs of tiles (s, t), s <= t, that its own tile is in
        tiled = open_.withColumn("own", F.pmod(F.xxhash64("v", F.lit(1)), F.col("tiles")).cast("int"))
        tiled = tiled.select("g", "v", "n", "component", "at", "own", F.inline(F.transform(F.sequence(F.lit(0), F.col("tiles") - 1), lambda t: F.struct(F.least(t, "own").alias("s"), F.greatest(t, "own").alias("t")))))
        other = tiled.selectExpr("g", "s", "t", "v b", "n nb", "component cb", "at pb", "own ob")
        both = tiled.selectExpr("g", "s", "t", "v a", "n na", "component ca", "at pa", "own oa").join(other, ["g", "s", "t"])
        pairs = both.where(F.expr("a < b AND ca <> cb AND (s = t OR oa <> ob)") & fits)
    else:
        pairs = open_.where("component <> lead.component").selectExpr("v a", "n na", "at pa", "lead.v b", "lead.n nb", "lead.at pb").where(fits)
    return pairs.select("a", "b", "na", "nb", F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high")).dropDuplicates(["low", "high"])


def similar_groups(docs: DataFrame, size: int = 5, percent: int = 75, max_bits: int = 62) -> DataFrame:
    """doc_id, n_shingles and component_id: the least doc_id reachable by links, itself included.

    docs has doc_id and text; other columns are not read. Words are lower-cased A-Z. Two documents link
    when 100 * shared shingles >= percent * all their shingles. A null or empty text, or one without
    words, has no shingle and links with nothing. Repeated rows give a row each; rows of one doc_id with different
    texts are different documents of that name. A null doc_id comes before all others, so component_id is null
    in its group. Any number of equal or similar documents is linked, without caps.
    """
    spark = docs.sparkSession
    full = stored(similar_sets(docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(X.NULL_ID)).alias("doc_id"), "text"), size, percent, max_bits), "jaccard-sets")
    lead = F.min(F.struct("doc_id", "row")).alias("lead")
    classes = cut(full.where("n > 0").groupBy("s1", "s2").agg(lead, F.count("*").alias("copies")).select("s1", "s2", F.col("lead.doc_id").alias("least"), F.col("lead.row").alias("v"), "copies"))
    sets = stored(full.where("grams IS NOT NULL").select(F.col("row").alias("v"), "n", "before", "prefix", "grams").join(classes.select("v"), "v", "left_semi"), "jaccard-live")
    documents = stored(full.select("doc_id", "n", "s1", "s2"), "jaccard-documents")
    discard(full)
    prefixes = sets.select("v", "n", "before", F.posexplode("prefix").alias("i", "g")).select("v", "n", "g", (F.col("before") + F.col("i") + 1).alias("at"))

    none = spark.createDataFrame([], "a long, b long")
    links, tested, labels = none, None, None
    for turn in range(3):
        pairs = candidates(prefixes, labels, percent, turn == 2)
        pairs = cut(pairs if tested is None else pairs.join(tested, ["low", "high"], "left_anti"))
        if pairs.isEmpty():
            continue
        own = pairs.select("low", "high")
        tested = own if tested is None else tested.union(own)
        new = cut(counted(pairs, sets, percent))
        if turn == 2 and new.isEmpty():
            continue
        links = links.union(new)
        labels = components(links, 1 if turn == 0 else None)
    labels = spark.createDataFrame([], "id long, component long") if labels is None else labels

    # the least doc_id of a component is that of one of its classes
    named = labels.join(classes.select(F.col("v").alias("id"), "least"), "id")
    named = named.join(named.groupBy("component").agg(F.min("least").alias("component_id")), "component").select(F.col("id").alias("v"), "component_id")
    moved = classes.join(named, "v", "left").where("copies > 1 OR component_id IS NOT NULL").select("s1", "s2", F.coalesce("component_id", "least").alias("component_id"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt"))
    found = documents.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))).join(moved, ["s1", "s2", "salt"], "left")
    null = F.lit(X.NULL_ID)
    return found.select(F.nullif("doc_id", null).alias("doc_id"), F.col("n").alias("n_shingles"), F.nullif(F.coalesce("component_id", "doc_id"), null).alias("component_id"))

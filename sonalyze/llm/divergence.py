"""How the words of a language's sources differ: each source from each other, and from the language.

Partitions count terms in radix tries whose leaves have a counter for each source. Subtries are dealt by range of
their prefixes, and those of a range merge into one trie, of which terms in enough documents of a language stay. Walks of
these in UTF-8 order give each pair of sources its sum of differences, and each source its best terms, of equal ones the
first; sums and bests of walks are put together by grouping.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sonalyze.llm.shared import freed, ship, stored
from sonalyze.llm.text import LOWER, buffers, chunks, tidied
from sonalyze.llm.tries import Trie, by_prefix

#: Bytes of text that are counted at once, leaves that a task holds before it gives them away, terms of a walk's step.
TEXT_BYTES, LEAVES, STEP = 4 << 20, 1 << 18, 4096
#: Parts of probabilities, what is added to each count, and the fewest documents of a term.
PARTS, EXTRA, LEAST_DOCS = 10**9, 5, 30
TERM_BYTE = np.zeros(256, bool)
TERM_BYTE[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
WALKS = pa.schema([("lang_id", pa.int64()), ("terms", pa.list_(pa.binary())), ("sizes", pa.list_(pa.int32())), ("groups", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64()))])


def terms_of(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The terms of texts, and the text of each: runs of letters A-Z and all characters beyond ASCII, A-Z lower-cased."""
    solid = TERM_BYTE[data]
    begin, end = solid.copy(), solid.copy()
    begin[1:] &= ~solid[:-1]
    end[:-1] &= ~solid[1:]
    inner = offsets[:-1][offsets[:-1] < len(data)]
    begin[inner] = solid[inner]
    last = offsets[1:][offsets[1:] > 0] - 1
    end[last] = solid[last]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    places = np.append(0, np.cumsum(ends - starts)).astype(np.int32)
    tokens = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(places.tobytes()), pa.py_buffer(LOWER[data[solid]].tobytes())])
    return tokens, np.searchsorted(offsets, starts, "right") - 1


def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of subtries of (lang_id, group_id, text)."""
    held: list[Trie] = []
    for batch in batches:
        lang, group = (np.asarray(batch.column(c)) for c in ("lang_id", "group_id"))
        for chunk in chunks(batch.column("text"), TEXT_BYTES):
            rows = slice(chunk.first, chunk.first + chunk.n)
            held.append(Trie.counted(*terms_of(chunk.data, chunk.offsets), lang[rows], group[rows]))
            if sum(map(len, held)) >= 2 * LEAVES:
                held = [Trie.merged(held)]
                if len(held[0]) >= LEAVES:
                    yield held.pop().subtries()
    if held:
        yield Trie.merged(held).subtries()


def kept_terms(least: int):
    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Steps of the walk of each language's terms, in order, that are in enough documents."""
        for trie in by_prefix(batches, LEAVES):
            for lang in np.unique(trie.lang).tolist():
                own = trie.lang == lang
                docs = np.zeros(len(trie), np.int64)
                np.add.at(docs, trie.leaf[own], trie.docs[own])
                keep = np.flatnonzero(docs >= least)
                own &= docs[trie.leaf] >= least
                leaf, group, n = trie.leaf[own], trie.group[own], trie.n[own]
                for at in range(0, len(keep), STEP):
                    leaves = keep[at : at + STEP]
                    lo, hi = np.searchsorted(leaf, [leaves[0], leaves[-1] + 1])
                    sizes = np.bincount(np.searchsorted(leaves, leaf[lo:hi]), minlength=len(leaves))
                    row = [pa.array([lang]), pa.array([trie.terms.take(pa.array(leaves)).to_pylist()], pa.list_(pa.binary())), pa.array([sizes], pa.list_(pa.int32())), pa.array([group[lo:hi]], pa.list_(pa.int64())), pa.array([n[lo:hi]], pa.list_(pa.int64()))]
                    yield pa.RecordBatch.from_arrays(row, schema=WALKS)

    return merge


def shares(counts: np.ndarray, totals: np.ndarray, n_terms: int) -> np.ndarray:
    """1 + floor(PARTS * (count + EXTRA) / (total + EXTRA * n_terms)), in whole numbers: three digits at a time, so that
    no product leaves 63 bits."""
    over = totals + EXTRA * n_terms
    out, left = np.divmod(counts + EXTRA, over)
    for _ in range(3):
        more, left = np.divmod(left * 1000, over)
        out = out * 1000 + more
    return out + 1


FOUND = pa.schema([("lang", pa.string()), ("source", pa.string()), ("part", pa.string()), ("item", pa.string()), ("value", pa.int64())])


def compared(top: int):
    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of each step of a walk: what it adds to each pair of sources, the first of which is the lesser in order, and the
        best terms of each source."""
        for batch in batches:
            for row in batch.to_pylist():
                groups, totals = np.array([s["group_id"] for s in row["sources"]]), np.array([s["total"] for s in row["sources"]])
                names = [s["source"] for s in row["sources"]]
                order = np.argsort(groups)
                column = order[np.searchsorted(groups, row["groups"], sorter=order)]
                line = np.repeat(np.arange(len(row["terms"])), row["sizes"])
                counts = np.array(row["counts"])
                sums = np.zeros(len(row["terms"]), np.int64)
                np.add.at(sums, line, counts)
                q = shares(sums, totals.sum(), row["n_terms"])
                none = shares(np.zeros(len(names), np.int64), totals, row["n_terms"])
                p = shares(counts, totals[column], row["n_terms"])
                above = p - q[line]
                for c in np.unique(column[above > 0]).tolist():
                    mine = np.flatnonzero((column == c) & (above > 0))
                    best = mine[np.argsort(-above[mine], kind="stable")[:top]]
                    yield pa.RecordBatch.from_arrays([pa.array([row["lang"]] * len(best)), pa.array([names[c]] * len(best)), pa.array(["term"] * len(best)), pa.array([row["terms"][i].decode() for i in line[best]]), pa.array(above[best])], schema=FOUND)
                wide = max(1, (1 << 22) // max(len(names), 1))  # terms at once
                value = {a: np.zeros(len(names) - a - 1, np.int64) for a in range(len(names) - 1)}
                for lo in range(0, len(row["terms"]), wide):
                    table = np.tile(none, (min(wide, len(row["terms"]) - lo), 1))
                    own = (line >= lo) & (line < lo + wide)
                    table[line[own] - lo, column[own]] = p[own]
                    for a in value:
                        value[a] += np.abs(table[:, a + 1 :] - table[:, a : a + 1]).sum(0)
                for a, v in value.items():
                    yield pa.RecordBatch.from_arrays([pa.array([row["lang"]] * len(v)), pa.array([names[a]] * len(v)), pa.array(["pair"] * len(v)), pa.array(names[a + 1 :]), pa.array(v)], schema=FOUND)

    return walk


def divergence(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = 50) -> DataFrame:
    """lang, source, part, item, value, rank. Part pair: how far a source of a language is from each other one (item), the sum
    over the language's kept terms of the difference of their shares in billionths. Part term: the `top` kept terms (item)
    that a source has and that exceed their share of the language the most, by how much.

    docs has text, lang and source, null as ''; other columns are not read. Each row is a document. A kept term is in
    `least_docs` documents of its language. A language without kept terms has pairs of value 0 and no terms; a source
    alone in its language has no pairs. Shares have EXTRA added to each count. Equal values are ranked by the UTF-8 order of
    their items. An empty table gives no rows. The result has a row for each pair of sources of a language, so a language's
    sources are held as one array.
    """
    spark = docs.sparkSession
    ship(spark)
    named = docs.select(F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source"), "text")
    lang_id, group_id = F.xxhash64("lang"), F.xxhash64("lang", F.lit(0), "source")
    tries = named.select(lang_id.alias("lang_id"), group_id.alias("group_id"), "text").mapInArrow(tidied(counted), "prefix binary, labels binary, shape binary, counters binary")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    walks = tries.repartitionByRange(parts, "prefix").sortWithinPartitions("prefix").mapInArrow(tidied(kept_terms(least_docs)), "lang_id long, terms array<binary>, sizes array<int>, groups array<long>, counts array<long>")
    walks = stored(walks, "divergence-walks")
    counts = walks.select(F.explode(F.arrays_zip("groups", "counts")).alias("x")).groupBy(F.col("x.groups").alias("group_id")).agg(F.sum("x.counts").alias("total"))
    n_terms = walks.groupBy("lang_id").agg(F.sum(F.size("terms")).cast("long").alias("n_terms"))
    groups = named.select("lang", "source").distinct().select(lang_id.alias("lang_id"), group_id.alias("group_id"), "lang", "source")
    groups = groups.join(counts, "group_id", "left").select("lang_id", "lang", F.struct("source", "group_id", F.coalesce("total", F.lit(0)).cast("long").alias("total")).alias("s"))
    langs = groups.groupBy("lang_id").agg(F.min("lang").alias("lang"), F.max("lang").alias("other"), F.sort_array(F.collect_list("s")).alias("sources"), F.count_distinct("s.group_id").alias("n"))
    # two names of one hash would be one group
    langs = langs.where(F.when((F.col("lang") == F.col("other")) & (F.col("n") == F.size("sources")), True).otherwise(F.raise_error(F.lit("names of one hash")).cast("boolean")))
    langs = stored(langs.select("lang_id", "lang", "sources"), "divergence-langs")
    steps = walks.join(n_terms, "lang_id").join(langs, "lang_id")
    with freed(spark):
        found = stored(steps.mapInArrow(tidied(compared(top)), "lang string, source string, part string, item string, value long"), "divergence-found")
    none = langs.select("lang", "sources", F.posexplode("sources").alias("at", "s")).select("lang", F.col("s.source").alias("source"), F.lit("pair").alias("part"), F.explode(F.expr("slice(sources, at + 2, size(sources))")).alias("x"))
    none = none.select("lang", "source", "part", F.col("x.source").alias("item"), F.lit(0).cast("long").alias("value"))
    pairs = found.where("part = 'pair'").unionByName(none).groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    pairs = pairs.unionByName(pairs.select("lang", F.col("item").alias("source"), "part", F.col("source").alias("item"), "value"))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    best = found.where("part = 'term'").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return pairs.withColumn("rank", F.row_number().over(order)).unionByName(best)

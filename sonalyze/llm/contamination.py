"""Benchmark passages in documents, with DataFrame expressions only.

A document's windows have as many words as the items they are held against. First, positions whose word shingle
is in any item of a size are found; windows of that size with fewer of them than a similar item needs are none. All
others are fingerprinted (SimHash of their shingles, each as often as it occurs), by sums of packed counters. Equal windows
are one class from there on. A fingerprint is cut into BLOCKS blocks of bits; two within the radius differ in at most
radius / BLOCKS bits in one of them at least. So an item is entered under every pattern that near to each of its blocks, and a
join on size, block and bits names the items of each class, and misses none within the radius. Where a window or an item
repeats a shingle, one shingle may turn many bits, so fingerprints tell nothing: a window that repeats one is held
against all items of its size, and such an item against all windows of its size. Pairs within the radius are
verified by the weighted similarity of their shingles: the sum of the lesser counts over the sum of the greater.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sonalyze.llm.shared import stored
from sonalyze.llm.text import NULL_ID

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BITS, BLOCKS = 64, 6
#: Positions of a document that are worked on at once.
STEP = 1024


def words(text: Column) -> Column:
    return F.filter(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def shingles(size: int) -> str:
    """Hashes of the runs of `size` words in w; of all words together, where there are fewer."""
    parts = ", ".join(f"w[i + {k}]" for k in range(size))
    return f"CASE WHEN size(w) >= {size} THEN transform(sequence(0, size(w) - {size}), i -> xxhash64({parts})) WHEN size(w) > 0 THEN array(xxhash64(array_join(w, ' '), 'short')) ELSE array() END"


def fingerprint(hashes: str) -> str:
    """Bit b is set where more than half of the hashes have it."""
    return f"aggregate(sequence(0, {BITS - 1}), 0L, (f, b) -> f | shiftleft(CAST(2 * aggregate({hashes}, 0L, (n, h) -> n + (shiftright(h, b) & 1L)) > size({hashes}) AS BIGINT), b))"


def packing(most: int) -> tuple[int, int]:
    """Lanes of a word of packed counters, and bits of a lane that counts to `most`."""
    return next((lanes, 63 // lanes) for lanes in (8, 4, 2, 1) if most < 1 << 63 // lanes)


def spread(h: str, word: int, lanes: int, width: int) -> str:
    """The bits of a hash that a word of counters counts, one in each lane."""
    return " | ".join(f"shiftleft(shiftrightunsigned({h}, {word * lanes + j}) & 1L, {j * width})" for j in range(lanes))


def packed_print(counters: str, start: str, n: str, lanes: int, width: int) -> str:
    """The fingerprint of n shingles from `start`, from the counters of all, word by word."""
    mask = (1 << width) - 1
    bits = " | ".join(f"shiftleft(CAST(2 * (shiftrightunsigned(v, {j * width}) & {mask}L) > {n} AS BIGINT), {j})" for j in range(lanes))
    sums = f"transform({counters}, q -> aggregate(slice(q, {start} + 1, {n}), 0L, (a, b) -> a + b))"
    return f"aggregate(transform({sums}, (v, k) -> shiftleft({bits}, k * {lanes})), 0L, (f, v) -> f | v)"


def edges() -> list[tuple[int, int]]:
    at = [k * BITS // BLOCKS for k in range(BLOCKS + 1)]
    return list(zip(at, at[1:]))


def block_of(value: str, others: list[str]) -> str:
    """(block, bits) of a fingerprint cut into blocks, and further blocks without bits."""
    cuts = (f"struct({k} AS block, shiftrightunsigned({value}, {a}) & {(1 << b - a) - 1}L AS bits)" for k, (a, b) in enumerate(edges()))
    return f"inline(array_compact(array({', '.join([*others, *cuts])})))"


def near_blocks(value: str, near: int, others: list[str]) -> str:
    """block_of() with all bits that differ from the fingerprint's in at most `near` places of a block."""
    cuts = []
    for k, (a, b) in enumerate(edges()):
        turned = [sum(1 << x for x in places) for n in range(min(near, b - a) + 1) for places in combinations(range(b - a), n)]
        cuts.append(f"transform(array({', '.join(f'{t}L' for t in turned)}), t -> struct({k} AS block, (shiftrightunsigned({value}, {a}) & {(1 << b - a) - 1}L) ^ t AS bits))")
    return f"inline(concat(array_compact(array({', '.join(others)})), {', '.join(cuts)}))"


def first_block(x: str, near: int) -> str:
    """The first block in which two fingerprints differ in at most `near` bits; x: their differing bits."""
    return "CASE " + " ".join(f"WHEN bit_count(shiftrightunsigned({x}, {a}) & {(1 << b - a) - 1}L) <= {near} THEN {k}" for k, (a, b) in enumerate(edges())) + " END"


def computed(df: DataFrame, name: str, value: Column) -> DataFrame:
    """df with a column that is computed once a row, however often lambdas below read it: a generator
    isn't folded into the expressions that use it."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def find_passages(docs: DataFrame, items: DataFrame, size: int = 5, percent: int = 75, radius: int = 23) -> DataFrame:
    """doc_id, item_id, start, n_words, similarity: for each document and item that it holds, the best window
    (the first of equal ones; start counts words from 0).

    docs has doc_id and text, items item_id and text; other columns are not read. Words are lower-cased A-Z.
    Windows have the item's number of words; a shorter document is one window. Texts with fewer than `size`
    words have one shingle, so items that short match their exact words. Null and empty texts hold and match nothing. Rows that share a doc_id are one
    document with several texts, and a null doc_id is one such document. The same holds for items.
    """
    null = F.lit(NULL_ID)
    docs = docs.select(F.coalesce(F.col("doc_id").cast("long"), null).alias("doc_id"), "text")
    bench = computed(items.select(F.coalesce(F.col("item_id").cast("long"), null).alias("item_id"), "text"), "w", words(F.col("text")))
    bench = computed(bench, "item", F.expr(shingles(size))).where(F.size("item") > 0)
    bench = bench.select("item_id", "item", F.size("w").alias("length"), F.size("item").alias("n"), F.expr(fingerprint("item")).alias("item_print")).distinct()
    short = bench.where(F.col("length") < size)
    bench = bench.where(F.col("length") >= size)
    own = stored(windows(docs, bench, size, percent).withColumn("class", F.xxhash64("window")), "passage-windows")
    classes = own.select("n", "class", "print", "window").dropDuplicates(["n", "class", "print"])
    found = own.select("doc_id", "n", "start", "class", "print").join(verified(matched(classes, bench, radius), percent), ["n", "class", "print"])
    best = found.groupBy("doc_id", "item_id").agg(F.max_by(F.struct("start", "length"), F.struct("similarity", -F.col("start"))).alias("x"), F.max("similarity").alias("similarity"))
    best = best.select("doc_id", "item_id", "x.start", "x.length", "similarity")
    for n in sorted(r[0] for r in short.select("length").distinct().collect()):  # fewer than `size`: their windows have one shingle
        own = computed(docs, "w", words(F.col("text"))).where(F.size("w") >= n).select("doc_id", F.posexplode(F.expr(f"transform(sequence(0, size(w) - {n}), i -> xxhash64(array_join(slice(w, i + 1, {n}), ' '), 'short'))")).alias("start", "h"))
        same = own.join(short.where(F.col("length") == n).select("item_id", "length", F.col("item")[0].alias("h")), "h")
        best = best.unionByName(same.groupBy("doc_id", "item_id", "length").agg(F.min("start").alias("start"), F.lit(1.0).alias("similarity")))
    return best.select(F.nullif("doc_id", null).alias("doc_id"), F.nullif("item_id", null).alias("item_id"), F.col("start").cast("long").alias("start"), F.col("length").cast("long").alias("n_words"), "similarity")


def windows(docs: DataFrame, bench: DataFrame, size: int, percent: int) -> DataFrame:
    """(doc_id, n, start, window, print): of each size n of an item, the windows of the documents with enough shingles of
    any items of that size. A document with fewer shingles is one window. Texts are worked on STEP positions at a time."""
    most = bench.agg(F.max("n")).first()[0] or 1
    lanes, width = packing(most)
    known = bench.select(F.explode("item").alias("h"), "n").distinct()
    cut = computed(docs, "w", words(F.col("text"))).where(F.size("w") >= size).select("doc_id", F.size("w").alias("n_words"), F.expr(shingles(size)).alias("s"))
    hits = cut.select("doc_id", "n_words", F.posexplode("s").alias("at", "h")).join(known, "h")
    # a hit counts for windows that start in its own stretch, and in those before it that reach it
    hits = hits.select("doc_id", "n_words", "n", "at", F.explode(F.expr(f"sequence(greatest(at - n + 1, 0) div {STEP}, at div {STEP})")).alias("part"))
    parts = hits.groupBy("doc_id", "n_words", "n", "part").agg(F.sort_array(F.collect_set("at")).alias("at"))
    parts = parts.withColumn("long", F.expr(f"least(n, n_words - {size - 1})"))
    parts = parts.withColumn("needed", F.expr(f"CAST(ceil({percent} * (long + n) / {100 + percent}) AS INT)")).where("size(at) >= needed")
    # windows with so many hits start between these
    parts = parts.withColumn("low", F.expr(f"CAST(greatest(part * {STEP}, at[needed - 1] - long + 1) AS INT)"))
    parts = parts.withColumn("high", F.expr(f"CAST(least(part * {STEP} + {STEP - 1}, at[size(at) - needed], n_words - {size - 1} - long) AS INT)")).where("low <= high")
    parts = parts.groupBy("doc_id", "n_words").agg(F.collect_list(F.struct("n", "at", "long", "needed", "low", "high")).alias("parts"))
    texts = computed(docs.join(parts, "doc_id"), "w", words(F.col("text"))).where(F.size("w") == F.col("n_words"))
    texts = computed(texts, "s", F.expr(shingles(size)))
    # s: the shingles from position `low` on
    texts = texts.select("doc_id", F.expr("inline(transform(parts, x -> struct(x.n, x.at, x.long, x.needed, x.low, x.high, slice(s, x.low + 1, x.high - x.low + x.long) AS s)))"))
    texts = computed(texts, "counters", F.expr("array(" + ", ".join(f"transform(s, h -> {spread('h', k, lanes, width)})" for k in range(BITS // lanes)) + ")"))
    # needed hits in a row lie in the windows that start from the last one's place back to the first's
    first, last = "greatest(low, at[i + needed - 1] - long + 1)", "least(high, at[i])"
    ranges = f"transform(sequence(0, size(at) - needed), i -> CASE WHEN {first} <= {last} THEN sequence({first}, {last}) ELSE array() END)"
    own = f"struct(n, x AS start, slice(s, x - low + 1, long) AS window, {packed_print('counters', '(x - low)', 'long', lanes, width)} AS print)"
    return texts.select("doc_id", F.expr(f"inline(transform(array_distinct(flatten({ranges})), x -> {own}))"))


def matched(classes: DataFrame, bench: DataFrame, radius: int) -> DataFrame:
    """The classes of windows (n, class, print, window) with the items of their size whose fingerprints are within the radius, each
    pair once, and pairs of which one repeats a shingle."""
    near = radius // BLOCKS
    index = bench.withColumn("item_repeats", F.expr("size(array_distinct(item)) < size(item)"))
    others = ["struct(-1 AS block, 0L AS bits)", "IF(item_repeats, struct(-2 AS block, 0L AS bits), NULL)"]
    index = index.select("n", "item_id", "item", "length", "item_print", "item_repeats", F.expr(near_blocks("item_print", near, others)))
    own = computed(classes, "repeats", F.expr("size(array_distinct(window)) < size(window)"))
    own = own.select("*", F.expr(block_of("print", ["IF(repeats, struct(-1 AS block, 0L AS bits), NULL)", "IF(repeats, NULL, struct(-2 AS block, 0L AS bits))"])))
    pairs = own.join(index, ["n", "block", "bits"])
    alike = f"NOT repeats AND NOT item_repeats AND bit_count(print ^ item_print) <= {radius} AND block = {first_block('(print ^ item_print)', near)}"
    return pairs.where(f"IF(block < 0, true, {alike})")


def verified(pairs: DataFrame, percent: int) -> DataFrame:
    """Pairs of classes and items whose weighted similarity reaches the threshold, and that similarity."""
    # the k-th of equal shingles is told from the others, so that sets have the weights
    tagged = lambda a: f"transform(array_sort({a}), (x, i) -> struct(x, i - array_position(array_sort({a}), x) AS k))"
    both = F.expr(f"size(IF(repeats OR item_repeats, array_intersect({tagged('window')}, {tagged('item')}), array_intersect(transform(window, x -> struct(x, 0L AS k)), transform(item, x -> struct(x, 0L AS k)))))")
    found = computed(pairs, "shared", both).withColumn("all", F.size("window") + F.size("item") - F.col("shared")).where(100 * F.col("shared") >= percent * F.col("all"))
    return found.select("n", "class", "print", "item_id", "length", (F.col("shared") / F.col("all")).alias("similarity"))

"""The news funnel: counts and routes of each stage are the specified ones; how an article is told apart,
judged and grouped is our own design, as the specification names no method."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sonalyze.operators.components import components
from sonalyze.shared import cut, stored

STAGES = ["fetch", "metadata_dedup", "classify", "fulltext", "content_dedup", "cluster", "score", "safety"]
TIERS = ["default", "sensitive", "redline"]
#: Letters of a word that can tell an event, how many words of an article do, and the words that are too common: of more
#: articles than both of these, a number and a part of all.
TERM, SIGNATURE, LEAST_COMMON, COMMON_PART = 4, 6, 50, 64
#: MinHash signatures of near duplicates: bands, and hashes of a band.
BANDS, BAND_ROWS = 24, 3
#: Tasks that the rows of one key are spread over.
SALTS = 16


def normalized_url(url: Column) -> Column:
    """Without scheme, www or m, query, fragment, and slash at the end; host in lower case."""
    bare = F.regexp_replace(F.regexp_replace(url, r"[?#].*$", ""), r"^[A-Za-z]+://(?:www\.|m\.)?", "")
    host, rest = F.lower(F.regexp_extract(bare, r"^([^/]*)", 1)), F.regexp_extract(bare, r"^[^/]*(.*)$", 1)
    return F.concat(host, F.regexp_replace(rest, "/+$", ""))


def normalized_text(text: Column) -> Column:
    """In lower case, runs of white space as one space."""
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))


def dedup(rows: DataFrame, key: Column, order: str) -> DataFrame:
    """rows with dedup_key and kept: the first in order of each key. Keys meet by a grouped minimum, and rows that
    are of one key, or of none, in SALTS tasks; rows without a key are all kept."""
    keyed = rows.withColumn("dedup_key", key).withColumn("_salt", F.pmod(F.xxhash64(order), F.lit(SALTS)))
    first = keyed.where("dedup_key IS NOT NULL").groupBy("dedup_key").agg(F.min(order).alias("_first"), F.count("*").alias("_n")).where("_n > 1")
    first = first.select("dedup_key", "_first", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("_salt"))
    return keyed.join(first, ["dedup_key", "_salt"], "left").withColumn("kept", F.coalesce(F.col(order) == F.col("_first"), F.lit(True))).drop("_first", "_salt")


def fetch_state(pages: DataFrame) -> DataFrame:
    """pages with state: failed (nothing came), updated, skipped or new; by rules of our own on the address."""
    url = F.col("url")
    return pages.withColumn("state", F.when(F.col("html").isNull(), "failed").when(url.contains("?page="), "updated").when(url.contains("#"), "skipped").otherwise("new"))


def compared(items: DataFrame, history: DataFrame) -> DataFrame:
    """Items (link, title) with state, by what earlier runs have (link, title): failed without a link, new, skipped
    where nothing changed, else updated. Links are unique in history."""
    known = history.select("link", F.col("title").alias("_title"), F.lit(True).alias("_known"))
    state = F.when(F.col("link").isNull(), "failed").when(F.col("_known").isNull(), "new").when(F.col("title").eqNullSafe(F.col("_title")), "skipped").otherwise("updated")
    return items.join(known, "link", "left").withColumn("state", state).drop("_title", "_known")


def fetch_counts(pages: DataFrame) -> DataFrame:
    """Items of each state, and apart from them the sources (hosts) they are of."""
    host = F.lower(F.regexp_extract("url", r"^[A-Za-z]+://([^/:?#]+)", 1))
    return fetch_state(pages).groupBy("state").agg(F.count("*").alias("items"), F.count_distinct(host).alias("sources"))


def metadata_reasons(pages: DataFrame) -> DataFrame:
    """Why pages are metadata duplicates: an equal address came before (same_url), or one that differs in parts
    that don't count (same_address)."""
    own = metadata_dedup(pages)
    first = own.groupBy("url").agg(F.min("page_id").alias("first_page"))
    gone = own.where(~F.col("kept")).join(first, "url")
    return reasons(gone.withColumn("why", F.when(F.col("page_id") == F.col("first_page"), "same_address").otherwise("same_url")), "metadata_dedup", "why")


def metadata_dedup(pages: DataFrame) -> DataFrame:
    return dedup(pages, normalized_url(F.col("url")), "page_id")


def content_dedup(docs: DataFrame) -> DataFrame:
    """Equal normalized texts are duplicates."""
    return dedup(docs, F.sha2(normalized_text(F.col("text")), 256), "doc_id")


def near_dedup(docs: DataFrame) -> DataFrame:
    """Articles with the same words, whatever their order, number, case, spacing and marks, are near duplicates. A null
    text has no key."""
    words = F.array_sort(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))))
    return dedup(docs, F.sha2(F.array_join(words, " "), 256), "doc_id")


def similar_dedup(docs: DataFrame, percent: int = 75, size: int = 5) -> DataFrame:
    """docs (doc_id, text) with kept: false where an earlier article (of a lesser doc_id) is near, that is, where the distinct runs of
    `size` words of both share `percent` of all. Words are runs of letters and digits in lower case; fewer words are one run. A null
    or wordless text is near to none. doc_id is unique.

    Articles of equal runs are told apart by a grouped minimum. The others meet in bands of MinHash signatures: first each is held
    against the first of its band, and only those that aren't near to it against all that come before them in a band. So a
    group of copies costs a comparison each. Signatures miss a pair at the threshold in two of a million cases, others less.

    Texts are shuffled once to be signed, which leaves some numbers of each; runs are made again for articles that meet another
    of like size alone, and stored.
    """
    spark = docs.sparkSession
    hashes = f"transform(sequence(0, {BANDS * BAND_ROWS - 1}), k -> array_min(transform(s, h -> xxhash64(h, k))))"
    bands = f"transform(sequence(0, {BANDS - 1}), b -> xxhash64(slice(m, b * {BAND_ROWS} + 1, {BAND_ROWS}), b))"
    dealt = docs.select("doc_id", "text").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "doc_id")
    signed = _runs(dealt, size).select("doc_id", F.size("s").alias("n"), F.unhex(F.sha2(F.array_join("s", ","), 256)).alias("same"), F.explode(F.array(F.expr(hashes))).alias("m"))
    signed = stored(signed.select("doc_id", "n", "same", F.expr(bands).alias("keys")), "news-signed")
    copies = signed.groupBy("same").agg(F.min("doc_id").alias("first"), F.count("*").alias("c")).where("c > 1")
    same = stored(signed.select("doc_id", "same").join(copies, "same").where("doc_id <> first").select("doc_id"), "news-same")
    banded = signed.join(same, "doc_id", "left_anti").select("doc_id", "n", F.explode("keys").alias("key"))
    heads = banded.groupBy("key").agg(F.min(F.struct("doc_id", "n")).alias("head"), F.count("*").alias("c")).where("c > 1").select("key", F.col("head.doc_id").alias("head"), F.col("head.n").alias("head_n"))
    met = stored(banded.join(heads, "key"), "news-met")  # the articles of every band of two or more
    first = stored(met.where("doc_id <> head").where(_fits("n", "head_n", percent)).select("doc_id", F.col("head").alias("other")).distinct(), "news-heads")
    gone = stored(_near(first, _sets(docs, first, size), percent), "news-gone")
    left = met.where("doc_id <> head").join(gone, "doc_id", "left_anti").select("key", "doc_id", "n", "head")
    rest = left.join(met.select("key", F.col("doc_id").alias("other"), F.col("n").alias("other_n")), "key").where("other < doc_id AND other <> head").where(_fits("n", "other_n", percent))
    rest = stored(rest.select("doc_id", "other").distinct(), "news-rest")
    gone = gone.unionByName(_near(rest, _sets(docs, rest, size), percent))
    return docs.join(gone.unionByName(same).distinct().withColumn("_gone", F.lit(True)), "doc_id", "left").withColumn("kept", F.col("_gone").isNull()).drop("_gone")


def _runs(docs: DataFrame, size: int) -> DataFrame:
    """doc_id and s, the hashes of the distinct runs of words in order, of docs (doc_id, text) that have any."""
    words = F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))
    runs = "CASE WHEN size(w) >= {0} THEN array_distinct(transform(sequence(0, size(w) - {0}), i -> xxhash64({1}))) WHEN size(w) > 0 THEN array(xxhash64(array_join(w, ' '), 'short')) ELSE array() END"
    made = F.array_sort(F.expr(runs.format(size, ", ".join(f"w[i + {k}]" for k in range(size)))))
    # generators keep what is made once a text from being folded into what reads it
    return docs.select("doc_id", F.explode(F.array(words)).alias("w")).select("doc_id", F.explode(F.array(made)).alias("s")).where("size(s) > 0")


def _sets(docs: DataFrame, pairs: DataFrame, size: int) -> DataFrame:
    """The runs of the articles of pairs (doc_id, other), stored."""
    ids = stored(pairs.select("doc_id").unionByName(pairs.select(F.col("other").alias("doc_id"))).distinct(), "news-ids")
    return stored(_runs(docs.select("doc_id", "text").join(ids, "doc_id", "left_semi"), size), "news-runs")


def _fits(a: str, b: str, percent: int) -> Column:
    """Sets whose sizes differ too much can't be near."""
    return (100 * F.col(a) >= percent * F.col(b)) & (100 * F.col(b) >= percent * F.col(a))


def _near(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """doc_id of the pairs (doc_id, other) whose sets share enough."""
    shared = F.size(F.array_intersect("s", "o"))
    both = pairs.join(sets, "doc_id").join(sets.select(F.col("doc_id").alias("other"), F.col("s").alias("o")), "other")
    return both.where(100 * shared >= percent * (F.size("s") + F.size("o") - shared)).select("doc_id").distinct()


def unseen(items: DataFrame, history: DataFrame, key: str) -> DataFrame:
    """Items of a run that no earlier run has, each once: running again adds nothing."""
    return items.join(history.select(key), key, "left_anti").dropDuplicates([key])


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs with relevance and reason: relevant, irrelevant, or uncertain where the evidence is missing. Being
    ruled out or too short is a reason of irrelevance, not a route of its own."""
    known = labels.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
    short = F.col("n_chars") < 200
    relevance = F.when(short, "irrelevant").when(F.col("quality").isNull(), "uncertain").when(F.col("quality") == 0, "irrelevant").otherwise("relevant")
    reason = F.when(short, "too_short").when(F.col("quality").isNull(), "no_evidence").when(F.col("quality") == 0, "rule_excluded").otherwise("labelled")
    return docs.join(known, "doc_id", "left").withColumns({"relevance": relevance, "reason": reason})


def fulltext(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with fetch: failed (no text), empty or fetched, and how many characters, a metric."""
    return docs.withColumns({"fetch": F.when(F.col(text).isNull(), "failed").when(F.trim(F.col(text)) == "", "empty").otherwise("fetched"), "chars": F.length(text).cast("long")})


def event_terms(docs: DataFrame) -> DataFrame:
    """doc_id, lang and terms of docs (doc_id, lang, text): of an article's distinct words of TERM letters and more, over its
    whole text, the SIGNATURE rarest of its language (of equally rare ones the first in order) that another article has too, but not
    more than LEAST_COMMON and one in COMMON_PART of all. bits: how much it tells that two articles share a word, the
    length of (articles of the language / those with the word) in binary."""
    own = F.coalesce("lang", F.lit(""))
    terms = F.array_distinct(F.filter(F.split(F.lower("text"), r"\s+"), lambda w: F.length(w) >= TERM))
    held = stored(docs.select("doc_id", own.alias("lang"), terms.alias("terms")), "news-terms")
    words = held.select("doc_id", "lang", F.explode("terms").alias("word"))
    articles = held.groupBy("lang").agg(F.count("*").alias("articles"))
    index = words.groupBy("lang", "word").agg(F.count("*").alias("n")).where("n > 1").join(articles, "lang")
    index = index.where(F.expr(f"n <= greatest({LEAST_COMMON}, articles div {COMMON_PART})")).select("lang", "word", "n", F.expr("length(bin(articles div n))").alias("bits"), F.expr("length(bin(articles))").alias("all_bits"))
    best = words.join(index, ["lang", "word"]).groupBy("doc_id", "lang").agg(F.slice(F.sort_array(F.collect_list(F.struct("n", "word", "bits"))), 1, SIGNATURE).alias("terms"), F.first("all_bits").alias("all_bits"))
    return best.select("doc_id", "lang", "terms", (2 * F.col("all_bits")).alias("needed"))


def event_keys(terms: DataFrame) -> DataFrame:
    """doc_id and key: a key for each least set of an article's terms whose bits reach what is needed. Two articles share a key
    just where the terms that they share reach it, so links need no pairs of articles."""
    chosen = "filter(terms, (t, i) -> (shiftright(m, i) & 1) = 1)"
    sets = f"transform(sequence(1, shiftleft(1, size(terms)) - 1), m -> {chosen})"
    bits = "aggregate(s, 0, (a, t) -> a + t.bits)"
    least = f"filter({sets}, s -> {bits} >= needed AND {bits} - s[size(s) - 1].bits < needed)"  # the last is the commonest
    return terms.select("doc_id", F.explode(F.expr(f"transform({least}, s -> unhex(md5(concat_ws(' ', lang, array_join(transform(s, t -> t.word), ' ')))))")).alias("key"))


def event_links(docs: DataFrame) -> DataFrame:
    """a, b: articles that share rare words of enough bits, each linked to the first that shares them. Two articles of a
    language of n that share words by chance share 2 * log2(n) bits in one of all pairs; so many are needed."""
    keys = event_keys(stored(event_terms(docs), "news-event-terms"))
    first = keys.groupBy("key").agg(F.min("doc_id").alias("b"), F.count("*").alias("n")).where("n > 1").drop("n")
    return keys.withColumnRenamed("doc_id", "a").join(first, "key").select("a", "b").where("a <> b").distinct()


def cluster(docs: DataFrame) -> DataFrame:
    """docs (doc_id, lang, text) with event_id: the language and the first article of those that links (event_links) connect.
    An article that no other tells is unhandled (null)."""
    found = components(event_links(docs)).select(F.col("id").alias("doc_id"), F.col("component").alias("_event"))
    return docs.join(found, "doc_id", "left").withColumn("event_id", F.when(F.col("_event").isNotNull(), F.concat_ws(":", F.coalesce("lang", F.lit("")), F.col("_event").cast("string")))).drop("_event")


def score(docs: DataFrame) -> DataFrame:
    """docs (quality, n_chars) with score and outcome; a deterministic stand-in for a model. Without a label it
    is skipped, an empty article fails."""
    outcome = F.when(F.col("quality").isNull(), "skipped").when(F.col("n_chars") == 0, "failed").otherwise("scored")
    value = F.col("quality") * 50 + F.least(F.col("n_chars"), F.lit(5000)) / 100
    return docs.withColumns({"outcome": outcome, "score": F.when(outcome == "scored", value.cast("double"))})


def safety_tier(toxic: Column, text: Column) -> Column:
    """The tier of a first judgement: labelled toxic texts are sensitive."""
    return F.when(toxic == 1, "sensitive").otherwise("default")


def override(before: Column, rule: Column) -> Column:
    """The stricter of two tiers: an override never loosens."""
    rank = lambda c: F.coalesce(F.array_position(F.array(*map(F.lit, TIERS)), c), F.lit(1))
    return F.element_at(F.array(*map(F.lit, TIERS)), F.greatest(rank(before), rank(rule)).cast("int"))


def admit(docs: DataFrame) -> DataFrame:
    """Articles that may be stored: no redline; sensitive ones are labelled, not dropped."""
    return docs.where(F.coalesce(F.col("safety") != "redline", F.lit(True)))


def stage_counts(rows: DataFrame, stage: str, output: Column, routes: dict[str, Column], by: list[str] | None = None) -> DataFrame:
    """A funnel row of a stage over its rows: stage_key, input, output, routes; routes exclude each other."""
    by = by or []
    pairs = [x for name, cond in routes.items() for x in (F.lit(name), F.count_if(cond))]
    return rows.groupBy(*by).agg(F.count("*").alias("input"), F.count_if(output).alias("output"), F.create_map(*pairs).alias("routes")).select(*by, F.lit(stage).alias("stage_key"), "input", "output", "routes")


def reasons(rows: DataFrame, stage: str, reason: str) -> DataFrame:
    """Breakdown of a stage by reason; no part of its conservation."""
    return rows.groupBy(F.col(reason).alias("reason")).agg(F.count("*").alias("n")).select(F.lit(stage).alias("stage_key"), "reason", "n")


def funnel(docs: DataFrame, pages: DataFrame, labels: DataFrame) -> DataFrame:
    """The funnel of one run over fetched pages and documents: a row for each of the eight stages."""
    fetched = fetch_state(pages)
    is_ = lambda c, v: F.col(c) == v
    # texts are read by two stages, from a table; the others take what they need of them from it
    known = fulltext(classify(docs, labels)).withColumn("_same", F.sha2(normalized_text(F.col("text")), 256))
    known = stored(known.select("doc_id", "lang", "n_chars", "quality", "toxic", "relevance", "fetch", "_same", "text"), "news-known")
    texts = known.where(is_("relevance", "relevant")).drop("text")
    there = texts.where(is_("fetch", "fetched"))
    unique = stored(dedup(there, F.col("_same"), "doc_id").drop("dedup_key"), "news-unique")
    kept = unique.where("kept")
    own = kept.select(F.col("doc_id").alias("_id"), F.col("_same").alias("_text"))
    grouped = cluster(known.join(own, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_same") == F.col("_text")), "left_semi").select("doc_id", "lang", "text"))
    scored = score(kept)
    judged = scored.withColumn("before", F.lit("default")).withColumn("safety", override(F.col("before"), safety_tier(F.col("toxic"), F.lit(""))))
    parts = [
        stage_counts(fetched, "fetch", is_("state", "new"), {s: is_("state", s) for s in ("updated", "skipped", "failed")}),
        stage_counts(metadata_dedup(pages), "metadata_dedup", F.col("kept"), {"duplicates": ~F.col("kept")}),
        stage_counts(known, "classify", is_("relevance", "relevant"), {s: is_("relevance", s) for s in ("irrelevant", "uncertain")}),
        stage_counts(texts, "fulltext", is_("fetch", "fetched"), {s: is_("fetch", s) for s in ("failed", "empty")}),
        stage_counts(unique, "content_dedup", F.col("kept"), {"duplicates": ~F.col("kept")}),
        stage_counts(grouped, "cluster", F.col("event_id").isNotNull(), {"unhandled": F.col("event_id").isNull()}),
        stage_counts(scored, "score", is_("outcome", "scored"), {s: is_("outcome", s) for s in ("failed", "skipped")}),
        stage_counts(judged, "safety", F.col("safety") == F.col("before"), {"changed": F.col("safety") != F.col("before")}),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def events(grouped: DataFrame, history: DataFrame) -> DataFrame:
    """How many events are new and how many known before: metrics in another unit than articles."""
    own = grouped.where("event_id IS NOT NULL").select("event_id").distinct()
    known = history.select("event_id").distinct().withColumn("known", F.lit(True))
    return own.join(known, "event_id", "left").agg(F.count_if(F.col("known").isNull()).alias("new_events"), F.count("known").alias("reused_events"))


def candidates(docs: DataFrame, day: list[str], domain: str, rank: str, hook: Column, n: int = 3) -> DataFrame:
    """The n best candidates of each day, of different domains, the first recommended. A candidate needs a
    domain and a hook."""
    own = docs.withColumn("hook", hook).where(F.col(domain).isNotNull() & (F.coalesce(F.trim("hook"), F.lit("")) != ""))
    best = own.groupBy(*day, domain).agg(F.min_by(F.struct(rank, "doc_id", "hook"), F.struct(F.col(rank) * -1, "doc_id")).alias("x")).select(*day, domain, "x.*")
    place = F.row_number().over(Window.partitionBy(*day).orderBy(F.desc(rank), "doc_id"))
    return best.withColumn("place", place).where(F.col("place") <= n).withColumn("recommended", F.col("place") == 1)


def rhythm(picks: DataFrame, archive: DataFrame, days: int = 14) -> DataFrame:
    """picks (day, topic, score) with the score lowered by how lately the archive (date, topic) had the topic.
    Our own reading of a reinforcement rhythm."""
    none = F.lit(None).cast("date")
    days_ = picks.select("topic", "day", none.alias("date")).union(archive.select("topic", F.col("date").alias("day"), "date")).groupBy("topic", "day").agg(F.max("date").alias("date"))
    before = Window.partitionBy("topic").orderBy("day").rowsBetween(Window.unboundedPreceding, -1)  # a row a day
    last = days_.select("topic", "day", F.max("date").over(before).alias("last"))
    gap = F.datediff("day", "last")
    return picks.join(last, ["day", "topic"], "left").withColumn("adjusted", F.when(gap <= days, F.col("score") * gap / days).otherwise(F.col("score")))


def diversity(chosen: DataFrame, by: list[str], source: str, official: Column) -> DataFrame:
    """Of the candidates of a day: sources, and whether they are mixed rather than all official."""
    return chosen.groupBy(*by).agg(F.count("*").alias("n"), F.count_distinct(source).alias("sources"), F.count_if(official).alias("official")).withColumn("diverse", (F.col("sources") == F.col("n")) & (F.col("official") < F.col("n")))

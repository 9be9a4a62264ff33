"""The operators over their whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sonalyze.llm import sql
from sonalyze.llm.shared import ship

#: The training mixture: sources below the mean size come up more often than in the corpus.
MIXTURE_ALPHA = 0.7
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sonalyze.llm.contamination import find_passages

    return find_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sonalyze.llm.suffix_tree import score

    return score(table(spark, sf_dir, "documents"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sonalyze.llm.substrings import dedup_substrings

    kept = F.coalesce("text", F.lit(""))
    return dedup_substrings(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "n_words", "n_removed", F.sha2(kept, 256).alias("kept_sha256"))


def rolled_up(spark: SparkSession, sf_dir: str, counts: DataFrame) -> DataFrame:
    """Totals of counts (doc_id, source, lang, tokenizer, n_tokens): all are inserted; the toxic documents are
    deleted; the first tokenizer's counts of the others of low quality are revised to count an end; the deletes are
    sent twice."""
    from sonalyze.llm.rollups import Rollup
    from sonalyze.llm.shared import scratch, stored

    counts = stored(counts, "rollup-counts")
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("quality").alias("quality"))
    own = counts.join(labels, "doc_id")
    event = lambda df, op, n, old: df.select(F.lit(op).alias("op"), "source", "lang", "tokenizer", n.alias("n_tokens"), old.alias("old_tokens"))
    n = F.col("n_tokens")
    rollup = Rollup(spark, scratch(spark, "rollup"))
    rollup.commit("inserts", event(counts, "insert", n, F.lit(0)))
    gone = event(own.where("toxic = 1"), "delete", n, F.lit(0))
    rollup.commit("deletes", gone)
    rollup.compact()
    rollup.commit("revisions", event(own.where("toxic = 0 AND quality = 0 AND tokenizer LIKE '%-1'"), "revise", n + 1, n))
    rollup.commit("deletes", gone)
    return rollup.totals()


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of the byte-level vocabulary: version 1 counts the text, version 2 the end too."""
    from sonalyze.llm.rollups import id_count

    n = id_count(table(spark, sf_dir, "documents"), BYTE_BPE)
    versions = F.explode(F.create_map(F.lit("byte_bpe_50k-1"), F.col("n_tokens"), F.lit("byte_bpe_50k-2"), F.col("n_tokens") + 1)).alias("tokenizer", "n_tokens")
    return rolled_up(spark, sf_dir, n.select("doc_id", "source", "lang", versions))


def word_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rollup of counts that SQL can make: words and bytes."""
    from sonalyze.llm.rollups import byte_count, word_count

    counts = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", F.explode(F.create_map(F.lit("words-1"), word_count(), F.lit("bytes-2"), byte_count())).alias("tokenizer", "n_tokens"))
    return rolled_up(spark, sf_dir, counts)


ROLLUP_SQL = r"""
WITH marks AS (SELECT doc_id, max(toxic) AS toxic, min(quality) AS quality FROM labels GROUP BY doc_id),
kept AS (
    SELECT d.source, d.lang, CASE WHEN m.quality = 0 AND m.toxic = 0 THEN 1 ELSE 0 END AS revised,
        len(list_filter(string_split_regex(coalesce(d.text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')) AS words, strlen(coalesce(d.text, '')) AS bytes
    FROM documents d LEFT JOIN marks m ON d.doc_id = m.doc_id WHERE m.toxic IS NULL OR m.toxic <> 1)
SELECT source, lang, 'words-1' AS tokenizer, count(*) AS docs, CAST(sum(words + revised) AS BIGINT) AS tokens FROM kept GROUP BY source, lang
UNION ALL SELECT source, lang, 'bytes-2', count(*), CAST(sum(bytes) AS BIGINT) FROM kept GROUP BY source, lang
"""


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sonalyze.llm.langid import identify, page_rows, train

    model = train(table(spark, sf_dir, "documents"))
    return identify(page_rows(table(spark, sf_dir, "pages")), model).withColumnRenamed("id", "page_id")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each source is due in proportion to the 0.7th power of its tokens."""
    from sonalyze.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"), BYTE_BPE, alpha=MIXTURE_ALPHA)


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sonalyze.llm.caps import similar_vectors

    return similar_vectors(table(spark, sf_dir, "embeddings"))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sonalyze.llm.shared import scratch
    from sonalyze.llm.tokenfile import read_ids, write_ids

    path = scratch(spark, "token-ids")
    write_ids(table(spark, sf_dir, "documents"), path, BYTE_BPE)
    return read_ids(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sonalyze.llm.bytespans import dedup_bytes

    return dedup_bytes(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sonalyze.llm.jaccard import similar_groups

    return similar_groups(table(spark, sf_dir, "documents"))


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sonalyze.llm.secrets import find_secrets, in_order, listed

    found = find_secrets(table(spark, sf_dir, "documents"))
    n = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", n("assign"), n("access"), n("hex"), F.sha2(listed("base"), 256).alias("base_sha256"), listed(in_order("base", "added")).alias("spans"))


#: D, U and P may come so long after the row before.
CLICK_GAP = 600_000_000


def falling_or_rising(sign: int):
    def fits(now: dict, before: dict, has_before):
        return has_before & (sign * (now["value"] - before["value"]) > 0) & now["calm"].astype(bool) & (now["ts"] - before["ts"] <= CLICK_GAP)

    return fits


def op12_row_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A (D|U)*? P over the clicks of each client. A value that is no number of cents in 63 bits fits no letter."""
    from sonalyze.llm.patterns import Either, Letter, Many, Seq
    from sonalyze.llm.row_matching import Condition, match_rows

    cents = F.floor(100 * F.col("value") + 0.5)
    cents = F.when(F.abs("value") < 9e16, cents)
    features = {"ts": F.col("ts"), "calm": F.col("kind").isNotNull() & (F.col("kind") != "error"), "bought": F.col("kind") == "purchase"}
    letters = {
        "A": Condition(lambda now, before, has_before: has_before | True), "D": Condition(falling_or_rising(-1)), "U": Condition(falling_or_rising(1)),
        "P": Condition(lambda now, before, has_before: has_before & now["bought"].astype(bool) & (now["ts"] - before["ts"] <= CLICK_GAP), at_least_first=True),
    }
    pattern = Seq((Letter("A"), Many(Either((Letter("D"), Letter("U"))), lazy=True), Letter("P")))
    found = match_rows(table(spark, sf_dir, "clicks"), "client_id", ["ts", "click_id"], "click_id", cents, features, letters, pattern)
    return found.select("client_id", "match_no", "first_id", "last_id", "n_rows", F.col("sum_value").alias("sum_cents"), F.sha2("labels", 256).alias("labels_sha256"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sonalyze.llm.divergence import divergence

    return divergence(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if (name.startswith("op") or name == "word_rollup") and callable(f)}


def oracle_sql() -> dict[str, str]:
    return {"op1_decontamination": sql.DECONTAMINATION, "op3_substring_dedup": sql.SUBSTRINGS, "word_rollup": ROLLUP_SQL, "op7_embedding_dedup": sql.EMBEDDINGS, "op10_jaccard_join": sql.JACCARD,
            "op11_secret_scan": sql.secrets(), "op13_source_divergence": sql.DIVERGENCE}

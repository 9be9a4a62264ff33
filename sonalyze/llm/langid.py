"""Language identification by Bayesian fusion of evidence.

The text gives a likelihood for each language from hashed letter trigrams, counted over all labelled
documents. The declared language of the markup, the suffix of the address, and the host give priors. Host
priors are smoothed in steps: what the other texts of a host say, towards its site, towards the whole collection;
a row's own text has no vote in its priors, as it counts already. All of these are counted by grouped aggregation over all rows. A further class, und, spreads its
probability evenly over all trigrams, and wins over texts that are like no language.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sonalyze.llm import text as X
from sonalyze.llm.shared import stored

BUCKETS = 1 << 16
#: Languages whose likelihoods are broadcast at once (64 MB); more are scored block by block. Buckets of a row of counts.
BLOCK, PIECE = 128, 1 << 10
#: Trigrams whose evidence counts in full; longer texts are tempered to as many, as trigrams aren't independent.
FULL_WEIGHT = 200.0
#: How often a declared language is right; rows of evidence that a broader level is worth; prior of und.
DECLARED_RIGHT, LEVEL_ROWS, UND_PRIOR, LEAST_POSTERIOR = 0.9, 8.0, 1e-3, 0.5
UND = "und"
SALTS = 16

_fold = X.LOWER.copy()
_fold[[b for b in range(128) if not chr(b).isalpha()]] = 0x20


def trigrams(c: X.Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the trigrams that hold a letter, and the text of each. All but letters are blanks; bytes
    of other characters count as letters."""
    data = _fold[c.data].astype(np.uint32)
    if len(data) < 3:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    code = (data[:-2] * np.uint32(0x9E3779B1)) ^ (data[1:-1] * np.uint32(0x85EBCA77)) ^ (data[2:] * np.uint32(0xC2B2AE3D))
    code ^= code >> np.uint32(15)
    code *= np.uint32(0x2C1B3C6D)
    bucket = (code >> np.uint32(16)).astype(np.int64)
    at = X.inside(c.offsets, len(data), 3)
    at = at[(data[at] != 0x20) & (data[at + 1] != 0x20) | (data[at + 1] != 0x20) & (data[at + 2] != 0x20)]
    return bucket[at], np.searchsorted(c.offsets, at, "right") - 1


@dataclass
class Model:
    """All languages, and the trigram counts of each in a stored table of pieces."""

    languages: list[str]
    table: DataFrame

    def log_p(self, lo: int, hi: int) -> np.ndarray:
        known = self.languages[lo:hi]
        n, number = np.zeros((len(known), BUCKETS)), {lang: i for i, lang in enumerate(known)}
        for r in self.table.where(F.col("lang").isin(known)).collect() if known else []:
            n[number[r["lang"]], r["piece"] * PIECE : (r["piece"] + 1) * PIECE] = np.frombuffer(r["n"], np.int64)
        return np.log((n + 0.1) / (n.sum(1, keepdims=True) + 0.1 * BUCKETS))


def train(labelled: DataFrame) -> Model:
    """labelled has text and lang; rows without either teach nothing. Every other lang is a class."""
    labelled = labelled.where("text is not null and lang is not null and lang <> ''").select("text", F.lower("lang").alias("lang"))

    def dealt(held: dict[str, np.ndarray]) -> pa.RecordBatch:
        full = [(lang, p, n[p * PIECE : (p + 1) * PIECE]) for lang, n in held.items() for p in range(BUCKETS // PIECE)]
        full = [(lang, p, n.tobytes()) for lang, p, n in full if not p or n.any()]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in full], t) for i, t in enumerate((pa.string(), pa.int32(), pa.binary()))], ["lang", "piece", "n"])

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            labels = batch.column(1).to_pylist()
            for c in X.chunks(batch.column(0)):
                bucket, row = trigrams(c)
                names = sorted(set(labels[c.first : c.first + c.n]))
                number = {lang: i for i, lang in enumerate(names)}
                own = np.array([number[x] for x in labels[c.first : c.first + c.n]], np.int64)[row]
                for lo in range(0, len(names), BLOCK):
                    block = names[lo : lo + BLOCK]
                    here = (own >= lo) & (own < lo + BLOCK)
                    total = np.bincount((own[here] - lo) * BUCKETS + bucket[here], minlength=len(block) * BUCKETS).reshape(-1, BUCKETS)
                    for lang, n in zip(block, total):
                        held[lang] = held.get(lang, 0) + n
                    if len(held) > BLOCK:
                        yield dealt(held)
                        held = {}
        yield dealt(held)

    def summed(key: tuple, table: pa.Table) -> pa.Table:
        n = sum(np.frombuffer(b.as_py(), np.int64) for b in table.column("n"))
        return pa.table({"lang": [key[0].as_py()], "piece": pa.array([key[1].as_py()], pa.int32()), "n": pa.array([n.tobytes()], pa.binary())})

    schema = "lang string, piece int, n binary"
    table = stored(labelled.mapInArrow(X.tidied(counts), schema).groupBy("lang", "piece").applyInArrow(summed, schema), "langid-counts")
    return Model(sorted(r["lang"] for r in table.where("piece = 0").select("lang").collect()), table)


def likelihoods(rows: DataFrame, model: Model, kept: list[str]) -> DataFrame:
    """The columns kept, with n_grams and ll: the tempered log-likelihood of the text in each class, und the
    last. Languages beyond BLOCK take further passes over the texts."""
    rows, n = rows.select("text", *kept), len(model.languages)
    for lo in range(0, max(n, 1), BLOCK):
        last = lo + BLOCK >= n
        rows = block_likelihoods(rows, model.log_p(lo, lo + BLOCK), last)
        if not last:
            rows = stored(rows, "langid-block")
    return rows.select(*kept, "n_grams", "ll")


def block_likelihoods(rows: DataFrame, log_p: np.ndarray, last: bool) -> DataFrame:
    """Rows with the likelihoods in further languages behind those in ll, if any; the last have no text, but n_grams."""
    shared = rows.sparkSession.sparkContext.broadcast(np.vstack([log_p, np.full((1, BUCKETS), -np.log(BUCKETS))]) if last else log_p)
    size, own = len(log_p) + last, [c for c in rows.columns if c not in ("text", "ll")]
    more = "ll" in rows.columns
    rows = rows.select("text", *own, *(["ll"] if more else []))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin in range(0, whole.num_rows, 4096):
                batch = whole.slice(begin, 4096)
                n, ll = np.zeros(batch.num_rows), np.zeros((batch.num_rows, size))
                for c in X.chunks(batch.column(0)):
                    bucket, row = trigrams(c)
                    at = slice(c.first, c.first + c.n)
                    n[at] = np.bincount(row, minlength=c.n)
                    for k in range(size):
                        ll[at, k] = np.bincount(row, shared.value[k][bucket], c.n)
                ll *= np.minimum(1, FULL_WEIGHT / np.maximum(n, 1))[:, None]
                if more:
                    ll = np.hstack([batch.column(len(own) + 1).flatten().to_numpy().reshape(batch.num_rows, -1), ll])
                found = pa.ListArray.from_arrays(pa.array(np.arange(len(ll) + 1) * ll.shape[1], pa.int32()), pa.array(ll.ravel()))
                columns = {c: batch.column(i) for i, c in enumerate(["text", *own])} | {"n_grams": pa.array(n.astype(np.int64)), "ll": found}
                columns.pop("text" if last else "n_grams")
                yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    kinds = [f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields if f.name in own]
    return rows.mapInArrow(X.tidied(run), ", ".join([*kinds, "n_grams long", "ll array<double>"] if last else ["text string", *kinds, "ll array<double>"]))


def identify(rows: DataFrame, model: Model) -> DataFrame:
    """id, language, posterior, n_grams, rejected for each row of rows (id, text, declared, host, site, suffix).

    Any column may be null: null text has no trigrams, and other nulls give no evidence. A row is rejected
    if its text holds no letter, if und is the most probable, or if no language reaches
    LEAST_POSTERIOR; its language is then und. Equal probabilities go to the first language in the alphabet.
    Repeated rows count and are returned each. Without any labelled document every row is und. An empty
    table gives no rows.
    """
    languages = model.languages
    table = stored(likelihoods(rows.select(F.col("id").cast("long").alias("id"), "text", F.lower("declared").alias("declared"), "host", "site", "suffix", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("lettered")), model, ["id", "declared", "host", "site", "suffix", "lettered"]), "langid-rows")
    likely = F.array_position("ll", F.array_max("ll")) - 1
    table = table.withColumn("said", F.when(F.col("n_grams") > 0, likely).cast("int"))
    votes = table.where(F.col("said") < len(languages))
    n_languages = len(languages)
    counts = F.expr(f"transform(sequence(0, {n_languages - 1}), k -> coalesce(try_element_at(m, k), 0D))" if languages else "cast(array() as array<double>)")

    def tallied(level: str) -> DataFrame:
        """How many rows of each language the texts of a level say."""
        each = votes.where(f"{level} is not null").groupBy(level, "said").agg(F.count("*").cast("double").alias("n"))
        return each.groupBy(level).agg(F.map_from_entries(F.collect_list(F.struct("said", "n"))).alias("m")).select(level, counts.alias(f"c_{level}"))

    def smoothed(own: Column, above: Column) -> Column:
        """Counts of a level without the row's own vote, with those of the level above as LEVEL_ROWS further rows."""
        others = F.transform(own, lambda x, k: x - F.when(k == F.col("said"), 1.0).otherwise(0.0))
        total = F.aggregate(others, F.lit(0.0), lambda a, x: a + x) + LEVEL_ROWS
        return F.transform(F.zip_with(others, above, lambda x, p: x + LEVEL_ROWS * p), lambda x: x / total)

    whole = {r["said"]: r["count"] for r in votes.groupBy("said").count().collect()}
    p_all = [(whole.get(k, 0) + LEVEL_ROWS * (1.0 / n_languages)) / (sum(whole.values()) + LEVEL_ROWS) for k in range(n_languages)]
    base = F.array(*[F.lit(p) for p in p_all]).cast("array<double>")
    own = table.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)))
    for level in ("host", "site", "suffix"):  # most rows may be of one
        own = own.join(tallied(level).select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt")), [level, "salt"], "left")
    own = own.withColumn("p_site", smoothed(F.col("c_site"), base)).withColumn("p_suffix", smoothed(F.col("c_suffix"), base))
    own = own.withColumn("p_host", smoothed(F.col("c_host"), F.coalesce("p_site", base)))
    prior = F.coalesce("p_host", "p_site", base)
    names = F.array(*[F.lit(x) for x in languages]).cast("array<string>")
    wrong = (1 - DECLARED_RIGHT) / max(len(languages) - 1, 1)
    # the suffix tells by how much it raises a language over the whole collection
    score = F.expr("transform(names, (x, k) -> ll[k] + ln(prior[k]) + coalesce(ln(p_suffix[k] / base[k]), 0D) + CASE WHEN named THEN IF(x = declared, ln({0}D), ln({1}D)) ELSE 0D END)".format(DECLARED_RIGHT, wrong))
    und = F.col("ll")[len(languages)] + float(np.log(UND_PRIOR)) + F.when(F.col("named"), F.lit(float(np.log(wrong)))).otherwise(0.0)
    fused = own.withColumns({"names": names, "prior": prior, "base": base, "named": F.array_contains(names, F.col("declared"))}).withColumn("score", F.concat(score, F.array(und)))
    fused = fused.withColumn("top", F.array_max("score")).withColumn("best", (F.array_position("score", F.col("top")) - 1).cast("int"))
    posterior = 1 / F.aggregate("score", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("top")))
    fused = fused.withColumn("posterior", posterior)
    rejected = ~F.col("lettered") | (F.col("best") == len(languages)) | (F.col("posterior") < LEAST_POSTERIOR)
    return fused.select("id", F.when(rejected, F.lit(UND)).otherwise(F.get("names", F.col("best"))).alias("language"), "posterior", "n_grams", rejected.alias("rejected"))


def page_rows(pages: DataFrame) -> DataFrame:
    """id, text, declared, host, site, suffix of pages (page_id, url, html)."""
    body = F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", " ")
    host = F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1))
    rows = pages.select(F.col("page_id").alias("id"), F.regexp_replace(body, r"&[A-Za-z0-9#]+;", " ").alias("text"), F.regexp_extract("html", r"(?is)<html\b[^>]*\blang\s*=\s*[\"']?([A-Za-z]+)", 1).alias("declared"), F.nullif(host, F.lit("")).alias("host"))
    return rows.select("id", "text", F.nullif("declared", F.lit("")).alias("declared"), "host", F.nullif(F.regexp_extract("host", r"([^.]+\.[^.]+)$", 1), F.lit("")).alias("site"), F.nullif(F.regexp_extract("host", r"\.([^.]+)$", 1), F.lit("")).alias("suffix"))


def document_rows(docs: DataFrame) -> DataFrame:
    """The same of documents: the declared language is lang, the host is the source."""
    none = F.lit(None).cast("string")
    return docs.select(F.col("doc_id").alias("id"), "text", F.col("lang").alias("declared"), F.col("source").alias("host"), none.alias("site"), none.alias("suffix"))

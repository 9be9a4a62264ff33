"""Extra columns of any name change nothing."""

import pytest
from pyspark.sql import functions as F

#: Names that the operators use inside, among them those of their results.
CLASHING = ["component_id", "block", "block0", "key", "key0", "n_words", "start", "h", "kept", "salt", "id", "part", "w", "s", "n", "class", "print", "label", "filters", "shingles", "length", "doc", "row", "pos", "count", "t", "terms", "packed", "rep", "c", "to"]


def documents(spark):
    words = [f"w{k}" for k in range(60)]
    rows = []
    for d in range(40):
        own = words[d % 5 : d % 5 + 30] + [f"x{d % 7}", "token='abcdef123456'"] * (d % 3)
        rows.append((d if d else None, " ".join(own) if d % 9 else None, ["en", "de", None][d % 3], f"src{d % 4}", 10))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(2)


def operators():
    from sonalyze.llm import queries as Q
    from sonalyze.llm.bytespans import dedup_bytes
    from sonalyze.llm.contamination import find_passages
    from sonalyze.llm.divergence import divergence
    from sonalyze.llm.jaccard import similar_groups
    from sonalyze.llm.langid import document_rows, identify, train
    from sonalyze.llm.packing import pack
    from sonalyze.llm.secrets import find_secrets, listed
    from sonalyze.llm.shared import scratch
    from sonalyze.llm.substrings import dedup_substrings
    from sonalyze.llm.suffix_tree import score
    from sonalyze.llm.tokenfile import read_ids, write_ids

    def ids(docs):
        path = scratch(docs.sparkSession, "clash")
        write_ids(docs, path, Q.BYTE_BPE)
        return read_ids(docs.sparkSession, path).select("doc_id", "start", "n_tokens", F.crc32("ids"))

    items = lambda docs: docs.sparkSession.createDataFrame([(1, " ".join(f"w{k}" for k in range(3, 20)), 5)], "item_id long, text string, start int")
    own = lambda df, *names: df.select(*names)
    return {
        "op1": lambda d: find_passages(d, items(d)), "op2": lambda d: own(score(d), "doc_id", "n_tokens", "base_score"), "op3": lambda d: own(dedup_substrings(d), "doc_id", "n_words", "n_removed", "text"),
        "op5": lambda d: own(identify(document_rows(d), train(d)), "id", "rejected"), "op6": lambda d: own(pack(d, Q.BYTE_BPE, alpha=0.7), "doc_id", "length", "doc_tokens"), "op8": ids,
        "op9": lambda d: own(dedup_bytes(d), "doc_id", "n_bytes", "n_removed", F.sha2("kept", 256)), "op10": similar_groups, "op11": lambda d: find_secrets(d).select("doc_id", listed("base"), listed("added")), "op13": divergence,
    }


@pytest.mark.parametrize("name", ["op1", "op2", "op3", "op5", "op6", "op8", "op9", "op10", "op11", "op13"])
def test_extra_columns_change_nothing(spark, name):
    docs, run = documents(spark), operators()[name]
    clashing = docs.select("*", *(F.lit("clash").alias(c) if k % 2 else F.lit(7).alias(c) for k, c in enumerate(CLASHING)))
    shown = lambda df: sorted(map(repr, map(tuple, df.collect())))
    plain = shown(run(docs))
    assert plain and shown(run(clashing)) == plain

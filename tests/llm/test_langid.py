import random

import pytest

from sonalyze.llm import langid
from sonalyze.llm.langid import UND, document_rows, identify, page_rows, train

PARTS = {"en": ["the", "tion", "ing", "and", "of", "her"], "de": ["der", "ung", "sch", "über", "ein", "ich"], "es": ["ción", "los", "que", "ado", "ñ", "para"]}


def text(rng, lang, n):
    return " ".join("".join(rng.choice(PARTS[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def model(spark):
    rng = random.Random(1)
    rows = [(text(rng, lang, rng.randrange(20, 60)), lang) for lang in PARTS for _ in range(60)] + [(None, "en"), ("x", None), ("", "")]
    return train(spark.createDataFrame(rows, "text string, lang string"))


def test_held_out_accuracy_and_rejects(spark, model):
    rng = random.Random(2)
    docs = [(i, text(rng, lang, rng.randrange(3, 40)), lang if i % 4 else None, f"s{i % 5}") for i, lang in enumerate(rng.choices(sorted(PARTS), k=300))]
    truth = {}
    rng = random.Random(2)
    for (i, _, _, _), lang in zip(docs, rng.choices(sorted(PARTS), k=300)):
        truth[i] = lang
    docs += [(900, None, "en", "s1"), (901, " 12 $ ", "de", None), (902, "zqxj wvkq xzzk qqjv " * 30, None, None), (903, "", None, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string")
    got = {r.id: r for r in identify(document_rows(df.selectExpr("*", "1 ll", "2 posterior")), model).collect()}
    assert len(got) == 304 and all(got[k].language == UND and got[k].rejected for k in (900, 901, 902, 903))
    assert sum(got[k].language == v for k, v in truth.items()) >= 0.99 * len(truth)
    assert not any(got[k].rejected for k in truth)


def test_priors_decide_short_texts(spark, model):
    rng = random.Random(3)
    pages = [(i, f"http://www.a.de/x{i}", f"<html lang=\"de\"><script>the and</script><p>{text(rng, 'de', 20)}</p>") for i in range(40)]
    pages += [(100, "http://www.a.de/short", "<p>enen</p>"), (101, "http://b.a.de:80/", "<p>enen</p>"), (102, None, None), (103, "no address", "<b>" + text(rng, "es", 10))]
    pages += [(i, f"https://u@c.com/{i}", f"<html lang='en'>{text(rng, 'en', 20)}") for i in range(200, 240)]
    got = {r.id: r for r in identify(page_rows(spark.createDataFrame(pages, "page_id long, url string, html string")), model).collect()}
    assert got[100].language == got[101].language == "de" and got[102].language == UND and got[103].language == "es"
    assert all(got[i].language == "de" for i in range(40)) and all(got[i].language == "en" for i in range(200, 240))


def test_no_rows_and_no_labels(spark, model):
    docs = spark.createDataFrame([(1, "the and", "en", "s"), (1, "the and", "en", "s"), (None, "the", None, None)], "doc_id long, text string, lang string, source string")
    assert identify(document_rows(docs.limit(0)), model).count() == 0
    assert identify(document_rows(docs), model).count() == 3
    none = train(docs.select("text", "lang").limit(0))
    assert {r.language for r in identify(document_rows(docs), none).collect()} == {UND}


def test_every_labelled_language_is_a_class(spark, monkeypatch):
    rng = random.Random(5)
    own = {f"l{i:02}": ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=3)) for _ in range(6)] for i in range(70)}
    say = lambda lang, n: " ".join("".join(rng.choices(own[lang], k=2)) for _ in range(n))
    labelled = spark.createDataFrame([(say(lang, 40), lang) for i, lang in enumerate(own) for _ in range(1 + (i < 64))], "text string, lang string")
    docs = spark.createDataFrame([(i, say(lang, 12), None, None) for i, lang in enumerate(own)], "doc_id long, text string, lang string, source string")
    whole = {r.id: r for r in identify(document_rows(docs), train(labelled)).collect()}
    assert [whole[i].language for i in range(70)] == list(own)
    monkeypatch.setattr(langid, "BLOCK", 16)
    blocks = {r.id: r for r in identify(document_rows(docs), train(labelled)).collect()}
    assert blocks.keys() == whole.keys() and all(blocks[i].language == whole[i].language for i in whole)
    assert all(blocks[i].posterior == pytest.approx(whole[i].posterior) for i in whole)


def test_fusion_against_brute_force(spark, model):
    import math
    from collections import Counter

    from sonalyze.llm.langid import DECLARED_RIGHT, LEAST_POSTERIOR, LEVEL_ROWS, UND_PRIOR, likelihoods

    rng = random.Random(9)
    kinds = "id long, text string, declared string, host string, site string, suffix string"
    rows = []
    for i in range(150):
        site = rng.choice(["a.de", "b.com", "c.es", None])
        host = rng.choice([None, "www.", "m."]) if site else None
        rows.append((i, rng.choice([text(rng, rng.choice(sorted(PARTS)), rng.choice([1, 1, 2, 30])), "1 2", None]), rng.choice([None, "de", "EN", "xx"]), host and host + site, site, site and site.split(".")[1]))
    df = spark.createDataFrame(rows, kinds)
    got = {r.id: r for r in identify(df, model).collect()}
    ll = {r.id: (r.n_grams, list(r.ll)) for r in likelihoods(df, model, ["id"]).collect()}
    names = model.languages
    said = {i: (lambda v: v.index(max(v)))(ll[i][1]) if ll[i][0] else None for i in ll}
    votes = [(r, said[r[0]]) for r in rows if said[r[0]] is not None and said[r[0]] < len(names)]
    n = Counter(k for _, k in votes)
    base = [(n[k] + LEVEL_ROWS / len(names)) / (len(votes) + LEVEL_ROWS) for k in range(len(names))]
    wrong = (1 - DECLARED_RIGHT) / (len(names) - 1)
    for r in rows:
        i, own, declared, *levels = r

        def smoothed(at, above):
            voted = [k for v, k in votes if v[3 + at] == levels[at]]
            if levels[at] is None or not voted:
                return None
            c = Counter(k for v, k in votes if v[3 + at] == levels[at] and v[0] != i)
            return [(c[k] + LEVEL_ROWS * above[k]) / (sum(c.values()) + LEVEL_ROWS) for k in range(len(names))]

        site = smoothed(1, base)
        prior, suffix = smoothed(0, site or base) or site or base, smoothed(2, base)
        named = declared and declared.lower() in names
        score = [ll[i][1][k] + math.log(prior[k]) + (math.log(suffix[k] / base[k]) if suffix else 0) + (math.log(DECLARED_RIGHT if declared.lower() == x else wrong) if named else 0) for k, x in enumerate(names)]
        score.append(ll[i][1][-1] + math.log(UND_PRIOR) + (math.log(wrong) if named else 0))
        top = max(score)
        posterior = 1 / sum(math.exp(x - top) for x in score)
        best = score.index(top)
        rejected = not any(c.isalpha() for c in own or "") or best == len(names) or posterior < LEAST_POSTERIOR
        assert got[i].posterior == pytest.approx(posterior) and got[i].rejected == rejected and got[i].language == (UND if rejected else names[best])


def test_held_out_documents_without_their_label_as_evidence(spark):
    from zlib import crc32

    from pyspark.sql import functions as F

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(10)) == 0
    truth = {r.doc_id: r.lang for r in docs.where(out & F.col("lang").isNotNull()).collect()}
    assert all(crc32(str(k).encode()) % 10 == 0 for k in truth) and len(truth) > 50
    blind = docs.where(out).withColumn("lang", F.lit(None).cast("string"))
    got = {r.id: r.language for r in identify(document_rows(blind), train(docs.where(~out))).collect()}
    assert sum(got[k] == v for k, v in truth.items()) >= 0.95 * len(truth)

"""Events of articles, and components, against brute force."""

import random
from collections import Counter, defaultdict
from pathlib import Path

from sonalyze.operators import news as N
from sonalyze.operators.components import components


def reach(links):
    near = defaultdict(set)
    for a, b in links:
        if a != b:
            near[a].add(b)
            near[b].add(a)
    out = {}
    for x in sorted(near):
        todo = [x] if x not in out else []
        while todo:
            y = todo.pop()
            if y not in out:
                out[y] = x
                todo += near[y]
    return out


def test_components_equal_brute_force(spark):
    r = random.Random(2)
    chain = [(k, k + 1) for k in range(100, 160)]
    r.shuffle(chain)
    for links in ([], [(1, 1)], chain + [(7, k) for k in range(200, 260)] + [(3, 9), (9, 3), (260, 259), (-5, 3)], [(r.randrange(80), r.randrange(80)) for _ in range(60)]):
        found = components(spark.createDataFrame(links, "a long, b long"))
        assert {x.id: x.component for x in found.collect()} == reach(links)


def brute_events(rows):
    words = {d: {w for w in (t or "").lower().split() if len(w) >= N.TERM} for d, _, t in rows}
    lang = {d: g or "" for d, g, _ in rows}
    n_lang = Counter(lang.values())
    df = Counter((lang[d], w) for d, ws in words.items() for w in ws)
    signature = {}
    for d, ws in words.items():
        n = n_lang[lang[d]]
        known = [(df[lang[d], w], w) for w in ws if 1 < df[lang[d], w] <= max(N.LEAST_COMMON, n // N.COMMON_PART)]
        signature[d] = {w: (n // k).bit_length() for k, w in sorted(known)[: N.SIGNATURE]}
    links = []
    for a in words:
        for b in words:
            if a < b and lang[a] == lang[b]:
                shared = signature[a].keys() & signature[b].keys()
                if sum(signature[a][w] for w in shared) >= 2 * n_lang[lang[a]].bit_length():
                    links.append((a, b))
    found = reach(links)
    return {d: f"{lang[d]}:{found[d]}" if d in found else None for d in words}


def test_events_equal_brute_force_and_tell_stories_apart(spark):
    r = random.Random(4)
    common = [f"common{k}" for k in range(60)]
    stories = [[f"s{s}term{k}" for k in range(6)] for s in range(12)]
    rows = [(0, "en", None), (1, "en", ""), (2, None, "nothing shared here at all")]
    for d in range(3, 240):
        story = stories[d % 12] if d % 5 else []
        words = r.choices(common, k=30) + r.sample(story, k=min(len(story), 5)) + [f"own{d}", "surname" if d % 12 < 2 else "other"]
        r.shuffle(words)
        rows.append((d, "en" if d % 7 else None, "\n ".join(words).upper()))
    df = spark.createDataFrame([(*x, "clash") for x in rows], "doc_id long, lang string, text string, terms string").repartition(3)
    got = {x.doc_id: x.event_id for x in N.cluster(df).collect()}
    want = brute_events(rows)
    assert got == want
    # retold in other words of the same story, an article keeps its event; a surname that two stories share joins none
    told = defaultdict(set)
    for d, _, t in rows[3:]:
        if d % 5 and d % 7:
            told[d % 12].add(got[d])
    assert all(None not in e and len(e) == 1 for e in told.values()) and len(set.union(*told.values())) == 12
    assert N.cluster(spark.createDataFrame([], "doc_id long, lang string, text string")).collect() == []


def test_similar_articles_equal_all_pairs(spark):
    r = random.Random(6)
    words = [f"w{k}" for k in range(400)]
    base = [r.choices(words, k=40) for _ in range(12)]
    texts = [None, "", "...", "one two", "Two, one!", "one TWO"]
    for _ in range(150):
        own = list(r.choice(base))
        for _ in range(r.choice([0, 0, 1, 1, 2, 3, 6])):
            own[r.randrange(len(own))] = r.choice(words)
        texts.append(" ".join(own) if r.random() < 0.5 else ", ".join(own).upper())
    ids = list(range(len(texts)))
    r.shuffle(ids)

    def runs(text):
        w = __import__("re").findall(r"[^\W_]+", (text or "").lower())
        return {tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()

    sets = {i: runs(t) for i, t in zip(ids, texts)}
    want = {i: not any(sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]) for j in sets if j < i) for i in sets}
    df = spark.createDataFrame([(i, t, "clash", 1) for i, t in zip(ids, texts)], "doc_id long, text string, s string, band int")
    got = {x.doc_id: x.kept for x in N.similar_dedup(df).collect()}
    assert got == want and 10 < sum(want.values()) < 140
    assert N.similar_dedup(df.limit(0)).collect() == []


def test_similar_dedup_stores_no_runs_of_articles_that_meet_none(spark, tmp_path):
    from sonalyze.shared import shared_dir

    folder = shared_dir(spark).removeprefix("file:")
    size = lambda: sum(f.stat().st_size for f in Path(folder).rglob("*") if f.is_file())
    r = random.Random(3)
    rows = [(i, " ".join("".join(r.choices("abcdefghij", k=6)) for _ in range(300))) for i in range(200)]
    before = size()
    assert all(x.kept for x in N.similar_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert size() - before < sum(len(t) for _, t in rows) / 2


def test_cluster_stores_words_of_an_article_in_one_row(spark):
    from sonalyze.shared import shared_dir

    folder = shared_dir(spark).removeprefix("file:")
    size = lambda: sum(f.stat().st_size for f in Path(folder).rglob("*") if f.is_file())
    r = random.Random(4)
    rows = [(i, "en", " ".join("".join(r.choices("abcdefghij", k=6)) for _ in range(300))) for i in range(300)]
    before = size()
    assert all(x.event_id is None for x in N.cluster(spark.createDataFrame(rows, "doc_id long, lang string, text string")).collect())
    assert size() - before < sum(len(t) for *_, t in rows)

import math
import random
import re
from collections import Counter
from dataclasses import replace

import numpy as np
import pytest

from sonalyze.llm import sketch
from sonalyze.llm import suffix_tree as M

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def tokens(text):
    return [*WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")), None]


def corpus():
    rng = random.Random(1)
    docs = []
    for i in range(300):
        out = ["The"]
        for _ in range(rng.randrange(0, 60)):
            mat = [w.lower() for w in out[-2:]] == ["on", "the"]
            out.append({"the": "mat" if mat else "cat", "cat": rng.choice(["sat", "ran"]), "sat": "on", "on": "the"}.get(out[-1].lower(), rng.choice(["the", "on", f"r{rng.randrange(500)}"])))
        docs.append((i, " ".join(out) if i % 11 else rng.choice([None, "", " \n", "Ünique É"])))
    return docs


def brute(docs, bounds):
    """Scores by the definition, with dictionaries."""
    texts = {i: tokens(x) for i, (_, x) in enumerate(docs)}
    train = [i for i, (k, _) in enumerate(docs) if not M.held_out(k)]
    counts = Counter(t for i in train for t in texts[i])
    n, v = sum(counts.values()), len(counts)
    base = lambda t: (counts[t] + 0.1) / (n + 0.1 * (v + 1))
    states = {(): None}

    def probability(past, t):
        """In the longest suffix state of past, nearest symbol first."""
        p, length = base(t), 0
        for k in range(1, len(past) + 1):
            if past[:k] not in states:
                break
            left, mass = states[past[:k]]
            p, length = p * left + mass.get(t, 0.0), k
        return p, length

    def pasts(ts):
        for at in range(len(ts)):
            yield at, tuple([*ts[:at][::-1], None])

    follow = {}
    for k in range(0, bounds.depth + 1):
        for i in train:
            for at, past in pasts(texts[i]):
                if len(past) >= k:
                    follow.setdefault(past[:k], Counter())[texts[i][at]] += 1
    for k in range(1, bounds.depth + 1):
        new = {}
        for context, c in follow.items():
            total, cells = sum(c.values()), {t: m for t, m in c.items() if m >= bounds.cell}
            if len(context) != k or total < bounds.state or context[:-1] not in states:
                continue
            suffix = follow[context[:-1]]
            p = {t: suffix[t] / sum(suffix.values()) for t in cells}
            gain, rest = sum(m * math.log(m / (total * p[t])) for t, m in cells.items()), total - sum(cells.values())
            if rest:
                gain += rest * math.log(rest / (total * max(1 - sum(p.values()), 1e-9)))
            if gain >= bounds.gain:
                mass = {t: (m - 0.75) / total for t, m in cells.items()}
                new[context] = 1 - sum(mass.values()), mass
        if not new:
            break
        states |= new
    out = []
    for i, (key, _) in enumerate(docs):
        got = [probability(past[: bounds.depth], texts[i][at]) for at, past in pasts(texts[i])]
        out.append((key, M.held_out(key), len(got), sum(counts[t] > 0 for t in texts[i]), n, sum(math.log10(base(t)) for t in texts[i]), sum(math.log10(p) for p, _ in got), sum(k > 0 for _, k in got) / len(got)))
    return out, states


def close(got, want):
    got, want = (sorted(map(tuple, rows), key=lambda r: tuple(r[:4]) + (round(r[5], 6),)) for rows in (got, want))
    assert [r[:5] for r in got] == [r[:5] for r in want]
    for a, b in zip(got, want):
        assert a[5:] == pytest.approx(b[5:])


SMALL = M.Bounds(state=8, cell=2, gain=2.0, depth=4)


@pytest.mark.parametrize("bounds, parts", [(M.Bounds(), 4), (SMALL, 4), (replace(SMALL, state=5, cell=3, depth=1), 1), (replace(SMALL, depth=2), 3), (replace(SMALL, state=4, depth=7), 2)])
def test_scores_against_brute_force(spark, monkeypatch, bounds, parts):
    docs = corpus()
    monkeypatch.setattr(M, "BLOCK_BYTES", 3000)
    monkeypatch.setattr(M, "PART_BYTES", 9000)
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("doc_id", "text", "1 part", "'x' score").repartition(parts)
    want, states = brute(docs, bounds)
    close(M.score(df, bounds).collect(), want)
    assert len(states) >= 8 and max(map(len, states)) >= min(bounds.depth, 2)


def test_the_tree_grows_with_the_corpus():
    rng = random.Random(3)
    sizes = []
    for n in (40, 400):
        words = rng.choices(range(n), k=80 * n)
        docs = [(i, " ".join(f"w{x} v{x}" for x in words[i::50])) for i in range(50)]
        sizes.append(len(brute(docs, M.Bounds())[1]))
    assert sizes[1] > 5 * sizes[0]


def test_every_state_sums_to_one():
    docs = corpus()
    _, states = brute(docs, SMALL)
    counts = Counter(t for k, x in docs if not M.held_out(k) for t in tokens(x))
    n, v = sum(counts.values()), len(counts)

    def total(context):
        if not context:
            return sum((c + 0.1) / (n + 0.1 * (v + 1)) for c in counts.values()) + 0.1 / (n + 0.1 * (v + 1))  # and unknown words
        left, mass = states[context]
        return left * total(context[:-1]) + sum(mass.values())

    assert len(states) > 8 and all(total(c) == pytest.approx(1) for c in states)


def test_runs_of_marked_tokens():
    assert M.in_a_row(np.array([0, 1, 4, 6, 7, 8]), 10).tolist() == [1, 2, 0, 0, 1, 0, 1, 2, 3, 0]


def test_held_out_words_are_likelier_in_contexts(spark):
    docs = spark.createDataFrame(corpus(), "doc_id long, text string")
    out = [r for r in M.score(docs).collect() if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out) + 50 and max(r.state_share for r in out) > 0.5


def test_repeated_rows_null_ids_and_no_rows(spark):
    docs = [(None, "a b"), (3, "a b"), (3, "a b"), (3, "c"), (3, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = M.score(df, SMALL).collect()
    assert sorted((r.doc_id or 0, r.n_tokens) for r in got) == [(0, 3), (3, 1), (3, 2), (3, 3), (3, 3)]
    close([(r.doc_id or 0, *r[1:]) for r in got], [(r[0] or 0, *r[1:]) for r in brute(docs, SMALL)[0]])
    assert M.score(df.limit(0)).count() == 0


def test_answers_hold_no_hashes(spark, monkeypatch):
    for module in (M, sketch):
        monkeypatch.setattr(module, "n_buckets", lambda *_: 1)
    rng = random.Random(5)
    docs = [(i, " ".join(f"w{min(int(rng.paretovariate(0.7)), 2000)}" for _ in range(3000))) for i in range(30)]
    told = M.learn(spark.createDataFrame(docs, "doc_id long, text string"), SMALL).told
    texts = [[None, *tokens(x)] for k, x in docs if not M.held_out(k)]
    runs = Counter(tuple(t[i : i + n]) for t in texts for n in range(1, SMALL.depth + 2) for i in range(len(t) - n + 1) if n > 1 or i)
    n_bytes = {k: sum(len(r.c1 or b"") + len(r.c2 or b"") for r in told[k].collect() if r.kind == k) for k in (M.RUNS, M.STATES)}
    assert n_bytes[M.RUNS] < 4 * sum(n >= SMALL.cell and len(run) > 1 for run, n in runs.items())
    assert n_bytes[M.STATES] < 8 * sum(n >= SMALL.state and len(run) <= SMALL.depth for run, n in runs.items())


def test_a_block_has_its_rows_in_one_order(spark):
    df = spark.createDataFrame([*corpus()[:50], (7, "b c"), (7, "a"), (None, "d"), (None, None)], "doc_id long, text string")
    learner = M.Learner(df, SMALL)
    table = learner.blocks.docs.toArrow()
    one, two = (learner.ordered(table.take(at)) for at in (list(range(54)), random.Random(2).sample(range(54), 54)))
    assert one.equals(two) and (M.Symbols(one).s == M.Symbols(two).s).all()

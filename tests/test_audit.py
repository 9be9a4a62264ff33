import datetime as dt

import pytest
from pyspark.sql import functions as F

from sonalyze.operators import audit as A
from sonalyze.plans import views as V
from sonalyze.plans.workflows import NEWS, Registry, Stage, Workflow

FAKE = Workflow("fake", 1, (Stage("A", "unit", ("lost",)), Stage("B", "unit"), Stage("C", "unit")))


def rows(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.collect()]


def test_a_workflow_that_is_not_news(spark):
    registry = Registry(NEWS, FAKE)
    stages = spark.createDataFrame([(1, "A", 1, "succeeded"), (1, "B", 2, "succeeded"), (1, "C", 3, "succeeded"), (2, "A", 1, "failed"), (2, "B", 2, "succeeded"), (3, "B", 1, "succeeded"), (3, "A", 2, "succeeded")], "task_id int, stage_key string, actual_seq int, status string").withColumns({"workflow": F.lit("fake"), "version": F.lit(1)})
    found = sorted(rows(A.precondition_check(stages, registry.preconditions(spark)), "task_id", "stage_key", "required_key"))
    assert found == [(2, "B", "A"), (3, "B", "A")]
    expected = registry.definitions(spark).where("workflow = 'fake'").select(F.lit(3).alias("task_id"), "stage_key", F.col("expected_seq").cast("long"))
    got = {r.stage_key: r.finding for r in A.reconcile(expected, stages.where("task_id = 3")).collect()}
    assert got == {"A": "matched", "B": "out_of_order", "C": "missing"}
    assert registry.definitions(spark).where("workflow = 'news'").count() == 8
    with pytest.raises(ValueError):
        registry.add(FAKE)
    with pytest.raises(ValueError):
        Registry(Workflow("x", 1, (Stage("A", "u"),), {"A": ("Z",)}))


def test_funnel_and_exit(spark):
    stages = spark.createDataFrame([(1, "A", 100, 90, {"lost": 7}), (1, "B", 90, 90, {}), (2, "A", None, 1, {}), (2, "B", 5, 5, {"x": None}), (3, "A", 0, 0, {"lost": 0})], "task_id int, stage_key string, input long, output long, routes map<string,long>")
    checked = A.funnel_check(stages)
    assert sorted(rows(checked, "task_id", "stage_key", "residual", "verdict"), key=str) == [(1, "A", 3, "deviation"), (1, "B", 0, "compliant"), (2, "A", None, "incomplete"), (2, "B", None, "incomplete"), (3, "A", 0, "compliant")]
    assert [tuple(r[0]) for r in checked.where("result is not null").select("result").collect()] == [("funnel_conservation", 100, 97, 3)]
    verdicts = A.task_verdicts(checked)
    assert sorted(rows(verdicts, "task_id", "design")) == [(1, "deviation"), (2, "incomplete"), (3, "compliant")]
    done = A.terminal_check(verdicts.withColumn("status", F.lit("succeeded")))
    assert sorted(rows(done, "task_id", "conclusion", "exit_code", "legal")) == [(1, "not_successful", 9, True), (2, "succeeded", 0, False), (3, "succeeded", 0, True)]


def test_blocked_is_no_deviation(spark):
    t = spark.createDataFrame([(1, "blocked", "compliant", None), (2, "failed", "pending", "no_model"), (3, "running", "pending", None), (4, "abandoned", "incomplete", "lock"), (5, "odd", "pending", None), (6, None, None, None)], "task_id int, status string, design string, failure string")
    got = {r.task_id: (r.terminal, r.legal, r.conclusion, r.exit_code) for r in A.terminal_check(t).collect()}
    assert got[1] == (True, True, "not_successful", 9) and got[2] == (True, True, "not_successful", 7) and got[3] == (False, True, "open", None) and got[4] == (True, True, "not_successful", 5) and got[5][1] is False and got[6][1] is False


def test_links(spark):
    stages = spark.createDataFrame([(10, 1), (20, 2)], "stage_id int, task_id int")
    details = spark.createDataFrame([(None, None), (1, None), (None, 10), (1, 10), (2, 10), (1, 99)], "task_id int, stage_id int")
    assert sorted(rows(A.link_check(details, stages), "link")) == [("cross_task",), ("half_null",), ("half_null",), ("none",), ("ok",), ("orphan",)]


def test_recovery(spark):
    at = lambda h: dt.datetime(2026, 7, 15, h)
    tasks = spark.createDataFrame([(1, "d", "running", at(1)), (2, "d", "succeeded", at(1)), (3, "d", "running", at(9)), (4, "e", "running", at(1)), (5, "d", "running", at(2))], "task_id int, lock_domain string, status string, started_at timestamp_ntz")
    locks = spark.createDataFrame([("d", 5, at(5))], "lock_domain string, holder int, acquired_at timestamp_ntz")
    assert rows(A.recovery(tasks, locks), "task_id", "recovered_by", "status", "design") == [(1, 5, "abandoned", "incomplete")]


def test_transitions_and_sequences(spark):
    log = spark.createDataFrame([(1, 1, "requested"), (1, 2, "running"), (1, 3, "succeeded"), (1, 4, "running"), (2, 1, "running"), (3, 1, "requested"), (3, 2, "blocked")], "task_id int, seq int, state string")
    assert sorted(rows(A.transition_check(log).where("not legal"), "task_id", "seq")) == [(1, 4), (2, 1)]
    stages = spark.createDataFrame([(1, "a", 1, 1), (1, "a", 2, 2), (2, "a", 1, 1), (2, "a", 1, 3), (3, "a", 1, 1), (3, "b", 1, 1)], "task_id int, stage_key string, attempt_no int, actual_seq int")
    assert sorted(rows(A.sequence_check(stages), "task_id", "repeated_seq", "gapless", "repeated_attempts", "valid")) == [(1, 0, True, 0, True), (2, 0, False, 1, False), (3, 1, True, 0, False)]
    renumbered = A.number_stages(stages.drop("actual_seq"), ["stage_key", "attempt_no"])
    assert sorted(rows(renumbered, "task_id", "actual_seq")) == [(1, 1), (1, 2), (2, 1), (2, 2), (3, 1), (3, 2)]


def test_commands_and_rollout(spark):
    tasks = spark.createDataFrame([("run", "r1", 0, False, "compliant"), ("run", "r1", 0, False, "compliant"), ("list", "r2", 0, False, "compliant")], "command string, run_id string, exit_code int, overdue boolean, design string")
    monitored = A.monitoring(tasks)
    assert sorted(rows(monitored, "command", "extra_tasks", "no_go")) == [("list", 0, False), ("run", 1, True)] and A.no_go(monitored).first()[0]
    assert A.no_go(monitored.limit(0)).first()[0] is False
    assert A.tasks_added(tasks, tasks).count() == 0 and rows(A.tasks_added(tasks.limit(0), tasks.limit(1)), "change") == [("added",)]
    text = spark.createDataFrame([("Cookie: a=b; x", ), ("api_key=12 ok",), ("nothing here",)], "t string")
    assert [r[0] for r in text.select(A.redact(F.col("t"), 20)).collect()] == ["Cookie: ***; x", "api_key=*** ok", "nothing here"]
    assert [r[0] for r in text.select(A.leaks(F.col("t"))).collect()] == [True, True, False]


def test_views_show_the_same_as_json(spark):
    import json

    at = dt.datetime(2026, 7, 15)
    tasks = spark.createDataFrame([(1, "m", "op", "me", "succeeded", at), (2, "m", "op", None, "failed", at)], "task_id int, module string, operation string, actor string, status string, started_at timestamp_ntz")
    stages = spark.createDataFrame([(1, 1, "A", "succeeded", at, at + dt.timedelta(seconds=5))], "task_id int, actual_seq int, stage_key string, status string, started_at timestamp_ntz, ended_at timestamp_ntz")
    shown = V.task_show(tasks, stages)
    assert rows(shown, "task_id", "who", "stage_key", "seconds") == [(1, "me", "A", 5), (2, None, None, None)]
    parsed = [json.loads(r.json) for r in V.as_json(shown).collect()]
    assert [p["who"] for p in parsed] == ["me", None] and list(parsed[0]) == shown.columns
    assert rows(V.task_list(tasks, status="failed", module="m"), "task_id") == [(2,)]
    assert V.resolve(tasks, {"m": lambda s: s.select("task_id")})["m"].count() == 2


def test_locks_that_change_hands(spark):
    """The first acquisition by another, over spans, ties and runs of one holder."""
    import random

    r = random.Random(8)
    at = lambda h: dt.datetime(2026, 7, 1) + dt.timedelta(hours=h)
    tasks = [(k, r.choice("de"), r.choice(["running", "failed"]), at(r.randrange(300)) if k % 11 else None) for k in range(60)]
    locks = [(r.choice("de"), r.choice([k, k, 5, 5, None]), at(r.randrange(0, 300, 3))) for k in range(0, 60, 2)] * 2
    want = []
    for k, domain, status, start in tasks:
        later = [(a, h) for d, h, a in locks if d == domain and h is not None and h != k and status == "running" and start and a > start]
        if later:
            first = min(later)[0]
            holders = {h for d, h, a in locks if d == domain and a == first and h is not None}
            want.append((k, max(holders) if min(holders) == k else min(holders)))
    t = spark.createDataFrame(tasks, "task_id int, lock_domain string, status string, started_at timestamp_ntz")
    own = spark.createDataFrame(locks, "lock_domain string, holder int, acquired_at timestamp_ntz")
    for span in ("DAY", "HOUR", "YEAR"):
        assert sorted(rows(A.recovery(t, own, span), "task_id", "recovered_by")) == want and want
    assert A.recovery(t, own.limit(0)).collect() == []


def test_snapshots_judge_their_own_tasks(spark):
    old, new = Workflow("w", 1, (Stage("a", "u"), Stage("b", "u"))), Workflow("w", 2, (Stage("b", "u"), Stage("c", "u")))
    held = [(1, old.snapshot()), (2, new.snapshot()), (3, None), (4, "{"), (5, '{"stages": []}'), (6, '{"stages": [{"key": "a"}, {"key": "b"}]}')]
    tasks = spark.createDataFrame(held, "task_id int, snapshot string")
    stages = spark.createDataFrame([(t, s, n) for t in range(1, 7) for n, s in enumerate("ab", 1)], "task_id int, stage_key string, actual_seq int")
    found = {}
    for r in A.reconcile_snapshots(tasks, stages).collect():
        found.setdefault(r.task_id, {})[r.stage_key] = r.finding
    assert found == {1: {"a": "matched", "b": "matched"}, 2: {"a": "extra", "b": "matched", "c": "missing"}, 3: {None: "no_snapshot"}, 4: {None: "no_snapshot"}, 5: {None: "no_snapshot"}, 6: {"a": "matched", "b": "matched"}}


def test_formulas_of_versions(spark):
    one = Workflow("w", 1, (Stage("a", "item", ("lost",)), Stage("b", "item", hard=False)))
    two = Workflow("w", 2, (Stage("a", "item", ("lost", "held"), relation="input = 2 * (output + lost) + held"),))
    data = [
        (1, 1, "a", "item", 10, 8, {"lost": 2}), (2, 1, "a", "item", 10, 8, {"lost": 1}), (3, 1, "a", "item", 10, 8, {}), (4, 1, "a", "item", 10, 8, {"lost": 2, "held": 0}), (5, 1, "a", "box", 10, 8, {"lost": 2}),
        (6, 1, "b", "item", 5, 4, {}), (7, 1, "c", "item", 5, 5, {}), (8, 3, "a", "item", 5, 5, {}), (9, 2, "a", "item", 21, 8, {"lost": 2, "held": 1}), (10, 1, "b", "item", None, 4, {}), (11, 1, "a", None, 10, 8, {"lost": 2}),
    ]
    stages = spark.createDataFrame([(k, "w", *x) for k, *x in data], "task_id int, workflow string, version int, stage_key string, unit string, input long, output long, routes map<string,long>")
    got = {r.task_id: (r.verdict, r.rule_id, r.residual) for r in Registry(one, two).check(stages).collect()}
    assert got == {
        1: ("compliant", None, 0), 2: ("deviation", "funnel_conservation", 1), 3: ("incomplete", None, None), 4: ("deviation", "undeclared_route", 0), 5: ("deviation", "mixed_units", 0), 6: ("warning", "funnel_conservation", 1),
        7: ("deviation", "undeclared_stage", None), 8: ("deviation", "undeclared_stage", None), 9: ("compliant", None, 0), 10: ("incomplete", None, None), 11: ("compliant", None, 0),
    }
    for bad in ("input = output + other", "input", "input = output; drop", "input = f(output)"):
        with pytest.raises(ValueError):
            Registry(Workflow("x", 1, (Stage("a", "u", relation=bad),)))


def test_launch_checks(spark):
    at = lambda h: dt.datetime(2026, 7, 1) + dt.timedelta(hours=h)
    tasks = [("c", 1, 1, -1, 0, 6, "deviation"), ("c", 1, 2, 0, 1, 0, "compliant"), ("c", 2, 3, 1, 2, 0, "compliant"), ("c", 2, 4, 2, 3, 0, "compliant"), ("c", 3, 5, 3, None, None, "pending"), ("c", 4, 6, 5, 6, 6, "incomplete"), ("e", 9, 7, 30, 31, 0, "compliant")]
    t = spark.createDataFrame([(c, r, k, at(s), None if e is None else at(e), x, d) for c, r, k, s, e, x, d in tasks], "command string, run_id int, task_id int, started_at timestamp_ntz, ended_at timestamp_ntz, exit_code int, design string")
    launches = spark.createDataFrame([("c", at(0), 1800), ("d", at(0), 60), ("e", at(0), 60)], "command string, launched_at timestamp_ntz, max_seconds int")
    got = {(r.command, r.check_key): tuple(r)[2:] for r in A.launch_checks(t, launches, F.lit(at(10))).collect()}
    assert got["c", "first_task"] == (True, 1, 1, 0, 0, 0, 0, False) and got["c", "first_runs"] == (True, 3, 4, 1, 0, 1, 0, True)
    assert got["c", "within_4_hours"] == (True, 3, 4, 1, 0, 1, 0, True) and got["c", "within_24_hours"] == (False, 4, 5, 1, 1, 1, 1, True)
    assert got["d", "first_task"] == (False, 0, 0, 0, 0, 0, 0, False) and got["e", "within_24_hours"][:3] == (False, 0, 0) and len(got) == 12


def test_states_that_do_not_go_together_break_a_constraint(spark):
    base = "1 AS task_id, 'a' AS stage_key, 1 AS actual_seq, 1 AS attempt_no, 1L AS input, 1L AS output, map('r', 0L) AS routes, timestamp_ntz'2026-01-01' AS started_at, timestamp_ntz'2026-01-02' AS ended_at"
    df = spark.sql(f"SELECT {base}, * FROM VALUES ('succeeded', 'compliant'), ('succeeded', 'pending'), ('running', 'pending'), ('running', 'deviation'), ('odd', 'pending') AS v(status, design)")
    assert sorted((r.status, r.design, *r.violations) for r in A.constraint_violations(df).collect()) == [("odd", "pending", "illegal_state"), ("running", "deviation", "illegal_state"), ("succeeded", "pending", "illegal_state")]

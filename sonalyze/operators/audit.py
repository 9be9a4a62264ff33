"""Checks over a ledger of business tasks and their stages. Every check is a query over rows; none changes them.

tasks: task_id, status, design, ...; stages: task_id, stage_key, attempt_no, actual_seq, status, input, output,
routes (map of exclusive routes to counts). Order is proven by actual_seq, never by time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sonalyze.operators.asof import before, first_after

# States, edges, terminal pairs, exit codes and command classes of the specification.
EDGES = [("requested", "running"), ("requested", "blocked"), ("running", "succeeded"), ("running", "partial_success"), ("running", "failed"), ("running", "abandoned")]
EXECUTION = ["requested", "running", "succeeded", "partial_success", "failed", "blocked", "abandoned"]
DESIGN = ["pending", "compliant", "deviation", "incomplete"]
TERMINAL = ["succeeded", "partial_success", "failed", "blocked", "abandoned"]
EXIT_PARTIAL, EXIT_LOCKED, EXIT_AUDIT, EXIT_NO_MODEL, EXIT_DEVIATION = 4, 5, 6, 7, 9
RERUN_NEVER = ["committed", "unknown"]
SECRETS = r"(?i)\b(authorization|proxy-authorization|cookie|set-cookie|api[_-]?key|access[_-]?key|token|secret|password)\b(\s*[:=]\s*)(?:(?:bearer|basic)\s+)?[^\s,;]+"
#: The exit code of success isn't specified; 0 is our choice.
EXIT_SUCCESS = 0


def number_stages(stages: DataFrame, order: list[str]) -> DataFrame:
    """stages with actual_seq from 1 within each task, in the given order."""
    return stages.withColumn("actual_seq", F.row_number().over(Window.partitionBy("task_id").orderBy(*order)))


def sequence_check(stages: DataFrame) -> DataFrame:
    """A row for each task: its stages, sequence numbers that repeat, whether they run from 1 without a gap, and
    (stage, attempt) pairs that repeat. Counted by grouping alone, so a task of many stages is no large group."""
    seqs = stages.groupBy("task_id", "actual_seq").agg(F.count("*").alias("n"))
    own = seqs.groupBy("task_id").agg(F.sum("n").alias("stages"), F.sum(F.col("n") - 1).alias("repeated_seq"), F.count("actual_seq").alias("distinct_seq"), F.min("actual_seq").alias("low"), F.max("actual_seq").alias("high"))
    attempts = stages.groupBy("task_id", "stage_key", "attempt_no").agg((F.count("*") - 1).alias("n")).groupBy("task_id").agg(F.sum("n").alias("repeated_attempts"))
    gapless = (F.col("low") == 1) & (F.col("high") == F.col("distinct_seq"))
    return own.join(attempts, "task_id").select("task_id", "stages", "repeated_seq", gapless.alias("gapless"), "repeated_attempts", (gapless & (F.col("repeated_seq") == 0) & (F.col("repeated_attempts") == 0)).alias("valid"))


def predecessor_check(stages: DataFrame) -> DataFrame:
    """stages with the status before, whether it had succeeded, and whether a deviation came earlier, after
    which no stage may run. rule_id and blocked_stage name what is violated."""
    w = Window.partitionBy("task_id").orderBy("actual_seq")
    before = F.lag("status").over(w)
    earlier = F.max((F.col("status") == "deviation").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, -1))
    ready = F.coalesce(before == "succeeded", F.lag("task_id").over(w).isNull())
    late = F.coalesce(earlier, F.lit(0)) == 1
    rule = F.when(late, "stopped_after_deviation").when(~ready, "predecessor_succeeded")
    return stages.select("*", before.alias("previous_status"), ready.alias("predecessor_ok"), late.alias("after_deviation"), rule.alias("rule_id"))


def precondition_check(stages: DataFrame, required: DataFrame) -> DataFrame:
    """Of stages (task_id, workflow, version, stage_key, actual_seq), the preconditions that no earlier stage
    that succeeded meets: task_id, stage_key, required_key."""
    wanted = stages.join(required, ["workflow", "version", "stage_key"]).select("task_id", "stage_key", "required_key", "actual_seq")
    met = stages.where("status = 'succeeded'").groupBy("task_id", F.col("stage_key").alias("required_key")).agg(F.min("actual_seq").alias("met_at"))
    return wanted.join(met, ["task_id", "required_key"], "left").where("met_at IS NULL OR met_at >= actual_seq").select("task_id", "stage_key", "required_key")


def reconcile(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Expected (task_id, stage_key, expected_seq) against actual stages: matched, missing, extra, duplicate or
    out_of_order. expected is what the task stored at its start, not today's definition."""
    had = actual.groupBy("task_id", "stage_key").agg(F.count("*").alias("times"), F.min("actual_seq").alias("actual_seq"))
    both = expected.join(had, ["task_id", "stage_key"], "full")
    # the order among the stages that are both expected and there
    there = F.col("expected_seq").isNotNull() & F.col("actual_seq").isNotNull()
    w = Window.partitionBy("task_id").orderBy(F.col("expected_seq").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    ahead = F.max(F.when(there, F.col("actual_seq"))).over(w)
    finding = F.when(F.col("actual_seq").isNull(), "missing").when(F.col("expected_seq").isNull(), "extra").when(F.col("times") > 1, "duplicate").when(ahead > F.col("actual_seq"), "out_of_order").otherwise("matched")
    return both.select("task_id", "stage_key", "expected_seq", "actual_seq", F.coalesce("times", F.lit(0)).cast("long").alias("times"), finding.alias("finding"))


def snapshot_stages(tasks: DataFrame) -> DataFrame:
    """task_id, stage_key, expected_seq out of the snapshot of each of tasks (task_id, snapshot: text of JSON): the stages that its
    workflow had when it started, in their order. A task whose snapshot can't be read has one row, without a stage."""
    held = tasks.select("task_id", F.try_parse_json("snapshot").alias("_body"))
    stage = held.sparkSession.tvf.variant_explode_outer(F.try_variant_get(F.col("_body").outer(), "$.stages", "variant"))
    key, seq = F.try_variant_get("value", "$.key", "string"), F.try_variant_get("value", "$.seq", "int")
    return held.lateralJoin(stage).select("task_id", key.alias("stage_key"), F.coalesce(seq, F.col("pos") + 1).cast("long").alias("expected_seq"))


def reconcile_snapshots(tasks: DataFrame, actual: DataFrame) -> DataFrame:
    """reconcile() of each task with the stages that its own snapshot expects, so that a changed definition judges no old task. A
    task without a readable snapshot can't be judged: it has one row, no_snapshot."""
    expected = snapshot_stages(tasks)
    unknown = expected.where("stage_key IS NULL").select("task_id").distinct()
    found = reconcile(expected.where("stage_key IS NOT NULL").join(unknown, "task_id", "left_anti"), actual.join(unknown, "task_id", "left_anti"))
    none = unknown.select("task_id", F.lit("no_snapshot").alias("finding"))
    return found.unionByName(none, allowMissingColumns=True)


def funnel_check(stages: DataFrame) -> DataFrame:
    """stages with explained (output and exclusive routes), residual and verdict. A count that is missing makes a
    stage incomplete; it is never 0. Reasons and metrics in other units are no routes."""
    routes = F.aggregate(F.map_values("routes"), F.lit(0).cast("long"), lambda a, x: a + x)
    explained = F.col("output") + routes
    residual = F.col("input") - explained
    verdict = F.when(residual.isNull(), "incomplete").when(residual == 0, "compliant").otherwise("deviation")
    result = F.when(residual != 0, F.struct(F.lit("funnel_conservation").alias("rule_id"), F.col("input").alias("expected"), explained.alias("actual"), residual.alias("diff")))
    return stages.select("*", explained.alias("explained"), residual.alias("residual"), verdict.alias("verdict"), result.alias("result"))


def task_verdicts(checked: DataFrame) -> DataFrame:
    """A task's design verdict from its stages': any deviation, else anything incomplete, else compliant."""
    any_ = lambda v: F.coalesce(F.bool_or(F.col("verdict") == v), F.lit(False))
    return checked.groupBy("task_id").agg(F.when(any_("deviation"), "deviation").when(any_("incomplete"), "incomplete").otherwise("compliant").alias("design"), F.count_if(F.col("verdict") == "deviation").alias("deviations"))


def terminal_check(tasks: DataFrame) -> DataFrame:
    """tasks (task_id, status, design) with terminal, legal, conclusion and exit_code.

    A success is compliant or a deviation; what failed or was blocked keeps its verdict so far; what was
    abandoned is incomplete; others are pending. A deviation is shown as such, whatever the status; a request
    that was blocked as it should be is none. failure: lock, audit or no_model where the reason is known.
    """
    status, design = F.col("status"), F.col("design")
    terminal = status.isin(*TERMINAL)
    legal = (
        F.when(status.isin("succeeded", "partial_success"), design.isin("compliant", "deviation"))
        .when(status == "abandoned", design == "incomplete")
        .when(status.isin("failed", "blocked"), design.isin(*DESIGN))
        .otherwise(status.isin("requested", "running") & (design == "pending"))
    )
    conclusion = F.when(terminal & (design == "deviation"), "not_successful").when(status.isin("succeeded", "partial_success"), status).when(terminal, "not_successful").otherwise("open")
    failure = F.col("failure") if "failure" in tasks.columns else F.lit(None).cast("string")
    code = (
        F.when(~terminal, F.lit(None).cast("int"))
        .when(failure == "audit", EXIT_AUDIT).when(failure == "lock", EXIT_LOCKED).when(failure == "no_model", EXIT_NO_MODEL)
        .when((design == "deviation") | (status == "blocked"), EXIT_DEVIATION).when(status == "partial_success", EXIT_PARTIAL).when(status == "succeeded", EXIT_SUCCESS)
        .otherwise(1)
    )
    return tasks.select("*", terminal.alias("terminal"), F.coalesce(legal, F.lit(False)).alias("legal"), conclusion.alias("conclusion"), code.alias("exit_code"))


def transition_check(log: DataFrame) -> DataFrame:
    """log (task_id, seq, state) with the state before and whether the step is an edge of the state machine. The
    first state must be requested; nothing follows a terminal state."""
    before = F.lag("state").over(Window.partitionBy("task_id").orderBy("seq"))
    edge = F.lit(False)
    for a, b in EDGES:
        edge = edge | ((F.col("previous") == a) & (F.col("state") == b))
    return log.withColumn("previous", before).select("*", F.when(F.col("previous").isNull(), F.col("state") == "requested").otherwise(edge).alias("legal"))


def link_check(details: DataFrame, stages: DataFrame) -> DataFrame:
    """details (task_id, stage_id) with link: none where both are null, half_null, orphan, cross_task or ok."""
    known = stages.select("stage_id", F.col("task_id").alias("owner")).dropDuplicates(["stage_id"])
    half = F.col("task_id").isNull() != F.col("stage_id").isNull()
    link = F.when(half, "half_null").when(F.col("stage_id").isNull(), "none").when(F.col("owner").isNull(), "orphan").when(F.col("owner") != F.col("task_id"), "cross_task").otherwise("ok")
    return details.join(known, "stage_id", "left").select(*details.columns, link.alias("link"))


def recovery(tasks: DataFrame, locks: DataFrame, span: str = "DAY") -> DataFrame:
    """Tasks (task_id, lock_domain, status, started_at) that an acquisition of their domain's lock (lock_domain, holder,
    acquired_at) proves dead: still running, started before it, and not its holder. The first such acquisition recovers a task; of
    several at one time the least holder's, or the greatest's where the least is the task itself. They are abandoned and incomplete; no
    success is inferred, and none is run again. A domain's lock may change hands any number of times; span: the unit of time by which a domain's history is cut."""
    by, at = ["lock_domain"], "acquired_at"
    held = locks.where("holder IS NOT NULL AND acquired_at IS NOT NULL").groupBy(*by, at).agg(F.min("holder").alias("holder"), F.max("holder").alias("second"))
    held = held.withColumn("second", F.nullif("second", "holder")).withColumn("alone", F.when(F.col("second").isNull(), F.col("holder")))
    # where another than the holder before acquires it, and where that happens next
    turns = before(held, by, at, [], "alone", span).where("alone IS NULL OR previous IS NULL OR alone <> previous")
    follows = first_after(held.select(*by, at, "holder", "second"), turns, by, at, at, ["holder"], span, "other")
    running = tasks.where("status = 'running'").select("task_id", "lock_domain", "started_at")
    found = first_after(running, follows, by, "started_at", at, ["holder", "second", "other"], span, "lock")
    own = F.col("lock.holder") == F.col("task_id")
    by_ = F.when(own, F.coalesce("lock.second", "lock.other.holder")).otherwise(F.col("lock.holder"))
    return found.select("task_id", "lock_domain", by_.alias("recovered_by")).where("recovered_by IS NOT NULL").select("*", F.lit("abandoned").alias("status"), F.lit("incomplete").alias("design"))


def constraint_violations(stages: DataFrame) -> DataFrame:
    """Rows that break a row constraint, with the names of those broken. Where rows have status and design (tasks), a
    combination of them that terminal_check() doesn't know is one."""
    bad = lambda name, cond: F.when(F.coalesce(cond, F.lit(False)), name)
    checks = [
        F.when(F.col("task_id").isNull(), "task_id_null"), F.when(F.col("stage_key").isNull(), "stage_key_null"),
        F.when(F.coalesce(F.col("actual_seq") < 1, F.lit(True)), "seq_not_positive"), F.when(F.coalesce(F.col("attempt_no") < 1, F.lit(True)), "attempt_not_positive"),
        bad("input_negative", F.col("input") < 0), bad("output_negative", F.col("output") < 0), bad("route_negative", F.exists(F.map_values("routes"), lambda x: x < 0)), bad("ends_before_start", F.col("ended_at") < F.col("started_at")),
    ]
    if {"status", "design"} <= {*stages.columns}:
        legal = terminal_check(stages)
        return legal.withColumn("violations", F.array_compact(F.array(*checks, F.when(~F.col("legal"), "illegal_state")))).where(F.size("violations") > 0).select(*stages.columns, "violations")
    return stages.withColumn("violations", F.array_compact(F.array(*checks))).where(F.size("violations") > 0)


def classify_commands(commands: DataFrame, classes: DataFrame) -> DataFrame:
    """commands (command, ...) with class and needs_task, by lookup in classes (command, class, needs_task); an
    unknown command is unclassified and needs a task."""
    known = classes.dropDuplicates(["command"])
    return commands.join(known, "command", "left").withColumns({"class": F.coalesce("class", F.lit("unclassified")), "needs_task": F.coalesce("needs_task", F.lit(True))})


def path_check(requests: DataFrame) -> DataFrame:
    """requests (path_type, reason, ...) with blocked: a non-standard run must give its reason before any work."""
    blank = F.trim(F.coalesce("reason", F.lit(""))) == ""
    return requests.withColumn("blocked", (F.col("path_type") == "non_standard") & blank)


def coverage_gaps(commands: DataFrame, tasks: DataFrame) -> DataFrame:
    """Runs of commands that need a task and have none; must be empty."""
    return commands.where("needs_task").join(tasks.select("run_id").distinct(), "run_id", "left_anti")


def tasks_added(before: DataFrame, after: DataFrame) -> DataFrame:
    """Tasks that a read-only command added or lost; must be empty."""
    change = lambda a, b, name: a.exceptAll(b).withColumn("change", F.lit(name))
    return change(after, before, "added").unionByName(change(before, after, "lost"))


def lock_retries(attempts: DataFrame, most: int = 3) -> DataFrame:
    """Of attempts to take a lock or to write the ledger (run_id, attempt_no from 1, outcome: done or conflict), a
    row for each run: how often it tried, whether it got through within `most` tries, whether it tried after that
    or beyond the bound (a violation), and its exit code, null while it may still try."""
    first = F.min(F.when(F.col("outcome") == "done", F.col("attempt_no")))
    out = attempts.groupBy("run_id").agg(F.count("*").alias("attempts"), F.max("attempt_no").alias("last"), first.alias("done_at"))
    done = F.coalesce(F.col("done_at") <= most, F.lit(False))
    over = (F.col("last") > most) | F.coalesce(F.col("last") > F.col("done_at"), F.lit(False))
    code = F.when(done, EXIT_SUCCESS).when(F.col("last") >= most, EXIT_AUDIT)
    return out.select("run_id", "attempts", done.alias("acquired"), over.alias("out_of_bounds"), code.alias("exit_code"))


def monitoring(tasks: DataFrame) -> DataFrame:
    """A row for each command of tasks (command, run_id, exit_code, overdue, design): runs, tasks beyond one for
    a run, audit failures, overdue tasks, findings, and whether the rollout may go on."""
    runs = tasks.groupBy("command", "run_id").agg(F.count("*").alias("n"), F.count_if(F.col("exit_code") == EXIT_AUDIT).alias("audit_failures"), F.count_if("overdue").alias("overdue"), F.count_if(F.col("design").isin("deviation", "incomplete")).alias("findings"))
    out = runs.groupBy("command").agg(F.count("*").alias("runs"), F.sum(F.col("n") - 1).alias("extra_tasks"), *(F.sum(c).alias(c) for c in ("audit_failures", "overdue", "findings")))
    return out.withColumn("no_go", F.greatest("extra_tasks", "audit_failures", "overdue", "findings") > 0)


#: Checks after a launch: of the first task, of the first runs, and of all that started within so many hours.
FIRST_RUNS, HOURS = 3, (4, 24)


def launch_checks(tasks: DataFrame, launches: DataFrame, as_of: Column, hours: tuple[int, ...] = HOURS, first_runs: int = FIRST_RUNS) -> DataFrame:
    """A row for each command of launches (command, launched_at, max_seconds) and check: first_task, first_runs, and within each of
    `hours` of its launch. tasks: command, run_id, task_id, started_at, ended_at (null while it runs), exit_code, design.

    due: the check's tasks are all there, or its time is over by as_of. extra_tasks: beyond one for a run; overdue: tasks that at
    the check's time (as_of, or the end of the hours if that is before) have run longer than max_seconds and not ended. no_go: any
    of these, audit failures or findings. A command without tasks has rows of zeros.
    """
    live = launches.select("command", "launched_at", "max_seconds").dropDuplicates(["command"])
    own = tasks.join(live, "command").where(F.col("started_at") >= F.col("launched_at"))
    runs = own.groupBy("command", "run_id").agg(F.min(F.struct("started_at", "task_id")).alias("first"))
    # the few first runs of a command are found before its rows meet
    order = F.row_number().over(Window.partitionBy("command").orderBy("first"))
    runs = runs.withColumn("place", order).where(F.col("place") <= first_runs).select(F.col("command").alias("_command"), F.col("run_id").alias("_run"), F.col("first.task_id").alias("first_task"), "place")
    own = own.join(runs, (F.col("command") == F.col("_command")) & F.col("run_id").eqNullSafe(F.col("_run")), "left")
    hour = lambda h: F.col("launched_at") + F.make_dt_interval(hours=F.lit(h))
    at = lambda name, time: F.struct(F.lit(name).alias("check_key"), time.alias("checked_at"))
    checks = [F.when((F.col("place") == 1) & (F.col("task_id") == F.col("first_task")), at("first_task", as_of)), F.when(F.col("place").isNotNull(), at("first_runs", as_of))]
    checks += [F.when(F.col("started_at") < hour(h), at(f"within_{h}_hours", F.least(as_of, hour(h)))) for h in hours]
    rows = own.select("*", F.explode(F.array_compact(F.array(*checks))).alias("x")).select("*", "x.check_key", "x.checked_at")
    late = (F.col("ended_at").isNull() | (F.col("ended_at") > F.col("checked_at"))) & (F.col("started_at") + F.make_dt_interval(secs=F.col("max_seconds")) < F.col("checked_at"))
    each = rows.groupBy("command", "check_key", "run_id").agg(F.count("*").alias("n"), F.count_if(F.col("exit_code") == EXIT_AUDIT).alias("audit_failures"), F.count_if(late).alias("overdue"), F.count_if(F.col("design").isin("deviation", "incomplete")).alias("findings"))
    found = each.groupBy("command", "check_key").agg(F.count("*").alias("runs"), F.sum("n").alias("tasks"), F.sum(F.col("n") - 1).alias("extra_tasks"), *(F.sum(c).alias(c) for c in ("audit_failures", "overdue", "findings")))
    want = lambda name, h, n: F.struct(F.lit(name).alias("check_key"), F.lit(h).cast("int").alias("hours"), F.lit(n).cast("int").alias("needs"))
    wanted = [want("first_task", None, 1), want("first_runs", None, first_runs), *(want(f"within_{h}_hours", h, None) for h in hours)]
    all_ = live.select("command", "launched_at", F.explode(F.array(*wanted)).alias("w")).select("command", "launched_at", "w.*")
    counts = ["runs", "tasks", "extra_tasks", "audit_failures", "overdue", "findings"]
    out = all_.join(found, ["command", "check_key"], "left").fillna(0, counts)
    due = F.coalesce(F.col("runs") >= F.col("needs"), F.col("launched_at") + F.make_dt_interval(hours=F.col("hours")) <= as_of)
    return out.select("command", "check_key", due.alias("due"), *counts, (F.greatest("extra_tasks", "audit_failures", "overdue", "findings") > 0).alias("no_go"))


def no_go(monitored: DataFrame) -> DataFrame:
    """One row: any failed condition blocks the schedule."""
    return monitored.agg(F.coalesce(F.bool_or("no_go"), F.lit(False)).alias("no_go"))


def may_rerun(commit_state: Column) -> Column:
    """After an audit failure, only what surely wasn't committed may be run again by itself."""
    return commit_state.isNotNull() & ~commit_state.isin(*RERUN_NEVER)


def redact(text: Column, most: int = 500) -> Column:
    """Text without secrets, cut to a length for display."""
    return F.left(F.regexp_replace(text, SECRETS, "$1$2***"), F.lit(most))


def leaks(text: Column) -> Column:
    """Whether a secret is still in the text."""
    return text.rlike(SECRETS.replace(r"[^\s,;]+", r"(?!\*\*\*)[^\s,;]+"))


def retention(details: DataFrame, as_of: Column, days: int = 30) -> DataFrame:
    """details (ts, ...) with detail: expired after so many days, else available. Expired isn't incomplete."""
    return details.withColumn("detail", F.when(F.col("ts") < as_of - F.expr(f"INTERVAL {days} DAYS"), "expired").otherwise("available"))


def trigger_context(option: Column, environment: Column, user: Column) -> Column:
    """Who acts: the explicit option, else the environment, else the system user. Blank is none."""
    some = lambda c: F.nullif(F.trim(c), F.lit(""))
    return F.coalesce(some(option), some(environment), some(user))


def seconds(start: Column, end: Column) -> Column:
    """Duration, for display."""
    return F.timestamp_diff("SECOND", start, end)

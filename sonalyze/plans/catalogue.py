"""The operators over the test tables, each with the SQL that gives the same rows.

Where a table stands for another (orders for tasks, lineitem for stages, conversations for episodes), the
columns are derived by fixed rules, in the query and in its SQL alike.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sonalyze.functions import speech as S
from sonalyze.operators import audit as A
from sonalyze.operators import news as N
from sonalyze.operators import product as P
from sonalyze.operators import review as R
from sonalyze.plans import views as V
from sonalyze.plans.workflows import Registry, Stage, Workflow

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Rows over all cores before costly expressions; the tables are one file each."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def wide(*names: str) -> list[Column]:
    return [F.col(n).cast("long").alias(n) for n in names]


# ---- speech over conversations: conv_id is the episode, turn + 1 the line, role the speaker


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    emotion = F.element_at(F.array(*map(F.lit, ("HAPPY", "NEUTRAL", "SAD"))), (F.col("turn") % 3 + 1).cast("int"))
    heard = F.when((F.col("conv_id") + F.col("turn")) % 3 == 0, F.substring("text", 21, 1 << 30)).otherwise(F.col("text"))
    planned = F.when(F.col("conv_id") % 4 == 0, "happy").when(F.col("conv_id") % 4 == 1, "calm").when(F.col("conv_id") % 4 == 2, "Fearful")
    gone = F.when((F.col("conv_id") * 7 + F.col("turn")) % 11 == 0, "missing_audio").when((F.col("conv_id") * 5 + F.col("turn")) % 13 == 0, "assessment_error")
    return rows.select(
        "conv_id", (F.col("turn") + 1).cast("int").alias("line_id"), F.col("role").alias("speaker"), F.concat(F.lit("一千四百万，（笑）<#0.25#>"), "text").alias("tts_text"),
        F.concat(F.lit("<|zh|><|"), F.lower(emotion), F.lit("|><|Speech|><|withitn|>　 1400万"), heard, F.lit("\n")).alias("raw_output"), planned.alias("planned_emotion"), gone.alias("gone"),
    )


def records(spark: SparkSession, sf_dir: str, all_heard: bool = True) -> DataFrame:
    own = lines(spark, sf_dir)
    unavailable = F.lit(None).cast("string") if all_heard else F.col("gone")
    own = own.withColumn("unavailable", unavailable).withColumn("raw_output", F.when(F.col("unavailable").isNull(), F.col("raw_output"))).drop("gone")
    return R.review(spread(own))


BLANK_SQL = r"[\s\p{Z}\x{1c}-\x{1f}\x{85}]"
NUM = S.NUMERALS


def number_sql(s: str) -> str:
    digits = " ".join(f"WHEN '{k}' THEN {v}" for k, v in S.DIGITS.items())
    small = " ".join(f"WHEN '{k}' THEN {v}" for k, v in S.SMALL_UNITS.items())
    big = " ".join(f"WHEN '{k}' THEN {v}" for k, v in S.BIG_UNITS.items())
    # a state is total, section, digit; a character comes as a state that holds its code
    chars = f"list_transform(string_split({s}, ''), lambda c: {{'t': 0::BIGINT, 's': CASE c {small} ELSE CASE c {big} ELSE 0 END END::BIGINT, 'n': CASE c {digits} ELSE -1 END::BIGINT}})"
    step = "CASE WHEN c.n >= 0 THEN {'t': a.t, 's': a.s, 'n': c.n} WHEN c.s < 10000 THEN {'t': a.t, 's': a.s + greatest(a.n, 1) * c.s, 'n': 0::BIGINT} ELSE {'t': a.t + greatest(a.s + a.n, 1) * c.s, 's': 0::BIGINT, 'n': 0::BIGINT} END"
    end = f"list_reduce({chars}, lambda a, c: {step}, {{'t': 0::BIGINT, 's': 0::BIGINT, 'n': 0::BIGINT}})"
    return f"list_transform([{end}], lambda e: e.t + e.s + e.n)[1]"


def normalize_sql(x: str) -> str:
    bare = f"regexp_replace(regexp_replace({x}, '<#[0-9]+(\\.[0-9]+)?#>', '', 'g'), '\\([^)]*\\)|（[^）]*）', '', 'g')"
    zeros = "CASE WHEN right(p, 1) = '万' THEN '0000' ELSE '00000000' END"
    digits = "ltrim(left(p, length(p) - 1), '0')"
    arabic = f"array_to_string(list_transform(regexp_extract_all({bare}, '[0-9]+[万亿]|[0-9]+|[^0-9]+'), lambda p: CASE WHEN NOT regexp_matches(p, '^[0-9]+[万亿]$') THEN p WHEN {digits} = '' THEN '0' ELSE {digits} || {zeros} END), '')"
    chinese = f"array_to_string(list_transform(regexp_extract_all({arabic}, '[{NUM}]+|[^{NUM}]+'), lambda q: CASE WHEN regexp_matches(q, '^[{NUM}]') THEN CAST({number_sql('q')} AS VARCHAR) ELSE q END), '')"
    return f"lower(regexp_replace(coalesce({chinese}, ''), '[^一-鿿A-Za-z0-9]', '', 'g'))"


LINES_SQL = """
SELECT conv_id, CAST(turn + 1 AS BIGINT) AS line_id, role AS speaker, '一千四百万，（笑）<#0.25#>' || text AS tts_text,
    list_value('HAPPY', 'NEUTRAL', 'SAD')[CAST(turn % 3 + 1 AS INT)] AS emotion,
    '1400万' || CASE WHEN (conv_id + turn) % 3 = 0 THEN substr(text, 21) ELSE text END AS asr_text,
    CASE conv_id % 4 WHEN 0 THEN 'happy' WHEN 1 THEN 'calm' WHEN 2 THEN 'Fearful' END AS planned_emotion,
    CASE WHEN (conv_id * 7 + turn) % 11 = 0 THEN 'missing_audio' WHEN (conv_id * 5 + turn) % 13 = 0 THEN 'assessment_error' END AS gone
FROM conversations"""
GROUP_SQL = "CASE lower(planned_emotion) WHEN 'happy' THEN ['HAPPY', 'SURPRISED'] WHEN 'fearful' THEN ['ANGRY', 'FEARFUL', 'SAD'] WHEN 'calm' THEN ['CALM', 'NEUTRAL'] ELSE [] END"


def records_sql(available: bool) -> str:
    """With flags joined by ';'."""
    gone = "NULL" if available else "gone"
    return f"""
lines AS ({LINES_SQL}),
norm AS (SELECT *, {gone} AS unavailable, {normalize_sql("tts_text")} AS a, {normalize_sql("asr_text")} AS b, {GROUP_SQL} AS fit FROM lines),
rated AS (SELECT *, CASE WHEN unavailable IS NOT NULL THEN NULL WHEN a = b THEN 0.0 WHEN a = '' THEN 1.0 ELSE levenshtein(a, b) / CAST(length(a) AS DOUBLE) END AS rate FROM norm),
flagged AS (SELECT *, coalesce(unavailable, array_to_string(list_filter([CASE WHEN rate > 0.1 THEN 'asr_mismatch' END, CASE WHEN len(fit) > 0 AND NOT list_contains(fit, emotion) THEN 'emotion_mismatch' END], lambda x: x IS NOT NULL), ';')) AS flags FROM rated),
records AS (SELECT *, CASE WHEN unavailable IS NOT NULL THEN 120 ELSE CASE WHEN contains(flags, 'asr_mismatch') THEN 100 ELSE 0 END + CASE WHEN contains(flags, 'emotion_mismatch') THEN 60 ELSE 0 END END AS priority,
    CAST(format('{{:.4f}}', rate) AS DOUBLE) AS cer, CASE WHEN flags = '' THEN 'pass' ELSE 'needs_human' END AS status, CASE WHEN flags = '' THEN 'asr_and_emotion_check_pass' ELSE replace(flags, ';', '; ') END AS reason FROM flagged)"""


@query(f"WITH {records_sql(True)} SELECT conv_id, line_id, speaker, tts_text, asr_text, 'zh' AS language, emotion, planned_emotion, array_to_string(fit, ';') AS expected_emotion_group, cer, flags, CAST(priority AS BIGINT) AS priority, status AS decision_status, reason AS decision_reason FROM records")
def review_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line, the most urgent first in its episode."""
    queue = R.listening_queue(records(spark, sf_dir), ["conv_id"])
    return queue.withColumns({c: F.col(c).cast("long") for c in ("line_id", "priority")})


@query(f"WITH lines AS ({LINES_SQL}) SELECT conv_id, line_id, 'zh' AS language, emotion, 'Speech' AS event, 'withitn' AS itn, regexp_replace(asr_text, '^[ \\n\\t]+|[ \\n\\t]+$', '', 'g') AS transcript FROM lines")
def tag_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1-F4"""
    return lines(spark, sf_dir).select("conv_id", *wide("line_id"), S.tags(F.col("raw_output")).alias("t")).select("conv_id", "line_id", "t.*")


NUMBER_CASES = ["1万亿", "1亿万", "007万", "0万", "14亿", "5千万", "1.4亿", "一千四百万到两千万种", "二零二六", "十", "零万", "一万亿", "万一", "三千零五", "一亿二千万", "哇一起", "12345678901234567890万"]
CASES_SQL = "list_value(" + ", ".join(f"'{c}'" for c in NUMBER_CASES) + f")[CAST((conv_id * 31 + turn) % {len(NUMBER_CASES)} + 1 AS INT)]"


@query(f"SELECT conv_id, turn, {normalize_sql(f'{CASES_SQL} || text')} AS normalized FROM conversations")
def number_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F7-F9, with injected numerals"""
    case = F.element_at(F.array(*map(F.lit, NUMBER_CASES)), ((F.col("conv_id") * 31 + F.col("turn")) % len(NUMBER_CASES) + 1).cast("int"))
    return spread(table(spark, sf_dir, "conversations")).select("conv_id", "turn", S.normalize(F.concat(case, "text")).alias("normalized"))


@query(f"SELECT doc_id, sha256({normalize_sql('text')}) AS normalized_sha256, CAST(length({normalize_sql('text')}) AS BIGINT) AS n FROM documents")
def cer_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F5, F6, F10, F11 over whole documents"""
    own = spread(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", F.explode(F.array(S.normalize(F.coalesce("text", F.lit(""))))).alias("x"))
    return own.select("doc_id", F.sha2("x", 256).alias("normalized_sha256"), F.length("x").cast("long").alias("n"))


@query(f"WITH {records_sql(True)} SELECT conv_id, line_id, cer, rate > 0.1 AS mismatch FROM records")
def cer_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F12, F13, F18, P2"""
    return records(spark, sf_dir).select("conv_id", *wide("line_id"), "cer", F.array_contains("flags", "asr_mismatch").alias("mismatch"))


@query(f"WITH {records_sql(False)} SELECT conv_id, line_id, CASE WHEN unavailable IS NULL THEN asr_text END AS asr_text, cer, flags, CAST(priority AS BIGINT) AS priority, reason FROM records WHERE unavailable IS NOT NULL")
def unavailable_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines whose audio is missing, by a join with the files there are, or whose assessment failed"""
    own = lines(spark, sf_dir)
    files = own.where("gone IS NULL OR gone <> 'missing_audio'").select("conv_id", R.part_name(F.col("line_id"), F.col("speaker")).alias("file_name"))
    held = R.attach_audio(own, files, ["conv_id"]).withColumn("unavailable", F.coalesce("unavailable", "gone")).drop("gone", "file_name")
    held = held.withColumn("raw_output", F.when(F.col("unavailable").isNull(), F.col("raw_output")))
    out = R.review(held.where("unavailable IS NOT NULL"))
    return out.select("conv_id", *wide("line_id"), "asr_text", "cer", F.array_join("flags", ";").alias("flags"), *wide("priority"), F.col("decision.reason").alias("reason"))


ADVICE_SQL = "array_to_string(list_filter([" + ", ".join(f"CASE WHEN contains(flags, '{k}') THEN '{v}' END" for k, v in S.ADVICE.items()) + "], lambda x: x IS NOT NULL), '|')"


@query(f"WITH {records_sql(False)} SELECT conv_id, line_id, speaker, flags AS problem, CASE WHEN unavailable IS NULL THEN emotion END AS detected_emotion, cer, {ADVICE_SQL} AS actions, CAST(0 AS BIGINT) AS retry, 'needs_human_review' AS status FROM records WHERE flags <> ''")
def fix_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P8, F17"""
    items = R.fix_items(records(spark, sf_dir, False), ["conv_id"])
    return items.select("conv_id", *wide("line_id"), "speaker", F.array_join("problem", ";").alias("problem"), "evidence.detected_emotion", "evidence.cer", F.array_join("actions", "|").alias("actions"), *wide("retry"), "status")


@query(f"WITH {records_sql(False)} SELECT conv_id, count(*) AS lines, count(*) FILTER (WHERE flags <> '') AS review_required FROM records GROUP BY conv_id")
def episode_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1"""
    return R.summaries(records(spark, sf_dir, False), ["conv_id"])


@query(f"WITH {records_sql(False)} SELECT conv_id, CAST(1 AS BIGINT) AS round, count(*) FILTER (WHERE flags <> '') AS review_required, coalesce(string_agg(CAST(line_id AS VARCHAR), ',' ORDER BY line_id) FILTER (WHERE flags <> ''), '') AS line_ids FROM records GROUP BY conv_id")
def fix_plan_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One nested plan for each episode"""
    plans = R.fix_plans(records(spark, sf_dir, False), ["conv_id"], 1)
    return plans.select("conv_id", *wide("round", "review_required"), F.array_join(F.transform("items", lambda i: i["line_id"].cast("string")), ",").alias("line_ids"))


@query(f"WITH {records_sql(False)} SELECT printf('ep%d_round%d', conv_id, 1) AS run_id, line_id, coalesce(planned_emotion, '') AS planned_cues, 'SenseVoiceSmall' AS detector, unavailable IS NULL AS has_output, status FROM records")
def raw_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U3, F20, C5"""
    own = records(spark, sf_dir, False).withColumns({"error": F.lit(None).cast("string"), "audio_path": R.part_name(F.col("line_id"), F.col("speaker"))})
    raw = R.raw_records(own, F.format_string("ep%d", "conv_id"), 1, {"name": "SenseVoiceSmall", "funasr_version": "unknown", "model": "m", "device": "cpu", "output_type": "asr_ser_aed"})
    return raw.select("run_id", *wide("line_id"), F.array_join("planned_cues", ";").alias("planned_cues"), F.col("detectors")[0]["name"].alias("detector"), F.col("detectors")[0]["raw_output"].isNotNull().alias("has_output"), F.col("decision.status").alias("status"))


# ---- the ledger over orders (tasks) and lineitem (stages)


def tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    status = F.when(F.col("o_orderstatus") == "F", "succeeded").when(F.col("o_orderstatus") == "O", "running").otherwise("partial_success")
    design = F.element_at(F.array(*map(F.lit, A.DESIGN)), (F.col("o_orderkey") % 4 + 1).cast("int"))
    return o.select(F.col("o_orderkey").alias("task_id"), F.col("o_custkey").alias("actor"), F.col("o_orderpriority").alias("module"), F.lit("run").alias("operation"), status.alias("status"), design.alias("design"), F.col("o_orderdate").alias("started_at"), F.col("o_totalprice").alias("price"))


def stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    status = F.when(F.col("l_returnflag") == "R", "deviation").when(F.col("l_linestatus") == "F", "succeeded").otherwise("failed")
    return li.select(F.col("l_orderkey").alias("task_id"), F.concat(F.lit("stage_"), (F.col("l_linenumber") % 4).cast("string")).alias("stage_key"), F.lit(1).alias("attempt_no"), F.col("l_linenumber").alias("actual_seq"), status.alias("status"), F.col("l_shipdate").alias("started_at"), (F.col("l_shipdate") + F.expr("make_dt_interval(0, 0, 0, l_quantity)")).alias("ended_at"), F.col("l_returnflag").alias("flag"), F.col("l_partkey").alias("part"))


TASKS_SQL = "SELECT o_orderkey AS task_id, o_custkey AS actor, o_orderpriority AS module, 'run' AS operation, CASE o_orderstatus WHEN 'F' THEN 'succeeded' WHEN 'O' THEN 'running' ELSE 'partial_success' END AS status, list_value('pending', 'compliant', 'deviation', 'incomplete')[CAST(o_orderkey % 4 + 1 AS INT)] AS design, o_orderdate AS started_at, o_totalprice AS price FROM orders"
STAGES_SQL = "SELECT l_orderkey AS task_id, 'stage_' || CAST(l_linenumber % 4 AS VARCHAR) AS stage_key, 1 AS attempt_no, l_linenumber AS actual_seq, CASE WHEN l_returnflag = 'R' THEN 'deviation' WHEN l_linestatus = 'F' THEN 'succeeded' ELSE 'failed' END AS status, l_shipdate AS started_at, l_returnflag AS flag, l_quantity AS quantity, l_partkey AS part FROM lineitem"


@query(f"""
WITH s AS ({STAGES_SQL}), seqs AS (SELECT task_id, actual_seq, count(*) AS n FROM s GROUP BY ALL), att AS (SELECT task_id, stage_key, attempt_no, count(*) AS n FROM s GROUP BY ALL),
a AS (SELECT task_id, sum(n) AS stages, sum(n - 1) AS repeated_seq, min(actual_seq) = 1 AND max(actual_seq) = count(*) AS gapless FROM seqs GROUP BY task_id), b AS (SELECT task_id, sum(n - 1) AS repeated_attempts FROM att GROUP BY task_id)
SELECT task_id, CAST(stages AS BIGINT) AS stages, CAST(repeated_seq AS BIGINT) AS repeated_seq, gapless, CAST(repeated_attempts AS BIGINT) AS repeated_attempts, gapless AND repeated_seq = 0 AND repeated_attempts = 0 AS valid FROM a JOIN b USING (task_id)""")
def audit_sequence_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W2, W3"""
    return A.sequence_check(stages(spark, sf_dir))


CLEAN_SQL = "SELECT conv_id AS task_id, turn + 1 AS actual_seq, CASE WHEN length(text) % 7 = 0 THEN 'deviation' WHEN length(text) % 5 = 0 THEN 'failed' ELSE 'succeeded' END AS status FROM conversations"


@query(f"""
WITH s AS ({CLEAN_SQL}), w AS (SELECT *, lag(status) OVER (PARTITION BY task_id ORDER BY actual_seq) AS previous_status, coalesce(max(CASE WHEN status = 'deviation' THEN 1 ELSE 0 END) OVER (PARTITION BY task_id ORDER BY actual_seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) = 1 AS after_deviation FROM s)
SELECT *, coalesce(previous_status = 'succeeded', true) AS predecessor_ok, CASE WHEN after_deviation THEN 'stopped_after_deviation' WHEN previous_status <> 'succeeded' THEN 'predecessor_succeeded' END AS rule_id FROM w""")
def audit_sequence_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W2, W4, W5, E10 on gapless sequences"""
    rows = table(spark, sf_dir, "conversations")
    n = F.length("text")
    own = rows.select(F.col("conv_id").alias("task_id"), (F.col("turn") + 1).alias("actual_seq"), F.when(n % 7 == 0, "deviation").when(n % 5 == 0, "failed").otherwise("succeeded").alias("status"))
    return A.predecessor_check(own)


@query(f"""
WITH s AS ({STAGES_SQL}), had AS (SELECT task_id, stage_key, count(*) AS times, min(actual_seq) AS actual_seq FROM s GROUP BY ALL),
e AS (SELECT o_orderkey AS task_id, 'stage_' || k AS stage_key, CAST(k + 1 AS BIGINT) AS expected_seq FROM orders, range(0, 3) r(k)),
j AS (SELECT coalesce(e.task_id, had.task_id) AS task_id, coalesce(e.stage_key, had.stage_key) AS stage_key, expected_seq, actual_seq, times FROM e FULL JOIN had ON e.task_id = had.task_id AND e.stage_key = had.stage_key),
w AS (SELECT *, max(CASE WHEN expected_seq IS NOT NULL THEN actual_seq END) OVER (PARTITION BY task_id ORDER BY expected_seq NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS ahead FROM j)
SELECT task_id, stage_key, expected_seq, CAST(actual_seq AS BIGINT) AS actual_seq, coalesce(times, 0) AS times, CASE WHEN actual_seq IS NULL THEN 'missing' WHEN expected_seq IS NULL THEN 'extra' WHEN times > 1 THEN 'duplicate' WHEN ahead > actual_seq THEN 'out_of_order' ELSE 'matched' END AS finding FROM w""")
def audit_missing_stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three stages are expected of each task, a fourth is extra"""
    expected = tasks(spark, sf_dir).select("task_id", F.posexplode(F.array(*(F.lit(f"stage_{k}") for k in range(3)))).alias("at", "stage_key")).select("task_id", "stage_key", (F.col("at") + 1).cast("long").alias("expected_seq"))
    return A.reconcile(expected, stages(spark, sf_dir)).withColumn("actual_seq", F.col("actual_seq").cast("long"))


@query(f"""
WITH t AS ({TASKS_SQL}), r AS (SELECT module AS command, actor AS run_id, count(*) AS n, count(*) FILTER (WHERE price > 400000) AS audit_failures, count(*) FILTER (WHERE status = 'running' AND price < 1500) AS overdue, count(*) FILTER (WHERE design IN ('deviation', 'incomplete')) AS findings FROM t GROUP BY ALL)
SELECT command, count(*) AS runs, CAST(sum(n - 1) AS BIGINT) AS extra_tasks, CAST(sum(audit_failures) AS BIGINT) AS audit_failures, CAST(sum(overdue) AS BIGINT) AS overdue, CAST(sum(findings) AS BIGINT) AS findings, greatest(sum(n - 1), sum(audit_failures), sum(overdue), sum(findings)) > 0 AS no_go FROM r GROUP BY command""")
def audit_monitoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Priority is the command, a customer's orders under it are one run"""
    own = tasks(spark, sf_dir).withColumns({"command": F.col("module"), "run_id": F.col("actor"), "exit_code": F.when(F.col("price") > 400000, A.EXIT_AUDIT), "overdue": (F.col("status") == "running") & (F.col("price") < 1500)})
    return A.monitoring(own)


FUNNEL_SQL = f"""
s AS ({STAGES_SQL}), f AS (SELECT task_id, stage_key, CASE WHEN max(actual_seq) < 7 THEN CAST(max(actual_seq) AS BIGINT) END AS input, count(*) FILTER (WHERE flag = 'N') AS output, count(*) FILTER (WHERE flag = 'A') + count(*) FILTER (WHERE flag = 'R') AS routes FROM s GROUP BY ALL),
c AS (SELECT *, output + routes AS explained, input - output - routes AS residual, CASE WHEN input IS NULL THEN 'incomplete' WHEN input = output + routes THEN 'compliant' ELSE 'deviation' END AS verdict FROM f)"""


def funnel_stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = F.max("actual_seq").cast("long")
    is_ = lambda v: F.count_if(F.col("flag") == v)
    return stages(spark, sf_dir).groupBy("task_id", "stage_key").agg(F.when(last < 7, last).alias("input"), is_("N").alias("output"), F.create_map(F.lit("accepted"), is_("A"), F.lit("returned"), is_("R")).alias("routes"))


@query(f"WITH {FUNNEL_SQL} SELECT task_id, stage_key, input, output, explained, residual, verdict, CASE WHEN residual <> 0 THEN 'funnel_conservation' END AS rule_id FROM c")
def audit_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3, A4: the highest number is the declared input, and unknown at 7"""
    return A.funnel_check(funnel_stages(spark, sf_dir)).select("task_id", "stage_key", "input", "output", "explained", "residual", "verdict", F.col("result.rule_id").alias("rule_id"))


@query(f"WITH {FUNNEL_SQL} SELECT task_id, CASE WHEN bool_or(verdict = 'deviation') THEN 'deviation' WHEN bool_or(verdict = 'incomplete') THEN 'incomplete' ELSE 'compliant' END AS design, count(*) FILTER (WHERE verdict = 'deviation') AS deviations FROM c GROUP BY task_id")
def audit_task_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A13"""
    return A.task_verdicts(A.funnel_check(funnel_stages(spark, sf_dir)))


@query(f"WITH {FUNNEL_SQL} SELECT task_id, {', '.join(f'''CAST(sum(output) FILTER (WHERE stage_key = 'stage_{k}') AS BIGINT) AS stage_{k}''' for k in range(4))} FROM f GROUP BY task_id")
def task_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A12"""
    return V.task_funnel(funnel_stages(spark, sf_dir), [f"stage_{k}" for k in range(4)])


@query(f"""
WITH t AS (SELECT task_id, list_value('requested', 'running', 'succeeded', 'partial_success', 'failed', 'blocked', 'abandoned')[CAST(task_id % 7 + 1 AS INT)] AS status, list_value('pending', 'compliant', 'deviation', 'incomplete')[CAST(actor % 4 + 1 AS INT)] AS design, CASE WHEN price > 400000 THEN 'audit' WHEN price < 1500 THEN 'lock' END AS failure FROM ({TASKS_SQL})),
u AS (SELECT *, status NOT IN ('requested', 'running') AS terminal, CASE WHEN status IN ('succeeded', 'partial_success') THEN design IN ('compliant', 'deviation') WHEN status = 'abandoned' THEN design = 'incomplete' WHEN status IN ('failed', 'blocked') THEN true ELSE design = 'pending' END AS legal FROM t)
SELECT *, CASE WHEN terminal AND design = 'deviation' THEN 'not_successful' WHEN status IN ('succeeded', 'partial_success') THEN status WHEN terminal THEN 'not_successful' ELSE 'open' END AS conclusion,
    CAST(CASE WHEN NOT terminal THEN NULL WHEN failure = 'audit' THEN 6 WHEN failure = 'lock' THEN 5 WHEN design = 'deviation' OR status = 'blocked' THEN 9 WHEN status = 'partial_success' THEN 4 WHEN status = 'succeeded' THEN 0 ELSE 1 END AS BIGINT) AS exit_code FROM u""")
def audit_terminal_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E4-E8"""
    pick = lambda values, n: F.element_at(F.array(*map(F.lit, values)), (n % len(values) + 1).cast("int"))
    own = tasks(spark, sf_dir).select("task_id", pick(A.EXECUTION, F.col("task_id")).alias("status"), pick(A.DESIGN, F.col("actor")).alias("design"), F.when(F.col("price") > 400000, "audit").when(F.col("price") < 1500, "lock").alias("failure"))
    return A.terminal_check(own).withColumn("exit_code", F.col("exit_code").cast("long"))


@query("""
WITH l AS (SELECT conv_id AS task_id, turn AS seq, CASE WHEN turn = 0 THEN 'requested' WHEN turn = 1 THEN CASE WHEN conv_id % 5 = 0 THEN 'blocked' ELSE 'running' END ELSE list_value('succeeded', 'failed', 'running')[CAST((conv_id + turn) % 3 + 1 AS INT)] END AS state FROM conversations),
w AS (SELECT *, lag(state) OVER (PARTITION BY task_id ORDER BY seq) AS previous FROM l)
SELECT *, CASE WHEN previous IS NULL THEN state = 'requested' ELSE previous || '>' || state IN ('requested>running', 'requested>blocked', 'running>succeeded', 'running>partial_success', 'running>failed', 'running>abandoned') END AS legal FROM w""")
def audit_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W6, E4"""
    c = table(spark, sf_dir, "conversations")
    later = F.element_at(F.array(*map(F.lit, ("succeeded", "failed", "running"))), ((F.col("conv_id") + F.col("turn")) % 3 + 1).cast("int"))
    state = F.when(F.col("turn") == 0, "requested").when(F.col("turn") == 1, F.when(F.col("conv_id") % 5 == 0, "blocked").otherwise("running")).otherwise(later)
    return A.transition_check(c.select(F.col("conv_id").alias("task_id"), F.col("turn").alias("seq"), state.alias("state")))


LINKS_SQL = """
d AS (SELECT event_id, CASE WHEN event_id % 7 IN (0, 1) THEN NULL WHEN event_id % 7 = 2 THEN user_id + 1 ELSE user_id END AS task_id, CASE WHEN event_id % 7 IN (0, 3) THEN NULL WHEN event_id % 7 = 4 THEN -user_id - 1 ELSE user_id END AS stage_id FROM events),
s AS (SELECT DISTINCT user_id AS stage_id, user_id AS owner FROM events)"""


@query(f"WITH {LINKS_SQL} SELECT event_id, task_id, d.stage_id, CASE WHEN (task_id IS NULL) <> (d.stage_id IS NULL) THEN 'half_null' WHEN d.stage_id IS NULL THEN 'none' WHEN owner IS NULL THEN 'orphan' WHEN owner <> task_id THEN 'cross_task' ELSE 'ok' END AS link FROM d LEFT JOIN s ON d.stage_id = s.stage_id")
def audit_link_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J5"""
    e, k, u = table(spark, sf_dir, "events"), F.col("event_id") % 7, F.col("user_id")
    details = e.select("event_id", F.when(k.isin(0, 1), None).when(k == 2, u + 1).otherwise(u).alias("task_id"), F.when(k.isin(0, 3), None).when(k == 4, -u - 1).otherwise(u).alias("stage_id"))
    return A.link_check(details, e.select(u.alias("stage_id"), u.alias("task_id")).distinct())


@query(f"""
WITH t AS ({TASKS_SQL}), l AS (SELECT module AS lock_domain, max(task_id) AS holder, arg_max(started_at, task_id) AS acquired_at FROM t GROUP BY module)
SELECT task_id, lock_domain, holder AS recovered_by, 'abandoned' AS status, 'incomplete' AS design FROM t JOIN l ON module = lock_domain WHERE status = 'running' AND started_at < acquired_at AND task_id <> holder""")
def audit_recovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last task of each domain holds its lock"""
    own = tasks(spark, sf_dir).withColumnRenamed("module", "lock_domain")
    locks = own.groupBy("lock_domain").agg(F.max("task_id").alias("holder"), F.max_by("started_at", "task_id").alias("acquired_at"))
    return A.recovery(own, locks)


HANDS_SQL = f"SELECT module AS lock_domain, task_id - task_id % 20 AS holder, started_at AS acquired_at FROM ({TASKS_SQL}) WHERE task_id % 9 = 0"


@query(f"""
WITH t AS ({TASKS_SQL}), l AS (SELECT DISTINCT * FROM ({HANDS_SQL})), f AS (SELECT t.task_id, module, min(acquired_at) AS taken FROM t JOIN l ON module = lock_domain AND acquired_at > started_at AND holder <> t.task_id WHERE status = 'running' GROUP BY ALL)
SELECT f.task_id, module AS lock_domain, CASE WHEN min(holder) = f.task_id THEN max(holder) ELSE min(holder) END AS recovered_by, 'abandoned' AS status, 'incomplete' AS design FROM f JOIN l ON module = lock_domain AND acquired_at = taken GROUP BY f.task_id, module""")
def audit_lock_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lock of a domain changes hands many times; the first that takes it later recovers a task"""
    own = tasks(spark, sf_dir).withColumnRenamed("module", "lock_domain")
    return A.recovery(own, own.where("task_id % 9 = 0").select("lock_domain", (F.col("task_id") - F.col("task_id") % 20).alias("holder"), F.col("started_at").alias("acquired_at")), "MONTH")


# ---- what a module declares: of two versions, the second has other stages, units and routes

STOCK = (
    Workflow("stock", 1, tuple(Stage(f"stage_{k}", "line", ("accepted", "returned")) for k in range(3))),
    Workflow("stock", 2, (Stage("stage_1", "line", ("accepted", "returned")), Stage("stage_3", "line", ("accepted", "returned"), hard=False), Stage("stage_0", "line", ("accepted",)), Stage("stage_2", "line", ("accepted", "returned"), relation="2 * input = output + accepted + returned"))),
)
SNAPSHOT_SQL = "SELECT o_orderkey AS task_id, 'stage_' || CAST(unnest(CASE WHEN o_orderkey % 2 = 0 THEN [0, 1, 2] ELSE [1, 3, 0, 2] END) AS VARCHAR) AS stage_key, CAST(unnest(CASE WHEN o_orderkey % 2 = 0 THEN [1, 2, 3] ELSE [1, 2, 3, 4] END) AS BIGINT) AS expected_seq FROM orders WHERE o_orderkey % 97 > 0"


@query(f"""
WITH s AS (SELECT * FROM ({STAGES_SQL}) WHERE task_id % 97 > 0), had AS (SELECT task_id, stage_key, count(*) AS times, min(actual_seq) AS actual_seq FROM s GROUP BY ALL), e AS ({SNAPSHOT_SQL}),
j AS (SELECT coalesce(e.task_id, had.task_id) AS task_id, coalesce(e.stage_key, had.stage_key) AS stage_key, expected_seq, actual_seq, times FROM e FULL JOIN had ON e.task_id = had.task_id AND e.stage_key = had.stage_key),
w AS (SELECT *, max(CASE WHEN expected_seq IS NOT NULL THEN actual_seq END) OVER (PARTITION BY task_id ORDER BY expected_seq NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS ahead FROM j)
SELECT task_id, stage_key, expected_seq, CAST(actual_seq AS BIGINT) AS actual_seq, CASE WHEN actual_seq IS NULL THEN 'missing' WHEN expected_seq IS NULL THEN 'extra' WHEN times > 1 THEN 'duplicate' WHEN ahead > actual_seq THEN 'out_of_order' ELSE 'matched' END AS finding FROM w
UNION ALL SELECT o_orderkey, NULL, NULL, NULL, 'no_snapshot' FROM orders WHERE o_orderkey % 97 = 0""")
def audit_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each task is judged by the stages in its own snapshot; those of some can't be read"""
    text = F.when(F.col("task_id") % 97 == 0, F.when(F.col("task_id") % 2 == 0, "{")).when(F.col("task_id") % 2 == 0, STOCK[0].snapshot()).otherwise(STOCK[1].snapshot())
    found = A.reconcile_snapshots(tasks(spark, sf_dir).select("task_id", text.alias("snapshot")), stages(spark, sf_dir))
    return found.select("task_id", "stage_key", "expected_seq", F.col("actual_seq").cast("long").alias("actual_seq"), "finding")


@query(f"""
WITH s AS (SELECT *, task_id % 2 + 1 AS version, CASE WHEN task_id % 10 = 3 AND stage_key = 'stage_1' THEN 'box' ELSE 'line' END AS unit FROM ({STAGES_SQL})),
f AS (SELECT task_id, stage_key, any_value(version) AS version, any_value(unit) AS unit, CASE WHEN max(actual_seq) < 7 THEN CAST(max(actual_seq) AS BIGINT) END AS input, count(*) FILTER (WHERE flag = 'N') AS output, count(*) FILTER (WHERE flag = 'A') AS a, CASE WHEN NOT (any_value(version) = 2 AND stage_key = 'stage_0' AND count(*) FILTER (WHERE flag = 'R') = 0) THEN count(*) FILTER (WHERE flag = 'R') END AS r FROM s GROUP BY task_id, stage_key),
g AS (SELECT *, CASE WHEN version = 1 AND stage_key = 'stage_3' THEN NULL WHEN version = 2 AND stage_key = 'stage_2' THEN 2 * input ELSE input END AS l, CASE WHEN version = 1 AND stage_key = 'stage_3' THEN NULL WHEN version = 2 AND stage_key = 'stage_0' THEN output + a ELSE output + a + r END AS x FROM f),
h AS (SELECT *, CASE WHEN version = 1 AND stage_key = 'stage_3' THEN 'undeclared_stage' WHEN version = 2 AND stage_key = 'stage_0' AND r IS NOT NULL THEN 'undeclared_route' WHEN unit = 'box' THEN 'mixed_units' WHEN l <> x THEN 'funnel_conservation' END AS rule_id FROM g)
SELECT task_id, version, stage_key, l AS left_side, x AS right_side, l - x AS residual, rule_id, CASE WHEN rule_id = 'funnel_conservation' AND version = 2 AND stage_key = 'stage_3' THEN 'warning' WHEN rule_id IS NOT NULL THEN 'deviation' WHEN l - x IS NULL THEN 'incomplete' ELSE 'compliant' END AS verdict FROM h""")
def declared_formulas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U4, A3: the formulas of two versions, of which one declares a relation of its own, a soft rule, and fewer routes and stages"""
    version = F.col("task_id") % 2 + 1
    own = funnel_stages(spark, sf_dir).withColumns({"workflow": F.lit("stock"), "version": version, "unit": F.when((F.col("task_id") % 10 == 3) & (F.col("stage_key") == "stage_1"), "box").otherwise("line")})
    # a route that a stage doesn't have is not counted there
    bare = (F.col("version") == 2) & (F.col("stage_key") == "stage_0")
    own = own.withColumn("routes", F.map_filter("routes", lambda k, n: ~((k == "returned") & bare & (n == 0))))
    return Registry(*STOCK).check(own).select("task_id", *wide("version"), "stage_key", "left_side", "right_side", "residual", "rule_id", "verdict")


LAUNCH_SQL = """SELECT module AS command, CAST(TIMESTAMP '1995-03-01' + ascii(module) * INTERVAL 1 DAY AS TIMESTAMP) AS launched FROM (SELECT DISTINCT o_orderpriority AS module FROM orders)"""


@query(f"""
WITH l AS ({LAUNCH_SQL}), t AS (SELECT module AS command, actor % 400 AS run_id, task_id, CAST(started_at AS TIMESTAMP) AS s, CASE WHEN status <> 'running' THEN CAST(started_at AS TIMESTAMP) + CAST(actor % 40 AS BIGINT) * INTERVAL 1 HOUR END AS e, CASE WHEN price > 400000 THEN 6 END AS code, design FROM ({TASKS_SQL})),
o AS (SELECT t.*, launched FROM t JOIN l USING (command) WHERE s >= launched), r0 AS (SELECT command, run_id, min({{'s': s, 't': task_id}}) AS f FROM o GROUP BY command, run_id), r AS (SELECT command, run_id, f.t AS first_task, row_number() OVER (PARTITION BY command ORDER BY f) AS place FROM r0),
q AS (SELECT o.*, place, first_task FROM o LEFT JOIN (SELECT * FROM r WHERE place <= 3) x ON x.command = o.command AND x.run_id = o.run_id),
c AS (SELECT *, 'first_task' AS check_key, TIMESTAMP '1997-01-01' AS due_at FROM q WHERE place = 1 AND task_id = first_task UNION ALL SELECT *, 'first_runs', TIMESTAMP '1997-01-01' FROM q WHERE place IS NOT NULL
    UNION ALL SELECT *, 'within_96_hours', launched + INTERVAL 96 HOUR FROM q WHERE s < launched + INTERVAL 96 HOUR UNION ALL SELECT *, 'within_20000_hours', least(launched + INTERVAL 20000 HOUR, TIMESTAMP '1997-01-01') FROM q WHERE s < launched + INTERVAL 20000 HOUR),
g AS (SELECT command, check_key, run_id, count(*) AS n, count(*) FILTER (code = 6) AS f, count(*) FILTER ((e IS NULL OR e > due_at) AND s + INTERVAL 30 HOUR < due_at) AS late, count(*) FILTER (design IN ('deviation', 'incomplete')) AS d FROM c GROUP BY ALL),
w AS (SELECT command, launched, check_key, needs, hours FROM l, (VALUES ('first_task', 1, NULL), ('first_runs', 3, NULL), ('within_96_hours', NULL, 96), ('within_20000_hours', NULL, 20000)) v(check_key, needs, hours)),
z AS (SELECT w.command, w.check_key, needs, hours, launched, count(run_id) AS runs, coalesce(sum(n), 0) AS tasks, coalesce(sum(n - 1), 0) AS extra, coalesce(sum(f), 0) AS f, coalesce(sum(late), 0) AS late, coalesce(sum(d), 0) AS d FROM w LEFT JOIN g ON g.command = w.command AND g.check_key = w.check_key GROUP BY ALL)
SELECT command, check_key, coalesce(runs >= needs, launched + hours * INTERVAL 1 HOUR <= TIMESTAMP '1997-01-01') AS due, runs, CAST(tasks AS BIGINT) AS tasks, CAST(extra AS BIGINT) AS extra_tasks, CAST(f AS BIGINT) AS audit_failures, CAST(late AS BIGINT) AS overdue, CAST(d AS BIGINT) AS findings, greatest(extra, f, late, d) > 0 AS no_go FROM z""")
def audit_launch_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """After the launch of each command, its first task, its first three runs, and all within 96 and 20,000 hours; a task may run for 30"""
    t = tasks(spark, sf_dir)
    start = F.col("started_at").cast("timestamp_ntz")
    own = t.select(F.col("module").alias("command"), (F.col("actor") % 400).alias("run_id"), "task_id", start.alias("started_at"), F.when(F.col("status") != "running", start + F.make_dt_interval(hours=(F.col("actor") % 40).cast("int"))).alias("ended_at"), F.when(F.col("price") > 400000, A.EXIT_AUDIT).alias("exit_code"), "design")
    launches = t.select(F.col("module").alias("command")).distinct().select("command", (F.lit("1995-03-01").cast("timestamp_ntz") + F.make_dt_interval(days=F.ascii("command"))).alias("launched_at"), F.lit(30 * 3600).alias("max_seconds"))
    return A.launch_checks(own, launches, F.lit("1997-01-01").cast("timestamp_ntz"), (96, 20000))


@query(f"""
WITH s AS (SELECT task_id, stage_key, actual_seq - 1 AS actual_seq, part % 5 AS attempt_no, started_at, started_at + CAST(quantity - 5 AS BIGINT) * INTERVAL 1 SECOND AS ended_at, part % 11 - 1 AS input FROM ({STAGES_SQL}))
SELECT task_id, stage_key, CAST(actual_seq AS BIGINT) AS actual_seq, array_to_string(list_filter([CASE WHEN actual_seq < 1 THEN 'seq_not_positive' END, CASE WHEN attempt_no < 1 THEN 'attempt_not_positive' END, CASE WHEN input < 0 THEN 'input_negative' END, CASE WHEN ended_at < started_at THEN 'ends_before_start' END], lambda x: x IS NOT NULL), ';') AS violations
FROM s WHERE actual_seq < 1 OR attempt_no < 1 OR input < 0 OR ended_at < started_at""")
def audit_constraints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P14"""
    own = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("task_id"), F.concat(F.lit("stage_"), (F.col("l_linenumber") % 4).cast("string")).alias("stage_key"), (F.col("l_linenumber") - 1).alias("actual_seq"), (F.col("l_partkey") % 5).alias("attempt_no"), F.col("l_shipdate").alias("started_at"), (F.col("l_shipdate") + F.expr("make_dt_interval(0, 0, 0, l_quantity - 5)")).alias("ended_at"), (F.col("l_partkey") % 11 - 1).alias("input"), F.lit(0).cast("long").alias("output"), F.create_map(F.lit("r"), F.lit(0).cast("long")).alias("routes"))
    return A.constraint_violations(own).select("task_id", "stage_key", *wide("actual_seq"), F.array_join("violations", ";").alias("violations"))


@query(f"""
WITH t AS ({TASKS_SQL}), c AS (SELECT *, CASE module WHEN '1-URGENT' THEN 'write' WHEN '2-HIGH' THEN 'write' WHEN '3-MEDIUM' THEN 'maintenance' WHEN '5-LOW' THEN 'read' ELSE 'unclassified' END AS class, module <> '5-LOW' AS needs_task FROM t)
SELECT task_id, module AS command, class, needs_task, actor % 3 = 0 AND trim(CASE WHEN actor % 2 = 0 THEN ' ' ELSE 'why' END) = '' AS blocked, needs_task AND task_id % 10 = 0 AS gap, NOT (list_value('not_started', 'not_committed', 'committed', 'unknown')[CAST(task_id % 4 + 1 AS INT)] IN ('committed', 'unknown')) AS may_rerun, coalesce(nullif(trim(CASE WHEN task_id % 2 = 0 THEN ' ' END), ''), CASE WHEN task_id % 3 = 0 THEN 'env' END, 'system') AS actor_name FROM c""")
def command_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tenth run has no task"""
    own = tasks(spark, sf_dir).select("task_id", F.col("module").alias("command"), "actor", F.col("task_id").alias("run_id"), F.when(F.col("actor") % 3 == 0, "non_standard").otherwise("standard").alias("path_type"), F.when(F.col("actor") % 2 == 0, " ").otherwise("why").alias("reason"))
    classes = spark.createDataFrame([("1-URGENT", "write", True), ("2-HIGH", "write", True), ("3-MEDIUM", "maintenance", True), ("5-LOW", "read", False)], "command string, class string, needs_task boolean")
    known = A.path_check(A.classify_commands(own, classes))
    gaps = A.coverage_gaps(known, tasks(spark, sf_dir).where("task_id % 10 <> 0").select(F.col("task_id").alias("run_id")))
    state = F.element_at(F.array(*map(F.lit, ("not_started", "not_committed", "committed", "unknown"))), (F.col("task_id") % 4 + 1).cast("int"))
    name = A.trigger_context(F.when(F.col("task_id") % 2 == 0, " "), F.when(F.col("task_id") % 3 == 0, "env"), F.lit("system"))
    out = known.join(gaps.select("task_id", F.lit(True).alias("gap")), "task_id", "left")
    return out.select("task_id", "command", "class", "needs_task", "blocked", F.coalesce("gap", F.lit(False)).alias("gap"), A.may_rerun(state).alias("may_rerun"), name.alias("actor_name"))


@query(f"WITH t AS ({TASKS_SQL}) SELECT * FROM t WHERE status = 'running' AND started_at >= TIMESTAMP '1995-01-01' ORDER BY started_at DESC, task_id LIMIT 20")
def task_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The page of the most recent tasks that a user sees"""
    return V.task_list(tasks(spark, sf_dir), status="running", since=F.lit("1995-01-01").cast("timestamp_ntz"))


@query(f"""
WITH t AS ({TASKS_SQL}), s AS ({STAGES_SQL}) SELECT t.task_id, actor AS who, t.started_at AS started, operation AS action, module AS object, t.status AS result, CAST(actual_seq AS BIGINT) AS actual_seq, stage_key, s.status AS stage_status, CAST(quantity AS BIGINT) AS seconds FROM t LEFT JOIN s ON t.task_id = s.task_id""")
def task_show(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The story of every task"""
    return V.task_show(tasks(spark, sf_dir), stages(spark, sf_dir)).withColumnRenamed("at", "started").withColumns({"actual_seq": F.col("actual_seq").cast("long"), "seconds": F.col("seconds").cast("long")})


@query("WITH m AS (SELECT max(ts) AS last FROM events) SELECT event_id, ts, CASE WHEN ts < last - INTERVAL 10 DAYS THEN 'expired' ELSE 'available' END AS detail FROM events, m")
def detail_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F24, as of the last event, kept for 10 days"""
    e = table(spark, sf_dir, "events")
    last = e.agg(F.max("ts")).first()[0]
    return A.retention(e.select("event_id", "ts"), F.lit(last).cast("timestamp_ntz"), 10)


@query("SELECT event_id, left('Authorization: *** ' || props || ' token=***, ok', 60) AS shown, false AS leaks FROM events")
def redaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F23"""
    shown = A.redact(F.concat(F.lit("Authorization: Bearer abc.def "), "props", F.lit(" token=s3cr3t, ok")), 60)
    return table(spark, sf_dir, "events").select("event_id", shown.alias("shown")).withColumn("leaks", A.leaks(F.col("shown")))


# ---- news


URL_SQL = r"lower(regexp_extract(bare, '^([^/]*)', 1)) || regexp_replace(regexp_extract(bare, '^[^/]*(.*)$', 1), '/+$', '')"
PAGES_SQL = rf"SELECT page_id, url, html, {URL_SQL} AS k FROM (SELECT *, regexp_replace(regexp_replace(url, '[?#].*$', ''), '^[A-Za-z]+://(www\.|m\.)?', '') AS bare FROM pages)"
TEXT_SQL = r"trim(regexp_replace(lower(text), '[ \t\n\x0B\f\r]+', ' ', 'g'), ' ')"
KNOWN_SQL = "SELECT d.*, l.quality, l.toxic, CASE WHEN n_chars < 200 THEN 'irrelevant' WHEN l.quality IS NULL THEN 'uncertain' WHEN l.quality = 0 THEN 'irrelevant' ELSE 'relevant' END AS relevance, CASE WHEN n_chars < 200 THEN 'too_short' WHEN l.quality IS NULL THEN 'no_evidence' WHEN l.quality = 0 THEN 'rule_excluded' ELSE 'labelled' END AS reason FROM documents d LEFT JOIN (SELECT doc_id, min(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id) l ON d.doc_id = l.doc_id"


def events_sql(articles: str) -> str:
    """doc_id and event_id of articles: pairs that share enough bits, then all that these reach."""
    return rf"""SELECT a.doc_id, event_id FROM {articles} a LEFT JOIN (
        WITH RECURSIVE w AS (SELECT doc_id, coalesce(lang, '') AS lang, unnest(list_filter(list_distinct(string_split({TEXT_SQL}, ' ')), lambda x: length(x) >= 4)) AS word FROM {articles}),
        t AS (SELECT coalesce(lang, '') AS lang, count(*) AS articles FROM {articles} GROUP BY 1),
        f AS (SELECT lang, word, n, length(bin(articles // n)) AS bits, 2 * length(bin(articles)) AS needed FROM (SELECT lang, word, count(*) AS n FROM w GROUP BY ALL HAVING count(*) > 1) JOIN t USING (lang) WHERE n <= greatest(50, articles // 64)),
        s AS (SELECT doc_id, lang, word, bits, needed FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n, word) AS place FROM w JOIN f USING (lang, word)) WHERE place <= 6),
        links AS (SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b ON a.lang = b.lang AND a.word = b.word AND a.doc_id <> b.doc_id GROUP BY ALL HAVING sum(a.bits) >= any_value(a.needed)),
        reach AS (SELECT DISTINCT a AS id, a AS r FROM links UNION SELECT reach.id, links.b FROM reach JOIN links ON reach.r = links.a),
        c AS (SELECT id, min(r) AS component FROM reach GROUP BY id)
        SELECT id, coalesce(d.lang, '') || ':' || CAST(component AS VARCHAR) AS event_id FROM c JOIN {articles} d ON d.doc_id = c.id) x ON x.id = a.doc_id"""


@query(f"WITH p AS ({PAGES_SQL}) SELECT page_id, k AS dedup_key, page_id = min(page_id) OVER (PARTITION BY k) AS kept FROM p")
def news_metadata_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """N2, A6"""
    return N.metadata_dedup(table(spark, sf_dir, "pages").select("page_id", "url")).select("page_id", "dedup_key", "kept")


@query("SELECT CASE WHEN html IS NULL THEN 'failed' WHEN contains(url, '?page=') THEN 'updated' WHEN contains(url, '#') THEN 'skipped' ELSE 'new' END AS state, count(*) AS items, count(DISTINCT lower(regexp_extract(url, '^[A-Za-z]+://([^/:?#]+)', 1))) AS sources FROM pages GROUP BY 1")
def news_fetch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5: items, and sources apart from them"""
    return N.fetch_counts(table(spark, sf_dir, "pages"))


@query(f"WITH p AS ({PAGES_SQL}), m AS (SELECT *, min(page_id) OVER (PARTITION BY k) AS one, min(page_id) OVER (PARTITION BY url) AS same FROM p) SELECT 'metadata_dedup' AS stage_key, CASE WHEN page_id = same THEN 'same_address' ELSE 'same_url' END AS reason, count(*) AS n FROM m WHERE page_id <> one GROUP BY ALL")
def news_dedup_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Breakdown by reason"""
    doubled = table(spark, sf_dir, "pages").select("page_id", "url")
    return N.metadata_reasons(doubled)


@query(f"SELECT doc_id, sha256({TEXT_SQL}) AS dedup_key, doc_id = min(doc_id) OVER (PARTITION BY {TEXT_SQL}) AS kept FROM documents")
def news_content_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact, on normalized text"""
    return N.content_dedup(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "dedup_key", "kept")


WORDS_SQL = r"array_to_string(list_sort(list_distinct(regexp_extract_all(lower(text), '[\p{L}\p{N}]+'))), ' ')"


@query(f"SELECT doc_id, sha256({WORDS_SQL}) AS dedup_key, doc_id = min(doc_id) OVER (PARTITION BY {WORDS_SQL}) AS kept FROM documents")
def news_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles of the same words"""
    return N.near_dedup(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "dedup_key", "kept")


@query(r"""
WITH w AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM documents), s AS (SELECT DISTINCT doc_id, array_to_string(w[p + 1:p + 5], ' ') AS g FROM w, unnest(range(0, greatest(len(w) - 4, 1))) r(p) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id), gone AS (SELECT DISTINCT b.doc_id FROM (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL) p JOIN n x ON x.doc_id = p.a JOIN n b ON b.doc_id = p.b WHERE 100 * c >= 75 * (x.n + b.n - c))
SELECT doc_id, doc_id NOT IN (SELECT doc_id FROM gone) AS kept FROM documents""")
def news_similar_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles that share three quarters of their runs of five words with an earlier one; the SQL compares all pairs"""
    return N.similar_dedup(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "kept")


@query(f"WITH p AS ({PAGES_SQL}) SELECT min(page_id) AS page_id, k FROM p WHERE k NOT IN (SELECT k FROM p WHERE page_id % 3 = 0) GROUP BY k")
def news_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses that earlier runs have not seen"""
    p = table(spark, sf_dir, "pages").select("page_id", N.normalized_url(F.col("url")).alias("k"))
    return N.unseen(p.groupBy("k").agg(F.min("page_id").alias("page_id")), p.where("page_id % 3 = 0"), "k").select("page_id", "k")


@query(f"WITH k AS ({KNOWN_SQL}) SELECT relevance, reason, count(*) AS n FROM k GROUP BY ALL")
def news_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """N4, A7"""
    return N.classify(table(spark, sf_dir, "documents").drop("text"), table(spark, sf_dir, "labels")).groupBy("relevance", "reason").agg(F.count("*").alias("n"))


@query("SELECT CASE WHEN text IS NULL THEN 'failed' WHEN trim(text) = '' THEN 'empty' ELSE 'fetched' END AS outcome, count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS chars FROM documents GROUP BY 1")
def news_fulltext(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A8"""
    return N.fulltext(table(spark, sf_dir, "documents").select("text")).groupBy(F.col("fetch").alias("outcome")).agg(F.count("*").alias("n"), F.sum("chars").alias("chars"))


@query(f"WITH e AS ({events_sql('documents')}) SELECT event_id, count(*) AS articles FROM e GROUP BY event_id")
def news_cluster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles of each event, and those of none"""
    return N.cluster(spread(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))).groupBy("event_id").agg(F.count("*").alias("articles"))


@query(f"WITH e AS ({events_sql('documents')}), h AS (SELECT DISTINCT event_id FROM e WHERE doc_id % 2 = 0 AND event_id IS NOT NULL), o AS (SELECT DISTINCT event_id FROM e WHERE doc_id % 2 = 1 AND event_id IS NOT NULL) SELECT count(*) FILTER (WHERE h.event_id IS NULL) AS new_events, count(h.event_id) AS reused_events FROM o LEFT JOIN h USING (event_id)")
def news_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New and reused events, in their own unit"""
    e = N.cluster(spread(table(spark, sf_dir, "documents").select("doc_id", "text", "lang")))
    return N.events(e.where("doc_id % 2 = 1"), e.where("doc_id % 2 = 0 AND event_id IS NOT NULL"))


@query(f"WITH k AS ({KNOWN_SQL}) SELECT doc_id, CASE WHEN quality IS NULL THEN 'skipped' WHEN n_chars = 0 THEN 'failed' ELSE 'scored' END AS outcome, CASE WHEN quality IS NOT NULL AND n_chars > 0 THEN quality * 50 + least(n_chars, 5000) / 100.0::DOUBLE END AS score FROM k")
def news_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """N6, A10"""
    return N.score(N.classify(table(spark, sf_dir, "documents").drop("text"), table(spark, sf_dir, "labels"))).select("doc_id", "outcome", "score")


@query(f"WITH k AS ({KNOWN_SQL}), s AS (SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'default' WHEN 1 THEN 'sensitive' ELSE 'redline' END AS before, CASE WHEN toxic = 1 THEN 'sensitive' ELSE 'default' END AS rule FROM k) SELECT doc_id, before, CASE WHEN 'redline' IN (before, rule) THEN 'redline' WHEN 'sensitive' IN (before, rule) THEN 'sensitive' ELSE 'default' END AS safety FROM s WHERE before <> 'redline'")
def news_safety(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overrides are stricter only; redlines are never stored"""
    known = N.classify(table(spark, sf_dir, "documents").drop("text"), table(spark, sf_dir, "labels"))
    before = F.element_at(F.array(*map(F.lit, N.TIERS)), (F.col("doc_id") % 3 + 1).cast("int"))
    judged = known.select("doc_id", before.alias("before"), N.override(before, N.safety_tier(F.col("toxic"), F.lit(""))).alias("safety"))
    return N.admit(judged)


@query(rf"""
WITH p AS ({PAGES_SQL}), known AS ({KNOWN_SQL}), rel AS (SELECT * FROM known WHERE relevance = 'relevant'), there AS (SELECT *, min(doc_id) OVER (PARTITION BY {TEXT_SQL}) = doc_id AS kept FROM rel WHERE trim(text) <> ''), uniq AS (SELECT * FROM there WHERE kept), ev AS ({events_sql('uniq')}),
st AS (SELECT CASE WHEN html IS NULL THEN 'failed' WHEN contains(url, '?page=') THEN 'updated' WHEN contains(url, '#') THEN 'skipped' ELSE 'new' END AS state FROM pages), md AS (SELECT page_id = min(page_id) OVER (PARTITION BY k) AS kept FROM p)
SELECT stage_key, input, output, explained, input - explained AS residual FROM (
SELECT 'fetch' AS stage_key, count(*) AS input, count(*) FILTER (WHERE state = 'new') AS output, count(*) AS explained FROM st UNION ALL
SELECT 'metadata_dedup', count(*), count(*) FILTER (WHERE kept), count(*) FROM md UNION ALL
SELECT 'classify', count(*), count(*) FILTER (WHERE relevance = 'relevant'), count(*) FROM known UNION ALL
SELECT 'fulltext', count(*), count(*) FILTER (WHERE trim(text) <> ''), count(*) FROM rel UNION ALL
SELECT 'content_dedup', count(*), count(*) FILTER (WHERE kept), count(*) FROM there UNION ALL
SELECT 'cluster', count(*), count(event_id), count(*) FROM ev UNION ALL
SELECT 'score', count(*), count(*) FILTER (WHERE quality IS NOT NULL AND n_chars > 0), count(*) FROM uniq UNION ALL
SELECT 'safety', count(*), count(*) FILTER (WHERE coalesce(toxic, 0) <> 1), count(*) FROM uniq)""")
def news_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each stage conserves its input"""
    t = lambda name: table(spark, sf_dir, name)
    return A.funnel_check(N.funnel(spread(t("documents")), t("pages"), t("labels"))).select("stage_key", "input", "output", "explained", "residual")


# ---- product rules


@query(f"""
WITH d AS (SELECT *, doc_id % 30 AS day, nullif(trim(regexp_extract({TEXT_SQL}, '^(\\S+)', 1)), '') AS hook FROM documents), b AS (SELECT day, source, arg_min({{'n': n_chars, 'd': doc_id, 'h': hook}}, {{'a': -n_chars, 'b': doc_id}}) AS x FROM d WHERE source IS NOT NULL AND hook IS NOT NULL GROUP BY day, source),
r AS (SELECT day, source, x.n AS n_chars, x.d AS doc_id, x.h AS hook, row_number() OVER (PARTITION BY day ORDER BY x.n DESC, x.d) AS place FROM b)
SELECT day, source, n_chars, doc_id, hook, place, place = 1 AS recommended FROM r WHERE place <= 3""")
def candidates_top3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O5, P16"""
    docs = table(spark, sf_dir, "documents").withColumn("day", F.col("doc_id") % 30)
    hook = F.regexp_extract(N.normalized_text(F.col("text")), r"^(\S+)", 1)
    return N.candidates(docs, ["day"], "source", "n_chars", hook).withColumn("place", F.col("place").cast("long"))


@query(f"""
WITH d AS (SELECT *, doc_id % 30 AS day, nullif(trim(regexp_extract({TEXT_SQL}, '^(\\S+)', 1)), '') AS hook FROM documents), b AS (SELECT day, source, arg_min({{'n': n_chars, 'd': doc_id}}, {{'a': -n_chars, 'b': doc_id}}) AS x FROM d WHERE source IS NOT NULL AND hook IS NOT NULL GROUP BY day, source),
r AS (SELECT day, source, row_number() OVER (PARTITION BY day ORDER BY x.n DESC, x.d) AS place FROM b), c AS (SELECT * FROM r WHERE place <= 3)
SELECT day, count(*) AS n, count(DISTINCT source) AS sources, count(*) FILTER (WHERE source IN ('src0', 'src1')) AS official, count(DISTINCT source) = count(*) AND count(*) FILTER (WHERE source IN ('src0', 'src1')) < count(*) AS diverse FROM c GROUP BY day""")
def candidate_diversity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A18"""
    return N.diversity(candidates_top3(spark, sf_dir), ["day"], "source", F.col("source").isin("src0", "src1"))


@query("""
WITH l AS (SELECT doc_id, max(toxic) AS toxic FROM labels GROUP BY doc_id), i AS (SELECT d.doc_id, CASE WHEN d.doc_id % 17 = 0 THEN 'redline' WHEN toxic = 1 OR d.doc_id % 5 = 0 THEN 'sensitive' ELSE 'default' END AS safety, coalesce(list_value('conservative', 'standard', 'open', NULL)[CAST(d.doc_id % 4 + 1 AS INT)], 'standard') AS parent_tier, CASE WHEN d.doc_id % 2 = 0 THEN 'primary' ELSE 'junior' END AS age_tier FROM documents d LEFT JOIN l ON d.doc_id = l.doc_id)
SELECT doc_id, parent_tier, age_tier, safety, CASE WHEN safety = 'redline' THEN 'none' WHEN safety = 'default' THEN 'normal' WHEN parent_tier = 'conservative' THEN CASE age_tier WHEN 'primary' THEN 'none' ELSE 'rare' END ELSE CASE age_tier WHEN 'primary' THEN 'limited' ELSE 'normal' END END AS admit,
    CASE WHEN safety <> 'sensitive' THEN 'none' WHEN parent_tier = 'open' THEN 'weak' WHEN parent_tier = 'conservative' AND age_tier = 'primary' THEN 'none' ELSE 'normal' END AS hint, false AS review, safety = 'sensitive' AND NOT (parent_tier = 'conservative' AND age_tier = 'primary') AS heavy FROM i""")
def safety_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J8, N8, N9, P17"""
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n = F.col("doc_id")
    items = table(spark, sf_dir, "documents").select("doc_id").join(labels, "doc_id", "left").select("doc_id", F.when(n % 17 == 0, "redline").when((F.coalesce("toxic", F.lit(0)) == 1) | (n % 5 == 0), "sensitive").otherwise("default").alias("safety"), F.when(n % 4 == 0, "conservative").when(n % 4 == 1, "standard").when(n % 4 == 2, "open").alias("parent_tier"), F.when(n % 2 == 0, "primary").otherwise("junior").alias("age_tier"))
    return P.decide(items, P.safety_matrix(spark)).select("doc_id", "parent_tier", "age_tier", "safety", "admit", "hint", "review", "heavy")


@query("SELECT c_custkey AS family_id, e AS episode_id, CASE WHEN c_custkey % 3 = 0 THEN 'held' ELSE 'published' END AS release FROM customer, range(0, 3) r(e) WHERE NOT (c_custkey % 5 = 0 AND e = 1)")
def publish_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P18"""
    families = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("family_id"))
    episodes = families.select("family_id", F.explode(F.array(*(F.lit(k).cast("long") for k in range(3)))).alias("episode_id"))
    modes = families.where("family_id % 3 = 0").withColumn("mode", F.lit("review_first"))
    return P.publish(episodes, modes, families.where("family_id % 5 = 0").withColumn("episode_id", F.lit(1).cast("long"))).select("family_id", "episode_id", "release")


@query("SELECT event_type, count(*) AS started, count(*) FILTER (WHERE value >= 50) AS finished, count(*) FILTER (WHERE value >= 50) / count(*)::DOUBLE AS rate FROM events GROUP BY event_type")
def listening_completion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A14"""
    return P.completion(table(spark, sf_dir, "events"), ["event_type"], F.col("value") >= 50)


@query("WITH d AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events), r AS (SELECT *, day - CAST(row_number() OVER (PARTITION BY user_id ORDER BY day) AS INT) AS run FROM d) SELECT user_id, min(day) AS first_day, max(day) AS last_day, count(*) AS days FROM r GROUP BY user_id, run")
def listening_streak(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W7"""
    return P.streaks(P.days_of(table(spark, sf_dir, "events")))


@query("WITH d AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events), n AS (SELECT *, coalesce(lead(day) OVER (PARTITION BY user_id ORDER BY day) - day = 1, false) AS back FROM d) SELECT day, count(*) AS listeners, count(*) FILTER (WHERE back) AS returned, count(*) FILTER (WHERE back) / count(*)::DOUBLE AS rate FROM n GROUP BY day")
def next_day_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W8"""
    return P.next_day_return(P.days_of(table(spark, sf_dir, "events")))


@query("SELECT CAST(date_trunc('week', ts) AS DATE) AS week, CASE event_type WHEN 'error' THEN 'veto' WHEN 'view' THEN 'uncertain' ELSE 'uncovered' END AS kind, count(*) AS n FROM events GROUP BY 1, 2")
def policy_signal_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A17"""
    kind = F.when(F.col("event_type") == "error", "veto").when(F.col("event_type") == "view", "uncertain").otherwise("uncovered")
    return P.signal_digest(table(spark, sf_dir, "events").select("ts", kind.alias("kind")))


@query("""
WITH days AS (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events), picks AS (SELECT CAST(ts AS DATE) AS day, max(event_id) AS topic FROM events WHERE event_type = 'purchase' AND day(ts) % 3 <> 0 GROUP BY 1)
SELECT day, coalesce(CAST(topic AS VARCHAR), 'evergreen_' || CAST(date_diff('day', DATE '1970-01-01', day) % 7 AS VARCHAR)) AS topic, CASE WHEN topic IS NULL THEN 'evergreen' ELSE 'picked' END AS origin FROM days LEFT JOIN picks USING (day)""")
def evergreen_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J9"""
    e = table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    picks = e.where((F.col("event_type") == "purchase") & (F.dayofmonth("day") % 3 != 0)).groupBy("day").agg(F.max("event_id").cast("string").alias("topic"))
    evergreen = spark.createDataFrame([(k, f"evergreen_{k}") for k in range(7)], "turn int, topic string")
    return P.with_evergreen(e.select("day").distinct(), picks, evergreen)


@query("""
WITH l AS (SELECT conv_id, turn, CASE WHEN role = 'assistant' THEN '爸爸' ELSE role END AS speaker, CASE turn % 3 WHEN 0 THEN '为什么呢？' WHEN 1 THEN '所以我们要想想。' ELSE '' END || text AS text FROM conversations)
SELECT conv_id, CAST(sum(length(text)) AS BIGINT) AS chars, count(*) FILTER (WHERE regexp_matches(text, '今天告诉我们|所以我们要|小朋友应该')) AS didactic, CAST(sum(CASE WHEN speaker = '爸爸' THEN len(regexp_extract_all(text, '[？?]')) ELSE 0 END) AS BIGINT) AS questions, CAST(sum(CASE WHEN speaker = '爸爸' THEN len(regexp_extract_all(text, '[。！!.]')) ELSE 0 END) AS BIGINT) AS conclusions,
    sum(length(text)) BETWEEN CASE WHEN conv_id % 2 = 0 THEN 2000 ELSE 3000 END AND CASE WHEN conv_id % 2 = 0 THEN 2500 ELSE 3700 END AS length_ok, sum(CASE WHEN speaker = '爸爸' THEN len(regexp_extract_all(text, '[？?]')) ELSE 0 END) > sum(CASE WHEN speaker = '爸爸' THEN len(regexp_extract_all(text, '[。！!.]')) ELSE 0 END) AS asks_more FROM l GROUP BY conv_id""")
def script_lint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A15, F30, F31, with injected sentences"""
    c = table(spark, sf_dir, "conversations")
    said = F.when(F.col("turn") % 3 == 0, "为什么呢？").when(F.col("turn") % 3 == 1, "所以我们要想想。").otherwise("")
    own = c.select("conv_id", F.when(F.col("role") == "assistant", P.FATHER).otherwise(F.col("role")).alias("speaker"), F.concat(said, "text").alias("text"))
    return P.lint(own, ["conv_id"], F.when(F.col("conv_id") % 2 == 0, "primary").otherwise("junior"))


@query("""
WITH g AS (SELECT c_custkey, c_custkey % 9 + 1 AS grade, c_custkey % 5 - 2 AS nudge FROM customer), s AS (SELECT *, CASE WHEN grade <= 6 THEN 0 ELSE 1 END + greatest(-1, least(1, nudge)) AS tier FROM g) SELECT c_custkey, grade, CASE WHEN tier <= 0 THEN 'primary' ELSE 'junior' END AS age_tier FROM s""")
def age_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F32"""
    k = F.col("c_custkey")
    own = table(spark, sf_dir, "customer").select("c_custkey", (k % 9 + 1).alias("grade"), (k % 5 - 2).alias("nudge"))
    return own.select("c_custkey", "grade", P.age_tier(F.col("grade"), F.col("nudge")).alias("age_tier"))


CUE_CASES = ["（笑）", "（叹气）（开心）", "（惊呼）（压低）（紧张）", "（音色=male-qn-qingse）（更低沉）", "（音效=robotic）（平静）<换段>", "（兴奋）（吸气）（轻声）"]
CUE_ROWS = [("[laughs]", "(laughs)", None, "", None, None), ("[sigh]（开心）", "(sighs)", "happy", "", None, None), ("（惊呼）（压低）（紧张）", "(gasps)", "fearful", "压低", None, None), ("（音色=male-qn-qingse）（更低沉）", "", None, "", "male-qn-qingse", None), ("（音效=robotic）（平静）<换段>", "\n", "calm", "", None, "robotic"), ("[excited]（吸气）[whisper]", "(inhale)", None, "轻声", None, None)]


def _sql_list(k: int) -> str:
    return "list_value(" + ", ".join("NULL" if r[k] is None else "'" + r[k] + "'" for r in CUE_ROWS) + f")[CAST(turn % {len(CUE_ROWS)} + 1 AS INT)]"


@query(f"SELECT conv_id, turn, {_sql_list(0)} || text AS fish, {_sql_list(1)} || text AS native, {_sql_list(2)} AS emotion, {_sql_list(3)} AS prosody, {_sql_list(4)} AS voice, {_sql_list(5)} AS effect FROM conversations")
def cue_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F26-F29"""
    cue = F.element_at(F.array(*map(F.lit, CUE_CASES)), (F.col("turn") % len(CUE_CASES) + 1).cast("int"))
    own = table(spark, sf_dir, "conversations").withColumn("t", F.concat(cue, "text"))
    return own.select("conv_id", "turn", P.fish_text(F.col("t")).alias("fish"), P.native_text(F.col("t")).alias("native"), P.cue_settings(F.col("t")).alias("s")).select("conv_id", "turn", "fish", "native", "s.emotion", F.array_join("s.prosody", ";").alias("prosody"), "s.voice", "s.effect")


@query("SELECT conv_id, turn, replace(replace(text, 'the ', 'thuh '), 'de ', 'duh ') AS spoken FROM conversations")
def pronunciation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F34"""
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", P.spoken_forms(F.col("text"), {"the ": "thuh ", "de ": "duh "}).alias("spoken"))


@query("""
WITH p AS (SELECT DISTINCT CAST(ts AS DATE) AS day, event_type AS topic, 10.0::DOUBLE AS score FROM events WHERE event_id % 2 = 0), a AS (SELECT DISTINCT CAST(ts AS DATE) AS date, event_type AS topic FROM events WHERE event_id % 2 = 1),
l AS (SELECT p.day, p.topic, p.score, max(a.date) AS last FROM p LEFT JOIN a ON p.topic = a.topic AND a.date < p.day GROUP BY ALL) SELECT day, topic, score, CASE WHEN last IS NULL OR day - last > 14 THEN score ELSE score * (day - last) / 14 END AS adjusted FROM l""")
def topic_rhythm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """N10, our own reading: even events are picks, odd ones the archive"""
    e = table(spark, sf_dir, "events")
    picks = e.where("event_id % 2 = 0").select(F.to_date("ts").alias("day"), F.col("event_type").alias("topic"), F.lit(10.0).alias("score")).distinct()
    archive = e.where("event_id % 2 = 1").select(F.to_date("ts").alias("date"), F.col("event_type").alias("topic")).distinct()
    return N.rhythm(picks, archive).select("day", "topic", "score", "adjusted")


@query("""
WITH h AS (SELECT user_id AS family, event_type || ':' || CAST(event_id % 40 AS VARCHAR) AS topic, value FROM events), c AS (SELECT topic, CASE WHEN length(topic) % 2 = 0 THEN 'lower' ELSE 'upper' END AS tier, CAST(count(*) % 23 AS BIGINT) AS base FROM h GROUP BY topic),
f AS (SELECT c_custkey AS family, CASE WHEN c_nationkey % 2 = 0 THEN 'lower' ELSE 'upper' END AS tier FROM customer), t AS (SELECT family, topic, count(*) AS times FROM h GROUP BY ALL),
s AS (SELECT f.family, c.topic, base + 5 * least(coalesce(times, 0), 4) AS score FROM f JOIN c USING (tier) LEFT JOIN t ON t.family = f.family AND t.topic = c.topic)
SELECT * FROM (SELECT family, topic, score, row_number() OVER (PARTITION BY family ORDER BY score DESC, topic) AS place FROM s) WHERE place <= 3""")
def personal_picks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three topics for each family, by its grade's tier and what it has heard; the SQL scores every family with every topic"""
    e = table(spark, sf_dir, "events")
    history = e.select(F.col("user_id").alias("family"), F.concat_ws(":", "event_type", (F.col("event_id") % 40).cast("string")).alias("topic"))
    topics = history.groupBy("topic").agg((F.count("*") % 23).alias("base")).withColumn("tier", F.when(F.length("topic") % 2 == 0, "lower").otherwise("upper"))
    families = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("family"), F.when(F.col("c_nationkey") % 2 == 0, "lower").otherwise("upper").alias("tier"))
    return P.recommend(topics, families, history).select("family", "topic", "score", *wide("place"))

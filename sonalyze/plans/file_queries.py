"""Queries over files: they write what a run would find (requests, line audio, scripts, logs, feeds, ledgers) to the
shared folder, made of the test tables, and read it with the sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sonalyze.functions.detectors import Detector
from sonalyze.operators import audit as A
from sonalyze.operators import news as N
from sonalyze.operators import product as P
from sonalyze.operators import review as R
from sonalyze.plans import catalogue as C
from sonalyze.plans import views as V
from sonalyze.plans.workflows import Registry, Stage, Workflow
from sonalyze.sources import episodes as E
from sonalyze.shared import scratch
from sonalyze.sources import feeds, ledger
from sonalyze.sources.files import read_files, write_files
from sonalyze.streaming.ingest import Locked, RunLock, ingest

query, table, wide = C.query, C.table, C.wide
_folders: dict[tuple[str, str, str], str] = {}


def folder_of(spark: SparkSession, name: str) -> str:
    """A new folder that driver and executors share."""
    return scratch(spark, name)


def file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), spark._jvm.org.apache.hadoop.fs.Path


def lay_out(files: DataFrame, folder: str) -> None:
    """A file for each row of files (name, value), by tasks."""
    write_files(C.spread(files.withColumnRenamed("name", "path")), folder)


def lay_out_lines(rows: DataFrame, folder: str) -> None:
    """A file of many lines for each of a few names (name, value), whose parts Spark writes and the driver names."""
    spark, parts = rows.sparkSession, f"{folder}/parts"
    rows.repartition("name").write.partitionBy("name").text(parts)
    fs, path = file_system(spark, folder)
    for held in fs.listStatus(path(parts)):
        if held.isDirectory():
            [one] = [s.getPath() for s in fs.listStatus(held.getPath()) if s.getPath().getName().startswith("part-")]
            fs.rename(one, path(f"{folder}/{held.getPath().getName().split('=', 1)[1]}"))
    fs.delete(path(parts), True)


# ---- episodes: conv_id is the episode; beside four of twelve there is a request that can't be reviewed

REQUESTS = "*/*.json"
MISSING, BROKEN = "(conv_id + turn) % 7 = 0", "(turn + 1) % 6 = 0"


def recognized(path: str) -> list[dict]:
    """What the stand-in for a model hears depends on the number of the line alone."""
    n = int(path.rsplit("/", 1)[1].split("_")[0])
    if n % 6 == 0:
        raise RuntimeError(f"broken line {n}")
    if n % 5 == 0:
        return []
    return [{"text": f"<|zh|><|{('happy', 'NEUTRAL', 'SAD')[(n - 1) % 3]}|><|Speech|><|withitn|>第{n}句"}]


def stand_in(model: str, device: str):
    """Takes the lines of a batch; one that breaks breaks its batch."""
    return lambda paths: [recognized(p) for p in paths]


def heard() -> Detector:
    return Detector(stand_in, model="m2", device="cpu", version="1.0", batch=8)


def hundred():
    """The folder that the episodes of a hundred ids have, so that tasks can list them apart."""
    return F.expr("concat(conv_id div 100, '/')")


def episodes(spark: SparkSession, sf_dir: str, name: str = "episodes") -> str:
    """The folder of this name with a request for each conversation, and the audio of its lines."""
    folder, key = requested(spark, sf_dir, name), (spark.sparkContext.applicationId, sf_dir, f"{name}, audio")
    if key not in _folders:
        rows = table(spark, sf_dir, "conversations").where(f"NOT ({MISSING})")
        lay_out(rows.select(F.concat(hundred(), F.lit("ep"), "conv_id", F.lit(f"{E.PARTS}/"), R.part_name((F.col("turn") + 1).cast("int"), F.col("role"))).alias("name"), F.lit("").alias("value")), folder)
        _folders[key] = folder
    return folder


def requested(spark: SparkSession, sf_dir: str, name: str = "episodes") -> str:
    """The folder of this name with a request for each conversation; what reads requests alone needs no audio there."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key in _folders:
        return _folders[key]
    folder = folder_of(spark, name)
    rows = table(spark, sf_dir, "conversations")
    emotion = F.when(F.col("conv_id") % 4 == 0, "happy").when(F.col("conv_id") % 4 == 2, "Fearful").when(F.col("conv_id") % 4 == 3, "calm")
    turn = F.struct("turn", F.col("role").alias("speaker"), "text", F.struct(emotion.alias("emotion")).alias("voice_setting"))
    kind = F.col("conv_id") % 12
    turns = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    good = turns.select(F.concat(hundred(), F.lit("ep"), "conv_id", F.lit(E.REQUEST)).alias("name"), F.to_json(F.struct("turns")).alias("value"))
    body = F.when(kind == 8, '{"turns": []}').when(kind == 9, '{"turns": "x"}').when(kind == 11, "{").otherwise(F.to_json(F.struct("turns")))
    bad = turns.where(kind >= 8).select(F.concat(hundred(), F.lit("bad"), "conv_id", F.when(kind == 10, ".json").otherwise(E.REQUEST)).alias("name"), body.alias("value"))
    lay_out(good.unionByName(bad), folder)
    _folders[key] = folder
    return folder


NAMED = "CAST(conv_id AS VARCHAR) AS episode"
EPISODE_LINES_SQL = """
SELECT conv_id, CAST(turn + 1 AS BIGINT) AS line_id, role AS speaker, text AS tts_text,
    CASE WHEN (turn + 1) % 5 > 0 THEN list_value('HAPPY', 'NEUTRAL', 'SAD')[CAST(turn % 3 + 1 AS INT)] END AS emotion,
    CASE WHEN (turn + 1) % 5 = 0 THEN '' ELSE '第' || CAST(turn + 1 AS VARCHAR) || '句' END AS asr_text,
    CASE conv_id % 4 WHEN 0 THEN 'happy' WHEN 2 THEN 'Fearful' WHEN 3 THEN 'calm' END AS planned_emotion,
    CASE WHEN (conv_id + turn) % 7 = 0 THEN 'missing_audio' WHEN (turn + 1) % 6 = 0 THEN 'assessment_error' END AS gone
FROM conversations"""
EPISODES_SQL = C.records_sql(False).replace(C.LINES_SQL, EPISODE_LINES_SQL).replace("rate > 0.1", "rate > 0.97").replace("list_contains(fit, emotion)", "coalesce(list_contains(fit, emotion), false)")


def episode_of(column: str = "stem"):
    return F.substring(column, 3, 99).alias("episode")


@query(f"SELECT {NAMED}, line_id, speaker, tts_text, planned_emotion FROM ({EPISODE_LINES_SQL})")
def request_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The turns of all requests in a folder"""
    found = E.turns(E.requests_below(spark, requested(spark, sf_dir), REQUESTS))
    return found.select(episode_of(), *wide("line_id"), "speaker", "tts_text", "planned_emotion")


@query("SELECT DISTINCT 'bad' || CAST(conv_id AS VARCHAR) || CASE WHEN conv_id % 12 = 10 THEN '.json' ELSE '.minimax-request.json' END AS file_name, CASE conv_id % 12 WHEN 10 THEN 'bad_suffix' WHEN 11 THEN 'not_json' ELSE 'no_turns' END AS reason FROM conversations WHERE conv_id % 12 >= 8")
def request_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests that are refused before any work, and why"""
    bad = E.reject(E.requests_below(spark, requested(spark, sf_dir), REQUESTS))
    return bad.select(F.regexp_extract("request_json", "([^/]*)$", 1).alias("file_name"), "reason")


@query(f"SELECT {NAMED}, printf('%02d', turn + 1) || '_' || role || '.mp3' AS file_name FROM conversations WHERE NOT ({MISSING})")
def line_audio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audio there is, empty files too"""
    return E.audio_parts(spark, episodes(spark, sf_dir)).select(episode_of(), "file_name")


def reviewed(spark: SparkSession, sf_dir: str, name: str = "episodes") -> DataFrame:
    folder = episodes(spark, sf_dir, name)
    return E.review_episodes(spark, E.requests_below(spark, folder, REQUESTS), E.audio_parts(spark, folder), heard(), 0.97)


@query(f"WITH {EPISODES_SQL} SELECT {NAMED}, line_id, CASE WHEN unavailable IS NULL THEN asr_text END AS asr_text, CASE WHEN unavailable IS NULL THEN emotion END AS emotion, cer, flags, CAST(priority AS BIGINT) AS priority, status FROM records")
def episode_review(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests and audio listing in, records out; the model fails on some lines and says
    nothing on others; the threshold is 0.97"""
    return reviewed(spark, sf_dir).select(episode_of(), *wide("line_id"), "asr_text", "emotion", "cer", F.array_join("flags", ";").alias("flags"), *wide("priority"), F.col("decision.status").alias("status"))


@query(f"""WITH {EPISODES_SQL} SELECT printf('ep%d_round%d', conv_id, 3) AS run_id, line_id, tts_text, 'm2' AS model, 'cpu' AS device, CASE WHEN unavailable IS NULL THEN CASE WHEN asr_text = '' THEN '' ELSE '<|zh|><|' || replace(emotion, 'HAPPY', 'happy') || '|><|Speech|><|withitn|>' || asr_text END END AS raw_output,
    CASE WHEN unavailable = 'assessment_error' THEN 'broken line ' || CAST(line_id AS VARCHAR) END AS error, reason FROM records""")
def raw_record_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw records written as JSON lines and read back"""
    records, path = reviewed(spark, sf_dir), folder_of(spark, "raw")
    raw = R.raw_records(records, F.col("stem"), 3, heard().provenance)
    E.write_raw(raw, path)
    d = F.col("detectors")[0]
    return spark.read.schema(raw.schema).json(path).select("run_id", *wide("line_id"), "tts_text", d["model"].alias("model"), d["device"].alias("device"), d["raw_output"].alias("raw_output"), d["error"].alias("error"), F.col("decision.reason").alias("reason"))


@query(f"""WITH {EPISODES_SQL}, queue AS (SELECT conv_id, line_id, speaker, tts_text, CASE WHEN unavailable IS NULL THEN nullif(asr_text, '') END AS asr_text, cer, flags, CAST(priority AS BIGINT) AS priority, reason, unavailable,
    row_number() OVER (PARTITION BY conv_id ORDER BY priority DESC, line_id) AS place FROM records)
    SELECT {NAMED}, line_id, place, speaker, tts_text, asr_text, cer, flags, priority, reason AS decision_reason, printf('ep%d_round%d', conv_id, 2) AS run_id, CASE unavailable WHEN 'missing_audio' THEN 1 WHEN 'assessment_error' THEN 2 ELSE 0 END AS audio,
    flags <> '' AS planned, count(*) FILTER (flags <> '') OVER (PARTITION BY conv_id) AS review_required FROM queue""")
def episode_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations reviewed; the three files of each are written by tasks and read back.
    audio: 1 where none is, 2 where the model failed; place: of the line in its listening queue"""
    folder = episodes(spark, sf_dir, "reviewed-episodes")  # its own, as fix plans are JSON beside requests
    records = reviewed(spark, sf_dir, "reviewed-episodes")
    E.write_episodes(records, 2, heard().provenance, folder_of(spark, "episodes-done"))
    found = lambda end: read_files(spark, folder, f"*/ep*{end}")
    at = F.regexp_extract("path", r"/ep(\d+)\.[^/]*$", 1).alias("episode")
    or_empty = lambda c: F.coalesce(c, F.lit("")).alias(c)  # noqa: E731: a record has these, and CSV doesn't tell empty from null
    queue = E.queues(found(".review_round2.csv")).select(at, "place", *(F.col(c).cast("long").alias(c) for c in ("line_id", "priority")), "speaker", or_empty("tts_text"), "asr_text", F.col("cer").cast("double").alias("cer"), or_empty("flags"), "decision_reason")
    line = F.from_json("line", "line_id long, run_id string, detectors array<struct<raw_output: string, error: string>>")
    said = found(E.RAW).select(at, F.explode(F.split("value", "\n")).alias("line")).where("line <> ''").select("episode", line.alias("r"))
    one = F.col("r.detectors")[0]
    raw = said.select("episode", "r.line_id", "r.run_id", F.when(one["error"].isNotNull(), 2).when(one["raw_output"].isNull(), 1).otherwise(0).alias("audio"))
    plan = found(".fix_plan_round2.json").select(at, F.from_json("value", "review_required long, items array<struct<line_id: long>>").alias("p")).select("episode", "p.review_required", F.col("p.items.line_id").alias("items"))
    rows = queue.join(raw, ["episode", "line_id"]).join(plan, "episode")
    return rows.withColumn("planned", F.array_contains("items", F.col("line_id"))).drop("items")


# ---- scripts, logs, feeds


def script_folder(spark: SparkSession, sf_dir: str) -> str:
    key = (spark.sparkContext.applicationId, sf_dir, "scripts")
    if key not in _folders:
        folder = folder_of(spark, "scripts")
        line = F.concat(F.lit("**"), "role", F.lit("**：**"), F.replace("text", F.lit("\n"), F.lit(" ")), F.lit("**（笑）"))
        rows = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", line.alias("line")))).alias("x"))
        body = F.concat(F.lit("# 标题\n爸爸：不算\n## 正文\n"), F.array_join("x.line", "\n"), F.lit("\n## 备注\n爸爸：不算"))
        lay_out(rows.select(F.concat(F.lit("ep"), "conv_id", F.lit(".md")).alias("name"), body.alias("value")), folder)
        last = rows.agg(F.max("conv_id")).first()[0]
        fs, path = file_system(spark, folder)
        newest = path(f"{folder}/ep{last}.md")
        fs.setTimes(newest, fs.getFileStatus(newest).getModificationTime() + 60_000, -1)
        _folders[key] = folder
    return _folders[key]


@query("SELECT 'ep' || CAST(conv_id AS VARCHAR) || '.md' AS file_name, turn + 1 AS line_no, role AS speaker, trim(replace(text, chr(10), ' '), ' ') AS text FROM conversations")
def script_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines spoken in the scripts of a folder"""
    found = P.script_lines(ledger.scripts(spark, script_folder(spark, sf_dir)))
    return found.select(F.regexp_extract("path", "([^/]*)$", 1).alias("file_name"), *wide("line_no"), "speaker", "text")


@query("SELECT 'ep' || CAST(max(conv_id) AS VARCHAR) || '.md' AS file_name FROM conversations")
def newest_script(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By default the newest script is taken"""
    return ledger.scripts(spark, script_folder(spark, sf_dir), newest=True).select(F.regexp_extract("path", "([^/]*)$", 1).alias("file_name"))


@query("SELECT event_id, event_type, 'app.log' || CASE event_id % 3 WHEN 0 THEN '' ELSE '.' || CAST(event_id % 3 AS VARCHAR) END AS file FROM events WHERE user_id = (SELECT min(user_id) FROM events)")
def correlated_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of one correlation key in the current log and those rotated"""
    e, folder = table(spark, sf_dir, "events"), folder_of(spark, "logs")
    turn = F.col("event_id") % 3
    lay_out_lines(e.select(F.concat(F.lit("app.log"), F.when(turn == 0, "").otherwise(F.concat(F.lit("."), turn))).alias("name"), F.to_json(F.struct(F.concat(F.lit("u"), "user_id").alias("correlation_id"), "event_id", "event_type")).alias("value")), folder)
    key = f"u{e.agg(F.min('user_id')).first()[0]}"
    rows = ledger.logs(spark, [f"{folder}/app.log*"], key)
    return rows.select(F.get_json_object("value", "$.event_id").cast("long").alias("event_id"), F.get_json_object("value", "$.event_type").alias("event_type"), "file")


@query("""
WITH i AS (SELECT page_id, 'unit' || CAST(page_id % 14 AS VARCHAR) AS feed, CASE WHEN page_id % 11 > 0 THEN url END AS link FROM pages)
SELECT feed, CASE WHEN link IS NULL THEN 'failed' WHEN page_id % 3 > 0 THEN 'new' WHEN page_id % 2 = 0 THEN 'skipped' ELSE 'updated' END AS state, count(*) AS items FROM i GROUP BY ALL""")
def feed_fetch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C11, A5: items of the feeds of fourteen units against what earlier runs have"""
    p, folder, n = table(spark, sf_dir, "pages"), folder_of(spark, "feeds"), F.col("page_id")
    link = F.concat(F.replace("url", F.lit("&"), F.lit("&amp;")), F.lit("#p"), "page_id")
    item = F.concat(F.lit("<item><title>t"), "page_id", F.lit("</title><link>"), F.when(n % 11 > 0, link).otherwise(""), F.lit("</link></item>"))
    files = p.groupBy((n % 14).alias("unit")).agg(F.array_join(F.collect_list(item), "\n").alias("x"))
    lay_out(files.select(F.concat(F.lit("unit"), "unit", F.lit(".xml")).alias("name"), F.concat(F.lit("<rss><channel>\n"), "x", F.lit("\n</channel></rss>")).alias("value")), folder)
    history = p.where("page_id % 3 = 0").select(F.concat("url", F.lit("#p"), "page_id").alias("link"), F.when(n % 2 == 0, F.concat(F.lit("t"), "page_id")).otherwise("old").alias("title"))
    return N.compared(feeds.feed_items(spark, folder), history).groupBy("feed", "state").agg(F.count("*").alias("items"))


# ---- ledger


@query(f"WITH t AS ({C.TASKS_SQL}), s AS (SELECT task_id, count(*) AS stages FROM ({C.STAGES_SQL}) GROUP BY task_id) SELECT module, t.status, count(*) AS tasks, CAST(coalesce(sum(stages), 0) AS BIGINT) AS stages FROM t LEFT JOIN s ON t.task_id = s.task_id GROUP BY ALL")
def ledger_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Task and stage tables of a ledger, written and read by their schemas"""
    folder = folder_of(spark, "ledger")
    C.tasks(spark, sf_dir).select("task_id", "module", "operation", F.col("actor").cast("string").alias("actor"), "status", "design", "started_at").write.parquet(f"{folder}/tasks")
    C.stages(spark, sf_dir).select("task_id", "stage_key", "attempt_no", F.col("actual_seq").cast("int").alias("actual_seq"), "status").write.parquet(f"{folder}/stages")
    stages = ledger.stages(spark, f"{folder}/stages").groupBy("task_id").agg(F.count("*").alias("stages"))
    return ledger.tasks(spark, f"{folder}/tasks").join(stages, "task_id", "left").groupBy("module", "status").agg(F.count("*").alias("tasks"), F.coalesce(F.sum("stages"), F.lit(0)).alias("stages"))


@query("""WITH t AS (%s) SELECT '{"task_id":' || CAST(task_id AS VARCHAR) || ',"module":"' || module || '","status":"' || status || '","failure":' || CASE WHEN status = 'running' THEN 'null' ELSE '"none"' END || '}' AS json FROM t""" % C.TASKS_SQL)
def task_list_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The task list for machines, nulls kept"""
    rows = V.task_list(C.tasks(spark, sf_dir), limit=None).select("task_id", "module", "status", F.when(F.col("status") != "running", "none").alias("failure"))
    return V.as_json(rows)


@query(f"WITH t AS ({C.TASKS_SQL}), b AS (SELECT task_id, status FROM t WHERE task_id % 50 <> 0), a AS (SELECT task_id, CASE WHEN task_id % 7 = 0 THEN 'failed' ELSE status END AS status FROM t) SELECT *, 'added' AS change FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) UNION ALL SELECT *, 'lost' FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)")
def read_only_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a command that claims to read alone has added, changed or lost"""
    own = C.tasks(spark, sf_dir).select("task_id", "status")
    return A.tasks_added(own.where("task_id % 50 <> 0"), own.withColumn("status", F.when(F.col("task_id") % 7 == 0, "failed").otherwise(F.col("status"))))


@query("""
WITH a AS (SELECT l_orderkey AS run_id, l_linenumber AS n, l_returnflag = 'R' AS done FROM lineitem), r AS (SELECT run_id, count(*) AS attempts, max(n) AS last, min(n) FILTER (WHERE done) AS done_at FROM a GROUP BY run_id)
SELECT run_id, attempts, coalesce(done_at <= 3, false) AS acquired, last > 3 OR coalesce(last > done_at, false) AS out_of_bounds, CAST(CASE WHEN done_at <= 3 THEN 0 WHEN last >= 3 THEN 6 END AS BIGINT) AS exit_code FROM r""")
def lock_retries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An order's lines are attempts, those returned get through"""
    own = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("run_id"), F.col("l_linenumber").alias("attempt_no"), F.when(F.col("l_returnflag") == "R", "done").otherwise("conflict").alias("outcome"))
    return A.lock_retries(own).withColumn("exit_code", F.col("exit_code").cast("long"))


SHOP = Workflow("shop", 1, (Stage("a", "item"), Stage("b", "item", ("lost",)), Stage("c", "item")), {"c": ("a", "b")})
SHOP_SQL = "SELECT conv_id AS task_id, list_value('a', 'b', 'c')[CAST((conv_id + turn) % 3 + 1 AS INT)] AS stage_key, turn + 1 AS actual_seq, CASE WHEN length(text) % 3 = 0 THEN 'failed' ELSE 'succeeded' END AS status FROM conversations"


@query(f"""WITH d AS (SELECT * FROM (VALUES ('shop', 1, 'a', 1, 'item', 'input = output', true), ('shop', 1, 'b', 2, 'item', 'input = output + lost', true), ('shop', 1, 'c', 3, 'item', 'input = output', true)) v(workflow, version, stage_key, expected_seq, unit, formula, hard)), s AS ({SHOP_SQL})
    SELECT workflow, CAST(version AS BIGINT) AS version, d.stage_key, CAST(expected_seq AS BIGINT) AS expected_seq, unit, formula, hard, count(s.stage_key) AS stages, count(DISTINCT task_id) AS tasks FROM d LEFT JOIN s ON s.stage_key = d.stage_key GROUP BY ALL""")
def workflow_definitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U4: what a module declares that no operator knows by name, and the stages of the ledger that are of it"""
    ran = shop_stages(spark, sf_dir).groupBy("workflow", "version", "stage_key").agg(F.count("*").alias("stages"), F.count_distinct("task_id").alias("tasks"))
    found = Registry(SHOP).definitions(spark).join(ran, ["workflow", "version", "stage_key"], "left").fillna(0, ["stages", "tasks"])
    return found.select("workflow", *wide("version"), "stage_key", *wide("expected_seq"), "unit", "formula", "hard", "stages", "tasks")


def shop_stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.element_at(F.array(*map(F.lit, "abc")), ((F.col("conv_id") + F.col("turn")) % 3 + 1).cast("int"))
    return table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("task_id"), F.lit("shop").alias("workflow"), F.lit(1).alias("version"), key.alias("stage_key"), (F.col("turn") + 1).alias("actual_seq"), F.when(F.length("text") % 3 == 0, "failed").otherwise("succeeded").alias("status"))


@query(f"""
WITH s AS ({SHOP_SQL}), r(stage_key, required_key) AS (VALUES ('b', 'a'), ('c', 'a'), ('c', 'b')), m AS (SELECT task_id, stage_key AS required_key, min(actual_seq) AS met_at FROM s WHERE status = 'succeeded' GROUP BY ALL)
SELECT s.task_id, s.stage_key, r.required_key FROM s JOIN r ON s.stage_key = r.stage_key LEFT JOIN m ON m.task_id = s.task_id AND m.required_key = r.required_key WHERE met_at IS NULL OR met_at >= actual_seq""")
def precondition_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Preconditions of a declared workflow that no earlier stage meets"""
    own = shop_stages(spark, sf_dir)
    return A.precondition_check(own, Registry(SHOP).preconditions(spark))


@query(f"SELECT coalesce(bool_or(no_go), false) AS no_go FROM ({C.ORACLE['audit_monitoring']})")
def rollout_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Any failed condition blocks the schedule"""
    return A.no_go(C.audit_monitoring(spark, sf_dir))


class Lines:
    """A resolver that counts, as an object."""

    def details(self, stages: DataFrame) -> DataFrame:
        return stages.groupBy("task_id").agg(F.count("*").alias("n")).select(F.lit("lines").alias("module"), "task_id", "n")


@query(f"WITH s AS (SELECT *, CASE WHEN actual_seq % 2 = 0 THEN 'lines' ELSE 'last' END AS module FROM ({C.STAGES_SQL})) SELECT module, task_id, CAST(CASE WHEN module = 'lines' THEN count(*) ELSE max(actual_seq) END AS BIGINT) AS n FROM s GROUP BY module, task_id")
def stage_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each module resolves the details of its own stages"""
    own = C.stages(spark, sf_dir).withColumn("module", F.when(F.col("actual_seq") % 2 == 0, "lines").otherwise("last"))
    last = lambda s: s.groupBy("task_id").agg(F.max("actual_seq").cast("long").alias("n")).select(F.lit("last").alias("module"), "task_id", "n")
    found = V.resolve(own, {"lines": Lines(), "last": last})
    return found["lines"].unionByName(found["last"])


@query("SELECT event_type, count(*) AS n, CAST((SELECT count(*) FROM events WHERE event_id % 3 > 0) AS BIGINT) AS first_run, CAST((SELECT count(*) FROM events WHERE event_id % 3 = 0) AS BIGINT) AS second_run, CAST(0 AS BIGINT) AS third_run, true AS refused FROM events GROUP BY event_type")
def one_shot_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs over a folder; the second's files repeat rows of the first, the third finds none new; one that
    comes while another runs is refused"""
    e, folder = table(spark, sf_dir, "events").select("event_id", "event_type", "value"), folder_of(spark, "ingest")
    added = []
    for part in (e.where("event_id % 3 > 0"), e.where("event_id % 3 = 0 OR event_id % 5 = 0"), None):
        if part is not None:
            part.write.mode("append").parquet(f"{folder}/new")
        added.append(ingest(spark, f"{folder}/new", "event_id long, event_type string, value double", f"{folder}/all", f"{folder}/state", "event_id"))
    with RunLock(spark, f"{folder}/state.lock"):
        try:
            refused = ingest(spark, f"{folder}/new", "event_id long", f"{folder}/all", f"{folder}/state", "event_id") < 0
        except Locked:
            refused = True
    return spark.read.parquet(f"{folder}/all").groupBy("event_type").agg(F.count("*").alias("n")).select("*", F.lit(refused).alias("refused"), *(F.lit(n).cast("long").alias(k) for n, k in zip(added, ("first_run", "second_run", "third_run"))))

"""Line-by-line review of spoken episodes: records, listening queue, fix plan, summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sonalyze.functions import speech as S

RECORD = ["line_id", "speaker", "tts_text", "asr_text", "language", "emotion", "event", "planned_emotion", "expected_emotion_group", "cer", "flags", "priority", "decision"]
QUEUE = ["line_id", "speaker", "tts_text", "asr_text", "language", "emotion", "planned_emotion", "expected_emotion_group", "cer", "flags", "priority", "decision_status", "decision_reason"]
MISSING, FAILED = "missing_audio", "assessment_error"
NOTE = "自动结果只用于路由人工复听和提出局部建议，不单独决定通过。"


def review(lines: DataFrame, threshold: float = S.CER_THRESHOLD) -> DataFrame:
    """The columns of lines and a record for each line.

    lines has line_id, speaker, tts_text, raw_output, planned_emotion and unavailable: null where the line was
    recognized (raw_output null then counts as empty), else the reason why it could not be, which becomes its
    only flag. A line without audio or result is never dropped.
    """
    heard = F.col("unavailable").isNull()
    tags = S.tags(F.coalesce("raw_output", F.lit("")))
    # normalized texts are made once a line: a generator keeps them from being folded into what reads them
    made = lines.withColumn("tags", tags).select("*", F.explode(F.array(F.struct(S.normalize(F.coalesce("tts_text", F.lit(""))).alias("a"), S.normalize(F.col("tags.transcript")).alias("b")))).alias("norm"))
    made = made.withColumn("rate", F.when(heard, S.error_rate_of_normalized(F.col("norm.a"), F.col("norm.b"))))
    group = S.expected_emotions(F.col("planned_emotion"))
    made = made.withColumn("expected_emotion_group", group)
    off = (F.size("expected_emotion_group") > 0) & ~F.coalesce(F.array_contains("expected_emotion_group", F.col("tags.emotion")), F.lit(False))
    flags = F.array_compact(F.array(F.when(F.col("rate") > threshold, F.lit("asr_mismatch")), F.when(off, F.lit("emotion_mismatch"))))
    made = made.withColumn("flags", F.when(heard, flags).otherwise(F.array("unavailable")))
    points = lambda flag, n: F.when(F.array_contains("flags", flag), n).otherwise(0)
    priority = F.when(heard, points("asr_mismatch", S.ASR_POINTS) + points("emotion_mismatch", S.EMOTION_POINTS)).otherwise(S.UNAVAILABLE_POINTS)
    flagged = F.size("flags") > 0
    decision = F.struct(F.when(flagged, "needs_human").otherwise("pass").alias("status"), F.when(flagged, F.array_join("flags", "; ")).otherwise("asr_and_emotion_check_pass").alias("reason"))
    if_heard = lambda name: F.when(heard, F.col(f"tags.{name}"))
    made = made.withColumns({"asr_text": if_heard("transcript"), "language": if_heard("language"), "emotion": if_heard("emotion"), "event": if_heard("event"), "cer": S.rounded(F.col("rate")), "priority": priority.cast("int"), "decision": decision})
    others = [c for c in lines.columns if c not in RECORD]
    return made.select(*others, *RECORD)


def attach_audio(turns: DataFrame, files: DataFrame, episode: list[str], parts: int | None = None) -> DataFrame:
    """turns with file_name and unavailable: missing_audio where files (episode, file_name) has no such file. parts: how many
    partitions they come in, whatever their size."""
    named = turns.withColumn("file_name", part_name(F.col("line_id"), F.col("speaker")))
    if parts:
        named = named.repartition(parts, *episode, "file_name")
    there = files.select(*episode, "file_name").distinct().withColumn("there", F.lit(True))
    return named.join(there, [*episode, "file_name"], "left").withColumn("unavailable", F.when(F.col("there").isNull(), F.lit(MISSING))).drop("there")


def part_name(line_id: Column, speaker: Column) -> Column:
    """At least two digits, never cut."""
    return F.format_string("%02d_%s.mp3", line_id, speaker)


def run_id(stem: Column, round_number: int) -> Column:
    return F.format_string("%s_round%d", stem, F.lit(round_number))


def listening_queue(records: DataFrame, by: list[str] | None = None, ordered: bool = True) -> DataFrame:
    """Records as flat rows, the most urgent first, if ordered; equal ones in the order of their lines."""
    by = by or []
    rows = records.select(*by, *queue_columns())
    return rows.orderBy(*by, F.desc("priority"), "line_id") if ordered else rows


def queue_columns() -> list[Column]:
    """Of a record, in the listening queue."""
    made = {"expected_emotion_group": F.array_join("expected_emotion_group", ";"), "flags": F.array_join("flags", ";"), "decision_status": F.col("decision.status"), "decision_reason": F.col("decision.reason")}
    return [made.get(c, F.col(c)).alias(c) for c in QUEUE]


def fix_items(records: DataFrame, by: list[str] | None = None) -> DataFrame:
    """A row for each flagged line, with evidence and advice."""
    return records.where(F.size("flags") > 0).select(*(by or []), *item_columns())


def item_columns() -> list[Column]:
    """Of a flagged record, in a fix plan."""
    evidence = F.struct("tts_text", "asr_text", "cer", "planned_emotion", F.col("emotion").alias("detected_emotion"))
    return [F.col("line_id"), F.col("speaker"), F.col("flags").alias("problem"), evidence.alias("evidence"), S.suggested_actions(F.col("flags")).alias("actions"), F.lit(0).alias("retry"), F.lit("needs_human_review").alias("status")]


def fix_plans(records: DataFrame, by: list[str], round_number: int) -> DataFrame:
    """One nested plan for each episode, also where nothing is flagged. by: the columns that name an episode,
    among them request_json. An episode's lines meet in one row, as its file is one document."""
    item = F.struct("line_id", "speaker", "problem", "evidence", "actions", "retry", "status")
    items = fix_items(records, by).groupBy(*by).agg(F.sort_array(F.collect_list(item)).alias("items"))
    empty = F.array().cast(items.schema["items"].dataType)
    all_ = records.select(*by).distinct().join(items, by, "left").withColumn("items", F.coalesce("items", empty))
    return all_.select(*by, F.lit(round_number).alias("round"), F.size("items").alias("review_required"), "items", F.lit(NOTE).alias("note"))


def summaries(records: DataFrame, by: list[str]) -> DataFrame:
    """How many lines each episode has, and how many need review."""
    return records.groupBy(*by).agg(F.count("*").alias("lines"), F.count_if(F.size("flags") > 0).alias("review_required"))


def raw_records(records: DataFrame, stem: Column, round_number: int, detector: dict[str, str]) -> DataFrame:
    """What the detector said of each line: records with audio_path, raw_output and error."""
    return records.select(*raw_columns(stem, round_number, detector))


def raw_columns(stem: Column, round_number: int, detector: dict[str, str]) -> list[Column]:
    """Of a record, in the raw records."""
    found = F.struct(*(F.lit(v).alias(k) for k, v in detector.items()), F.col("raw_output"), F.col("error"))
    planned = F.col("planned_emotion")
    cues = F.when(planned.isNull() | (planned == ""), F.array().cast("array<string>")).otherwise(F.array(planned))
    return [run_id(stem, round_number).alias("run_id"), *map(F.col, ("line_id", "speaker", "audio_path", "tts_text")), cues.alias("planned_cues"), F.col("expected_emotion_group"), F.array(found).alias("detectors"), F.col("decision")]

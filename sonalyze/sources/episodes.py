"""Episodes on disk: request files and line audio in, raw records, listening queue and fix plan out."""

from __future__ import annotations

import csv
import io
import json
import re
from collections.abc import Iterable
from itertools import groupby

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sonalyze.functions.detectors import Detector, default_device, detect, funasr_model
from sonalyze.functions.speech import CER_THRESHOLD
from sonalyze.operators import review as R
from sonalyze.shared import listed
from sonalyze.sources.files import PARTS, TEXTS, in_batches, list_audio, read_files, write_files

# Names of the files of an episode, and the speaker of a turn that names none.
REQUEST, RAW = ".minimax-request.json", ".emotion_raw.jsonl"
UNKNOWN_SPEAKER = "未知"


def plain(uri: str | Column) -> str | Column:
    """Local files by their path alone; others keep their address."""
    if isinstance(uri, str):
        return re.sub(r"^file:/+", "/", uri)
    return F.when(uri.startswith("file:"), F.regexp_replace(F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B"))), "^file:/+", "/")).otherwise(uri)


def requests(spark: SparkSession, path: str) -> DataFrame:
    """request_json, stem, folder, body: whole request files. The body is a variant, so one odd value leaves
    the rest readable; it is null where the file is no JSON."""
    at = plain(F.col("_metadata.file_path"))
    with listed(spark):
        found = spark.read.text(path, wholetext=True)
    # many small files a task, however few Spark packs
    found = found.coalesce(tasks(spark))
    return named(found.select(at.alias("request_json"), "value"))


def requests_below(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """As requests(), of the files below folder whose place there matches pattern (files.TextFiles). Tasks list and read them,
    so that many small files cost the driver nothing."""
    return named(read_files(spark, folder, pattern).withColumnRenamed("path", "request_json"))


def named(files: DataFrame) -> DataFrame:
    """request_json, stem, folder, body of files (request_json, value)."""
    # a body is parsed once: a generator keeps it from being folded into what reads it
    rows = files.select("request_json", F.explode(F.array(F.expr("try_parse_json(value)"))).alias("body"))
    name = F.element_at(F.split("request_json", "/"), -1)
    stem = F.when(name.endswith(REQUEST), F.substring(name, F.lit(1), F.length(name) - len(REQUEST)))
    return rows.select("request_json", stem.alias("stem"), F.regexp_replace("request_json", "[^/]*$", "").alias("folder"), "body")


def refusal() -> Column:
    """Why a request (its body and stem) can't be reviewed, the first that is checked; null where it can."""
    kind = F.expr("schema_of_variant(try_variant_get(body, '$.turns', 'variant'))")
    return F.when(F.col("body").isNull(), "not_json").when(~F.coalesce(kind.startswith("ARRAY"), F.lit(False)) | (F.expr("try_variant_get(body, '$.turns[0]', 'variant')").isNull()), "no_turns").when(F.col("stem").isNull(), "bad_suffix")


def reject(found: DataFrame) -> DataFrame:
    """request_json and reason of requests that can't be reviewed, in the order in which they are checked."""
    return found.select("request_json", refusal().alias("reason")).where("reason is not null")


def as_text(field: str, default: str) -> Column:
    """A field as text: default where it is absent, None where it is null, True and False where boolean."""
    value = F.expr(f"try_variant_get(turn, '$.{field}', 'variant')")
    text = F.expr(f"try_variant_get(turn, '$.{field}', 'string')")
    boolean = F.expr(f"schema_of_variant(try_variant_get(turn, '$.{field}', 'variant'))") == "BOOLEAN"
    return F.when(value.isNull(), F.lit(default)).when(F.is_variant_null(value), F.lit("None")).when(boolean, F.initcap(text)).otherwise(F.coalesce(text, F.to_json(value)))


def turns(found: DataFrame) -> DataFrame:
    """A row for each turn, numbered from 1: request_json, stem, folder, line_id, speaker, tts_text,
    planned_emotion. A turn that is no object, and an emotion that is no string, raise no error here: the
    first has the defaults, the second plans nothing."""
    good = found.where(refusal().isNull())  # files are read once
    exploded = good.lateralJoin(found.sparkSession.tvf.variant_explode(F.try_variant_get(F.col("body").outer(), "$.turns", "variant"))).select("request_json", "stem", "folder", "pos", F.col("value").alias("turn"))
    emotion = F.expr("try_variant_get(turn, '$.voice_setting.emotion', 'variant')")
    is_text = F.schema_of_variant(emotion) == "STRING"
    return exploded.select("request_json", "stem", "folder", (F.col("pos") + 1).cast("int").alias("line_id"), as_text("speaker", UNKNOWN_SPEAKER).alias("speaker"), as_text("text", "").alias("tts_text"), F.when(is_text, F.expr("try_variant_get(turn, '$.voice_setting.emotion', 'string')")).alias("planned_emotion"))


def audio_parts(spark: SparkSession, folder: str) -> DataFrame:
    """folder, stem, file_name of the line audio below a folder, empty files too, as a file that is there is no missing one.
    Tasks list the folders (files.LineAudio); contents are not read."""
    return list_audio(spark, folder)


def tasks(spark: SparkSession) -> int:
    """How many tasks costly work on short rows is dealt to: as few bytes of them take long, their size doesn't tell."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)


def review_episodes(spark: SparkSession, found: DataFrame, files: DataFrame, detector: Detector, threshold: float = CER_THRESHOLD) -> DataFrame:
    """The records of all episodes of found (requests()) at once, with audio of files (audio_parts())."""
    lines = R.attach_audio(turns(found), files, ["folder", "stem"], tasks(found.sparkSession))
    lines = lines.withColumn("audio_path", F.concat("folder", "stem", F.lit(f"{PARTS}/"), "file_name"))
    return R.review(detect(lines, detector), threshold)


def review_episode(spark: SparkSession, request: str, detector: Detector | None = None, round_number: int = 1, threshold: float = CER_THRESHOLD) -> dict[str, str | int]:
    """Review one episode and write its three files beside the request. Its request, turns, name and audio
    folder are checked, in this order, before any model is loaded. An episode is small: its files are written
    by the driver, through the file system of the request."""
    found = requests(spark, request)
    bad = {r["reason"] for r in reject(found).collect()}
    if bad:
        raise ValueError(f"{request}: {bad.pop()}")
    place = spark._jvm.org.apache.hadoop.fs.Path(request)
    fs = place.getFileSystem(spark._jsc.hadoopConfiguration())
    folder, name = str(fs.makeQualified(place).getParent()), place.getName()
    stem = name[: -len(REQUEST)]
    parts = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{stem}{PARTS}")
    if not (fs.exists(parts) and fs.getFileStatus(parts).isDirectory()):
        raise FileNotFoundError(f"no folder of line audio: {parts}")
    detector = detector or Detector(funasr_model, device=default_device())
    names = [(stem, s.getPath().getName()) for s in fs.listStatus(parts) if s.isFile()]
    files = spark.createDataFrame(names, "stem string, file_name string")
    lines = R.attach_audio(turns(found), files, ["stem"]).withColumn("audio_path", F.concat(F.lit(plain(f"{parts}/")), "file_name"))
    records = R.review(detect(lines, detector), threshold).cache()
    raw = R.raw_records(records, F.col("stem"), round_number, detector.provenance).orderBy("line_id")
    queue = R.listening_queue(records)
    [plan] = R.fix_plans(records, ["request_json"], round_number).collect()
    out = {"raw_path": f"{folder}/{stem}{RAW}", "review_path": f"{folder}/{stem}.review_round{round_number}.csv", "fix_plan_path": f"{folder}/{stem}.fix_plan_round{round_number}.json"}
    put(spark, out["raw_path"], jsonl(raw))
    put(spark, out["review_path"], queue_csv(queue))
    put(spark, out["fix_plan_path"], json.dumps(plan.asDict(recursive=True), ensure_ascii=False, indent=2))
    records.unpersist()
    return {k: plain(v) for k, v in out.items()} | {"review_required": plan["review_required"]}


def jsonl(rows: DataFrame) -> str:
    """A line of JSON for each row, nulls kept, other scripts not escaped."""
    return "".join(json.dumps(r.asDict(recursive=True), ensure_ascii=False) + "\n" for r in rows.toLocalIterator())


def queue_csv(queue: DataFrame) -> str:
    """The queue as CSV for spreadsheets: a byte order mark, CRLF, a header, quotes where needed, null empty."""
    return csv_text(queue.columns, queue.toLocalIterator())


def csv_text(header: list[str], rows: Iterable) -> str:
    out = io.StringIO(newline="")
    writer = csv.writer(out)
    writer.writerow(header)
    writer.writerows(rows)
    return "\ufeff" + out.getvalue()


def put(spark: SparkSession, path: str, text: str) -> None:
    """Write text to a file, over any before."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = place.getFileSystem(spark._jsc.hadoopConfiguration()).create(place, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def episode_files(records: DataFrame, round_number: int, detector: dict[str, str]) -> DataFrame:
    """path and value of the three files of each episode of records (request_json, folder, stem, ...), as review_episode()
    writes them. Records are made once; an episode's go through one task, line by line, as each of its files is one document."""
    by = ["folder", "stem"]
    whole = lambda columns: F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    item = F.when(F.size("flags") > 0, whole(R.item_columns()))
    lines = records.select(*by, "request_json", "line_id", whole(R.raw_columns(F.col("stem"), round_number, detector)).alias("raw"), whole(R.queue_columns()).alias("queue"), item.alias("item"))
    return lines.repartition(tasks(records.sparkSession), *by).sortWithinPartitions(*by, "line_id").drop("line_id").mapInArrow(_files_of(round_number), "path string, value string")


def _files_of(round_number: int):
    def files(at: str, lines: list[tuple]) -> list[tuple[str, str]]:
        raw, queue, items = ([json.loads(x[k]) for x in lines if x[k] is not None] for k in (3, 4, 5))
        queue.sort(key=lambda r: (-r["priority"], r["line_id"]))
        plan = {"request_json": lines[0][2], "round": round_number, "review_required": len(items), "items": items, "note": R.NOTE}
        values = ["".join(json.dumps(r, ensure_ascii=False) + "\n" for r in raw), csv_text(list(queue[0]), [r.values() for r in queue]), json.dumps(plan, ensure_ascii=False, indent=2)]
        return list(zip((f"{at}{RAW}", f"{at}.review_round{round_number}.csv", f"{at}.fix_plan_round{round_number}.json"), values))

    def run(batches):
        rows = (row for b in batches for row in zip(*(c.to_pylist() for c in b.columns)))
        return in_batches((f for (folder, stem), own in groupby(rows, lambda r: r[:2]) for f in files(f"{folder}{stem}", list(own))), TEXTS)

    return run


def write_episodes(records: DataFrame, round_number: int, detector: dict[str, str], folder: str) -> None:
    """The three files of every episode, beside its request, written by tasks; folder: where the mark of the job is put."""
    write_files(episode_files(records, round_number, detector), folder)


def queues(files: DataFrame) -> DataFrame:
    """path, place and the columns of a queue, all text, for each row of its CSV files (path, value), whose rows are counted from 1.
    What is empty is null."""

    def run(batches):
        csv.field_size_limit(2**31 - 1)
        rows = ((path, place, *(row[c] or None for c in R.QUEUE)) for b in batches for path, text in zip(b["path"].to_pylist(), b["value"].to_pylist()) for place, row in enumerate(csv.DictReader(io.StringIO(text.removeprefix("\ufeff"), newline="")), 1))
        return in_batches(rows, columns)

    columns = {"path": "string", "place": "int64"} | dict.fromkeys(R.QUEUE, "string")
    return files.select("path", "value").mapInArrow(run, ", ".join(f"{c} {'long' if c == 'place' else k}" for c, k in columns.items()))


def write_raw(raw: DataFrame, path: str) -> None:
    """Raw records of many episodes, as a folder of JSON lines with nulls kept."""
    raw.write.mode("overwrite").option("ignoreNullFields", "false").json(path)

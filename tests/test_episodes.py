import csv
import json

import pytest

from sonalyze.functions.detectors import Detector, library_version
from sonalyze.operators import review as R
from sonalyze.sources import episodes as E

LINES = "line_id int, speaker string, tts_text string, raw_output string, planned_emotion string, unavailable string"


def records(spark, rows):
    return {r.line_id: r for r in R.review(spark.createDataFrame(rows, LINES)).collect()}


def test_records(spark):
    tag = lambda e, t: f"<|zh|><|{e}|><|Speech|><|withitn|>{t}"
    got = records(spark, [
        (12, "a", "哇，这棵树自己就是一片森林？", tag("NEUTRAL", "哇，这棵树就是森林"), "happy", None), (1, "a", "好。", tag("ANGRY", "好"), None, None),
        (2, "a", "abcdefghij", tag("SAD", "abcdefghiX"), "fearful", None), (3, "a", "ab", tag("HAPPY", "ab"), "fearful", None), (4, "a", "ab", "", "calm", None),
        (5, "a", "ab", None, "HAPPY", "missing_audio"), (6, "a", "", tag("HAPPY", ""), "unknown", None),
    ])
    assert got[12].priority == 160 and got[12].cer == 0.3333 and got[12].flags == ["asr_mismatch", "emotion_mismatch"] and got[12].decision.status == "needs_human" and got[12].decision.reason == "asr_mismatch; emotion_mismatch"
    assert (got[1].flags, got[1].priority, got[1].cer, got[1].decision.reason) == ([], 0, 0.0, "asr_and_emotion_check_pass")
    assert (got[2].flags, got[2].cer) == ([], 0.1)
    assert (got[3].flags, got[3].priority) == (["emotion_mismatch"], 60)
    assert (got[4].flags, got[4].cer, got[4].priority) == (["asr_mismatch", "emotion_mismatch"], 1.0, 160)
    assert (got[5].flags, got[5].priority, got[5].cer, got[5].asr_text, got[5].expected_emotion_group, got[5].decision.reason) == (["missing_audio"], 120, None, None, ["HAPPY", "SURPRISED"], "missing_audio")
    assert (got[6].flags, got[6].expected_emotion_group, got[6].cer) == ([], [], 0.0)
    queue = R.listening_queue(R.review(spark.createDataFrame([(i, "s", "ab", x, "happy", u) for i, (x, u) in enumerate([("<|z|><|SAD|>ab", None), ("x", None), ("<|z|><|HAPPY|>ab", None), (None, "missing_audio"), ("<|z|><|HAPPY|>", None), ("<|z|><|SAD|>ab", None)])], LINES)))
    assert [(r.line_id, r.priority) for r in queue.collect()] == [(1, 160), (3, 120), (4, 100), (0, 60), (5, 60), (2, 0)]


def episode(tmp_path, turns, parts, name="ep.minimax-request.json"):
    (tmp_path / name).write_text(turns if isinstance(turns, str) else json.dumps({"turns": turns}, ensure_ascii=False, indent=1), encoding="utf-8")
    if parts is not None:
        (tmp_path / "ep.line_parts").mkdir()
        for p in parts:
            (tmp_path / "ep.line_parts" / p).write_bytes(b"mp3")
    return str(tmp_path / name)


def fake(results):
    def load(model, device):
        def generate(path):
            found = results[path.rsplit("/", 1)[1][:2]]
            if isinstance(found, str) and found.startswith("!"):
                raise RuntimeError(found[1:])
            return [] if found is None else [{"text": found}]

        return generate

    return load


def test_episode_files(spark, tmp_path):
    turns = [{"speaker": "爸爸", "text": "你好。", "voice_setting": {"emotion": "calm"}}, {"speaker": "女儿", "text": "这是测试。", "voice_setting": {}}, {"text": "无", "voice_setting": "x"}, {"speaker": None, "text": None}, {"speaker": "爸爸", "text": "a,\"b\"\n", "voice_setting": {"emotion": 3}}]
    path = episode(tmp_path, turns, ["01_爸爸.mp3", "02_女儿.mp3", "04_None.mp3", "05_爸爸.mp3"])
    load = fake({"01": "<|zh|><|NEUTRAL|><|Speech|><|withitn|>你好", "02": "<|zh|><|HAPPY|><|Speech|><|withitn|>这是", "04": None, "05": "!broken mp3"})
    out = E.review_episode(spark, path, Detector(load, model="m1"), 2)
    assert out["review_required"] == 4
    raw = [json.loads(x) for x in (tmp_path / "ep.emotion_raw.jsonl").read_text(encoding="utf-8").splitlines()]
    assert [r["line_id"] for r in raw] == [1, 2, 3, 4, 5] and raw[0]["run_id"] == "ep_round2" and raw[0]["planned_cues"] == ["calm"]
    assert raw[0]["detectors"][0]["raw_output"].endswith("你好") and raw[0]["detectors"][0]["error"] is None and raw[0]["detectors"][0]["model"] == "m1"
    assert raw[0]["audio_path"] == f"{tmp_path}/ep.line_parts/01_爸爸.mp3"
    assert raw[2]["speaker"] == "未知" and raw[2]["decision"]["reason"] == "missing_audio" and raw[3]["tts_text"] == "None" and raw[3]["speaker"] == "None"
    assert raw[4]["detectors"][0]["error"] == "broken mp3" and raw[4]["decision"]["reason"] == "assessment_error"
    data = (tmp_path / "ep.review_round2.csv").read_bytes()
    assert data.startswith(b"\xef\xbb\xbfline_id,speaker") and b"\r\n" in data
    rows = list(csv.DictReader(data.decode("utf-8-sig").splitlines(keepends=True)))
    assert [r["line_id"] for r in rows] == ["3", "5", "2", "4", "1"] and rows[0]["cer"] == "" and rows[2]["cer"] == "0.5" and rows[1]["tts_text"].startswith('a,"b"')
    plan = json.loads((tmp_path / "ep.fix_plan_round2.json").read_text(encoding="utf-8"))
    assert list(plan) == ["request_json", "round", "review_required", "items", "note"] and [i["line_id"] for i in plan["items"]] == [2, 3, 4, 5]
    assert plan["items"][0]["actions"] and plan["items"][1]["actions"] == [] and plan["items"][0]["evidence"] == {"tts_text": "这是测试。", "asr_text": "这是", "cer": 0.5, "planned_emotion": None, "detected_emotion": "HAPPY"}


@pytest.mark.parametrize("turns, parts, name, error, message", [
    ("{", [], "ep.minimax-request.json", ValueError, "not_json"), ([], [], "ep.minimax-request.json", ValueError, "no_turns"), ("{\"turns\": \"x\"}", [], "ep.minimax-request.json", ValueError, "no_turns"),
    ([{}], [], "ep.json", ValueError, "bad_suffix"), ([{}], None, "ep.minimax-request.json", FileNotFoundError, "line_parts"),
])
def test_errors_come_before_the_model(spark, tmp_path, turns, parts, name, error, message):
    def load(model, device):
        raise AssertionError("loaded")

    with pytest.raises(error, match=message):
        E.review_episode(spark, episode(tmp_path, turns, parts, name), Detector(load))


def test_a_model_that_cannot_be_loaded_ends_the_job_and_writes_nothing(spark, tmp_path):
    def load(model, device):
        raise RuntimeError("no such library")

    with pytest.raises(Exception, match="no such library"):
        E.review_episode(spark, episode(tmp_path, [{"speaker": "a"}, {"speaker": "b"}], ["01_a.mp3"]), Detector(load))
    assert sorted(p.name for p in tmp_path.iterdir()) == ["ep.line_parts", "ep.minimax-request.json"]


def test_paths_are_plain_and_loaders_do_not_share_models(spark, tmp_path):
    path = episode(tmp_path, [{"speaker": "a b+%", "text": "你好"}], [])
    (tmp_path / "ep.line_parts" / "01_a b+%.mp3").write_bytes(b"")  # empty, but there
    one = E.review_episode(spark, path, Detector(fake({"01": "你好"})))
    assert one["raw_path"] == f"{tmp_path}/ep.emotion_raw.jsonl" and one["review_required"] == 0
    assert json.loads((tmp_path / "ep.fix_plan_round1.json").read_text(encoding="utf-8"))["request_json"] == path
    assert E.review_episode(spark, path, Detector(fake({"01": "再见"})))["review_required"] == 1
    assert json.loads((tmp_path / "ep.emotion_raw.jsonl").read_text(encoding="utf-8"))["detectors"][0]["funasr_version"] == library_version()
    assert [tuple(r) for r in E.audio_parts(spark, str(tmp_path)).collect()] == [(f"{tmp_path}/", "ep", "01_a b+%.mp3")]
    assert library_version("pyspark")[0].isdigit() and library_version("no such library") == "unknown"


def test_part_names_and_listing(spark, tmp_path):
    episode(tmp_path, [{}], ["01_a.mp3", "x.txt"])
    assert [(r.stem, r.file_name) for r in E.audio_parts(spark, str(tmp_path)).collect()] == [("ep", "01_a.mp3")]
    from pyspark.sql import functions as F

    assert spark.range(1).select(R.part_name(F.lit(100), F.lit("s"))).first()[0] == "100_s.mp3"


def test_all_episodes_are_written_as_one_is(spark, tmp_path):
    """Files written by tasks for many episodes are byte for byte those of review_episode()."""
    turns = [{"speaker": "爸爸", "text": "a,\"b\"\nc", "voice_setting": {"emotion": "calm"}}, {"speaker": "女儿", "text": "这是测试。"}, {"text": "无"}, {}]
    load = fake({"01": "<|zh|><|NEUTRAL|><|Speech|><|withitn|>你好", "02": "!broken, \"mp3\""})
    one, many = tmp_path / "one", tmp_path / "many"
    for place, names in ((one, ["ep"]), (many, ["ep", "other", "third"])):
        for name in names:
            (place / f"{name}.line_parts").mkdir(parents=True)
            (place / f"{name}.minimax-request.json").write_text(json.dumps({"turns": turns}), encoding="utf-8")
            for part in ("01_爸爸.mp3", "02_女儿.mp3"):
                (place / f"{name}.line_parts" / part).write_bytes(b"")
    detector = Detector(load, model="m1")
    E.review_episode(spark, str(one / "ep.minimax-request.json"), detector, 4)
    records = E.review_episodes(spark, E.requests(spark, f"{many}/*.json"), E.audio_parts(spark, str(many)), detector)
    E.write_episodes(records, 4, detector.provenance, str(tmp_path / "done"))
    assert json.loads((tmp_path / "done" / "_FILES").read_text()) == {"files": 9}
    for end in (".emotion_raw.jsonl", ".review_round4.csv", ".fix_plan_round4.json"):
        want = (one / f"ep{end}").read_bytes()
        assert (many / f"ep{end}").read_bytes() == want.replace(str(one).encode(), str(many).encode())
        assert (many / f"third{end}").exists()
    assert not [p for p in many.iterdir() if p.name.startswith(".")]


def test_files_by_tasks(spark, tmp_path):
    from sonalyze.sources.files import opened, write_files

    rows = spark.createDataFrame([("a/x.txt", "é"), ("b y.txt", None), (f"{tmp_path}/else/z", "1")], "path string, value string")
    for _ in range(2):  # over those before
        write_files(rows, f"file:{tmp_path}/out")
    assert (tmp_path / "out/a/x.txt").read_text() == "é" and (tmp_path / "out/b y.txt").read_text() == "" and (tmp_path / "else/z").read_text() == "1"
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == ["_FILES", "a", "b y.txt"]
    assert opened("file:///a/b/")[1:] == ("/a/b", "")
    with pytest.raises(Exception):
        write_files(rows.selectExpr("concat(path, '/', path, repeat('x', 300)) AS path", "value"), f"{tmp_path}/never")
    assert not (tmp_path / "never" / "_FILES").exists()


def test_batches_of_lines(spark, tmp_path):
    """A model that takes batches is asked for so many lines at once, and a batch that fails line by line; what it counts is in the text."""
    def load(model, device):
        def generate(paths):
            if "bad" in paths:
                raise RuntimeError("bad line")
            return [[{"text": f"{len(paths)} on {device}"}] for _ in paths]

        return generate

    from sonalyze.functions.detectors import OF_TASK, detect, task_device

    rows = spark.createDataFrame([(p, None if p else "missing_audio") for p in ["a", "b", "c", "", "d", "e", "f", "bad"]], "audio_path string, unavailable string").coalesce(1)
    got = [(r.raw_output, r.error, r.unavailable) for r in detect(rows, Detector(load, batch=5, device=OF_TASK)).collect()]
    assert got == [("5 on cpu", None, None)] * 3 + [(None, None, "missing_audio")] + [("5 on cpu", None, None)] * 2 + [("1 on cpu", None, None), (None, "bad line", "assessment_error")]
    from types import SimpleNamespace

    assert task_device({}) == "cpu" and task_device({"gpu": SimpleNamespace(addresses=["2", "3"])}) == "cuda:2"


def test_a_call_that_takes_too_long_is_a_failure_of_its_line(spark):
    def load(model, device):
        import time

        return lambda path: time.sleep(3 if path == "slow" else 0) or [{"text": "x"}]

    from sonalyze.functions.detectors import detect

    rows = spark.createDataFrame([("slow", None), ("fast", None)], "audio_path string, unavailable string").coalesce(1)
    got = {r.audio_path: (r.raw_output, r.error, r.unavailable) for r in detect(rows, Detector(load, seconds=0.5)).collect()}
    assert got == {"slow": (None, "no result within 0.5 s", "assessment_error"), "fast": ("x", None, None)}


def test_many_requests_are_listed_by_few_tasks_and_read_once(spark, tmp_path):
    body = json.dumps({"turns": [{"speaker": "a", "text": "x"}]})
    for i in range(80):
        (tmp_path / f"e{i}{E.REQUEST}").write_text(body if i % 2 else "{")
    spark.sparkContext.setJobGroup("listing", "")
    found = E.requests(spark, f"{tmp_path}/*.json")
    spark.sparkContext.setJobGroup("", "")
    status = spark.sparkContext.statusTracker()
    tasks = sum(status.getStageInfo(s).numTasks for j in status.getJobIdsForGroup("listing") for s in status.getJobInfo(j).stageIds)
    assert 0 < tasks <= 16
    turns = E.turns(found)
    assert turns.count() == 40 and turns._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 1


def conversations(spark, folder, rows):
    """A folder of test tables with this one, and what episode_files and its SQL make of it."""
    import duckdb

    from sonalyze.plans import file_queries
    from sonalyze.plans.catalogue import ORACLE

    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{folder}/conversations.parquet")
    found = file_queries.episode_files(spark, str(folder))
    with duckdb.connect() as db:
        db.sql(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{folder}/conversations.parquet/*.parquet')")
        want = db.sql(f"SELECT {', '.join(found.columns)} FROM ({ORACLE['episode_files']})").fetchall()
    return found, want


def test_a_line_that_passes_has_no_flags_in_its_file(spark, tmp_path):
    """A line read back from a listening queue has empty flags, not null, where it has none."""
    found, want = conversations(spark, tmp_path, [(1, 0, "user", "第1句"), (1, 1, "user", "Bonjour, a \"b\"\nc"), (1, 2, "assistant", "")])
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(want, key=repr)
    assert {r.line_id: (r.flags, r.planned, r.place) for r in found.collect()} == {1: ("", False, 3), 2: ("asr_mismatch", True, 1), 3: ("asr_mismatch", True, 2)}


def test_many_episodes_are_reviewed_once_and_read_back_by_few_tasks(spark, tmp_path):
    spark.sparkContext.setJobGroup("files", "")
    found, want = conversations(spark, tmp_path, [(i, t, "user", "a line that is long enough") for i in range(120) for t in range(3)])
    got = sorted(map(tuple, found.collect()), key=repr)
    spark.sparkContext.setJobGroup("", "")
    assert got == sorted(want, key=repr) and len(got) == 360
    status = spark.sparkContext.statusTracker()
    stages = [status.getStageInfo(s) for j in status.getJobIdsForGroup("files") for s in status.getJobInfo(j).stageIds]
    assert 0 < max(s.numTasks for s in stages if s) <= 16
    (tmp_path / f"e{E.REQUEST}").write_text(json.dumps({"turns": [{"speaker": "a", "text": "x"}]}))
    records = E.review_episodes(spark, E.requests(spark, f"{tmp_path}/*.json"), E.audio_parts(spark, str(tmp_path)), Detector(fake({})))
    plan = E.episode_files(records, 1, {})._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInPandas") == 1


def test_requests_are_listed_and_read_by_tasks(spark, tmp_path):
    """The same rows as by Spark's reader, from one folder or from many."""
    for i in range(7):
        (tmp_path / "many" / f"d{i % 3}" / "ep.line_parts").mkdir(parents=True, exist_ok=True)
        (tmp_path / "flat").mkdir(exist_ok=True)
        for place in (tmp_path / "flat", tmp_path / "many" / f"d{i % 3}"):
            (place / f"é {i}{E.REQUEST if i else '.json'}").write_text(json.dumps({"turns": [{"speaker": "a", "text": f"x{i}\n"}]}) if i < 5 else "{", encoding="utf-8")
            (place / f"{i}.txt").write_text("no request")
            (place / f"bytes{E.REQUEST}").write_bytes(b'{"turns": [{"text": "\xff\xe9"}]}')
            (place / f".draft{E.REQUEST}").write_text("{")
    for folder, pattern in (("flat", "*.json"), ("many", "*/*.json")):
        mine, theirs = E.requests_below(spark, f"{tmp_path}/{folder}", pattern), E.requests(spark, f"{tmp_path}/{folder}/{pattern}")
        for of in (E.turns, E.reject):
            assert sorted(map(tuple, of(mine).collect())) == sorted(map(tuple, of(theirs).collect())) != []
        assert mine.count() == (8 if folder == "flat" else 10)
    assert E.requests_below(spark, f"{tmp_path}/many", "d0/*3*.json").count() == 1

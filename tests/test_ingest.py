"""One-shot ingestion: keyed state, batches that come again, and runs that are refused."""

import threading
import time

import pytest

from sonalyze.streaming.ingest import Locked, RunLock, ingest

SCHEMA = "id long, v string"


def runs(spark, tmp_path):
    return lambda: ingest(spark, str(tmp_path / "new"), SCHEMA, str(tmp_path / "all"), str(tmp_path / "state"), "id")


def put(spark, tmp_path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "new"))


def test_keys_are_added_once_and_target_is_not_read(spark, tmp_path):
    run = runs(spark, tmp_path)
    put(spark, tmp_path, [(1, "a"), (2, "b"), (1, "a"), (None, "n")])
    assert run() == 3
    put(spark, tmp_path, [(2, "late"), (3, "c"), (None, "again")])
    for part in (tmp_path / "all").glob("batch=0/*.parquet"):
        part.write_bytes(b"not read")  # a run doesn't read what earlier ones wrote
    assert run() == 1 and run() == 0
    assert [tuple(r) for r in spark.read.schema(SCHEMA).parquet(str(tmp_path / "all/batch=1")).collect()] == [(3, "c")]
    assert not (tmp_path / "state.lock").exists()


def test_two_runs_at_once_one_is_refused(spark, tmp_path):
    run = runs(spark, tmp_path)
    put(spark, tmp_path, [(1, "a")])
    with RunLock(spark, str(tmp_path / "state.lock")):
        with pytest.raises(Locked):
            run()
        assert not (tmp_path / "all").exists()
    assert run() == 1

    got = []

    def take():
        try:
            with RunLock(spark, str(tmp_path / "race.lock")):
                got.append("held")
                time.sleep(1)
        except Locked:
            got.append("refused")

    threads = [threading.Thread(target=take) for _ in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(got) == ["held", "refused", "refused", "refused"]


def test_a_lock_of_a_dead_run_can_be_taken(spark, tmp_path):
    path = str(tmp_path / "x.lock")
    dead = RunLock(spark, path).__enter__()
    with pytest.raises(Locked):
        RunLock(spark, path).__enter__()
    time.sleep(1.1)
    with RunLock(spark, path, stale=1) as taken:
        assert taken.holder() == taken.owner
        dead.__exit__(None, None, None)  # the dead one's end takes nothing away
        assert taken.holder() == taken.owner
    assert taken.holder() is None


def test_a_failed_run_gives_the_lock_back(spark, tmp_path):
    with pytest.raises(Exception):
        ingest(spark, str(tmp_path / "new"), "id long, v string, bad", str(tmp_path / "all"), str(tmp_path / "state"), "id")
    assert not (tmp_path / "state.lock").exists()

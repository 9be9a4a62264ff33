import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sonalyze.llm.shared import cut, discard, freed, scratch, stored
from sonalyze.llm.sketch import Blocks, Places, Sketch


def numbers():
    def keys(column: pa.Array) -> np.ndarray:  # workers don't have this module
        return np.array([int(x) for t in column.to_pylist() for x in (t or "").split()], np.uint64)

    return keys


@pytest.mark.parametrize("rows, most", [(1, 0.45), (2, 0.2)])
def test_repeated_keys_are_all_found_and_others_as_seldom_at_any_size(spark, rows, most):
    keys = numbers()
    for n in (2_000, 40_000):
        docs = [(i, " ".join(str(x) for x in [*range(i * 20, i * 20 + 20), *([n + i // 2] if i % 10 < 2 else [])])) for i in range(n // 20)]
        docs += [(n, None), (None, ""), (None, str(5 * n)), (7, str(5 * n))]
        blocks = Blocks(spark.createDataFrame(docs, "doc_id long, text string"), 1, 1)
        sketch = Sketch(blocks, keys, n, rows=rows)

        def heard(key, table, answers):
            found = keys(blocks.distinct(table)[1])
            return pa.table({"key": found.astype(np.int64), "level": sketch.heard(answers).level(found).astype(np.int64)})

        got = blocks.grouped().cogroup(sketch.answers().groupBy("block")).applyInArrow(heard, "key long, level long").collect()
        once = [r.level for r in got if r.key < n]
        assert len(once) == n and all(r.level for r in got if r.key >= n)
        assert 0.02 < np.mean(np.array(once) > 0) < most


def test_a_counted_sketch_never_counts_too_few(spark):
    keys = numbers()
    rng = np.random.default_rng(3)
    words = rng.zipf(1.4, 6000) % 500
    docs = [(i, " ".join(map(str, words[i * 20 : i * 20 + 20]))) for i in range(300)]
    blocks = Blocks(spark.createDataFrame(docs, "doc_id long, text string"), 1, 1)
    sketch = Sketch(blocks, None, 6000, least=2)

    def ask(key, table):
        found = keys(blocks.distinct(table)[1])
        return sketch.ask(key[0].as_py(), found, found % np.uint64(2) == 0)  # odd keys are asked about, and don't count

    def heard(key, table, answers):
        found = np.unique(keys(blocks.distinct(table)[1]))
        return pa.table({"key": found.astype(np.int64), "level": sketch.heard(answers).level(found).astype(np.int64)})

    asked = blocks.grouped().applyInArrow(ask, "range long, block int, cells binary, times binary")
    got = blocks.grouped().cogroup(sketch.answers(asked).groupBy("block")).applyInArrow(heard, "key long, level long").distinct().collect()
    true = {k: int((words == k).sum()) for k in range(0, 500, 2)}
    assert all(r.level >= int(np.log2(true[r.key])) for r in got if r.key % 2 == 0 and true[r.key] >= 4)
    assert np.mean([r.level > 0 for r in got if r.key % 2]) < 0.2


def test_places():
    values = np.array([2**63 + 5, 3, 2**64 - 1], np.uint64)
    assert Places(values).of(np.array([3, 4, 2**64 - 1, 2**63 + 5, 2**63 + 6], np.uint64)).tolist() == [1, -1, 2, 0, -1]
    assert Places(values[:0]).of(values).tolist() == [-1] * 3 and Places(values).of(values[:0]).tolist() == []


def test_tables_are_discarded_and_shuffles_freed(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    table = stored(spark.range(100).repartition(3, "id"), "own")
    path = table.inputFiles()[0].rsplit("/", 1)[0]
    fs = spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    assert table.count() == 100 and cut(table.groupBy(F.col("id") % 7).count()).count() == 7
    discard(table)
    assert not fs.exists(spark._jvm.org.apache.hadoop.fs.Path(path)) and spark.conf.get(key) == before
    with pytest.raises(ZeroDivisionError), freed(spark):
        assert spark.conf.get(key) == "true"
        1 / 0
    assert spark.conf.get(key) == before


def test_a_cluster_without_a_shared_folder_is_an_error():
    class Conf:
        def get(self, key, default):
            return default

    class Context:
        master, getCheckpointDir = "spark://host:7077", staticmethod(lambda: None)

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch(Session(), "x")

import json
import os

import pytest

from telar.sources.upsert import FolderTransport, UnknownColumn, UpsertSink


class Failing(FolderTransport):
    """Refuses for good what holds key 13, for once what holds key 7, and does not know ``extra``."""

    def __init__(self, options):
        super().__init__(options)
        self.once = True

    def upsert(self, rows, keys, token):
        if "extra" in rows[0]:
            raise UnknownColumn("extra")
        ids = {r["id"] for r in rows}
        if 13 in ids:
            raise OSError("full")
        if 7 in ids and self.once:
            self.once = False
            raise OSError("busy")
        super().upsert(rows, keys, token)


class Dies(FolderTransport):
    """The first attempt of a task sends its first batch and dies; the next one does not."""

    def upsert(self, rows, keys, token):
        super().upsert(rows, keys, token)
        if self.fs.get_file_info(f"{self.path}/died").type.name == "NotFound":
            self._put("died", "")
            raise AttributeError("lost")


def sent(spark, df, folder, name, **options):
    spark.dataSource.register(UpsertSink)
    w = df.write.format("upsert").option("transport", f"tests.test_upsert:{name}").option("folder", f"file://{folder}").option("pause", 0)
    for k, v in options.items():
        w = w.option(k, v)
    w.mode("append").save()
    rows = [json.loads(line) for f in sorted(os.listdir(folder)) if f.endswith(".json") for line in open(f"{folder}/{f}")]
    return rows, json.load(open(f"{folder}/_summary"))


def test_failed_batches_are_counted_and_skipped(spark, tmp_path):
    df = spark.range(40).selectExpr("id", "id * 2 AS v", "'x' AS extra").repartitionByRange(2, "id").sortWithinPartitions("id")
    rows, n = sent(spark, df, tmp_path / "t", "Failing", size=5)
    lost = set(range(40)) - {r["id"] for r in rows}
    assert 13 in lost
    assert len(lost) == 5
    assert len(rows) == 35
    assert all(set(r) == {"id", "v"} and r["v"] == 2 * r["id"] for r in rows)
    assert (n["outcome"], n["rows"], n["failed_batches"], n["failed_rows"], n["retries"]) == ("committed", 35, 1, 5, 3)
    assert n["failures"] == [{"first": [min(lost)], "last": [max(lost)], "error": "OSError: full"}]
    assert n["batches"] == 8


def test_composite_keys_and_all_taken(spark, tmp_path):
    df = spark.createDataFrame([(1, 0, "a"), (1, 1, None)], "id long, n long, t string").coalesce(1)
    rows, n = sent(spark, df, tmp_path / "t", "Failing", keys="id,n")
    assert rows == [{"id": 1, "n": 0, "t": "a"}, {"id": 1, "n": 1, "t": None}]
    assert (n["batches"], n["failures"]) == (1, [])
    _, n = sent(spark, df.limit(0), tmp_path / "e", "Failing")
    assert n["rows"] == 0


def test_a_task_that_runs_again_writes_nothing_twice(spark, tmp_path):
    from telar.sources.upsert import UpsertWriter

    options = {"transport": "tests.test_upsert:Dies", "folder": f"file://{tmp_path}/t", "size": "2", "pause": "0"}
    rows = spark.range(5).coalesce(1).collect()
    writer = UpsertWriter(options, ["id"])

    class Context:
        @staticmethod
        def get():
            return Context

        @staticmethod
        def partitionId():
            return 3

    import pyspark

    real, pyspark.TaskContext = pyspark.TaskContext, Context
    try:
        with pytest.raises(AttributeError):
            writer.write(iter(rows))
        writer.commit([writer.write(iter(rows))])
    finally:
        pyspark.TaskContext = real
    lines = [line for f in os.listdir(tmp_path / "t") if f.endswith(".json") for line in open(tmp_path / "t" / f)]
    assert sorted(json.loads(x)["id"] for x in lines) == list(range(5))
    assert json.load(open(tmp_path / "t" / "_summary"))["rows"] == 5


def test_refusals(spark, tmp_path):
    spark.dataSource.register(UpsertSink)
    with pytest.raises(Exception, match="no columns"):
        spark.range(1).write.format("upsert").option("keys", "other").mode("append").save()
    with pytest.raises(Exception, match="mode append"):
        spark.range(1).write.format("upsert").mode("overwrite").save()

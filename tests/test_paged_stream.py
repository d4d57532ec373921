import json

from telar.sources.rest import Ids, PagedSource, PagedStream


class Growing:
    """Ids are the lines of a file, newest first; with the option ``param.grows`` new ones come while it is read."""

    def __init__(self, options):
        self.path, self.grows = options["file"], int(options.get("param.grows", 0))

    def fetch(self, page, size, params):
        ids = sorted({int(x) for x in open(self.path).read().split()}, reverse=True)
        if self.grows:
            with open(self.path, "a") as f:
                f.write(f"{ids[0] + 1}\n")
        rows = [{"idContrato": i} for i in ids] + [{"idContrato": None}]
        return {"pageable": {"totalPages": -(-len(rows) // size)}, "data": rows[(page - 1) * size : page * size]}


def add(path, ids):
    with open(path, "a") as f:
        f.write("".join(f"{i}\n" for i in ids))


def run(spark, tmp_path, **options):
    stream = spark.readStream.format("paged").option("transport", "tests.test_paged_stream:Growing").option("file", str(tmp_path / "ids")).option("size", 7)
    for k, v in options.items():
        stream = stream.option(k, v)
    q = stream.load().writeStream.format("json").option("path", f"file://{tmp_path}/out").option("checkpointLocation", f"file://{tmp_path}/check").trigger(processingTime="0 seconds").start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    return sorted(r.id for r in spark.read.schema("page int, id long, payload string").json(f"file://{tmp_path}/out").collect())


def test_restart_neither_loses_nor_repeats(spark, tmp_path):
    spark.dataSource.register(PagedSource)
    first, second, third = range(3, 60, 2), range(61, 64), range(70, 200)
    add(tmp_path / "ids", first)
    assert run(spark, tmp_path, known_id=9, partitions=4) == [i for i in first if i > 9]
    assert run(spark, tmp_path, known_id=9, partitions=4) == [i for i in first if i > 9]
    add(tmp_path / "ids", second)
    assert run(spark, tmp_path, known_id=9, partitions=1)[-3:] == [61, 62, 63]
    add(tmp_path / "ids", third)
    assert run(spark, tmp_path, known_id=9, partitions=4) == [i for i in (*first, *second, *third) if i > 9]


def test_ranges_are_replayable_while_records_come(tmp_path):
    """Any split of the ids gives each once, also where each call pushes all records on."""
    add(tmp_path / "ids", range(1, 101))
    for parts in (1, 3, 8):
        r = PagedStream({"transport": "tests.test_paged_stream:Growing", "file": str(tmp_path / "ids"), "size": "9", "partitions": str(parts), "param.grows": "1"})
        ranges = r.partitions({"id": 10}, {"id": 100})
        assert len(ranges) == parts
        for _ in range(2):
            got = [(k, json.loads(p)["idContrato"]) for x in ranges for _, k, p in r.read(Ids(x.low, x.high))]
            assert sorted(got) == [(i, i) for i in range(11, 101)]
    assert r.partitions({"id": 5}, {"id": 5}) == []

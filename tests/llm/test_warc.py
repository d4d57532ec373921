import hashlib

import pytest
from pyspark.sql import functions as F

from telar.llm import warc

FAKE = "WARC/1.1\r\nWARC-Type: response\r\nX-Page-Id: 666\r\nContent-Length: 5\r\n\r\nabcde\r\n\r\n"


@pytest.fixture(scope="module")
def pages(spark):
    big = "<p>" + "x" * 1000
    rows = [(1, "http://a/ b\r\n", big), (2, "u", big), (3, "u", big), (4, "u", "small"), (5, "u", "small"), (6, "u", None), (None, "u", big), (7, None, FAKE * 3), (8, "u", FAKE + "é" * 600)]
    rows += [(i, "u", f"page {i} " + FAKE) for i in range(100, 180)]
    return spark.createDataFrame([(*r, 0) for r in rows], "page_id long, url string, html string, size int").repartition(3)


def expected(rows):
    out, by = [], {}
    for r in rows:
        by.setdefault(r.html or "", []).append(r.page_id)
    for r in rows:
        b = (r.html or "").encode()
        top = max((x for x in by[r.html or ""] if x is not None), default=None)
        first = top if len(b) >= 1000 and top is not None and r.page_id != top else None
        out.append((r.page_id, len(b), hashlib.sha1(b).hexdigest(), "response" if first is None else "revisit", first))
    return sorted(out, key=repr)


@pytest.mark.parametrize(("split", "limit"), [(200, 5_000), (1_000, 1 << 20), (1 << 20, 1 << 20)])
def test_round_trip(pages, split, limit):
    """Magic inside payloads starts no record, whatever the splits."""
    files = warc.write(pages, file_bytes=limit)
    got = warc.read(files, split_bytes=split).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted(map(tuple, got), key=repr) == expected(pages.collect())


def test_candidates_are_rejected(spark, pages, tmp_path):
    one = pages.filter("page_id = 8").coalesce(1)
    files = warc.write(one.withColumn("html", F.col("html")))
    data = open(files.first().path.removeprefix("file://"), "rb").read()
    plain = tmp_path / "plain.warc"
    record = warc._record(1, "u", b"q", "d" * 40, None)
    html = FAKE.encode()
    stored = record.replace(b"Content-Length: ", b"X-Old: ")[: record.index(b"X-Page-Id")]
    body = b"HTTP/1.1 200 OK\r\n\r\n" + html
    own = stored + b"X-Page-Id: 9\r\nContent-Length: %d\r\n\r\n" % len(body) + body + b"\r\n\r\n"
    plain.write_bytes(own + data)
    f = spark.createDataFrame([(f"file://{plain}", len(own) + len(data))], "path string, size long")
    got = sorted(r.page_id for r in warc.read(f, split_bytes=150).collect())
    assert got == [8, 9]


@pytest.mark.parametrize("split", [200, 20_000, 1 << 20])
def test_long_heads_and_wide_numbers(spark, split):
    """Heads of any length, identifiers of 64 bits, and the records after them."""
    big = "<p>" + "x" * 1000
    rows = [(i, "u" * n, f"{i} {FAKE}") for i, n in enumerate((10, 16_000, 17_000, 300_000, 5))]
    rows += [((1 << 63) - 1, "u", big), (-(1 << 63), "u", big), (1_234_567_890_123_456_789, "u", "z")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    got = warc.read(warc.write(df), split_bytes=split).collect()
    assert sorted((r.page_id, r.url) for r in got) == sorted(r[:2] for r in rows)
    assert [r.refers_to for r in got if r.record_type == "revisit"] == [(1 << 63) - 1]


@pytest.mark.parametrize("split", [300, 1 << 20])
def test_a_broken_chain_is_an_error(spark, pages, tmp_path, split):
    files = warc.write(pages.filter("page_id > 100").coalesce(1))
    data = open(files.first().path.removeprefix("file://"), "rb").read()
    at = data.index(b"\r\n\r\nWARC/1.1", len(data) // 2) + 4
    for name, bad in (("cut", data[:-3]), ("hurt", data[:at] + b"X" + data[at + 1 :])):
        (tmp_path / name).write_bytes(bad)
        f = spark.createDataFrame([(f"file://{tmp_path}/{name}", len(bad))], "path string, size long")
        with pytest.raises(ValueError, match=name):
            warc.read(f, split_bytes=split).count()


def test_empty(spark, pages):
    files = warc.write(pages.limit(0))
    assert warc.read(files).count() == 0

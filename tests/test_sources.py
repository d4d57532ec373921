import http.server
import json
import threading
import urllib.error
from urllib.parse import parse_qs, urlsplit

import pytest
from pyspark.sql import functions as F

from telar.sources import captured, discovery, files, lookup
from telar.sources.rest import CapturedPages, HttpTransport, PagedReader, PagedSource
from telar.streaming import events


class Captured:
    """A source of 5 pages with ids falling from 50."""

    def __init__(self, options):
        self.least = int(options.get("param.least", 0))

    def fetch(self, page, size, params):
        ids = [i for i in range(50, 0, -1) if i > int(params.get("least", 0))]
        return {"pageable": {"totalPages": -(-len(ids) // size)}, "data": [{"idContrato": i} for i in ids[(page - 1) * size : page * size]]}


def test_paged_source(spark):
    spark.dataSource.register(PagedSource)
    read = spark.read.format("paged").option("transport", "tests.test_sources:Captured").option("size", 10)
    assert read.load().count() == 50
    assert [r[0] for r in read.option("known_id", 43).load().select("id").orderBy("id").collect()] == list(range(44, 51))
    assert read.option("known_id", 0).option("param.least", 25).load().count() == 25


class Whole:
    """763 pages; some records are no objects or have no integer id. Counts what the driver asks for."""

    asked: list[int] = []

    def __init__(self, options):
        pass

    def fetch(self, page, size, params):
        self.asked.append(page)
        ids = range(763 * 3 - (page - 1) * 3, 763 * 3 - page * 3, -1)
        return {"pageable": {"totalPages": 763}, "data": [{"idContrato": i} for i in ids] + ([{"idContrato": "abc"}, "x", {"idContrato": True}] if page % 100 == 0 else [])}


def test_full_ingestion_reads_every_page(spark):
    """763 pages, as many as a full run of the source has, and no limit unless one is given."""
    spark.dataSource.register(PagedSource)
    read = spark.read.format("paged").option("transport", "tests.test_sources:Whole").option("size", 3)
    rows = read.load()
    assert rows.select("page").distinct().count() == 763
    assert rows.filter("id IS NOT NULL").count() == 763 * 3
    assert rows.filter("id IS NULL").count() == 3 * 7
    assert read.option("max_pages", 500).load().select("page").distinct().count() == 500


def test_known_id_is_found_by_halving():
    reader = PagedReader({"transport": "tests.test_sources:Whole", "size": 3, "known_id": 300})
    Whole.asked.clear()
    assert max(p.last for p in reader.partitions()) == 763 - 99
    assert len(Whole.asked) < 15


def test_fallback_when_refused(monkeypatch):
    import io
    import urllib.error

    seen = []

    def urlopen(url, timeout):
        seen.append(url.split("?")[0])
        if url.startswith("http://first"):
            raise urllib.error.HTTPError(url, 403, "no", None, None)
        return io.BytesIO(b'{"data": [1]}')

    monkeypatch.setattr("urllib.request.urlopen", urlopen)
    t = HttpTransport({"base": "http://first", "fallback": "http://second"})
    assert t.fetch(1, 10, {}) == {"data": [1]}
    assert t.fetch(2, 10, {}) == {"data": [1]}
    assert seen == ["http://first", "http://second", "http://second"]


def test_csv_is_whole(spark, tmp_path):
    df = spark.range(5000).withColumn("t", F.lit("x" * 100))
    assert files.write_csv(df, str(tmp_path / "all"))
    assert len(next((tmp_path / "all").glob("*.csv")).read_text().splitlines()) == 5001


def test_files(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text("\n".join(json.dumps(x) for x in [{"id": 1, "v": "a"}, {"id": 2, "v": "b"}, {"id": 1, "v": "c"}]) + "\nbroken\n")
    got = files.read_sidecar(spark, str(tmp_path / "a.jsonl"), "id long, v string").orderBy("id").collect()
    assert [tuple(r) for r in got] == [(1, "c"), (2, "b")]
    (tmp_path / "log.txt").write_text("2026-08-22\nnuevos=93\nurl=a=b\n\nts2\n")
    assert files.read_log(spark, str(tmp_path / "log.txt")).first().kv == {"ts": "2026-08-22", "nuevos": "93", "url": "a=b"}
    (tmp_path / "docs").mkdir()
    (tmp_path / "docs/x.bin").write_bytes(b"%PDF-1.4")
    (tmp_path / "docs/y.bin").write_bytes(b" <!DOCTYPE html>")
    d = {r.path[-5:]: r for r in files.read_documents(spark, str(tmp_path / "docs")).collect()}
    assert (d["x.bin"].is_pdf, d["x.bin"].is_html, d["y.bin"].is_html) == (True, False, True)
    lists = spark.createDataFrame([('[{"idContratoArchivo":1}]',), ('{"a":1,"data":[{"idContratoArchivo":2}]}',), ("{}",)], "p string").select(files.attachments(F.col("p")).alias("x")).collect()
    assert [r.x and r.x[0].idContratoArchivo for r in lists] == [1, 2, None]
    df = spark.range(1500).withColumn("t", F.lit("é"))
    assert files.write_csv(df, str(tmp_path / "csv"))
    text = next((tmp_path / "csv").glob("*.csv")).read_text()
    assert text.startswith("﻿id,t")
    assert not files.write_csv(df, str(tmp_path / "few"), most_bytes=100)
    assert len(next((tmp_path / "few").glob("*.csv")).read_text().splitlines()) == 1001
    assert files.first_nonempty(df.limit(0), df).count() == 1500
    assert files.summary_lines({"a": 1, "b": [1]}) == "a=1\nb=[1]\n"


def test_discovery(spark):
    schema = "method string, url string, content_type string, content_disposition string, kind string, magic_pdf boolean, resource_type string, t double"
    ev = spark.createDataFrame([("GET", "http://h/archivo/7?x=7", "application/pdf", None, None, True, "xhr", 2.0), ("GET", "http://h/a.js", None, None, None, False, "script", 2.0), ("GET", "http://h/archivo/7?x=7", None, None, None, None, None, 1.0)], schema)
    got = discovery.candidates(ev, F.lit(7), F.lit(1.5)).collect()
    assert len(got) == 1
    assert got[0].score == 25 + 100 + 100 + 35 + 10 + 8
    assert ev.select(discovery.url_template(F.col("url"), F.lit(7)).alias("u")).first().u == "http://h/archivo/{id}?x={id}"


def test_streams(spark, tmp_path):
    src = "/root/testdata/sf0.001/events.parquet"
    batch = spark.read.parquet(src)
    batch.repartition(2).write.parquet(str(tmp_path / "in"))
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    stream = events.once(events.events(spark, str(tmp_path / "in"), schema), "event_id")
    q = events.windowed(stream, "1 day", "event_type").writeStream.outputMode("complete").format("memory").queryName("w").trigger(availableNow=True).start()
    q.awaitTermination(120)
    want = events.windowed(batch.withColumn("ts", F.col("ts").cast("timestamp")), "1 day", "event_type")
    key = lambda df: sorted((r.start, r.event_type, r.n) for r in df.collect())
    assert key(spark.table("w")) == key(want)
    state = {"n": -1}
    path = lambda n: str(tmp_path / f"snap{n}")

    def publish(df, n):
        df.write.mode("overwrite").parquet(path(n))
        state["n"] = n

    snapshot = lambda: spark.read.parquet(path(state["n"])) if state["n"] >= 0 else batch.limit(0)
    raw = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    events.merge_sink(raw, snapshot, publish, ["user_id"], [F.desc("ts"), F.desc("event_id")], str(tmp_path / "cp")).awaitTermination(120)
    assert spark.read.parquet(path(state["n"])).count() == batch.select("user_id").distinct().count()


def test_lookup(spark):
    def fetch(k):
        if k == 2:
            raise OSError("down")
        return {"v": k} if k == 1 else None

    got = lookup.lookup(spark.range(1, 4), "id", fetch, "v long").orderBy("id").collect()
    assert [(r.id, r.payload and r.payload.v, r.error) for r in got] == [(1, 1, None), (2, None, "OSError: down"), (3, None, None)]
    hints = spark.createDataFrame([('{"a": [{"u": "http://x"}, "n"], "b": {"c": "Descargar PDF"}}',), ("bad",), (None,)], "p string").select(lookup.json_hints(F.col("p")).alias("h")).collect()
    assert [r.h for r in hints] == [[".a[0].u=http://x", ".b.c=Descargar PDF"], [], []]


@pytest.fixture
def server():
    """Answers over HTTP: every page busy at first, the wrong token refused, /list answers a list. Notes what it is asked."""
    asked: list[tuple] = []

    class Handler(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            at, page = urlsplit(self.path), parse_qs(urlsplit(self.path).query)["page"][0]
            first = (at.path, page) not in {a[:2] for a in asked}
            asked.append((at.path, page, self.headers.get("Authorization")))
            code = 401 if self.headers.get("Authorization") != "Bearer right" else 503 if first else 200
            body = b"[1]" if at.path == "/list" else json.dumps({"pageable": {"totalElements": 5}, "data": [{"idContrato": 7 - 2 * int(page) + i} for i in (1, 0)]}).encode()
            self.send_response(code)
            self.end_headers()
            self.wfile.write(body if code == 200 else b"")

        def log_message(self, *_):
            pass

    s = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=s.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{s.server_port}", asked
    s.shutdown()
    s.server_close()


def test_token_tries_and_refusal(server):
    base, asked = server
    got = HttpTransport({"base": f"{base}/a", "token": "right", "pause": 0}).fetch(1, 2, {})
    assert got["data"] == [{"idContrato": 6}, {"idContrato": 5}]
    assert asked == [("/a", "1", "Bearer right")] * 2
    asked.clear()
    with pytest.raises(urllib.error.HTTPError):  # refused, so not asked again
        HttpTransport({"base": f"{base}/b", "token": "wrong", "pause": 0}).fetch(1, 2, {})
    assert len(asked) == 1
    asked.clear()
    with pytest.raises(urllib.error.HTTPError):
        HttpTransport({"base": f"{base}/c", "token": "right", "pause": 0, "tries": 1}).fetch(1, 2, {})
    with pytest.raises(ValueError, match="no object"):
        HttpTransport({"base": f"{base}/list", "token": "right", "pause": 0}).fetch(1, 2, {})
    assert len(asked) == 1 + 3


def test_pages_over_http(spark, server):
    """The number of pages follows from that of records; whole answers stay one payload each."""
    base, _ = server
    spark.dataSource.register(PagedSource)
    read = spark.read.format("paged").option("base", f"{base}/x").option("token", "right").option("pause", 0).option("size", 2)
    assert sorted(r.id for r in read.load().collect()) == [1, 2, 3, 4, 5, 6]
    assert "right" not in read.load()._jdf.queryExecution().toString()
    whole = read.option("whole", True).load().collect()
    assert sorted((r.page, r.id) for r in whole) == [(1, None), (2, None), (3, None)]
    assert all(json.loads(r.payload)["pageable"] == {"totalElements": 5} for r in whole)


@pytest.mark.parametrize("size", [1, 3, 100])
def test_captured_pages(spark, tmp_path, size):
    """Against pages made in plain Python: null objects, repeated, negative and null ids, one object with most rows."""
    rows = [(i, "a" if i % 10 else None) for i in range(-5, 40)] + [(7, "a"), (7, "b"), (None, "b")]
    df = spark.createDataFrame(rows, "k long, o string").repartition(4)
    numbered = captured.paged(df, "k", size, f"file://{tmp_path}/ranged", "o")
    body = F.to_json(F.struct(F.struct(F.col("pages").alias("totalPages")).alias("pageable"), F.transform("rows", lambda r: F.struct(r["k"].alias("idContrato"))).alias("data")))
    folder = captured.write_pages(captured.answers(numbered, "k", body), f"file://{tmp_path}/pages")
    source = CapturedPages({"base": folder})
    for o in ("a", "b", ""):
        want = sorted((k for k, x in rows if (x or "") == o), key=lambda k: (k is None, -(k or 0)))
        for page in range(1, -(-len(want) // size) + 1):
            got = source.fetch(page, size, {"objeto": o})
            assert got["pageable"] == {"totalPages": -(-len(want) // size)}
            assert [r.get("idContrato") for r in got["data"]] == want[(page - 1) * size : page * size]
        assert source.fetch(page + 1, size, {"objeto": o}) == {"data": []}
    spark.dataSource.register(PagedSource)
    read = spark.read.format("paged").option("transport", "telar.sources.rest:CapturedPages").option("base", folder).option("size", size).option("param.objeto", "a")
    assert sorted(r.id for r in read.load().collect()) == sorted(k for k, x in rows if x == "a")
    assert sorted(r.id for r in read.option("known_id", 0).load().collect()) == sorted(k for k, x in rows if x == "a" and k > 0)
    none = captured.paged(df.filter("k > 99"), "k", size, f"file://{tmp_path}/none", "o")
    assert captured.answers(none, "k", body).count() == 0

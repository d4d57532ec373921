"""WARC archives: writing, and reading by boundary-chain verification.

``write`` stores one record per row in uncompressed ``.warc`` files, a file per
task (a new one after ``file_bytes``). Of records with equal payloads of at least ``min_bytes``, the
one with the largest identifier is a ``response``, the others are ``revisit``
records that name it. Payloads are stored zlib-compressed under a
``Content-Encoding: deflate`` line of the HTTP head where that is shorter.

``read`` takes files apart in splits. A task looks for the magic at a line's
start in its split, parses each candidate record and emits its offset and the
offset at which its successor has to stand. Bytes inside a payload may look like
a record, so candidates prove nothing: a record is real if the chain of
successors from offset 0 of its file reaches it. Tasks jump pointers within
their split first (candidate to the first offset beyond the split), then the
exits of the splits are joined with themselves, doubling the distance each
time, and only reached records are kept. A file whose chain does not end at the
file's size is damaged: reading it raises an error. Heads may have any length.

Defined cases: null html is an empty payload; null identifiers are stored as
``null`` and read back as null; repeated rows give a record each (of rows that
share the largest identifier all are responses); an empty table gives no files.
"""

from __future__ import annotations

import hashlib
import math
import re
import uuid
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .common import arrow_fs, bounded, discard, fresh_path, written

MAGIC = b"WARC/1.1\r\n"
FILE_BYTES = 256 << 20
SPLIT_BYTES = 8 << 20
HEAD_BYTES = 16 << 10
TASK_BYTES = 32 << 20
PIECE_BYTES = 1 << 20
SMALL_SPLITS = 5_000


HOT_DIGESTS = 10_000
SALTS = 64


def _digest() -> Column:
    return F.sha1(F.encode(F.coalesce("html", F.lit("")), "UTF-8"))


def _length() -> Column:
    return F.octet_length(F.coalesce("html", F.lit(""))).cast("long")


def classify(rows: DataFrame, min_bytes: int = 1000) -> tuple[DataFrame, int]:
    """``rows`` (page_id, html and more) with digest and refers_to (null for a response), and the bytes of all payloads.

    Only digests that occur more than once take part in the join. The rows of a
    digest with more than a ten-thousandth of all rows, of which there are at
    most HOT_DIGESTS, are dealt over SALTS keys, and its one row is repeated for each.
    """
    size = Observation()
    facts = rows.observe(size, F.sum(_length()).alias("bytes")).filter(_length() >= min_bytes).select("page_id", _digest().alias("digest"))
    # Partial sums leave a row a digest and task, however many copies there are.
    copies = written(facts.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.max("page_id").alias("first")).filter("n > 1"), "warc-copies")
    most = max(64, (copies.agg(F.sum("n")).first()[0] or 0) // HOT_DIGESTS)
    hot = F.broadcast(copies.filter(F.col("n") > most).select("digest", F.lit(True).alias("hot")))  # at most HOT_DIGESTS rows
    salts = F.when(F.col("n") > most, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    copies = copies.select("digest", "first", F.explode(salts).alias("salt"))
    dealt = rows.withColumns({"digest": _digest(), "payload_bytes": _length()}).join(hot, "digest", "left")
    dealt = dealt.withColumn("salt", F.when(F.col("hot"), F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int")).otherwise(0))
    first = F.when((F.col("payload_bytes") >= min_bytes) & (F.col("page_id").isNull() | (F.col("page_id") < F.col("first"))), F.col("first"))
    return dealt.join(copies.hint("merge"), ["digest", "salt"], "left").withColumn("refers_to", first).drop("salt", "hot", "first"), 0 if rows.isEmpty() else size.get["bytes"]


def _record(page_id: int | None, url: str, html: bytes, digest: str, first: int | None) -> bytes:
    kind = "response" if first is None else "revisit"
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    if first is None:
        packed = zlib.compress(html, 6)
        http += (b"Content-Encoding: deflate\r\n\r\n" + packed) if len(packed) < len(html) else b"\r\n" + html
    else:
        http += b"\r\n"
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
    head = [
        f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>", f"WARC-Target-URI: {target}", "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{digest}", f"X-Page-Id: {'null' if page_id is None else page_id}", f"X-Payload-Length: {len(html)}", "Content-Type: application/http;msgtype=response", f"Content-Length: {len(http)}",
    ]
    if first is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"X-Refers-To-Page: {first}"]
    return MAGIC + "\r\n".join(head).encode() + b"\r\n\r\n" + http + b"\r\n\r\n"


def _write(batches: Iterator[pa.RecordBatch], folder: str, file_bytes: int) -> Iterator[pa.RecordBatch]:
    made: list[tuple[str, int]] = []
    out, uri, size = None, "", 0

    def closed() -> None:
        if out:
            out.close()
            made.append((uri, size))

    for batch in batches:
        cols = [batch.column(n).to_pylist() for n in ("page_id", "url", "html", "digest", "refers_to")]
        for page_id, url, html, digest, first in zip(*cols, strict=True):
            rec = _record(page_id, url or "", (html or "").encode(), digest, first)
            if out is None or size + len(rec) > file_bytes:
                closed()
                uri, size = f"{folder}/{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc", 0
                fs, path = arrow_fs(uri)
                fs.create_dir(path.rpartition("/")[0], recursive=True)
                out = fs.open_output_stream(path)
            out.write(rec)
            size += len(rec)
    closed()
    yield pa.RecordBatch.from_pydict({"path": pa.array([m[0] for m in made], pa.string()), "size": pa.array([m[1] for m in made], pa.int64())})


def _tasks(spark: SparkSession, size: int) -> int:
    """A task for every TASK_BYTES, at least as many as run at once."""
    return max(spark.sparkContext.defaultParallelism, size // TASK_BYTES)


def write(pages: DataFrame, id_col: str = "page_id", min_bytes: int = 1000, folder: str | None = None, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write the archives; returns their paths and sizes. Only the files of attempts that succeeded are listed.

    As many tasks write as TASK_BYTES go into the payloads, at least as many as
    run at once; the number of shuffle partitions has no say in the number of files.
    """
    spark = pages.sparkSession
    folder = folder or fresh_path(spark, "warc")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), "url", "html")
    told, size = classify(rows, min_bytes)
    told = told.select("page_id", "url", "html", "digest", "refers_to").coalesce(_tasks(spark, size))
    return written(bounded(told).mapInArrow(partial(_write, folder=folder, file_bytes=file_bytes), "path string, size long"), "warc-files")


RECORD = "path string, split int, at long, next long, exit long, page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string"


class _Buffer:
    """The bytes of a file from an offset on, read further as they are needed. Positions count from the offset."""

    def __init__(self, f, start: int, first: int, size: int):
        self.f, self.start, self.size = f, start, size - start
        self.data = f.read_at(min(first, self.size), start)

    def find(self, what: bytes, at: int) -> int:
        """As bytes.find, to the file's end."""
        while (i := self.data.find(what, at)) < 0 and len(self.data) < self.size:
            at = max(at, len(self.data) - len(what) + 1)
            more = self.f.read_at(min(max(HEAD_BYTES, len(self.data)), self.size - len(self.data)), self.start + len(self.data))
            self.data += more
        return i

    def slice(self, at: int, end: int) -> bytes:
        return self.data[at:end] if end <= len(self.data) else self.f.read_at(end - at, self.start + at)


def _parse(b: _Buffer, at: int) -> tuple[int, dict[str, str], bytes] | None:
    """(length of the whole record, its head, its block), or None if no whole record can start here."""
    head, p = {}, at + len(MAGIC)
    while (end := b.find(b"\r\n", p)) > p:
        k, colon, v = b.data[p:end].partition(b":")
        if not colon:
            return None
        head[k.decode("latin-1").lower()] = v.decode("utf-8", "replace").strip()
        p = end + 2
    n = _number(head.get("content-length"))
    if end < 0 or n is None or n < 0 or end + 2 + n + 4 > b.size:
        return None
    return end + 2 - at + n + 4, head, b.slice(end + 2, end + 2 + n)


def _number(text: str | None) -> int | None:
    """A 64-bit integer."""
    return n if text and re.fullmatch(r"-?[0-9]{1,19}", text) and -(1 << 63) <= (n := int(text)) < 1 << 63 else None


def _inflated(data: bytes) -> tuple[str, int]:
    """(SHA-1, length) of a zlib stream's content, made piece by piece; of nothing where it is damaged."""
    z, sha, n = zlib.decompressobj(), hashlib.sha1(), 0
    try:
        while piece := z.decompress(data, PIECE_BYTES):
            sha.update(piece)
            n, data = n + len(piece), z.unconsumed_tail
    except zlib.error:
        pass
    return (sha.hexdigest(), n) if z.eof else (hashlib.sha1().hexdigest(), 0)


def exits(at: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Pointer jumping within a split: for each candidate (at ascending offsets), the first offset of its chain that is no candidate."""
    after = after.copy()
    while True:
        i = np.minimum(np.searchsorted(at, after), len(at) - 1)
        here = at[i] == after
        if not here.any():
            return after
        after = np.where(here, after[i], after)


def _record_at(b: _Buffer, i: int) -> tuple | None:
    """(length, page_id, payload_bytes, payload_digest, record_type, refers_to, url) of the candidate there."""
    got = _parse(b, i)
    if not got:
        return None
    n, head, block = got
    kind = head.get("warc-type", "")
    if kind == "response":
        http, _, body = block.partition(b"\r\n\r\n")
        digest, length = _inflated(body) if b"content-encoding: deflate" in http.lower() else (hashlib.sha1(body).hexdigest(), len(body))
    else:
        digest, length = head.get("warc-payload-digest", "").removeprefix("sha1:"), _number(head.get("x-payload-length"))
    return n, _number(head.get("x-page-id")), length, digest, kind, _number(head.get("x-refers-to-page")), head.get("warc-target-uri")


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([(n, {"string": pa.string(), "int": pa.int32(), "long": pa.int64()}[t]) for n, t in (x.split() for x in RECORD.split(", "))])
    for batch in batches:
        for path, split, start, stop, size in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
            fs, p = arrow_fs(path)
            rows = []
            with fs.open_input_file(p) as f:
                b = _Buffer(f, start, stop - start + len(MAGIC) + HEAD_BYTES, size)
                i = b.data.find(MAGIC)
                while 0 <= i < stop - start:
                    if got := _record_at(b, i):
                        rows.append((start + i, *got))
                    i = b.data.find(MAGIC, i + 1)
            if rows:
                at, length, *rest = map(list, zip(*rows, strict=True))
                at = np.array(at, np.int64)
                after = at + np.array(length, np.int64)
                cols = [[path] * len(rows), [split] * len(rows), at, after, exits(at, after), *rest]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)


def read(files: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """The records of the listed files: page_id, payload_bytes, payload_digest, record_type, refers_to, url, path, at."""
    cuts = F.greatest(F.lit(1), F.ceil(F.col("size") / split_bytes)).cast("int")
    n, size = files.agg(F.coalesce(F.sum(cuts), F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    tasks = min(n, _tasks(files.sparkSession, size))
    splits = files.select("path", "size", F.explode(F.sequence(F.lit(0), cuts - 1)).alias("split"))
    splits = splits.select("path", "split", (F.col("split").cast("long") * split_bytes).alias("start"), F.least("size", (F.col("split").cast("long") + 1) * split_bytes).alias("stop"), "size")
    found = written(splits.repartition(tasks).mapInArrow(_scan, RECORD), "warc-candidates")
    return reached(found, files, split_bytes).coalesce(tasks).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "path", "at")


def _walk(group: pa.Table) -> pa.Table:
    """The records of a split on the chain from its entry (the one marked candidate)."""
    import pyarrow.compute as pc

    after = dict(zip(group.column("at").to_pylist(), group.column("next").to_pylist(), strict=True))
    on, keep = set(), pc.filter(group.column("at"), group.column("entry")).to_pylist()
    for x in keep:
        while x in after and x not in on:
            on.add(x)
            x = after[x]
    return group.filter(pa.array([x in on for x in group.column("at").to_pylist()], pa.bool_())).drop_columns(["entry"])


def reached(found: DataFrame, files: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """The candidates that the chain from the start of their file reaches; an error if a chain does not end at its file's size.

    A group is one split, so its size has a bound. Only candidates at which
    another split's chain comes out, a few a split, can be entries, so jumps are
    doubled for these alone; the splits of the longest file bound the rounds.
    """
    splits = F.greatest(F.lit(1), F.ceil(F.col("size") / split_bytes))
    most, n = files.agg(F.coalesce(F.max(splits), F.lit(1)), F.coalesce(F.sum(splits), F.lit(1))).first()
    few = 1 + n // SMALL_SPLITS  # a table of some rows a split needs no more files
    on = files.select("path", F.lit(0).cast("long").alias("at"))
    entries = found.select("path", F.col("exit").alias("at")).unionByName(on).distinct()
    jumps = written(found.select("path", "at", "exit").join(entries, ["path", "at"], "left_semi").coalesce(few), "warc-exits")
    step, old = jumps, []
    for _ in range(math.ceil(math.log2(most))):
        on = written(on.union(on.join(step, ["path", "at"]).select("path", F.col("exit").alias("at"))).distinct().coalesce(few), "warc-on")
        far = step.select("path", F.col("at").alias("exit"), F.col("exit").alias("far"))
        step = written(step.join(far, ["path", "exit"]).select("path", "at", F.col("far").alias("exit")).coalesce(few), "warc-jumps")
        discard(*old)
        old = [on, step]
    ends = on.join(jumps, ["path", "at"]).select("path", F.col("exit").alias("size"))
    if broken := [r.path for r in files.filter("size > 0").join(ends, ["path", "size"], "left_anti").limit(3).collect()]:
        raise ValueError(f"records do not reach the end of the file: {', '.join(broken)}")
    marked = found.join(on.withColumn("entry", F.lit(True)), ["path", "at"], "left").withColumn("entry", F.coalesce("entry", F.lit(False)))
    return marked.select(*found.columns, "entry").groupBy("path", "split").applyInArrow(_walk, RECORD)

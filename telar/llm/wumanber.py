"""Benchmark decontamination by Wu-Manber search over words.

Patterns are the windows of ten consecutive words of the test items (an item of
fewer words is one window). The search runs on words instead of characters:
the SHIFT table gives for a block of two words how far the window's end may move
on, suffix-block buckets select windows (split by their first block), and the
words are compared to confirm an occurrence. Windows of each length have tables
of their own, so one short test item doesn't shorten the shifts of the others.

The windows go to the executors in parts of at most ``part_words`` words and item
identifiers; every part sees all documents, and what the parts find is merged, so
any number of items, and of items with one window, gives whole results in bounded
memory (a document's own list of items is as long as its items are many).

Defined cases: null and empty texts have no words; null ids are kept (items
with a null id are searched, and listed as nothing); repeated documents are
answered row by row; equal items are all listed; an empty benchmark gives clean
documents. Only the named columns are read.
"""

from __future__ import annotations

import hashlib
import struct
from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_name, map_batches, utf8, written

WINDOW = 10
PART_WORDS = 2_000_000

#: Words are runs of digits, letters and bytes above 127, as [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ of the lower-cased text.
_WORD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))


def words(text: bytes) -> list[bytes]:
    return text.translate(_WORD).split()


class Tables:
    """SHIFT, suffix buckets and windows of one length."""

    def __init__(self, length: int, windows: dict[tuple[bytes, ...], list[int]]):
        self.length, self.block = length, min(2, length)
        b = self.block
        self.most = length - b + 1
        self.shift: dict[tuple[bytes, ...], int] = {}
        self.bucket: dict[tuple[bytes, ...], dict[tuple[bytes, ...], list]] = defaultdict(lambda: defaultdict(list))
        for w, items in windows.items():
            for end in range(b, length + 1):
                key, by = w[end - b : end], length - end
                if by < self.shift.get(key, self.most):
                    self.shift[key] = by
            self.bucket[w[-b:]][w[:b]].append((w, items))
        self.bucket = {k: dict(v) for k, v in self.bucket.items()}

    def search(self, ws: list[bytes]):
        """(end, items) of every occurrence."""
        n, b, length, most, shift, at = len(ws), self.block, self.length, self.most, self.shift.get, self.length
        while at <= n:
            key = tuple(ws[at - b : at])
            if by := shift(key, most):
                at += by
                continue
            for w, items in self.bucket[key].get(tuple(ws[at - length : at - length + b]), ()):
                if tuple(ws[at - length : at]) == w:
                    yield at, items
            at += 1


class Matcher:
    def __init__(self, windows: list[tuple[tuple[bytes, ...], list[int]]]):
        by: dict[int, dict] = defaultdict(dict)
        for w, items in windows:
            by[len(w)][w] = items
        self.tables = [Tables(n, ws) for n, ws in sorted(by.items())]

    def __call__(self, ws: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """(merged spans of hit words, items found)."""
        spans, found = [], set()
        for t in self.tables:
            for end, items in t.search(ws):
                spans.append((end - t.length, end))
                found.update(items)
        return merged(spans), found


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(b, out[-1][1])
        else:
            out.append((a, b))
    return out


def window_parts(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW, part_words: int = PART_WORDS):
    """The distinct windows with their items, in parts of at most so many words and item ids each, but for a window.

    Items stream through the driver one by one; only one part is held at a time.
    A long item, or a window of many items, goes on in the next part.
    """
    part: dict[tuple[bytes, ...], set[int]] = {}
    size = 0
    for row in benchmark.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).alias("t")).toLocalIterator():
        ws = words((row.t or "").encode())
        for at in range(max(1, len(ws) - window + 1) if ws else 0):
            w = tuple(ws[at : at + window])
            if w not in part:
                part[w] = set()
                size += len(w)
            if row.i is not None and row.i not in part[w]:
                part[w].add(row.i)
                size += 1
            if size >= part_words:
                yield [(w, sorted(items)) for w, items in part.items()]
                part, size = {}, 0
    if part:
        yield [(w, sorted(items)) for w, items in part.items()]


FOUND = "__spans binary, __items array<long>"


def find(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", window: int = WINDOW, part_words: int = PART_WORDS, item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of ``docs`` with ``__n_words`` int, ``__spans`` binary (pairs of little-endian uint32) and ``__items`` array<long>.

    With one part, it is one pass over the rows. Each further part reads the
    texts again and writes spans and items of the texts it finds, by two hashes
    of the text; these are merged and joined to the rows.
    """
    spark = docs.sparkSession
    out = docs.withColumns({"__n_words": F.lit(-1), "__spans": F.lit(b""), "__items": F.array().cast("array<bigint>")})
    key = [F.xxhash64(text_col).alias("__h"), F.hash(text_col).alias("__g")]
    texts = docs.filter(F.col(text_col).isNotNull()).select(F.col(text_col).alias("t"), F.lit(b"").alias("__spans"), F.array().cast("array<bigint>").alias("__items"))
    found, first = None, None
    for part in window_parts(benchmark, item_col, item_text, window, part_words):
        if first is None:
            first = part
            continue
        for p in [first, part] if found is None else [part]:  # one set of windows at a time in a worker
            some = _search(texts, spark.sparkContext.broadcast(p), "t").filter(F.length("__spans") > 0)
            some = written(some.select(F.xxhash64("t").alias("__h"), F.hash("t").alias("__g"), "__spans", "__items").dropDuplicates(["__h", "__g"]), "wu-manber")
            found = some if found is None else found.unionByName(some)
    if found is None:
        return _search(out, spark.sparkContext.broadcast(first or []), text_col)

    def union(batch: pa.RecordBatch) -> pa.RecordBatch:
        spans = [merged([x for s in own for x in struct.iter_unpack("<II", s)]) for own in batch.column("__spans").to_pylist()]
        return pa.RecordBatch.from_pydict({"__h": batch.column("__h"), "__g": batch.column("__g"), "__spans": pa.array([struct.pack(f"<{2 * len(s)}I", *(x for pair in s for x in pair)) for s in spans], pa.binary()), "__items": batch.column("__items")})

    by_text = found.groupBy("__h", "__g").agg(F.collect_list("__spans").alias("__spans"), F.sort_array(F.array_distinct(F.flatten(F.collect_list("__items")))).alias("__items"))
    by_text = map_batches(by_text, union, f"__h long, __g int, {FOUND}").withColumnsRenamed({"__spans": "__s", "__items": "__i"})
    joined = _search(out, spark.sparkContext.broadcast([]), text_col).withColumns({"__h": key[0], "__g": key[1]}).join(by_text, ["__h", "__g"], "left")
    return joined.select(*docs.columns, "__n_words", F.coalesce("__s", "__spans").alias("__spans"), F.coalesce("__i", "__items").alias("__items"))


def _search(docs: DataFrame, part, text_col: str) -> DataFrame:
    """The rows with ``__spans`` and ``__items`` of the part's windows, and ``__n_words`` where there is such a column."""
    own: dict = {}

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        if "m" not in own:
            own["m"] = Matcher(part.value)
        n, spans, items = [], [], []
        for text in utf8(batch, text_col):
            ws = words(text)
            s, i = own["m"](ws)
            n.append(len(ws))
            spans.append(struct.pack(f"<{2 * len(s)}I", *(x for pair in s for x in pair)))
            items.append(sorted(i))
        made = {"__n_words": pa.array(n, pa.int32()), "__spans": pa.array(spans, pa.binary()), "__items": pa.array(items, pa.list_(pa.int64()))}
        return pa.RecordBatch.from_pydict({k: made[k] if k in made else batch.column(k) for k in batch.schema.names})

    return map_batches(docs, run, docs.schema)


def report(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    found = find(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), benchmark, **how).drop("text")

    def digest(batch: pa.RecordBatch) -> pa.RecordBatch:
        hit = [sum(b - a for a, b in struct.iter_unpack("<II", s)) for s in batch.column("__spans").to_pylist()]
        items = [sorted(map(str, x)) for x in batch.column("__items").to_pylist()]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("__n_words").cast(pa.int64()), pa.array(hit, pa.int64()), pa.array(map(len, items), pa.int64()), pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in items]), pa.array([h > 0 for h in hit])],
            ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
        )

    return map_batches(found, digest, "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean")


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` in which no window occurs, with their own columns."""
    names = {c: free_name(docs, c) if c in ("__n_words", "__spans", "__items", "__h", "__g", "__s", "__i") else c for c in docs.columns}
    found = find(docs.withColumnsRenamed(names), benchmark, names[text_col], **how).filter(F.length("__spans") == 0)
    return found.select(*(F.col(f"`{kept}`").alias(c) for c, kept in names.items()))

"""Token ids in sorted-string-table shards.

Documents are keyed by identifier. A shard is

* data blocks, zstd-compressed: entries in ascending key order, each
  ``shared u8 | suffix length u8 | key suffix | width u8 | n varint | n ids``,
  where ``shared`` bytes of the key are those of the entry before (none at the
  start of a block) and ids take 2 or 4 bytes, little-endian;
* the sparse index: for each block its last key, offset, length, entries and crc32;
* a Bloom filter over the keys;
* a footer of 72 bytes with the places of index and filter, the counts and a magic.

A shard is closed at ``SHARD_BYTES`` or ``SHARD_DOCS``, whichever comes first, so
a task writes as many as its rows need and never holds more than one shard's index
and eight bytes a key for its filter. Tasks are as many as ``TASK_BYTES`` go into
the texts, whatever the shuffle partitions.

A lookup reads footer, filter and index, finds the block by binary search and
decodes that block alone. A key is one byte 0 for a null identifier (sorted
first) or byte 1 and the identifier as big-endian with the sign flipped, so
that byte order is numeric order.

Defined cases: null text is empty and stored as the end id alone; null and
repeated identifiers are stored, repeated ones in the order of Spark's xxhash64 of
their texts, by which an identifier of many rows is split over shards (rows equal
in both stand together); an empty table gives no shards. Columns other than the two named
ones are never read.
"""

from __future__ import annotations

import bisect
import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator
from functools import cache, partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import arrow_fs, bounded, fresh_path, written

MAGIC = b"TLSSTBL1"
FOOTER = struct.Struct("<QQQQQQQQ8s")
INDEX = struct.Struct("<BQIII")
BLOCK_BYTES = 256 << 10
SHARD_BYTES = 128 << 20
SHARD_DOCS = 4_000_000
TASK_BYTES = 256 << 20
CACHE_CHUNKS = 900_000

_TWO_SPACES = re.compile(r"\s\s")
_CHUNK_START = re.compile(r"(?<=\S)(?= )")
_CHUNK = re.compile(r" ?[^ \n]+|\n| ")
_PLAIN = re.compile(r"( ?[A-Za-zÀ-ÖØ-öø-ɏ]+)([!-/:-@\[-`{-~]*)")
_SHOWN = {b: chr(b) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255 else "" for b in range(256)}
_SHOWN |= {b: chr(256 + n) for n, b in enumerate(b for b in range(256) if not _SHOWN[b])}  # the characters by which byte-level vocabularies show bytes


@cache
def tokenizer(path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class ChunkEncoder(dict):
    """Whole texts to ids (as little-endian uint32 bytes) through the tokenizers library.

    The byte-level pre-tokeniser never joins a character that is not white
    space to a space after it, so a text may be cut before each space that
    follows such a character (and around single line breaks), and the parts be
    encoded on their own. This is the table of parts, of bounded size. A part
    that it lacks goes through the library: a run of Latin letters with at most
    a space before and ASCII marks after it is one or two pre-tokens, which the
    library's model takes at once; any other part goes through all of it. Special tokens
written out in a text get their own id, as in the library; they hold no white
space, so no cut falls within one.
    """

    def __init__(self, path: str):
        self.t = tokenizer(path)
        self.model = self.t.model

    @staticmethod
    def chunks(text: str) -> list[str]:
        return _CHUNK_START.split(text) if _TWO_SPACES.search(text) else _CHUNK.findall(text)

    def __missing__(self, part: str) -> bytes:
        plain = _PLAIN.fullmatch(part)
        if plain and plain[2]:
            ids = self[plain[1]] + (self.get(plain[2]) or self._token(plain[2], plain[2]))
        elif plain:
            return self._token(part, part)
        else:
            e = self.t.encode(part, add_special_tokens=False)
            ids = struct.pack(f"<{len(e.ids)}I", *e.ids)
        self[part] = ids
        return ids

    def _token(self, key: str, pretoken: str) -> bytes:
        ids = [t.id for t in self.model.tokenize(pretoken.encode().decode("latin-1").translate(_SHOWN))]
        self[key] = out = struct.pack(f"<{len(ids)}I", *ids)
        return out

    def encode(self, texts: list[str], end: bytes) -> list[bytes]:
        out = []
        for text in texts:
            if len(self) > CACHE_CHUNKS:
                self.clear()
            out.append((b"".join(map(self.__getitem__, self.chunks(text))) if text else b"") + end)
        return out


@cache
def chunk_encoder(path: str) -> ChunkEncoder:
    return ChunkEncoder(path)


def key_of(doc_id: int | None) -> bytes:
    return b"\0" if doc_id is None else b"\1" + struct.pack(">Q", doc_id + (1 << 63))


def id_of(key: bytes) -> int | None:
    return None if key == b"\0" else struct.unpack(">Q", key[1:])[0] - (1 << 63)


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes(out) + bytes([n])


def _digest(key: bytes) -> int:
    return zlib.crc32(key) | zlib.crc32(key, 0x9E3779B9) << 32


def _bits(a: int, m: int, k: int) -> list[int]:
    """The places in the filter of a key with this digest."""
    step = (a >> 17 | a << 47) & (1 << 64) - 1 | 1
    return [(a + i * step) % m for i in range(k)]


class Writer:
    def __init__(self, out):
        self.out, self.at, self.index, self.digests = out, 0, [], array("Q")
        self.docs = self.tokens = 0
        self._fresh()

    def _fresh(self) -> None:
        self.block, self.size, self.last, self.entries = [], 0, b"", 0

    def add(self, key: bytes, ids: bytes) -> None:
        """ids: little-endian uint32 bytes. Keys come in ascending order."""
        shared = 0
        while shared < min(len(key), len(self.last)) and key[shared] == self.last[shared]:
            shared += 1
        a = np.frombuffer(ids, "<u4")
        wide = bool(len(a)) and int(a.max()) > 65535
        body = ids if wide else a.astype("<u2").tobytes()
        self.block.append(bytes([shared, len(key) - shared]) + key[shared:] + bytes([4 if wide else 2]) + _varint(len(a)) + body)
        self.size += len(self.block[-1])
        self.last, self.entries = key, self.entries + 1
        self.digests.append(_digest(key))
        self.docs += 1
        self.tokens += len(a)
        if self.size >= BLOCK_BYTES:
            self.flush()

    def flush(self) -> None:
        if self.block:
            data = zstandard.compress(b"".join(self.block), 3)
            self.index.append((self.last, self.at, len(data), self.entries, zlib.crc32(data)))
            self.out.write(data)
            self.at += len(data)
            self._fresh()

    def close(self) -> None:
        self.flush()
        index = b"".join(INDEX.pack(len(k), o, n, e, c) + k for k, o, n, e, c in self.index)
        m, k = max(64, 10 * len(self.digests)), 7
        bits = bytearray((m + 7) // 8)
        for digest in self.digests:
            for b in _bits(digest, m, k):
                bits[b >> 3] |= 1 << (b & 7)
        self.out.write(index + bytes(bits))
        self.out.write(FOOTER.pack(self.at, len(index), self.at + len(index), m, k, len(self.index), self.docs, self.tokens, MAGIC))


class Reader:
    """Random and sequential access to one shard; reads no more than it needs."""

    def __init__(self, uri: str):
        fs, path = arrow_fs(uri)
        self.f = fs.open_input_file(path)
        size = self.f.size()
        i_at, i_len, b_at, self.m, self.k, n, self.docs, self.tokens, magic = FOOTER.unpack(self._read(size - FOOTER.size, FOOTER.size))
        if magic != MAGIC:
            raise ValueError(f"not a shard: {uri}")
        self.bloom = self._read(b_at, (self.m + 7) // 8)
        raw, at, self.index = self._read(i_at, i_len), 0, []
        for _ in range(n):
            klen, o, length, entries, crc = INDEX.unpack_from(raw, at)
            at += INDEX.size
            self.index.append((raw[at : at + klen], o, length, entries, crc))
            at += klen
        self.lasts = [x[0] for x in self.index]

    def _read(self, at: int, n: int) -> bytes:
        return self.f.read_at(n, at)

    def block(self, i: int) -> Iterator[tuple[bytes, np.ndarray]]:
        _, o, length, entries, crc = self.index[i]
        data = self._read(o, length)
        if zlib.crc32(data) != crc:
            raise ValueError(f"block {i} is damaged")
        raw, at, key = zstandard.decompress(data), 0, b""
        for _ in range(entries):
            shared, more = raw[at], raw[at + 1]
            key = key[:shared] + raw[at + 2 : at + 2 + more]
            at += 2 + more
            width, at, n, shift = raw[at], at + 1, 0, 0
            while True:
                b = raw[at]
                at, n, shift = at + 1, n | (b & 127) << shift, shift + 7
                if b < 128:
                    break
            yield key, np.frombuffer(raw, f"<u{width}", n, at).astype("<u4")
            at += width * n

    def __iter__(self) -> Iterator[tuple[bytes, np.ndarray]]:
        for i in range(len(self.index)):
            yield from self.block(i)

    def get(self, doc_id: int | None) -> np.ndarray | None:
        """The ids of one document: filter, binary search of the index, one block."""
        key = key_of(doc_id)
        if not all(self.bloom[b >> 3] >> (b & 7) & 1 for b in _bits(_digest(key), self.m, self.k)):
            return None
        i = bisect.bisect_left(self.lasts, key)
        return next((ids for k, ids in self.block(i) if k == key), None) if i < len(self.lasts) else None

    def close(self) -> None:
        self.f.close()


MANIFEST = "shard int, seq int, path string, docs long, tokens long, bytes long"


def _write_shard(batches: Iterator[pa.RecordBatch], folder: str, tokenizer_path: str, end_id: int, shard_bytes: int, shard_docs: int) -> Iterator[pa.RecordBatch]:
    part, run, seq, writer, uri = TaskContext.get().partitionId(), uuid.uuid4().hex, 0, None, ""
    encoder, end = chunk_encoder(tokenizer_path), struct.pack("<I", end_id)

    def closed() -> pa.RecordBatch:
        writer.close()
        writer.out.close()
        ints = {"docs": writer.docs, "tokens": writer.tokens, "bytes": writer.at}
        return pa.RecordBatch.from_pydict({"shard": pa.array([part], pa.int32()), "seq": pa.array([seq], pa.int32()), "path": [uri]} | {c: pa.array([n], pa.int64()) for c, n in ints.items()})

    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            some = batch.slice(at, 500)
            for doc, ids in zip(some.column(0).to_pylist(), encoder.encode([x or "" for x in some.column(1).to_pylist()], end), strict=True):
                if writer is None:
                    uri = f"{folder}/{part:06d}-{seq:06d}-{run}.sst"
                    fs, path = arrow_fs(uri)
                    fs.create_dir(path.rpartition("/")[0], recursive=True)
                    writer = Writer(fs.open_output_stream(path))
                writer.add(key_of(doc), ids)
                if writer.at + writer.size >= shard_bytes or writer.docs >= shard_docs:
                    yield closed()
                    seq, writer = seq + 1, None
    if writer:
        yield closed()


def _tasks(spark: SparkSession, size: int) -> int:
    """A task for every TASK_BYTES, at least twice as many as run at once."""
    return max(2 * spark.sparkContext.defaultParallelism, size // TASK_BYTES)


def write_shards(
    docs: DataFrame, tokenizer_path: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text", folder: str | None = None, shard_bytes: int = SHARD_BYTES, shard_docs: int = SHARD_DOCS
) -> DataFrame:
    """Encode all texts into shards that ascend by identifier; returns the manifest, one row per shard in order of (shard, seq).

    Each task writes under names of its own, and the manifest lists those of
    the attempts that succeeded, so a retried task leaves no wrong shard.
    """
    spark = docs.sparkSession
    folder = folder or fresh_path(spark, "sst")
    rows = docs.select(F.col(id_col).cast("long").alias("k"), F.col(text_col).alias("t"))
    size = rows.agg(F.sum(F.octet_length("t").cast("long")).alias("n")).first().n or 0
    order = [F.col("k").asc_nulls_first(), F.col("h").asc()]
    rows = rows.withColumn("h", F.xxhash64("t")).repartitionByRange(_tasks(spark, size), *order).sortWithinPartitions(*order)
    write = partial(_write_shard, folder=folder, tokenizer_path=tokenizer_path, end_id=end_id, shard_bytes=shard_bytes, shard_docs=shard_docs)
    return written(bounded(rows.select("k", "t")).mapInArrow(write, MANIFEST), "sst-manifest")


def _read_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist(), strict=True):
            shard = Reader(path)
            for i in range(len(shard.index)):
                cols: tuple[list, ...] = ([], [], [], [])
                for key, ids in shard.block(i):
                    for col, x in zip(cols, (id_of(key), start, len(ids), zlib.crc32(ids.tobytes())), strict=True):
                        col.append(x)
                    start += len(ids)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["doc_id", "start", "n_tokens", "ids_crc32"])
            shard.close()


def read_shards(manifest: DataFrame) -> DataFrame:
    """One row per document, from the files: doc_id, start, n_tokens, ids_crc32.

    ``start`` is a running sum over the manifest, which has a row per shard.
    """
    before = Window.orderBy("shard", "seq").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.withColumn("start", F.coalesce(F.sum("tokens").over(before), F.lit(0)))
    all_of = manifest.agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes")).first()
    tasks = min(all_of.n, _tasks(manifest.sparkSession, all_of.bytes or 0))
    return placed.repartition(max(1, tasks)).mapInArrow(_read_shards, "doc_id long, start long, n_tokens long, ids_crc32 long")

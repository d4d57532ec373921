"""Language-model scoring by deleted interpolation of bigrams.

    P(w | u) = l2(b) c(uw)/c(u) + l1(b) c(w)/N + l0(b)/(V + 1),    b = bucket of c(u)

with maximum-likelihood estimates from the training documents and the weights of
each bucket of the context's frequency (powers of two) learnt by expectation
maximisation. For that, a tenth of the training documents is held out, the other
estimates come from the rest, and a histogram of the held-out events over their
probabilities (eighths of an octave) goes to the driver, at most the grid's
cells. The final estimates count all training documents.

Nothing of the corpus' size is broadcast or gathered in one place:

1. tasks cut documents into blocks of ``BLOCK_BYTES`` (those of a training fold
   apart), with a vocabulary and word numbers of their own, written as a table;
2. each block asks for its distinct words and bigrams, once each, by 64-bit
   hash; requests are dealt by ranges of the hash, so a frequent n-gram is one
   entry a block, and a range adds up the counts and answers each block;
3. a block meets its answers and scores its documents.

Defined cases: null and empty texts are one end mark; null ids are training
documents, not held out; repeated rows count each time; without training
documents N and V are 0 and the uniform part remains (log probability 0); an
empty table gives no rows. Only the named columns are read.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded, crc_mod, utf8, written

FOLDS = 10
BLOCK_BYTES = 4 << 20
RANGE_TOKENS = 750_000
MAIN, DELETED, HELD_OUT = 0, 1, 2
END = 0x9E3779B97F4A7C15  # hash of the end mark; no word's text gives it by design
NONE = -(1 << 20)  # histogram cell of probability 0

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
BLOCKS = "block long, part long, kind int, tokens long, data binary"
SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _pack(*arrays: np.ndarray) -> bytes:
    raw = [struct.pack("<B", len(arrays))]
    for a in arrays:
        raw += [struct.pack("<3sQ", a.dtype.str[1:].encode().ljust(3), a.nbytes), a.tobytes()]
    return zstandard.compress(b"".join(raw), 1)


def _unpack(data: bytes) -> list[np.ndarray]:
    raw = zstandard.decompress(data)
    out, at = [], 1
    for _ in range(raw[0]):
        kind, n = struct.unpack_from("<3sQ", raw, at)
        kind = "<" + kind.decode().strip()
        out.append(np.frombuffer(raw, kind, n // np.dtype(kind).itemsize, at + 11))
        at += 11 + n
    return out


def _gaps(keys: np.ndarray) -> list[np.ndarray]:
    """Sorted keys as their gaps in as few bytes as nearly all of them need, and the rest of the few wider ones."""
    d = np.diff(keys, prepend=np.uint64(0))
    bits = np.sort(np.frexp(d.astype(float))[1])
    w = min(8, max(1, -(-int(bits[len(bits) * 99 // 100]) // 8))) if len(d) else 1
    wide = np.flatnonzero(d >> np.uint64(8 * w)) if w < 8 else np.zeros(0, np.int64)
    return [np.array([len(d), w], np.uint32), np.ascontiguousarray(d.view(np.uint8).reshape(-1, 8)[:, :w]).reshape(-1), wide.astype(np.uint32), (d[wide] >> np.uint64(8 * w)).astype(np.uint64) if w < 8 else np.zeros(0, np.uint64)]


def _keys(shape: np.ndarray, low: np.ndarray, wide: np.ndarray, high: np.ndarray) -> np.ndarray:
    n, w = shape.tolist()
    d = np.zeros((n, 8), np.uint8)
    d[:, :w] = low.reshape(n, w)
    d = d.view(np.uint64).reshape(-1)
    if len(wide):
        d[wide] |= high << np.uint64(8 * w)
    return np.cumsum(d, dtype=np.uint64)


def _block(docs: list[tuple[int | None, list[bytes]]]) -> tuple[int, bytes]:
    """(tokens, packed: ids, null flags, lengths, word hashes, word numbers). Number 0 is the end mark."""
    number: dict[bytes, int] = {b"": 0}
    take = number.setdefault
    flat = [take(w, len(number)) for _, ws in docs for w in (*ws, b"")]
    hashes = np.array([END, *map(xxhash.xxh64_intdigest, list(number)[1:])], np.uint64)
    ids = np.array([d or 0 for d, _ in docs], np.int64)
    null = np.array([d is None for d, _ in docs], np.uint8)
    lengths = np.array([len(ws) + 1 for _, ws in docs], np.int64)
    return len(flat), _pack(ids, null, lengths, hashes, np.array(flat, np.uint32))


def _blocks(batches: Iterator[pa.RecordBatch], block_bytes: int) -> Iterator[pa.RecordBatch]:
    part, made = TaskContext.get().partitionId(), 0
    open_: dict[int, list] = {MAIN: [], DELETED: [], HELD_OUT: []}
    size = dict.fromkeys(open_, 0)

    def closed(kind: int) -> pa.RecordBatch:
        nonlocal made
        tokens, data = _block(open_[kind])
        open_[kind], size[kind], made = [], 0, made + 1
        return pa.RecordBatch.from_pydict({"block": pa.array([part << 32 | made], pa.int64()), "part": pa.array([-1], pa.int64()), "kind": pa.array([kind], pa.int32()), "tokens": pa.array([tokens], pa.int64()), "data": pa.array([data], pa.binary())})

    for batch in batches:
        for doc, kind, text in zip(batch.column("k").to_pylist(), batch.column("kind").to_pylist(), utf8(batch, "t"), strict=True):
            open_[kind].append((doc, text.translate(_LOWER).split()))
            size[kind] += len(text) + 8
            if size[kind] >= block_bytes:
                yield closed(kind)
    for kind in open_:
        if open_[kind]:
            yield closed(kind)


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a * np.uint64(0x9E3779B97F4A7C15) + (b ^ b >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(29)


class Block:
    """A block with the keys it asks for: distinct words, then distinct bigrams, each by hash."""

    def __init__(self, data: bytes):
        self.ids, self.null, self.lengths, hashes, w = _unpack(data)
        self.w = w.astype(np.int64)
        self.context = np.concatenate([[0], self.w[:-1]])  # after an end mark comes a document
        pairs, self.pair = np.unique(self.context * len(hashes) + self.w, return_inverse=True)
        self.keys = [hashes, _mix(hashes[pairs // len(hashes)], hashes[pairs % len(hashes)])]
        self.numbers = [self.w, self.pair]
        self.order = [np.argsort(k) for k in self.keys]

    def requests(self, ranges: int) -> Iterator[tuple[int, bytes]]:
        counts = [np.bincount(n, minlength=len(k)).astype(np.uint32) for n, k in zip(self.numbers, self.keys, strict=True)]
        keys = [k[o] for k, o in zip(self.keys, self.order, strict=True)]
        cuts = [np.searchsorted(range_of(k, ranges), np.arange(ranges + 1)) for k in keys]
        for p in range(ranges):
            some = [slice(c[p], c[p + 1]) for c in cuts]
            if any(s.stop > s.start for s in some):
                yield p, _pack(*(x for k, n, o, s in zip(keys, counts, self.order, some, strict=True) for x in (*_gaps(k[s]), n[o][s])))

    def answered(self, answers: list[tuple[int, bytes]]) -> list[np.ndarray]:
        """Counts of words and bigrams in the block's own numbering."""
        got = [_unpack(a) for _, a in sorted(answers)]
        out = []
        for i, o in enumerate(self.order):
            c = np.empty(len(o), np.int64)
            c[o] = np.concatenate([g[i] for g in got])
            out.append(c)
        return out


def range_of(keys: np.ndarray, ranges: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)


def _ask(batches: Iterator[pa.RecordBatch], ranges: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block, kind, data in zip(batch.column("block").to_pylist(), batch.column("kind").to_pylist(), batch.column("data").to_pylist(), strict=True):
            got = list(Block(data).requests(ranges))
            yield pa.RecordBatch.from_pydict({"block": pa.array([block] * len(got), pa.int64()), "part": pa.array([p for p, _ in got], pa.int64()), "kind": pa.array([kind] * len(got), pa.int32()), "tokens": pa.array([0] * len(got), pa.int64()), "data": pa.array([d for _, d in got], pa.binary())})


def _answer(group: pa.Table) -> pa.Table:
    """All requests of a range: totals over the main and over all training documents.

    The rows of block -1 and -2 carry the words (as part) and distinct words
    (as tokens) of all training and of the main documents.
    """
    blocks, kinds = group.column("block").to_pylist(), group.column("kind").to_pylist()
    asked = [[x for i in (0, 5) for x in (_keys(*a[i : i + 4]), a[i + 4])] for a in map(_unpack, group.column("data").to_pylist())]
    part = group.column("part")[0].as_py()
    whole: list[list[np.ndarray]] = [[] for _ in blocks]
    main: list[list[np.ndarray]] = [[] for _ in blocks]
    sums = []
    for i in (0, 2):
        sizes = [len(a[i]) for a in asked]
        _, inv = np.unique(np.concatenate([a[i] for a in asked]), return_inverse=True)
        n, kind = np.concatenate([a[i + 1] for a in asked]).astype(float), np.repeat(kinds, sizes)
        for to, own in ((whole, kind != HELD_OUT), (main, kind == MAIN)):
            total = np.bincount(inv, n * own).astype(np.int64)
            if not i:
                sums.append((int(total.sum()), int((total > 0).sum())))
            for j, c in enumerate(np.split(total[inv], np.cumsum(sizes)[:-1])):
                to[j].append(c.astype(np.uint64 if len(c) and c.max() >> 32 else np.uint32))
    rows = [(b, part, k, 0, _pack(*w)) for b, k, w in zip(blocks, kinds, whole, strict=True)]
    rows += [(b, part, MAIN, 0, _pack(*m)) for b, k, m in zip(blocks, kinds, main, strict=True) if k == DELETED]  # kind MAIN: for the weights
    rows += [(-1 - i, n, 0, v, b"") for i, (n, v) in enumerate(sums)]
    cols = list(zip(*rows, strict=True))
    return pa.table({"block": pa.array(cols[0], pa.int64()), "part": pa.array(cols[1], pa.int64()), "kind": pa.array(cols[2], pa.int32()), "tokens": pa.array(cols[3], pa.int64()), "data": pa.array(cols[4], pa.binary())})


def bucket(c: np.ndarray) -> np.ndarray:
    """0 for a context never seen, else one more than the whole part of its binary logarithm."""
    return np.frexp(c.astype(float))[1].astype(np.int64)


def _parts(c: list[np.ndarray], block: Block, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket, P2, P1) of each token."""
    u = c[0][block.context]
    return bucket(u), c[1][block.pair] / np.maximum(u, 1), c[0][block.w] / max(n, 1)


def _split(group: pa.Table) -> tuple[bytes, int, list[tuple[int, bytes]], list[tuple[int, bytes]]]:
    part, kind, data = (group.column(x).to_pylist() for x in ("part", "kind", "data"))
    own = part.index(-1)
    answers = [(p, k, d) for p, k, d in zip(part, kind, data, strict=True) if p >= 0]
    return data[own], kind[own], [(p, d) for p, k, d in answers if k == kind[own]], [(p, d) for p, k, d in answers if k != kind[own]]


def _cells(p: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        return np.where(p > 0, np.round(8 * np.log2(np.where(p > 0, p, 1))), NONE).astype(np.int64)


def _histogram(group: pa.Table, n: int) -> pa.Table:
    data, _, _, answers = _split(group)
    block = Block(data)
    b, p2, p1 = _parts(block.answered(answers), block, n)
    cells, count = np.unique(np.stack([b, _cells(p2), _cells(p1)], 1), axis=0, return_counts=True)
    return pa.table({"b": cells[:, 0], "q2": cells[:, 1], "q1": cells[:, 2], "n": count.astype(np.int64)})


def learn(cells: np.ndarray, distinct: int, steps: int = 60) -> np.ndarray:
    """Mixture weights (bucket, order 0..2) from rows (bucket, cell of P2, cell of P1, count).

    A bucket with fewer than 50 events takes the weights of all events.
    """
    weights = np.tile([0.2, 0.4, 0.4], (65, 1))

    def em(rows: np.ndarray, seen: bool) -> np.ndarray:
        p = np.stack([np.full(len(rows), 1 / (distinct + 1)), *(np.where(rows[:, i] == NONE, 0, np.exp2(rows[:, i] / 8)) for i in (2, 1))], 1)
        w = np.array([0.2, 0.4, 0.4]) if seen else np.array([0.5, 0.5, 0.0])
        for _ in range(steps):
            post = p * w
            post *= (rows[:, 3] / np.maximum(post.sum(1), 1e-300))[:, None]
            w = post.sum(0) / post.sum()
        w = np.maximum(w, [1e-6, 1e-6, 1e-6 if seen else 0])
        return w / w.sum()

    if len(cells):
        old = cells[cells[:, 0] > 0]
        weights[:] = em(old, True) if len(old) else weights[0]
        for b in np.unique(cells[:, 0]).tolist():
            rows = cells[cells[:, 0] == b]
            if rows[:, 3].sum() >= 50:
                weights[b] = em(rows, b > 0)
    if weights[0, 2]:
        weights[0] = [weights[0, 0] + weights[0, 2] / 2, weights[0, 1] + weights[0, 2] / 2, 0]
    return weights


def _score(group: pa.Table, n: int, v: int, weights: np.ndarray) -> pa.Table:
    data, kind, answers, _ = _split(group)
    block = Block(data)
    c = block.answered(answers)
    b, p2, p1 = _parts(c, block, n)
    w = weights[b] if n else np.tile([1.0, 0.0, 0.0], (len(b), 1))
    token = np.log10(w[:, 0] / (v + 1) + w[:, 1] * p1 + w[:, 2] * p2)
    own = c[0][block.w]
    base = np.log10((own + 0.1) / (n + 0.1 * (v + 1)))
    starts = np.concatenate([[0], np.cumsum(block.lengths)[:-1]])
    ids = pa.array(block.ids, pa.int64(), mask=block.null.astype(bool))
    docs = len(block.ids)
    return pa.table({"doc_id": ids, "held_out": pa.array([kind == HELD_OUT] * docs), "n_tokens": block.lengths, "n_known": np.add.reduceat((own > 0).astype(np.int64), starts), "train_tokens": np.full(docs, n, np.int64), "base_score": np.add.reduceat(base, starts), "score": np.add.reduceat(token, starts)})


def scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = FOLDS, block_bytes: int = BLOCK_BYTES, range_tokens: int = RANGE_TOKENS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    fold = crc_mod("k", folds)
    rows = docs.select(F.col(id_col).cast("long").alias("k"), F.col(text_col).alias("t"))
    rows = rows.select("k", "t", F.when(fold == 0, HELD_OUT).when(fold == 1, DELETED).otherwise(MAIN).alias("kind"))
    blocks = written(bounded(rows).mapInArrow(partial(_blocks, block_bytes=block_bytes), BLOCKS), "lm-blocks")
    tokens, n_blocks = blocks.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.count(F.lit(1))).first()
    ranges = max(1, -(-tokens // range_tokens))
    asked = bounded(blocks).mapInArrow(partial(_ask, ranges=ranges), BLOCKS)
    # As many partitions as there are ranges, then blocks: a task's share does not grow with the corpus.
    answers = written(asked.repartition(ranges, "part").groupBy("part").applyInArrow(_answer, BLOCKS), "lm-answers")
    sums = {r.block: (r.n, r.v) for r in answers.filter("block < 0").groupBy("block").agg(F.sum("part").alias("n"), F.sum("tokens").alias("v")).collect()}
    (n, v), (main_n, main_v) = sums.get(-1, (0, 0)), sums.get(-2, (0, 0))
    held = blocks.filter(F.col("kind") == DELETED)
    held = held.unionByName(answers.filter("block >= 0 AND kind = 0").join(held.select("block"), "block", "left_semi"))
    cells = held.groupBy("block").applyInArrow(lambda g: _histogram(g, main_n), "b long, q2 long, q1 long, n long").groupBy("b", "q2", "q1").agg(F.sum("n").alias("n")).orderBy("b", "q2", "q1").collect()
    weights = learn(np.array([tuple(r) for r in cells], np.int64).reshape(-1, 4), main_v)
    both = blocks.unionByName(answers.filter("block >= 0")).repartition(max(1, n_blocks // 2), "block")
    return both.groupBy("block").applyInArrow(lambda g: _score(g, n, v, weights), SCORES)

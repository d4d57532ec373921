"""Toxicity by a factorization machine over hashed terms.

A text's features are the hash buckets of its distinct words and of the first
five bytes of longer words, present or not. The machine scores

    w0 + sum_i w_i + sum_{i<j} <v_i, v_j>      (over the features present)

through a sigmoid, so a pair of terms can count for more, or less, than both
alone. It learns on the driver from at most ``per_class`` labelled rows of each
class (chosen by the hash of the identifier; one text an id), on the ``features``
buckets that say most about the label in that sample (likelihood ratio) and on
those of pairs that say far more together than alone; the others weigh nothing.
Scoring reads every whole text.

Defined cases: null and empty texts have no features and get the score of the
bias; null ids are scored, not held out; repeated documents get a row each;
labels that are null or not 0/1 and repeated labels of an id add nothing but
their least value, repeated documents of a labelled id their least text; with no labelled rows of both classes every score is the base
rate (0 without labels). Labels, language, source and id are no inputs of a score.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, map_batches, utf8
from .wumanber import words

BITS = 28
PER_CLASS = 3000
FEATURES = 256
FACTORS = 4
PAIR_TERMS = 2000
PAIR_GAIN = 60.0
ENOUGH = 0.95
THRESHOLD = 0.7
_MASK = (1 << BITS) - 1


def terms(text: bytes) -> set[int]:
    """Hash buckets of a text."""
    ws = set(words(text))
    heads = {w[:5] + b"\0" for w in ws if len(w) > 5}
    return {h & _MASK for h in map(zlib.crc32, ws | heads)}


@dataclass
class Machine:
    bias: float
    buckets: np.ndarray  # int64, sorted
    w: np.ndarray
    v: np.ndarray

    def __post_init__(self):
        self.at = {b: i for i, b in enumerate(self.buckets.tolist())}

    def score(self, features: set[int]) -> float:
        on = [self.at[b] for b in features & self.at.keys()]
        z = self.bias
        if on:
            v = self.v[on]
            s = v.sum(0)
            z += float(self.w[on].sum() + (s @ s - (v * v).sum()) / 2)
        return float(1 / (1 + np.exp(-np.clip(z, -40, 40))))


def _surprise(seen: np.ndarray, total: np.ndarray, toxic: int, n: int) -> np.ndarray:
    """Twice the log likelihood ratio of presence and label: seen of the toxic rows and total of all n have it."""
    g = np.zeros(np.shape(seen))
    for cell, row, column in ((seen, total, toxic), (total - seen, total, n - toxic), (toxic - seen, n - total, toxic), (n - toxic - total + seen, n - total, n - toxic)):
        with np.errstate(divide="ignore", invalid="ignore"):
            g += np.where(cell > 0, 2 * cell * np.log(cell * n / (row * column)), 0)
    return g


def _telling_pairs(x: np.ndarray, y: np.ndarray, alone: np.ndarray, most: int) -> np.ndarray:
    """Columns of x of the pairs whose presence together says far more about the label than either alone."""
    toxic, n = int(y.sum()), len(y)
    together, all_ = x[y > 0].T @ x[y > 0], x.T @ x
    gain = _surprise(together, all_, toxic, n) - np.maximum(alone[:, None], alone[None, :])
    gain[(all_ < 5) | np.tri(len(alone), dtype=bool)] = 0
    best = np.argsort(-gain, axis=None, kind="stable")[:most]
    i, j = np.unravel_index(best[gain.reshape(-1)[best] > PAIR_GAIN], gain.shape)
    return np.unique(np.concatenate([i, j]))


def fit(rows: list[tuple[np.ndarray, int]], features: int = FEATURES, factors: int = FACTORS, steps: int = 300, penalty: float = 1e-4) -> Machine:
    """rows: (sorted buckets of a text, its label).

    The machine's buckets are those that say most about the label alone, and
    those of the pairs of the ``PAIR_TERMS`` buckets with most toxic rows that
    together say far more than alone. Where single terms are toxic in more than
    ``ENOUGH`` of their rows, each toxic row that has one is learnt from once
    more with three in ten of its features and one such term at least, so that
    one suffices; where only pairs tell, no row is.
    """
    y = np.array([r[1] for r in rows], np.float32)
    none = np.zeros(0)
    if not len(y) or y.min() == y.max():
        p = float(y.mean()) if len(y) else 0.0
        return Machine(40.0 if p >= 1 else -40.0, none.astype(np.int64), none, np.zeros((0, factors)))
    at = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])
    b, inv = np.unique(np.concatenate([r[0] for r in rows]), return_inverse=True)
    one, all_ = np.bincount(inv, y[at], len(b)), np.bincount(inv, minlength=len(b)).astype(float)
    n1, n = y.sum(), len(y)

    def columns(keep: np.ndarray) -> np.ndarray:
        slot = np.full(len(b), -1)
        slot[keep] = np.arange(len(keep))
        x = np.zeros((n, len(keep)), np.float32)
        own = slot[inv] >= 0
        x[at[own], slot[inv[own]]] = 1
        return x

    g = _surprise(one, all_, n1, n)
    g[all_ < 3] = 0
    keep = np.lexsort((b, -g))[:features]
    alone = keep = keep[g[keep] > 15]
    if factors:
        often = np.lexsort((b, -one))[:PAIR_TERMS]
        keep = np.union1d(keep, often[_telling_pairs(columns(often), y, g[often], features)])
    keep = np.sort(keep)
    x = columns(keep)
    rng = np.random.default_rng(7)
    telling = one[keep] / all_[keep] > ENOUGH
    thin = x[y > 0] * (rng.random((int(n1), len(keep))) < 0.3) * np.isin(keep, alone)
    thin = thin[thin[:, telling].any(1)].astype(np.float32)
    x, y = np.concatenate([x, thin]), np.concatenate([y, np.ones(len(thin), np.float32)])
    n, n1 = len(y), y.sum()
    p = {"c": np.zeros(1, np.float32), "w": np.zeros(len(keep), np.float32), "v": rng.normal(0, 0.05, (len(keep), factors)).astype(np.float32)}
    m, q = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    weight = np.where(y > 0, n / (2 * n1), n / (2 * (n - n1))).astype(np.float32)
    xt = np.ascontiguousarray(x.T)
    for t in range(1, steps + 1):
        by = x @ np.column_stack([p["w"] - (p["v"] ** 2).sum(1) / 2, p["v"]])
        s = by[:, 1:]
        z = p["c"] + by[:, 0] + (s * s).sum(1) / 2
        e = (weight * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / n).astype(np.float32)
        xe = xt @ np.column_stack([e, e[:, None] * s])
        grad = {"c": np.array([e.sum()]), "w": xe[:, 0] + penalty * p["w"], "v": xe[:, 1:] - p["v"] * xe[:, :1] + penalty * p["v"]}
        for k in p:
            m[k] = 0.9 * m[k] + 0.1 * grad[k]
            q[k] = 0.99 * q[k] + 0.01 * grad[k] ** 2
            p[k] = (p[k] - 0.08 * (m[k] / (1 - 0.9**t)) / (np.sqrt(q[k] / (1 - 0.99**t)) + 1e-8)).astype(np.float32)
    return Machine(float(p["c"][0]), b[keep], p["w"].astype(float), p["v"].astype(float))


def sample(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", held_out: int = 1, folds: int = 3) -> list[tuple[np.ndarray, int]]:
    """At most per_class training rows of each class as (buckets, label)."""
    known = labels.select(F.col(id_col).cast("long").alias("k"), F.col(label_col).cast("int").alias("y")).filter((crc_mod("k", folds) != held_out) & F.col("y").isin(0, 1))
    known = known.groupBy("k").agg(F.min("y").alias("y"))
    picked = [r for y in (1, 0) for r in known.filter(F.col("y") == y).orderBy(F.xxhash64("k"), "k").limit(per_class).collect()]
    if not picked:
        return []
    label = {r.k: r.y for r in picked}
    chosen = F.broadcast(docs.sparkSession.createDataFrame([(k,) for k in label], "k long"))  # at most 2 * per_class rows

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([batch.column("k"), pa.array([np.array(sorted(terms(x)), "<i4").tobytes() for x in utf8(batch, "t")], pa.binary())], ["k", "b"])

    texts = docs.select(F.col(id_col).cast("long").alias("k"), F.col(text_col).alias("t")).join(chosen, "k", "left_semi")
    texts = texts.groupBy("k").agg(F.min("t").alias("t"))  # one text an id
    got = map_batches(texts, run, "k long, b binary").collect()
    return [(np.frombuffer(r.b, "<i4").astype(np.int64), label[r.k]) for r in sorted(got, key=lambda r: (r.k, bytes(r.b)))]


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, **how) -> Machine:
    return fit(sample(docs, labels, per_class, **how))


def scored(docs: DataFrame, machine: Machine, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """The rows of ``docs`` with ``score_col`` (replacing a column of that name)."""
    docs = docs.withColumn(score_col, F.lit(0.0))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = pa.array([machine.score(terms(x)) for x in utf8(batch, text_col)], pa.float64())
        return pa.RecordBatch.from_pydict({k: made if k == score_col else batch.column(k) for k in batch.schema.names})

    return map_batches(docs, run, docs.schema)


def report(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    machine = train(docs, labels, id_col=id_col, text_col=text_col, **how)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return scored(rows, machine).select("doc_id", F.coalesce(crc_mod("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))

"""Periodic runs of words, found by blocks matched over integer sequences.

A run is a stretch of words with smallest period q, of at least
max(``least``, ``exponent`` * q) words, that no neighbouring word extends. For
each power of two B the text is cut into aligned blocks of B words. A run with
B <= q < 2B holds a whole aligned block within its first 2B - 1 words, and that
block's copy q words on. So the blocks become keys of an Aho-Corasick automaton
over word numbers, the text is searched for them, and an occurrence B to 2B - 1
words behind its block seeds an exact extension in both directions.

The work is near n log n, whatever repeats: keys of one scale are equally long, so
each place has one occurrence at most, and one block that it can be paired with;
blocks take part only if each of their words comes again within 2B - 1 words, and
the search covers only what can hold their copies; seeds within a known run of
period up to B, or within a stretch that was extended already, add nothing
(two periods of a stretch as long as both have their divisor as a period).

Defined cases: null and empty texts have no words, no runs and an empty collapsed
text; repeated rows are answered row by row; all other columns stay, columns named
as the results are replaced; an empty table gives no rows. A document is one task's
work, in memory linear in its words.
"""

from __future__ import annotations

from collections.abc import Callable

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, utf8

LEAST = 6
EXPONENT = 4
RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"
_ARROW = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
_STEP = 64
_PIECES = 8


def numbered(words: list[bytes]) -> np.ndarray:
    """Equal words get equal numbers."""
    seen: dict[bytes, int] = {}
    return np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))


def _until_next(ids: np.ndarray) -> np.ndarray:
    """Words until the same word comes again; more than the text has where it does not."""
    order = np.argsort(ids, kind="stable")
    same = ids[order[1:]] == ids[order[:-1]]
    out = np.full(len(ids), 2 * len(ids), np.int64)
    out[order[:-1][same]] = np.diff(order)[same]
    return out


def _equal_ahead(ids: np.ndarray, i: int, j: int) -> int:
    """How many words from i on equal those from j on (i < j)."""
    n, step, got = len(ids) - j, _STEP, 0
    while got < n:
        end = min(got + step, n)
        differ = ids[i + got : i + end] != ids[j + got : j + end]
        if differ.any():
            return got + int(differ.argmax())
        got, step = end, 2 * step
    return n


def _equal_behind(ids: np.ndarray, i: int, j: int) -> int:
    """How many words before i equal those before j (i < j)."""
    step, got = _STEP, 0
    while got < i:
        end = min(got + step, i)
        differ = (ids[i - end : i - got] != ids[j - end : j - got])[::-1]
        if differ.any():
            return got + int(differ.argmax())
        got, step = end, 2 * step
    return i


def _divisors(q: int) -> list[int]:
    """q by each of its primes: if the smallest period divides q and is none of q's own, one of these is a period."""
    out, rest, p = [], q, 2
    while rest > 1:
        p = p if p * p <= rest else rest
        if rest % p == 0:
            out.append(q // p)
            while rest % p == 0:
                rest //= p
        p += 1
    return out


def _names(ids: np.ndarray, size: int) -> np.ndarray:
    """A number below 2^31 for the ``size`` (a power of two) words from each place on; equal words get equal numbers, and hardly any others do."""
    if size == 1:
        return ids
    h = ids.astype(np.uint64)
    half = 1
    while half < size:
        h = (h[:-half] * np.uint64(0x9E3779B97F4A7C15)) ^ (h[half:] + np.uint64(0x632BE59BD9B4E019))
        h = (h ^ h >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
        half *= 2
    return (h >> np.uint64(33)).astype(np.int64)


def _seeds(ids: np.ndarray, blocks: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of aligned blocks, ascending, and how far behind them (size to 2 * size - 1 words) what looks like a copy starts.

    A long block is a key of ``_PIECES`` numbers, one a piece of its words, since a
    key that resembles its own tails costs their number at each place of the text.
    """
    stride = max(1, size // _PIECES)
    starts = blocks * size
    cuts = np.flatnonzero(starts[1:] > starts[:-1] + 3 * size) + 1
    spans = list(zip(starts[np.concatenate([[0], cuts])].tolist(), starts[np.concatenate([cuts - 1, [-1]])].tolist(), strict=True))
    names = [_names(ids[a : b + 3 * size], stride) for a, b in spans]
    number: dict[tuple[int, ...], int] = {}
    key_of = np.full(len(ids) // size + 1, -1)
    found = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
    at = 0
    for b in blocks.tolist():
        at += b * size > spans[at][1]
        key = tuple(names[at][b * size - spans[at][0] :][:size:stride].tolist())
        if key not in number:
            number[key] = len(number)
            found.add_word(key, number[key])
        key_of[b] = number[key]
    found.make_automaton()
    ends, keys = [], []
    for (first, _), name in zip(spans, names, strict=True):
        for r in range(min(stride, len(name))):
            for end, key in found.iter(tuple(name[r::stride].tolist())):
                ends.append(first + r + (end + 1) * stride)
                keys.append(key)
    copy = np.array(ends, np.int64) - size
    block = copy // size - 1  # the one aligned place in (copy - 2 * size, copy - size]
    own = (block >= 0) & (key_of[block] == np.array(keys, np.int64))
    at, copy = block[own] * size, copy[own]
    order = np.argsort(copy, kind="stable")
    return at[order], (copy - at)[order]


def runs(ids: np.ndarray, least: int = LEAST, exponent: int = EXPONENT) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, by start, then period. exponent: 3 or more."""
    if exponent < 3:
        raise ValueError("a run of fewer than three periods need not hold a whole block and its copy")
    n, size, out = len(ids), 1, []
    if n < max(least, exponent):
        return out
    longest = _until_next(ids)
    reach = np.zeros(n, np.int64)  # the furthest end of known runs that start here or before
    while size * exponent <= n:
        if size > 1:  # the most of each block of this scale, from the halves
            longest = longest[: len(longest) // 2 * 2].reshape(-1, 2).max(1)
        blocks = np.flatnonzero(longest < 2 * size)
        blocks = blocks[reach[blocks * size] < np.minimum(blocks * size + 3 * size, n)]
        known = len(out)
        done: dict[int, int] = {}
        ats, qs = _seeds(ids, blocks, size) if len(blocks) else (blocks, blocks)
        new = reach[ats] < ats + qs + size
        for at, q in zip(ats[new].tolist(), qs[new].tolist(), strict=True):
            if done.get(q, 0) >= at + q + size:
                continue
            end = at + q + _equal_ahead(ids, at, at + q)
            if end < at + q + size:
                continue
            done[q] = end
            start = at - _equal_behind(ids, at, at + q)
            if end - start >= max(least, exponent * q) and not any((ids[start : end - d] == ids[start + d : end]).all() for d in _divisors(q)):
                out.append((start, end - start, q))
        for start, length, _ in out[known:]:
            reach[start] = max(reach[start], start + length)
        if len(out) > known:
            np.maximum.accumulate(reach, out=reach)
        size *= 2
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(words: list[bytes], found: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that a run holds after its first period."""
    if not found:
        return words
    step = np.zeros(len(words) + 1, np.int64)
    for start, length, q in found:
        step[start + q] += 1
        step[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(step[:-1]) == 0).tolist()]


def with_runs(
    docs: DataFrame, text_col: str = "text", runs_col: str = "runs", collapsed_col: str = "collapsed", least: int = LEAST, exponent: int = EXPONENT, before: Callable[[object, list[bytes]], list[bytes]] | None = None, before_col: str | None = None
) -> DataFrame:
    """The rows with their runs and the text without the repeated words, joined by one space.

    before: gives the words to search from the value of ``before_col`` and the text's words.
    """
    docs = docs.withColumn(runs_col, F.lit(None).cast(RUNS)).withColumn(collapsed_col, F.lit(""))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found, kept = [], []
        keys = batch.column(before_col).to_pylist() if before else [None] * batch.num_rows
        for key, text in zip(keys, utf8(batch, text_col), strict=True):
            words = text.split()  # bytes are split at \x20 and \x09 to \x0D alone
            if before:
                words = before(key, words)
            got = runs(numbered(words), least, exponent)
            found.append([{"start": s, "length": n, "period": q} for s, n, q in got])
            kept.append(b" ".join(collapsed(words, got)))
        made = {runs_col: pa.array(found, _ARROW), collapsed_col: pa.array(kept, pa.binary()).cast(pa.string())}
        return pa.RecordBatch.from_pydict({k: made.get(k, batch.column(k)) for k in batch.schema.names})

    return map_batches(docs, run, docs.schema)


def strongest(runs_col: str) -> F.Column:
    """The run of greatest length by period; of equal ones the first, then that of the smallest period. Null without runs."""
    none = F.lit(None).cast(RUNS.removeprefix("array<")[:-1])
    return F.aggregate(runs_col, none, lambda best, r: F.when(best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best))


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", before: Callable[[object, list[bytes]], list[bytes]] | None = None, **how) -> DataFrame:
    """doc_id, n_runs, the strongest run and digests of all runs and of the collapsed text."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = with_runs(rows, before=before, before_col="doc_id", **how).withColumn("best", strongest("runs"))
    lines = F.transform("runs", lambda r: F.concat_ws("", F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return rows.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *(F.col(f"best.{k}").alias(k) for k in ("start", "length", "period")),
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )

"""SimHash near-duplicates by a byte-position inverted index with count filtering.

A fingerprint has eight bytes. Two that differ in at most four bits differ in
at most four bytes, so they share at least four of the eight positional bytes:
the guaranteed minimum. Of any seven positions they then share at least three,
so the index lists each distinct fingerprint under all triples of its first
seven positional bytes (35 composite postings; single bytes would make lists of
1/256 of the corpus). Other distances have keys of their own: pairs for five
bits, single bytes for six and seven; there is none for eight or more. Within a posting list the shared positional bytes of a
pair are tallied, pairs below the minimum are dropped, and the rest is verified
by its differing bits.

No list emits its pairs: it gives a spanning forest of its links, found by
growing components against what is not yet linked, so a dense list costs little
more than its length. A list of more than ``split_over`` fingerprints is dealt out
again: by each of its other bytes, of which a pair must share one more, and lists
that are still too long by triples of the half bytes that are not yet fixed, of
which a pair at four bits shares four of eight. What is left there differs in 20
bits, so the longest list has 2^20 fingerprints and few components, whatever the
corpus (at other distances the last lists have no such bound). Very long lists are
seen beforehand in a sample by hash of the fingerprints and never gathered; a list
that the sample misses is passed on, entry by entry, by the task that meets it.

Components come from rounds of large-star and small-star links over the forest's
edges, as tables; links never come to the driver. Fingerprints are the nodes.

Defined cases: null and empty texts have fingerprint zero and link like any
other; repeated identifiers keep their rows; a null identifier gets no say in
component ids, but its fingerprint links others (its row takes the id of its
component, null if no row there has one); an empty table gives no rows. Only the
named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded, discard, map_batches, utf8, written

SHINGLE = 4
DISTANCE = 4
SPLIT_OVER = 20_000
SAMPLE = 64
HOT_LISTS = 1_000_000
INDEX_ROWS = 20_000
DEALT, LAST = 1 << 62, -1 << 63  # marks of keys with one more byte, and of those by half bytes
TRIPLES = list(combinations(range(7), 3))


def positions(distance: int) -> list[tuple[int, ...]]:
    """The byte positions of the index keys: two fingerprints within the distance share all bytes of one of them."""
    if not 0 <= distance <= 7:
        raise ValueError(f"no bytes are sure to be shared at distance {distance}")
    return TRIPLES if distance <= 4 else list(combinations(range(7), 7 - distance)) if distance < 7 else list(combinations(range(8), 1))


_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    ws = text.translate(_LOWER).split()
    if not ws:
        return 0
    line = b" ".join(ws)
    if len(ws) <= shingle:
        return xxhash.xxh64_intdigest(line, 42)
    ends = np.cumsum(np.fromiter(map(len, ws), np.int64, len(ws)) + 1)
    starts = [0, *ends[: -shingle].tolist()]
    h64 = xxhash.xxh64_intdigest
    h = np.array([h64(line[a:b], 42) for a, b in zip(starts, (ends[shingle - 1 :] - 1).tolist(), strict=True)], "<u8")
    bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(bits * 2 > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, hashes: bool = False) -> DataFrame:
    """doc_id and fp, the fingerprint as a signed long, for each row; also h, Spark's xxhash64 of its text, on request."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        seen: dict[bytes, int] = {}
        out = []
        for text in utf8(batch, "t"):
            if text not in seen:
                seen[text] = fingerprint(text, shingle)
            out.append(seen[text])
        more = {"h": batch.column("h")} if hashes else {}
        return pa.RecordBatch.from_pydict({"doc_id": batch.column("k"), "fp": pa.array(np.array(out, "<u8").view("<i8"))} | more)

    more = [F.xxhash64(text_col).alias("h")] if hashes else []
    return map_batches(docs.select(F.col(id_col).cast("long").alias("k"), F.col(text_col).alias("t"), *more), run, "doc_id long, fp long" + ", h long" * hashes)


def _bytes(fp: np.ndarray) -> np.ndarray:
    return fp.view(np.uint8).reshape(-1, 8).astype(np.int64)


def _first_keys(fp: np.ndarray, places: list[tuple[int, ...]]) -> np.ndarray:
    """The key of each fingerprint at each place, place by place."""
    b = _bytes(fp)
    return np.concatenate([n << 24 | sum(b[:, p] << 8 * i for i, p in enumerate(reversed(at))) for n, at in enumerate(places)])


def _deal(key: np.ndarray, fp: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Longer keys for the entries of hot lists: one more byte, each of the others in turn; after that triples of free half bytes."""
    places, b = positions(distance), _bytes(fp)
    fixed = np.zeros((len(key), 8), bool)
    once = key >= DEALT
    place = np.where(once, key >> 16 & (1 << 30) - 1, key) >> 24
    for n, at in enumerate(places):
        fixed[np.ix_(place == n, list(at))] = True
    keys, fps = [], []
    more = ~once if distance < 7 else np.zeros(len(key), bool)
    for p in range(8):
        on = more & ~fixed[:, p]
        keys.append(DEALT | key[on] << 16 | p << 8 | b[on, p])
        fps.append(fp[on])
    if (~more).any():
        key, fp, b, fixed = key[~more], fp[~more], b[~more], fixed[~more]
        if distance < 7:
            fixed[np.arange(len(key)), key >> 8 & 255] = True
        free = np.argsort(fixed, axis=1, kind="stable")[:, : 8 - int(fixed[0].sum())]
        value = np.take_along_axis(b, free, 1)
        half = np.stack([value >> 4, value & 15], 2).reshape(len(key), -1)
        for n, at in enumerate(combinations(range(distance + 3), 3)):
            h = (key.view(np.uint64) ^ np.uint64(n << 50)) * np.uint64(0x9E3779B97F4A7C15)  # lists that share a hash are verified like any
            h = (h ^ h >> np.uint64(29) ^ (half[:, at[0]] << 8 | half[:, at[1]] << 4 | half[:, at[2]]).view(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
            keys.append((h ^ h >> np.uint64(32) | np.uint64(1 << 63)).view(np.int64))
            fps.append(fp)
    return np.concatenate(keys), np.concatenate(fps)


def _entries(fp: np.ndarray, distance: int, hot: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(key, fp) of all posting lists; the entries of lists known as hot are dealt out at once."""
    places = positions(distance)
    key, fps = _first_keys(fp, places), np.tile(fp, len(places))
    for h in hot:
        if (on := np.isin(key, h)).any():
            more = _deal(key[on], fps[on], distance)
            key, fps = np.concatenate([key[~on], more[0]]), np.concatenate([fps[~on], more[1]])
    return key, fps


def _near(one: np.uint64, many: np.ndarray, distance: int) -> np.ndarray:
    """Which of many link with one: tally of shared positional bytes, then the bits."""
    x = many ^ one
    shared = (x.view(np.uint8).reshape(-1, 8) == 0).sum(1)
    near = shared >= 8 - distance
    near[near] = np.bitwise_count(x[near]) <= distance
    return near


def forest(fp: np.ndarray, distance: int = DISTANCE) -> list[tuple[int, int]]:
    """Links of a spanning forest of one posting list, as places in it."""
    out, left = [], np.arange(len(fp))
    while len(left) > 1:
        grow, left = [int(left[0])], left[1:]
        while grow and len(left):
            at = grow.pop()
            near = _near(fp[at], fp[left], distance)
            if near.any():
                got = left[near].tolist()
                out += [(at, g) for g in got]
                grow += got
                left = left[~near]
    return out


def _linked(key: np.ndarray, fp: np.ndarray, distance: int) -> pa.RecordBatch:
    """Links of whole lists, sorted by key."""
    u = fp.view(np.uint64)
    cuts = np.flatnonzero(np.diff(key)) + 1
    starts, ends = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(key)]])
    size = ends - starts
    two = starts[size == 2]
    x = u[two] ^ u[two + 1]
    near = (x.view(np.uint8).reshape(-1, 8) == 0).sum(1) >= 8 - distance
    near &= np.bitwise_count(x) <= distance
    a, b = [two[near]], [two[near] + 1]
    for s, e in zip(starts[size > 2].tolist(), ends[size > 2].tolist(), strict=True):
        if pairs := forest(u[s:e], distance):
            i, j = zip(*pairs, strict=True)
            a.append(np.array(i, np.int64) + s)
            b.append(np.array(j, np.int64) + s)
    a, b = fp[np.concatenate(a)], fp[np.concatenate(b)]
    e = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], 1), axis=0)
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(e), None, object), pa.int64()), pa.array(e[:, 0]), pa.array(e[:, 1])], ["key", "a", "b"])


def _links(batches: Iterator[pa.RecordBatch], distance: int, split_over: int) -> Iterator[pa.RecordBatch]:
    """Rows (key, fp) sorted by key; lists may go on in the next batch. Gives links (a, b), and with its key each entry (as a and b) of a list to be dealt out."""
    rest, passing = [np.empty(0, np.int64)] * 2, None

    def passed(key: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(key), pa.array(fp), pa.array(fp)], ["key", "a", "b"])

    for batch in batches:
        key, fp = (np.concatenate([r, batch.column(i).to_numpy()]) for i, r in enumerate(rest))
        if passing is not None and (n := int(np.searchsorted(key, passing, "right"))):
            yield passed(key[:n], fp[:n])
            key, fp = key[n:], fp[n:]
        if not len(key):
            rest = [key, fp]
            continue
        cut = int(np.searchsorted(key, key[-1]))
        if cut:
            yield from _lists(key[:cut], fp[:cut], distance, split_over, passed)
        if len(key) - cut > split_over and key[-1] >= 0:
            yield passed(key[cut:], fp[cut:])
            passing, key, fp, cut = int(key[-1]), key[:0], fp[:0], 0
        rest = [key[cut:], fp[cut:]]
    if len(rest[0]) > 1:
        yield from _lists(*rest, distance, split_over, passed)


def _lists(key: np.ndarray, fp: np.ndarray, distance: int, split_over: int, passed) -> Iterator[pa.RecordBatch]:
    """Links of the lists that are short enough or of the last kind, and the entries of the others."""
    _, inv, size = np.unique(key, return_inverse=True, return_counts=True)
    long = (size[inv] > split_over) & (key >= 0)
    if long.any():
        yield passed(key[long], fp[long])
    if not long.all():
        yield _linked(key[~long], fp[~long], distance)


def _hot(prints: DataFrame, n: int, distance: int, split_over: int, sample: int) -> list[np.ndarray]:
    """Keys of lists that look hot in a sample by hash, first keys and dealt ones: at most HOT_LISTS each, whatever the corpus."""
    out: list[np.ndarray] = []
    if n <= split_over:
        return out
    some = prints.filter(F.pmod(F.xxhash64("fp"), F.lit(sample)) == 0)
    for _ in range(2 if distance < 7 else 1):
        last = list(out)

        def keys(batch: pa.RecordBatch, last=last) -> pa.RecordBatch:
            key = _entries(batch.column("fp").to_numpy(), distance, last)[0]
            key, count = np.unique(key[key >= (DEALT if last else 0)], return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(key), pa.array(count)], ["key", "n"])

        many = map_batches(some, keys, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
        least = max(split_over, 400 * n // HOT_LISTS) / sample  # a fingerprint has up to 35, and dealt out 175 keys
        got = [r.key for r in many.filter(F.col("n") > least).select("key").collect()]
        if not got:
            break
        out.append(np.sort(np.array(got, np.int64)))
    return out


def fingerprint_links(prints: DataFrame, distance: int = DISTANCE, split_over: int = SPLIT_OVER, sample: int = SAMPLE) -> DataFrame:
    """Edges (a, b) between fingerprints that span every component. prints: distinct fp."""
    positions(distance)
    n = prints.count()
    hot = _hot(prints, n, distance, split_over, sample)

    def index(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x) for x in _entries(batch.column("fp").to_numpy(), distance, hot)], ["key", "fp"])

    def dealt(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x) for x in _deal(batch.column("key").to_numpy(), batch.column("a").to_numpy(), distance)], ["key", "fp"])

    spread = prints.select("fp").repartition(max(1, -(-n // INDEX_ROWS)))  # each row becomes 35 at four bits
    entries, edges = map_batches(spread, index, "key long, fp long"), None
    while True:
        lists = entries.repartition(F.col("key")).sortWithinPartitions("key")
        found = written(bounded(lists).mapInArrow(partial(_links, distance=distance, split_over=split_over), "key long, a long, b long"), "simhash-links")
        own = found.filter("key IS NULL").select("a", "b")
        edges = own if edges is None else edges.unionByName(own)
        over = found.filter("key IS NOT NULL").select("key", "a")
        if over.isEmpty():
            return edges.distinct()
        entries = map_batches(over, dealt, "key long, fp long")


def links(prints: DataFrame, distance: int = DISTANCE, split_over: int = SPLIT_OVER, sample: int = SAMPLE) -> DataFrame:
    """As fingerprint_links, between representatives. prints: distinct fp with rep, an identifier of its own."""
    edges = fingerprint_links(prints, distance, split_over, sample)
    a, b = (prints.select(F.col("fp").alias(x), F.col("rep").alias(f"rep_{x}")) for x in "ab")
    return edges.join(a, "a").join(b, "b").select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b"))


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component): the smallest identifier reachable, for each node of the edges, by large-star and small-star rounds."""
    e = written(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    for _ in range(rounds):
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = written(large.filter("u <> v").distinct(), "large-star")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("x"), "m", "u")
        now = written(small.select(F.col("x").alias("u"), F.col("m").alias("v")).union(small.select("u", F.col("m").alias("v"))).filter("u <> v").distinct(), "small-star")
        same = now.count() == e.count() and now.join(e, ["u", "v"], "left_anti").isEmpty()
        discard(e, large)
        e = now
        if same:
            break
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE, split_over: int = SPLIT_OVER) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id."""
    prints = written(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    groups = written(prints.groupBy("fp").agg(F.min("doc_id").alias("rep")), "representatives")
    joined = components(fingerprint_links(groups, distance, split_over))
    member = groups.join(joined, groups["fp"] == joined["node"], "left").select("fp", "rep", F.coalesce("component", "fp").alias("component"))
    least = member.groupBy("component").agg(F.min("rep").alias("component_id"))
    label = member.join(least, "component").select("fp", "component_id")
    return prints.join(label, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def survivors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE, split_over: int = SPLIT_OVER) -> DataFrame:
    """doc_id and h (xxhash64 of the text) of the row that stays of each component of fingerprints: the smallest identifier, then fingerprint, then h.

    Rows without an identifier are chosen among themselves. Components link
    fingerprints, so rows that share an identifier but not their text stay apart.
    """
    prints = fingerprints(docs, id_col, text_col, shingle, hashes=True)
    best = written(prints.groupBy("fp", F.col("doc_id").isNull().alias("loose")).agg(F.min(F.struct("doc_id", "fp", "h")).alias("row")), "best-rows")
    joined = components(fingerprint_links(best.select("fp").distinct(), distance, split_over))
    label = best.join(joined, best["fp"] == joined["node"], "left").select(F.coalesce("component", "fp").alias("component"), "loose", "row")
    return label.groupBy("component", "loose").agg(F.min("row").alias("row")).select("row.doc_id", "row.h")

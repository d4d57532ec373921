import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from telar.llm import simhash as H


def plain(text):
    ws = (text or "").encode().translate(H._LOWER).split()
    if not ws:
        return 0
    sh = [b" ".join(ws[i : i + 4]) for i in range(max(1, len(ws) - 3))]
    hs = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def groups(fps, distance=4):
    """Smallest member reachable, by comparing all pairs. fps: {id: fingerprint}."""
    ids, f = sorted(fps), np.array([fps[i] for i in sorted(fps)], np.uint64)
    label = {}
    for i in range(len(ids)):
        if ids[i] in label:
            continue
        todo = [i]
        label[ids[i]] = ids[i]
        while todo:
            at = todo.pop()
            for j in np.flatnonzero(np.bitwise_count(f ^ f[at]) <= distance).tolist():
                if ids[j] not in label:
                    label[ids[j]] = ids[i]
                    todo.append(j)
    return label


@pytest.mark.parametrize("text", ["", None, "a", "A b C d", "a b c d e f g a b c d", "é " * 9, "  x y z w v"])
def test_fingerprint(text):
    assert H.fingerprint((text or "").encode()) == plain(text)


def test_same_as_sparks_hash(spark):
    x = spark.sql("SELECT xxhash64('uno dos tres cuatro') AS x").first().x
    assert H.fingerprint(b"Uno dos TRES cuatro") == x % (1 << 64)


def test_same_as_brute_force(spark, docs):
    texts = {r.doc_id: r.text for r in docs.collect()}
    fps = {i: plain(t) for i, t in texts.items()}
    want = groups(fps)
    got = H.near_duplicates(docs).collect()
    assert len(got) == len(texts)
    for r in got:
        assert (r.fingerprint, r.component_id) == (f"{fps[r.doc_id]:016x}", want[r.doc_id])


@pytest.mark.parametrize("split", [H.SPLIT_OVER, 20])
def test_dense_and_chained_groups(spark, split):
    """Chains at distance 4, a dense ball, pairs at 5, and lists dealt out again."""
    rnd = random.Random(9)
    fps, f = [], rnd.getrandbits(64)
    for _ in range(60):  # a chain
        fps.append(f)
        for b in rnd.sample(range(64), 4):
            f ^= 1 << b
    ball = rnd.getrandbits(64)
    fps += [ball ^ 1 << a ^ 1 << b for a, b in (rnd.sample(range(64), 2) for _ in range(300))]
    far = [rnd.getrandbits(64) for _ in range(200)]
    fps += far + [x ^ sum(1 << b for b in rnd.sample(range(64), 5)) for x in far]
    fps = dict(enumerate(dict.fromkeys(fps)))
    rnd_ids = rnd.sample(range(10_000), len(fps))
    fps = dict(zip(rnd_ids, fps.values(), strict=True))
    df = spark.createDataFrame([(int(np.uint64(f).astype(np.int64)), i) for i, f in fps.items()], "fp long, rep long").repartition(3)
    edges = H.links(df, split_over=split)
    pairs = [tuple(r) for r in edges.collect()]
    assert all((fps[a] ^ fps[b]).bit_count() <= 4 for a, b in pairs)
    assert len(pairs) < 35 * len(fps)
    label = {r.node: r.component for r in H.components(edges).collect()}
    assert {i: label.get(i, i) for i in fps} == groups(fps)


@pytest.mark.parametrize("split", [H.SPLIT_OVER, 20])
@pytest.mark.parametrize("distance", [3, 5, 6, 7])
def test_other_distances(spark, distance, split):
    """No pair is lost at distances whose differing bits may lie in as many bytes."""
    rnd = random.Random(distance)
    fps = []
    for _ in range(150):
        f = rnd.getrandbits(64)
        for n in (distance, distance + 1):
            fps += [f, f ^ sum(1 << 8 * byte + rnd.randrange(8) for byte in rnd.sample(range(8), n))]
    fps = dict(enumerate(dict.fromkeys(fps)))
    df = spark.createDataFrame([(int(np.uint64(f).astype(np.int64)), i) for i, f in fps.items()], "fp long, rep long").repartition(3)
    label = {r.node: r.component for r in H.components(H.links(df, distance, split)).collect()}
    assert {i: label.get(i, i) for i in fps} == groups(fps, distance)


def test_distances_without_keys(spark):
    df = spark.createDataFrame([(1, 1)], "fp long, rep long")
    for distance in (-1, 8):
        with pytest.raises(ValueError, match="distance"):
            H.links(df, distance)


def test_components(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, 300), (300, 400), (7, 7)]
    got = {r.node: r.component for r in H.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = dict.fromkeys(range(101, 161), 100) | {400: 300, 500: 300}
    assert {k: v for k, v in got.items() if k != v} == want
    assert H.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_components_of_large_identifiers(spark):
    edges = [(k * (1 << 61) + i, k * (1 << 61) + i + 1) for k in (-4, -1, 3) for i in range(6)]
    got = {r.node: r.component for r in H.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {k: v for k, v in got.items() if k != v} == {b: b >> 61 << 61 for _, b in edges}


def test_odd_rows(odd, none):
    got = H.near_duplicates(odd).collect()
    assert len(got) == odd.count()
    by = {}
    for r in got:
        by.setdefault(r.fingerprint, set()).add(r.component_id)
    assert all(len(v) == 1 for v in by.values())
    assert by["0" * 16] == {2}
    assert next(iter({r.component_id for r in got if r.doc_id == 4})) == 4
    assert {r.component_id for r in got if r.doc_id is None} == {2, None}
    assert H.near_duplicates(none).count() == 0
    assert H.near_duplicates(odd.withColumn("doc_id", F.lit(None).cast("long"))).filter("component_id IS NOT NULL").count() == 0


def test_links_through_rows_without_an_id(spark, monkeypatch):
    """A chain of fingerprints whose middle belongs to a row without an id, and an id shared by two texts."""
    bits = {"a": 0, "b": 0b1111 << 20, "c": 0b11111111 << 20, "d": 0xFFFFF << 40, "e": (1 << 64) - 1}
    monkeypatch.setattr(H, "fingerprints", lambda docs, *_: docs.select("doc_id", F.element_at(F.create_map(*(F.lit(x) for k, v in bits.items() for x in (k, int(np.uint64(v).astype(np.int64))))), F.col("text")).alias("fp")))
    rows = [((1 << 63) - 1, "a"), (None, "b"), (-(1 << 63), "c"), (None, "d"), ((1 << 63) - 1, "e")]
    got = H.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.fingerprint: r.component_id for r in got} == {f"{bits[k]:016x}": v for k, v in (("a", -(1 << 63)), ("b", -(1 << 63)), ("c", -(1 << 63)), ("d", None), ("e", (1 << 63) - 1))}


@pytest.mark.parametrize("sample", [1, 64])
def test_hot_lists_are_dealt_out(spark, sample):
    """Many fingerprints that share seven bytes' triples: known beforehand or met, lists end below the limit or at the last kind."""
    rnd, base = random.Random(4), 0x0123456789ABCDEF
    fps = {base ^ rnd.getrandbits(16) << 8 * (i % 7) for i in range(1500)} | {rnd.getrandbits(64) for _ in range(300)}
    fps |= {f ^ sum(1 << b for b in rnd.sample(range(64), 4)) for f in rnd.sample(sorted(fps), 200)}
    fps = dict(enumerate(sorted(fps)))
    df = spark.createDataFrame([(int(np.uint64(f).astype(np.int64)), i) for i, f in fps.items()], "fp long, rep long").repartition(3)
    label = {r.node: r.component for r in H.components(H.links(df, split_over=50, sample=sample)).collect()}
    assert {i: label.get(i, i) for i in fps} == groups(fps)


def test_a_long_list_is_passed_on_or_cut_down():
    """A list of a million fingerprints with seven common bytes' triples never stays whole in a worker; one of the last kind has few components."""
    fp = (np.arange(1 << 20, dtype=np.uint64) << np.uint64(44)).view(np.int64)
    key = np.zeros(len(fp), np.int64)
    cut = [H.pa.RecordBatch.from_arrays([H.pa.array(key[i : i + 50_000]), H.pa.array(fp[i : i + 50_000])], ["key", "fp"]) for i in range(0, len(fp), 50_000)]
    out = list(H._links(iter(cut), 4, 20_000))
    assert sum(b.num_rows for b in out) == len(fp)
    assert max(b.num_rows for b in out) <= 70_000
    last = list(H._links((H.pa.RecordBatch.from_arrays([H.pa.array(np.full(b.num_rows, -5)), b.column(1)], ["key", "fp"]) for b in cut), 4, 20_000))
    assert sum(b.num_rows for b in last) == len(fp) - 1  # one component

import random
import struct
import zlib

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from telar.llm import sstable as S

PATH = public_tokenizers.path("byte_bpe_50k.json")


def library(text):
    ids = S.tokenizer(PATH).encode(text, add_special_tokens=False).ids
    return struct.pack(f"<{len(ids)}I", *ids)


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("ab A'st.,!\n\t\r é日1$ \u0085ª×<|>"), max_size=25))
def test_encoder_property(text):
    assert S.chunk_encoder(PATH).encode([text], b"")[0] == library(text)


@pytest.mark.parametrize("text", ["", "x<|endoftext|>y", "it's they'll DON'T", "word ,x  y\n\n z", "a\x1c b", "naïve café\tß", "1 2,3.4 ", "Å. Ω; ǀǃ"])
def test_encoder_cases(text):
    assert S.chunk_encoder(PATH).encode([text], b"")[0] == library(text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["<|endoftext|>", "<|endoftext|", "a", "it's", " ", "  ", "\n", "\t", ",", ".)", "é", "日"]), max_size=9))
def test_special_tokens_as_in_the_library(parts):
    """Against a tokenizer of the test's own, as the file gives it."""
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(PATH)
    for text in ("".join(parts), "a <|endoftext|> b"):
        ids = plain.encode(text, add_special_tokens=False).ids
        assert S.chunk_encoder(PATH).encode([text], b"")[0] == struct.pack(f"<{len(ids)}I", *ids)
    assert 50256 in plain.encode("a <|endoftext|> b", add_special_tokens=False).ids


def test_files(tmp_path):
    rnd = random.Random(3)
    ids = {k: struct.pack(f"<{n}I", *(rnd.randrange(70_000 if k % 3 else 500) for _ in range(n))) for k in rnd.sample(range(-5000, 5000), 3000) for n in [rnd.randrange(90)]}
    w = S.Writer(open(tmp_path / "a.sst", "wb"))
    for k in sorted(ids):
        w.add(S.key_of(k), ids[k])
    w.close()
    w.out.close()
    r = S.Reader(f"file://{tmp_path}/a.sst")
    assert r.docs == 3000
    assert r.tokens == sum(map(len, ids.values())) // 4
    assert [(S.id_of(k), v.tobytes()) for k, v in r] == [(k, ids[k]) for k in sorted(ids)]
    assert len(r.index) > 1
    for k in range(-5100, 5100, 7):
        got = r.get(k)
        assert got.tobytes() == ids[k] if k in ids else got is None
    data = bytearray((tmp_path / "a.sst").read_bytes())
    data[10] ^= 1
    (tmp_path / "b.sst").write_bytes(data)
    with pytest.raises(ValueError, match="damaged"):
        list(S.Reader(f"file://{tmp_path}/b.sst"))


def test_keys_sort_as_numbers():
    ks = [None, -(1 << 63), -1, 0, 1, (1 << 63) - 1]
    assert sorted(ks, key=S.key_of) == ks
    assert [S.id_of(S.key_of(k)) for k in ks] == ks


def test_whole_table(spark, docs):
    manifest = S.write_shards(docs, PATH)
    got = sorted(map(tuple, S.read_shards(manifest).collect()))
    start, want = 0, []
    for r in sorted(docs.collect(), key=lambda r: r.doc_id):
        ids = library(r.text or "") + struct.pack("<I", 2)
        want.append((r.doc_id, start, len(ids) // 4, zlib.crc32(ids)))
        start += len(ids) // 4
    assert got == want


def test_odd_rows(odd, none):
    got = S.read_shards(S.write_shards(odd, PATH)).collect()
    assert len(got) == odd.count()
    assert sorted(r.start for r in got) == sorted(sum(x.n_tokens for x in got if x.start < r.start) for r in got)
    assert {r.n_tokens for r in got if r.doc_id in (2, 3)} == {1}
    assert S.read_shards(S.write_shards(none, PATH)).count() == 0


def test_repeated_identifiers(spark):
    """One identifier with half of the rows: it is split over shards, and two runs give the same starts."""
    rows = [(7, f"text {i} " * (i % 5 + 1)) for i in range(400)] + [(None, f"no id {i}") for i in range(200)] + [(i, f"own {i}") for i in range(300)]
    a = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    b = spark.createDataFrame(rows[::-1], "doc_id long, text string").repartition(3)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    first, second = (S.write_shards(x, PATH) for x in (a, b))
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    got = sorted(map(tuple, S.read_shards(first).collect()), key=repr)
    assert got == sorted(map(tuple, S.read_shards(second).collect()), key=repr)
    assert max(r.docs for r in first.collect()) < 400
    starts = sorted((r[1], r[2]) for r in got)
    assert [s for s, _ in starts] == [sum(n for _, n in starts[:i]) for i in range(len(starts))]


def test_shards_are_cut_by_size(spark, docs):
    """Several shards a task: the same rows, none above its bounds by more than an entry, filters and lookups right in each."""
    whole = sorted(map(tuple, S.read_shards(S.write_shards(docs, PATH)).collect()))
    tasks = 2 * spark.sparkContext.defaultParallelism
    for more in ({"shard_bytes": 4096}, {"shard_docs": 3}):
        manifest = S.write_shards(docs, PATH, **more)
        shards = sorted(manifest.collect())
        assert len(shards) > len({r.shard for r in shards})
        assert len({r.shard for r in shards}) <= tasks
        assert [r.seq for r in shards] == [i for n in sorted({r.shard for r in shards}) for i in range(sum(r.shard == n for r in shards))]
        if "shard_docs" in more:
            assert max(r.docs for r in shards) == 3
        assert sorted(map(tuple, S.read_shards(manifest).collect())) == whole
        last = None
        for r in shards[:20]:
            shard = S.Reader(r.path)
            keys = [S.id_of(k) for k, _ in shard]
            assert len(keys) == r.docs
            assert all(shard.get(k) is not None for k in keys)
            assert last is None or last <= keys[0]
            last = keys[-1]
            shard.close()


def test_filter_memory_is_eight_bytes_a_key():
    import io

    w = S.Writer(io.BytesIO())
    for k in range(20_000):
        w.add(S.key_of(k), b"\2\0\0\0")
    assert w.digests.itemsize * len(w.digests) == 160_000
    assert not any(isinstance(v, list) and len(v) > 20_000 for v in vars(w).values())

import hashlib
import struct
import zlib
from fractions import Fraction

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from telar.llm import mpeg


@given(st.binary(max_size=2000))
def test_round_trip(data):
    payload = mpeg.pad(data)
    assert len(payload) % 192 == 0
    assert payload.startswith(data)
    back, s, wrong = mpeg.restore(mpeg.store(payload, len(data)))
    assert back == payload
    n = len(payload) // 192
    assert (len(s.offsets), s.samples, s.bad, s.checked, wrong, s.resyncs) == (n, 1152 * n, 0, n, 0, 0)
    assert s.duration == Fraction(36 * n, 1000)
    assert (s.vbr["kind"], s.vbr["frames"]) == ("Info", n)


def frame(kbps_index, size, fill=0, head=0xFB):
    h = bytes([0xFF, head, kbps_index << 4, 0xC0])
    assert mpeg.header(h).size == size
    return h + bytes([fill]) * (size - 4)


def test_variable_rate_and_tags():
    frames = [frame(9, 417), frame(5, 208), frame(11, 626), frame(9, 417)]
    table = b"Xing" + struct.pack(">III", 7, 4, 2085) + bytes(range(100))
    first = bytearray(frame(9, 417))
    first[21 : 21 + len(table)] = table
    tag = b"ID3\3\0\0" + mpeg._safe(16) + b"TIT2" + struct.pack(">I", 6) + b"\0\0" + b"\0Title"
    v1 = b"TAG" + b"Old".ljust(30, b"\0") + bytes(95)
    ape = b"APETAGEX" + struct.pack("<IIII", 2000, 32, 0, 0) + bytes(8)
    s = mpeg.parse(tag + bytes(first) + b"".join(frames) + ape + v1)
    assert s.tags["TIT2"] == "Title"
    assert (s.vbr["kind"], s.vbr["frames"], s.vbr["toc"][3]) == ("Xing", 4, 3)
    assert s.kbps == {128, 64, 192}
    start = len(tag) + 417
    assert s.offsets == [start, start + 417, start + 625, start + 1251]
    assert s.duration == Fraction(4 * 1152, 44100)
    assert s.seek(2 * 1152) == start + 625
    assert s.seek(10**9) is None


@pytest.mark.parametrize("n", [10, 192, 193, 384, 1000])
@pytest.mark.parametrize(("mark", "place"), [(b"TAG", 127), (b"VINTAGE", 131), (b"APETAGEX", 31), (b"APETAGEX" + b"\0" * 24, 31)])
def test_payload_like_a_tag(n, mark, place):
    """A payload that has a tag's name where a tag would stand is read back whole, also before real tags."""
    size = len(mpeg.pad(b"x" * n))
    text = bytearray(b"x" * size)
    text[size - place : size - place + len(mark)] = mark
    text = bytes(text[:size])
    data = mpeg.store(text, size)
    v1 = b"TAG" + b"Old".ljust(30, b"\0") + bytes(95)
    ape = b"APETAGEX" + struct.pack("<IIII", 2000, 32, 0, 0) + bytes(8)
    for end in (b"", v1, ape, ape + v1):
        back, s, wrong = mpeg.restore(data + end)
        assert back == text
        assert (len(s.offsets), wrong, s.resyncs) == (size // 192, 0, 0)
        assert ("TIT2" in s.tags) == end.endswith(v1)


def test_cut_frame_before_a_tag():
    v1 = b"TAG" + b"Old".ljust(30, b"\0") + bytes(95)
    s = mpeg.parse(frame(9, 417) * 3 + frame(9, 417)[:300] + v1)
    assert (len(s.offsets), s.tags["TIT2"]) == (3, "Old")
    data = mpeg.store(b"x" * 64 + b"TAG" + b"x" * 317, 384)  # cut within its last frame
    assert mpeg.restore(data[:-100])[0] == mpeg.restore(data)[0][:192]


def test_vbri():
    first = bytearray(frame(9, 417))
    first[36 : 36 + 26] = b"VBRI" + struct.pack(">HHHIIHHHH", 1, 0, 0, 1251, 2, 2, 1, 2, 1)
    first[62:66] = struct.pack(">HH", 417, 417)
    s = mpeg.parse(bytes(first) + frame(9, 417) * 2)
    assert (s.vbr["kind"], s.vbr["frames"], s.vbr["toc"]) == ("VBRI", 2, [417, 417])


def test_resynchronises():
    good = frame(9, 417) * 3
    s = mpeg.parse(b"junk\xff\xfbjunk" + good + b"\xff\xfb\x90" + b"xx" + good)
    assert len(s.offsets) == 6
    assert s.resyncs == 2
    assert mpeg.parse(b"").offsets == []
    assert mpeg.parse(b"\xff" * 3000).offsets == []


def test_damage_is_seen():
    data = bytearray(mpeg.store(mpeg.pad(b"x" * 1000), 1000))
    at = mpeg.parse(bytes(data)).offsets[2]
    data[at + 8] ^= 1  # side information
    data[at + 40] ^= 1  # payload
    payload, s, wrong = mpeg.restore(bytes(data))
    assert (s.bad, wrong) == (1, 1)


@given(st.lists(st.sampled_from([frame(9, 417)[:40], b"ID3\3\0\0\0\0\0\7", b"ID3\4\0\0\0\0\0\7TIT2\0\0\0\x05\0\0", b"VBRI", b"Xing", b"Info\0\0\0\7", b"TAG", b"APETAGEX", b"\0" * 32, b"\xff" * 5, b"\xff\xe3\x14\xc0", b"\xff\xfb\x90\xc0"]), max_size=14), st.binary(max_size=60), st.integers(0, 400))
def test_damage_never_fails(parts, more, cut):
    data = (b"".join(parts) + more)[: cut or None]
    s = mpeg.parse(data)
    assert len(s.offsets) == len(s.sizes)
    mpeg.restore(data)


def test_tables_that_do_not_fit():
    """A frame of 48 bytes that begins a VBRI table, and a tag frame whose text would start at the end."""
    h = bytes([0xFF, 0xE3, 0x14, 0xC0])
    n = mpeg.header(h).size
    assert n == 48
    one = h + bytes(32) + b"VBRI" + bytes(n - 40)
    s = mpeg.parse(one + h + bytes(n - 4))
    assert (s.vbr, len(s.offsets)) == ({}, 2)
    assert mpeg.parse(b"ID3\4\0\0\0\0\0\x0aTIT2\0\0\0\x05\0\0").offsets == []


def test_stored_columns(spark, docs):
    """What the query gives of every stored stream: its exact duration and where each frame starts."""
    from telar.llm.common import written

    media = written(mpeg.to_media(docs), "media")
    got = mpeg.media_features(media).join(media.withColumnRenamed("doc_id", "k").select("k", "media"), F.col("doc_id") == F.col("k")).collect()
    assert len(got) == docs.count()
    for r in got:
        n = r.payload_bytes // 192
        assert (Fraction(r.duration_num, r.duration_den), r.samples, r.sample_rate) == (Fraction(36 * n, 1000), 1152 * n, 32000)
        assert len(r.seek_offsets) == n
        assert all(mpeg.header(bytes(r.media[o : o + 4])) for o in r.seek_offsets)


def test_rows(spark, odd, none):
    got = mpeg.media_features(mpeg.to_media(odd)).collect()
    texts = sorted((r.text or "").encode() for r in odd.collect())
    assert len(got) == len(texts)
    want = sorted((len(t), hashlib.sha256(mpeg.pad(t)).hexdigest(), zlib.crc32(mpeg.pad(t)[-16:])) for t in texts)
    assert sorted((r.n_bytes, r.payload_sha256, r.tail_crc32) for r in got) == want
    same = [r for r in got if r.doc_id == 4]
    assert len(same) == 2
    assert same[0] == same[1]
    assert mpeg.media_features(mpeg.to_media(none)).count() == 0


@pytest.mark.parametrize(("data", "n"), [(b"", 192), (b"a" * 192, 192), (b"a" * 193, 384)])
def test_pad(data, n):
    assert len(mpeg.pad(data)) == n

"""Media columns: MPEG audio.

``to_media`` stores a byte payload in an MPEG-1 layer III stream (32 kHz, 48
kbit/s, mono, protected): an ID3v2.4 tag, a first frame with an ``Info`` table
(frames, bytes, 100 seek points), then one frame of 216 bytes for every 192
bytes of payload. The side information of a frame is zero, so a decoder plays
silence, and the payload stands in its ancillary data. The last byte of a frame
is the low byte of the payload's crc32.

``parse`` reads any MPEG audio stream: it skips ID3v2, APE and ID3v1 tags (at
the end only where the frames end before them; payloads may look like tags),
resynchronises over junk on two consistent frame headers, checks the CRC-16 of
protected layer III frames, reads Xing/Info and VBRI tables, and gives the exact
duration (samples over rate) and the offset of each frame.

Defined cases: null text is an empty payload padded to one unit of 192 spaces;
null and repeated ids are kept row by row; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from dataclasses import dataclass, field
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, utf8

UNIT = 192

# Fixed values of the format: bit rates in kbit/s by (version 1?, layer), sample rates by version.
RATES = {
    (True, 1): (0, 32, 64, 96, 128, 160, 192, 224, 256, 288, 320, 352, 384, 416, 448),
    (True, 2): (0, 32, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320, 384),
    (True, 3): (0, 32, 40, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320),
    (False, 1): (0, 32, 48, 56, 64, 80, 96, 112, 128, 144, 160, 176, 192, 224, 256),
    (False, 2): (0, 8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
    (False, 3): (0, 8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
}
SAMPLE_RATES = {3: (44100, 48000, 32000), 2: (22050, 24000, 16000), 0: (11025, 12000, 8000)}


def _crc_table() -> list[int]:
    out = []
    for b in range(256):
        c = b << 8
        for _ in range(8):
            c = (c << 1) ^ (0x8005 if c & 0x8000 else 0)
        out.append(c & 0xFFFF)
    return out


_CRC = _crc_table()


def crc16(data: bytes) -> int:
    c = 0xFFFF
    for b in data:
        c = (c << 8 & 0xFFFF) ^ _CRC[c >> 8 ^ b]
    return c


@dataclass
class Header:
    version: int  # 3: MPEG-1, 2: MPEG-2, 0: MPEG-2.5
    layer: int
    protected: bool
    kbps: int
    rate: int
    mono: bool
    size: int
    samples: int

    @property
    def side(self) -> int:
        return (17 if self.mono else 32) if self.version == 3 else (9 if self.mono else 17)


_HEADERS: dict[bytes, Header | None] = {}


def header(four: bytes) -> Header | None:
    """The frame header in four bytes, or None. Free-format frames are not accepted."""
    if four in _HEADERS:
        return _HEADERS[four]
    h = None
    if len(four) == 4 and four[0] == 0xFF and four[1] & 0xE0 == 0xE0:
        version, layer, rate_i, sr_i = four[1] >> 3 & 3, 4 - (four[1] >> 1 & 3), four[2] >> 4, four[2] >> 2 & 3
        if version != 1 and layer != 4 and 0 < rate_i < 15 and sr_i < 3:
            kbps, rate, pad = RATES[version == 3, layer][rate_i], SAMPLE_RATES[version][sr_i], four[2] >> 1 & 1
            samples = 384 if layer == 1 else 1152 if layer == 2 or version == 3 else 576
            size = (12 * kbps * 1000 // rate + pad) * 4 if layer == 1 else samples // 8 * kbps * 1000 // rate + pad
            h = Header(version, layer, not four[1] & 1, kbps, rate, four[3] >> 6 == 3, size, samples)
    if len(_HEADERS) < 4096:
        _HEADERS[four] = h
    return h


@dataclass
class Stream:
    tags: dict[str, str] = field(default_factory=dict)
    offsets: list[int] = field(default_factory=list)
    sizes: list[int] = field(default_factory=list)
    samples: int = 0
    rate: int = 0
    kbps: set[int] = field(default_factory=set)
    vbr: dict = field(default_factory=dict)
    checked: int = 0
    bad: int = 0
    resyncs: int = 0
    skipped: int = 0

    @property
    def duration(self) -> Fraction:
        return Fraction(self.samples, self.rate) if self.rate else Fraction(0)

    def seek(self, sample: int) -> int | None:
        """Offset of the frame with that sample (frames of one size in samples)."""
        if not self.offsets or not 0 <= sample < self.samples:
            return None
        return self.offsets[sample * len(self.offsets) // self.samples]


def _syncsafe(b: bytes) -> int:
    return b[0] << 21 | b[1] << 14 | b[2] << 7 | b[3]


def _id3v2(data: bytes, at: int) -> tuple[int, dict[str, str]]:
    """(bytes of the tag or 0, its text frames)."""
    if data[at : at + 3] != b"ID3" or len(data) < at + 10 or max(data[at + 6 : at + 10]) > 127:
        return 0, {}
    end, tags, p = at + 10 + _syncsafe(data[at + 6 : at + 10]), {}, at + 10
    v = data[at + 3]
    while v >= 3 and p + 10 <= min(end, len(data)) and data[p : p + 4].isalnum():
        n = _syncsafe(data[p + 4 : p + 8]) if v == 4 else struct.unpack(">I", data[p + 4 : p + 8])[0]
        if data[p : p + 1] == b"T" and n and p + 10 < len(data):
            text = data[p + 11 : p + 10 + n].decode({0: "latin-1", 1: "utf-16", 2: "utf-16-be"}.get(data[p + 10], "utf-8"), "replace")
            tags[data[p : p + 4].decode()] = text.strip("\0")
        p += 10 + n
    return end - at + 10 * bool(data[at + 5] & 16), tags


def _table(frame: bytes, h: Header) -> dict:
    """The variable-bit-rate table of a first frame, if it has a whole one."""
    try:
        return _xing(frame, h) or _vbri(frame)
    except struct.error:  # the frame ends within the table
        return {}


def _xing(frame: bytes, h: Header) -> dict:
    for at in {4 + h.side, 6 + h.side} if h.layer == 3 else ():
        if (kind := frame[at : at + 4]) in (b"Xing", b"Info"):
            (flags,), p, out = struct.unpack_from(">I", frame, at + 4), at + 8, {"kind": kind.decode()}
            for bit, name in ((1, "frames"), (2, "bytes")):
                if flags & bit:
                    (out[name],), p = struct.unpack_from(">I", frame, p), p + 4
            if flags & 4:
                out["toc"] = list(struct.unpack_from("100B", frame, p))
            return out
    return {}


def _vbri(frame: bytes) -> dict:
    if frame[36:40] != b"VBRI":
        return {}
    _, _, _, size, frames, entries, scale, width, per = struct.unpack_from(">HHHIIHHHH", frame, 40)
    raw = struct.unpack_from(f"{entries * width}s", frame, 62)[0]
    return {"kind": "VBRI", "frames": frames, "bytes": size, "toc": [int.from_bytes(raw[i * width : (i + 1) * width], "big") * scale for i in range(entries)], "frames_per_entry": per}


def _follows(h: Header, four: bytes) -> bool:
    """Whether the four bytes are the header of a frame after one with header h."""
    return (g := header(four)) is not None and (g.version, g.layer, g.rate) == (h.version, h.layer, h.rate)


def _trailer(data: bytes, end: int) -> int:
    """Where a tag that ends at ``end`` starts; ``end`` if there is none."""
    if end >= 128 and data[end - 128 : end - 125] == b"TAG":
        return end - 128
    if end >= 32 and data[end - 32 : end - 24] == b"APETAGEX":
        size, flags = struct.unpack("<I", data[end - 20 : end - 16])[0], struct.unpack("<I", data[end - 12 : end - 8])[0]
        return max(0, end - max(size, 32) - (32 if flags >> 31 else 0))
    return end


def parse(data: bytes) -> Stream:
    """Walk a whole stream; never fails on damaged bytes."""
    tags, at, end, title = {}, 0, len(data), None
    while (n := _id3v2(data, at))[0]:
        tags.update(n[1])
        at += n[0]
    s, solid = _walk(data, at, end)
    while (start := _trailer(data, end)) < end and start >= solid:
        if title is None and data[start : start + 3] == b"TAG":
            title = data[start + 3 : start + 33].rstrip(b"\0 ").decode("latin-1")
        end = start
        s, solid = _walk(data, at, end)
    s.tags = tags if title is None else {"TIT2": title} | tags
    return s


def _walk(data: bytes, at: int, end: int) -> tuple[Stream, int]:
    """The stream of the bytes up to ``end``, and the offset before which all is of frames beyond doubt: a last frame counts if it ends at ``end`` or at another's header."""
    s, lost, solid = Stream(), False, at
    crcs: dict[bytes, int] = {}
    while at + 4 <= end:
        h = header(data[at : at + 4])
        nxt = at + h.size if h else 0
        sure = h and nxt <= end and (not (lost or not s.offsets) or nxt == end or _follows(h, data[nxt : nxt + 4]))
        if not sure or s.rate and h.rate != s.rate:
            s.resyncs += not lost
            lost = True
            to = data.find(b"\xff", at + 1, end)
            s.skipped += (end if to < 0 else to) - at
            at = end if to < 0 else to
            continue
        lost = False
        solid = nxt if nxt == end or _follows(h, data[nxt : nxt + 4]) else at
        if not s.offsets and not s.vbr and (t := _table(data[at:nxt], h)):
            s.vbr, s.rate, at = t | {"offset": at}, h.rate, nxt
            continue
        if h.protected and h.layer == 3:
            covered = data[at + 2 : at + 4] + data[at + 6 : at + 6 + h.side]
            if covered not in crcs:
                crcs[covered] = crc16(covered)
            s.checked += 1
            s.bad += crcs[covered] != data[at + 4] << 8 | data[at + 5]
        s.offsets.append(at)
        s.sizes.append(h.size)
        s.samples += h.samples
        s.rate = h.rate
        s.kbps.add(h.kbps)
        at = nxt
    return s, solid


_HEAD = bytes([0xFF, 0xFA, 0x38, 0xC0])  # MPEG-1 layer III, protected, 48 kbit/s, 32 kHz, mono
FRAME = header(_HEAD).size
_BODY = 4 + 2 + 17


def pad(data: bytes) -> bytes:
    """Spaces up to a positive multiple of the unit."""
    return data + b" " * (-len(data) % UNIT if data else UNIT)


def store(payload: bytes, n_bytes: int) -> bytes:
    """The stream for a payload whose length is a positive multiple of the unit."""
    n = len(payload) // UNIT
    frames = np.zeros((n, FRAME), np.uint8)
    frames[:, :4] = np.frombuffer(_HEAD, np.uint8)
    frames[:, 4:6] = np.frombuffer(struct.pack(">H", crc16(_HEAD[2:] + bytes(17))), np.uint8)
    frames[:, _BODY : _BODY + UNIT] = np.frombuffer(payload, np.uint8).reshape(n, UNIT)
    frames[:, -1] = [zlib.crc32(payload[i * UNIT : (i + 1) * UNIT]) & 255 for i in range(n)]
    text = b"\3" + str(n_bytes).encode()
    tags = b"TLEN" + _safe(len(ms := b"\3" + str(n * 36).encode())) + b"\0\0" + ms + b"TXXX" + _safe(len(x := b"\3payload\0" + text[1:])) + b"\0\0" + x
    info = bytearray(FRAME)
    info[:4], info[4:6] = _HEAD, struct.pack(">H", crc16(_HEAD[2:] + bytes(17)))
    toc = bytes(min(255, 256 * (FRAME + n * i // 100 * FRAME) // ((n + 1) * FRAME)) for i in range(100))
    table = b"Info" + struct.pack(">III", 7, n, (n + 1) * FRAME) + toc
    info[_BODY : _BODY + len(table)] = table
    return b"ID3\4\0\0" + _safe(len(tags)) + tags + bytes(info) + frames.tobytes()


def _safe(n: int) -> bytes:
    return bytes([n >> 21 & 127, n >> 14 & 127, n >> 7 & 127, n & 127])


def restore(data: bytes) -> tuple[bytes, Stream, int]:
    """(payload from the ancillary data, the parsed stream, frames whose check byte fails)."""
    s = parse(data)
    offsets = np.array(s.offsets, np.int64)
    if set(s.sizes) == {FRAME} and (np.diff(offsets) == FRAME).all():  # an unbroken run of frames
        frames = np.frombuffer(data, np.uint8, len(offsets) * FRAME, int(offsets[0])).reshape(-1, FRAME)
    else:
        frames = np.array([np.frombuffer(data, np.uint8, FRAME, o) for o in s.offsets if o + FRAME <= len(data)], np.uint8).reshape(-1, FRAME)
    payload = frames[:, _BODY : _BODY + UNIT].tobytes()
    wrong = sum(zlib.crc32(payload[i * UNIT : (i + 1) * UNIT]) & 255 != int(c) for i, c in enumerate(frames[:, -1]))
    return payload, s, wrong


def feature(s: Stream, wrong: int) -> str:
    d, seek = s.duration, hashlib.sha1(np.array(s.offsets, "<i8").tobytes()).hexdigest()[:12]
    return (
        f"layer3 {s.rate}Hz {'/'.join(map(str, sorted(s.kbps)))}kbps frames={len(s.offsets)} samples={s.samples} "
        f"seconds={d.numerator}/{d.denominator} table={s.vbr.get('kind', '-')}:{s.vbr.get('frames', 0)} crc={s.checked - s.bad}/{s.checked} "
        f"check={len(s.offsets) - wrong}/{len(s.offsets)} resync={s.resyncs} first={s.offsets[0] if s.offsets else -1} seek={seek}"
    )


def to_media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes and the stored stream of every text as the binary column ``media``."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = utf8(batch, "t")
        return pa.RecordBatch.from_pydict({"doc_id": batch.column("k"), "n_bytes": pa.array([len(x) for x in texts], pa.int64()), "media": pa.array([store(pad(x), len(x)) for x in texts], pa.binary())})

    return map_batches(docs.select(F.col(id_col).cast("long").alias("k"), F.col(text_col).alias("t")), run, "doc_id long, n_bytes long, media binary")


_FEATURES = {
    "payload_bytes": pa.int64(), "payload_sha256": pa.string(), "tail_crc32": pa.int64(), "media_bytes": pa.int64(), "media_sha256": pa.string(), "feature": pa.string(),
    "samples": pa.int64(), "sample_rate": pa.int32(), "duration_num": pa.int64(), "duration_den": pa.int64(), "seek_offsets": pa.list_(pa.int64()),
}


def media_features(media: DataFrame) -> DataFrame:
    """Digests and features of each stored stream, all from its bytes: also its exact duration, duration_num / duration_den seconds, and the offset of each of its frames."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for data in batch.column("media").to_pylist():
            payload, s, wrong = restore(data)
            d = s.duration
            rows.append((len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(data), hashlib.sha256(data).hexdigest(), feature(s, wrong), s.samples, s.rate, d.numerator, d.denominator, s.offsets))
        made = {k: pa.array(v, t) for (k, t), v in zip(_FEATURES.items(), zip(*rows, strict=True), strict=True)}
        return pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "n_bytes": batch.column("n_bytes")} | made)

    kinds = {pa.int64(): "long", pa.int32(): "int", pa.string(): "string", pa.list_(pa.int64()): "array<long>"}
    return map_batches(media, run, "doc_id long, n_bytes long, " + ", ".join(f"{k} {kinds[t]}" for k, t in _FEATURES.items()))

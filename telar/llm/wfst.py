"""SentencePiece encoding and decoding as a weighted finite-state transducer.

The model file (its pieces, scores, types and normaliser settings) is compiled
into three transducers, composed with each input:

* the normaliser: U+2581 for each space, one more in front of the text;
* the pieces: a state is the piece last written; reading the characters of
  piece v in state u writes v's id at weight 0 if the model keeps u and v apart
  (merging the characters of uv by descending score gives u, v again), and at
  infinite weight otherwise. A sequence is the model's own segmentation exactly
  if each of its neighbours are kept apart, so one path has finite weight;
* the byte fallback: a character that no piece holds is read into the ids of
  its UTF-8 bytes, without regard to neighbours.

Weights are zero or infinite, so the tropical-semiring shortest path is the one
path of weight zero. An automaton of all pieces reads a word once and gives the
arcs by the places they end at; each is relaxed from the place it starts at. A
prefix has one path of weight zero too, so a place keeps one state. No piece
holds a U+2581 after another character, so a text is a concatenation of words,
whose paths are kept in a bounded table.

``decode`` is the inverse: pieces to bytes, U+2581 to spaces, the space in front dropped.

Defined cases: null and empty texts have no ids and decode to the empty text;
a literal U+2581 reads as a space, as in the model's own library (such texts
report ``round_trip`` false); null and repeated ids keep their rows; extra
columns are not read (``report``) or passed through (``with_ids``).
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from collections import defaultdict
from functools import cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches

SPACE = "▁"
TABLE_WORDS = 800_000
INF = float("inf")
_WORD = re.compile(r" *[^ \n]+| +|\n")
_START = ""  # the state at the start of a word


def _fields(data: bytes):
    """(number, value) of each field of a protocol-buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        n = shift = 0
        while True:
            b = data[at]
            at, n, shift = at + 1, n | (b & 127) << shift, shift + 7
            if b < 128:
                return n

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            value = varint()
        else:
            n = varint() if kind == 2 else 8 if kind == 1 else 4
            value, at = data[at : at + n], at + n
        yield key >> 3, value


class Model:
    """What a model file says. Field numbers and piece types are fixed values of the format."""

    NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6

    def __init__(self, path: str):
        self.pieces: list[tuple[str, float, int]] = []
        self.kind, self.dummy_prefix, self.squeeze, self.charsmap = 1, True, True, b""
        with open(path, "rb") as f:
            data = f.read()
        for number, value in _fields(data):
            if number == 1:
                p = dict(_fields(value))
                self.pieces.append((p.get(1, b"").decode(), struct.unpack("<f", p[2])[0] if 2 in p else 0.0, p.get(3, self.NORMAL)))
            elif number == 2:
                self.kind = dict(_fields(value)).get(3, 1)
            elif number == 3:
                n = dict(_fields(value))
                self.charsmap, self.dummy_prefix, self.squeeze = n.get(2, b""), bool(n.get(3, 1)), bool(n.get(4, 1))


class _Words(dict):
    """Ids of words, found when they are first asked for."""

    def __init__(self, find):
        self.find = find

    def __missing__(self, word: str) -> bytes:
        return self.find(word)


class Transducer:
    def __init__(self, path: str):
        m = Model(path)
        if m.kind != 2 or m.charsmap or m.squeeze or not m.dummy_prefix or any(t in (Model.USER, Model.UNUSED) for _, _, t in m.pieces):
            raise ValueError("only BPE models with the identity normaliser, a dummy prefix and no user-defined pieces are compiled")
        self.ids = {p: i for i, (p, _, t) in enumerate(m.pieces) if t == Model.NORMAL}
        self.rank = {p: -s for p, s, t in m.pieces if t == Model.NORMAL}
        if any(SPACE in p.lstrip(SPACE) for p in self.ids) or any("\n" in p for p in self.ids):
            raise ValueError("a piece goes over the end of a word")
        self.byte_ids = [0] * 256
        self.is_byte = np.array([t == Model.BYTE for _, _, t in m.pieces])
        self.surface: list[bytes] = []
        for i, (p, _, t) in enumerate(m.pieces):
            if t == Model.BYTE:
                self.byte_ids[int(p[3:5], 16)] = i
            self.surface.append(bytes([int(p[3:5], 16)]) if t == Model.BYTE else b"" if t == Model.CONTROL else " ⁇ ".encode() if t == Model.UNKNOWN else p.replace(SPACE, " ").encode())
        #: The arcs of the pieces as an automaton: of each place in a word, the (length, id) of the pieces that end there.
        self.arcs = ahocorasick.Automaton()
        for p, i in self.ids.items():
            self.arcs.add_word(p, (len(p), i))
        self.arcs.make_automaton()
        self.names = [p for p, _, _ in m.pieces]
        self.sizes = [len(p) for p in self.names]
        #: Of each piece last written (-1 at the start of a word), the weights of the arcs tried.
        self.weights: defaultdict[int, dict[int, float]] = defaultdict(dict)
        self.known = 0
        #: Characters that are pieces; all others are read by the byte fallback, and the state after them is the start.
        self.characters = {p for p in self.ids if len(p) == 1}
        if any(not self.characters.issuperset(p) for p in self.ids):
            raise ValueError("a piece has a character that is no piece")
        self.words = _Words(self.ids_of)

    def _merged(self, text: str) -> list[str]:
        """The characters of a short text after all merges, best score first, leftmost among equals."""
        parts, rank = list(text), self.rank
        while len(parts) > 1:
            best, at = INF, -1
            for i in range(len(parts) - 1):
                r = rank.get(parts[i] + parts[i + 1], INF)
                if r < best:
                    best, at = r, i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def weight(self, u: str, v: str) -> float:
        """Of the arc that writes v in state u."""
        return 0.0 if self._merged(u + v) == ([u, v] if u else [v]) else INF

    def shortest(self, word: str) -> list[int]:
        """The ids along the shortest path of a word.

        Each prefix of a word has one path of finite weight as well (its own
        segmentation), so one arc at most is relaxed into a place, and it stays.
        """
        n, weights, sizes = len(word), self.weights, self.sizes
        last, rows = [-1] * n, [None] * n
        rows.append(weights[-1])  # places are those of a piece's last character; index -1 is the start
        if not self.characters.issuperset(word):
            for i, c in enumerate(word):
                if c not in self.characters:
                    rows[i] = weights[-1]
        for end, (size, v) in self.arcs.iter(word):
            if rows[end] is None and (row := rows[end - size]) is not None:
                w = row.get(v)
                if w is None:
                    at = end - size + 1
                    u = last[at - 1] if at else -1
                    w = row[v] = self.weight(word[at - sizes[u] : at] if u >= 0 else _START, word[at : end + 1])
                    self.known += 1
                if w < INF:
                    last[end], rows[end] = v, weights[v]
        out, at = [], n - 1
        while at >= 0:
            v = last[at]
            if v < 0:
                out += [self.byte_ids[x] for x in reversed(word[at].encode("utf-8", "replace"))]
                at -= 1
            else:
                out.append(v)
                at -= sizes[v]
        return out[::-1]

    def path(self, word: str) -> list[str]:
        """The pieces along the shortest path of a word."""
        return [self.names[v] for v in self.shortest(word)]

    def ids_of(self, word: str) -> bytes:
        """Ids of a word as little-endian int32."""
        found = self.shortest(word.replace(" ", SPACE))
        self.words[word] = ids = struct.pack(f"<{len(found)}i", *found)
        return ids

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian int32."""
        words, out = self.words, []
        for text in texts:
            if len(words) > TABLE_WORDS:
                words.clear()
            if self.known > 2 * TABLE_WORDS:
                self.weights.clear()
                self.known = 0
            out.append(b"".join(map(words.__getitem__, _WORD.findall(" " + text.replace(SPACE, " ")))) if text else b"")
        return out

    def fallback(self, ids: bytes) -> int:
        """How many ids are bytes."""
        return int(self.is_byte[np.frombuffer(ids, "<i4")].sum())

    def decode(self, ids: bytes) -> bytes:
        text = b"".join(map(self.surface.__getitem__, np.frombuffer(ids, "<i4").tolist()))
        return text[1:] if text[:1] == b" " else text


@cache
def transducer(path: str) -> Transducer:
    return Transducer(path)


def report(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, n_bytes (ids that are bytes), ids_crc32 (little-endian int32 ids), decoded_sha256, round_trip."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        t = transducer(model_path)
        texts = [x or "" for x in batch.column("t").to_pylist()]
        ids = t.encode(texts)
        decoded = [t.decode(x) for x in ids]
        return pa.RecordBatch.from_arrays(
            [batch.column("k"), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array([t.fallback(x) for x in ids], pa.int64()), pa.array([zlib.crc32(x) for x in ids], pa.int64()), pa.array([hashlib.sha256(d).hexdigest() for d in decoded]), pa.array([d == x.encode() for d, x in zip(decoded, texts, strict=True)])],
            ["doc_id", "n_tokens", "n_bytes", "ids_crc32", "decoded_sha256", "round_trip"],
        )

    return map_batches(docs.select(F.col(id_col).cast("long").alias("k"), F.col(text_col).alias("t")), run, "doc_id long, n_tokens long, n_bytes long, ids_crc32 long, decoded_sha256 string, round_trip boolean")


def with_ids(docs: DataFrame, model_path: str, text_col: str = "text", ids_col: str = "input_ids", check_col: str | None = None) -> DataFrame:
    """The rows of ``docs`` with ``ids_col`` array<int>; null text gives no ids.

    ``check_col`` tells whether decoding gives the text (null as empty) back.
    Columns of these names are replaced.
    """
    docs = docs.withColumn(ids_col, F.array().cast("array<int>"))
    docs = docs.withColumn(check_col, F.lit(None).cast("boolean")) if check_col else docs

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        t, texts = transducer(model_path), [x or "" for x in batch.column(text_col).to_pylist()]
        ids = t.encode(texts)
        offsets = np.concatenate([[0], np.cumsum([len(x) // 4 for x in ids])]).astype(np.int32)
        made = {ids_col: pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(ids), "<i4")))}
        if check_col:
            made[check_col] = pa.array([t.decode(i) == x.encode() for i, x in zip(ids, texts, strict=True)])
        return pa.RecordBatch.from_pydict({k: made[k] if k in made else batch.column(k) for k in batch.schema.names})

    return map_batches(docs, run, docs.schema)


def decoded(tokens: DataFrame, model_path: str, ids_col: str = "input_ids", text_col: str = "text") -> DataFrame:
    """The rows with ``text_col`` made from the ids (replacing a column of that name); bytes that are no UTF-8 give U+FFFD."""
    tokens = tokens.withColumn(text_col, F.lit(None).cast("string"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        t = transducer(model_path)
        text = [t.decode(struct.pack(f"<{len(x)}i", *x)).decode("utf-8", "replace") for x in (y or [] for y in batch.column(ids_col).to_pylist())]
        return pa.RecordBatch.from_pydict({k: pa.array(text, pa.string()) if k == text_col else batch.column(k) for k in batch.schema.names})

    return map_batches(tokens, run, tokens.schema)

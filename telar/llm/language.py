"""Language identification in two steps: the family, then the language within it.

A text becomes the relative frequencies (square roots, so vectors have length
one) of its hashed runs of one to four characters; letters are lower-cased, marks
kept, all else is one space. Linear support vector machines, one for each pair,
choose the family; machines for each pair of a family's languages choose within
it, and a family of one needs none. The class with most pairs won is chosen, of
equal ones that with the greater margins. The score is the probability of the
narrowest pair won in the family step times that in the language step, each by a
sigmoid fitted on sampled documents that no machine learned from.

Families are those of ``FAMILIES`` by the part of a language's name before ``-``
or ``_``; a language that is in none is a family of its own.

The machines learn on the driver from a sample: about ``PER_LANGUAGE`` different
texts a language and ``IN_ALL`` in all, chosen by their hash; each gives its
whole text and two short passages of it, since many texts are short. Everything
else reads every whole text.

Defined cases: texts that are null or have no letter are ``und`` with score zero,
and teach nothing; so is every text where no language was learned; with one
language learned its score is one. Null languages and identifiers teach nothing;
null identifiers are not held out; repeated rows are answered row by row. Columns
of the results' names are replaced, all others stay.
"""

from __future__ import annotations

import unicodedata
from collections import defaultdict
from dataclasses import dataclass, field
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, map_batches, utf8

BITS = 13
LONGEST = 4
PER_LANGUAGE = 300
IN_ALL = 1200
PASSAGES = (3, 12)
COST = 10.0
UNKNOWN = "und"
_STEP = 1 << 18
_BLOCK = 128

#: Two-letter codes of languages by family.
FAMILIES = {
    "germanic": "af da de en fo fy is lb nb nl nn no sv yi",
    "romance": "ca co es fr gl it la oc pt ro sc",
    "slavic": "be bg bs cs hr mk pl ru sh sk sl sr uk",
    "baltic": "lt lv",
    "celtic": "br cy ga gd kw",
    "hellenic": "el",
    "iranian": "fa ku ps tg",
    "indic": "as bn gu hi mr ne or pa sa sd si ur",
    "uralic": "et fi hu se",
    "turkic": "az ba kk ky tk tr tt ug uz",
    "semitic": "am ar he mt ti",
    "dravidian": "kn ml ta te",
    "austronesian": "id jv mg mi ms su tl",
    "sinitic": "zh yue wuu",
}


def family(language: str) -> str:
    code = language.replace("_", "-").split("-")[0].lower()
    return next((f for f, codes in FAMILIES.items() if code in codes.split()), f"own:{code}")


@cache
def _plain() -> tuple[np.ndarray, np.ndarray]:
    """By code point: the lower-cased letter, the mark, or a space; and whether it is a letter."""
    to, letter = np.full(0x110000, 32, np.uint32), np.zeros(0x110000, bool)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            to[i], letter[i] = ord(c.lower()[0]), True
        elif unicodedata.category(c)[0] == "M":
            to[i] = i
    return to, letter


def characters(text: str) -> np.ndarray:
    """Letters and marks with single spaces between and around; empty without any letter."""
    to, letter = _plain()
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    if not letter[c].any():
        return np.empty(0, np.uint32)
    c = np.concatenate([[np.uint32(32)], to[c], [np.uint32(32)]])
    return c[np.concatenate([[True], (c[1:] != 32) | (c[:-1] != 32)])]


def counts(c: np.ndarray) -> np.ndarray:
    """How often each bucket's runs of characters occur."""
    out = np.zeros(1 << BITS, np.int64)
    for first in range(0, len(c), _STEP):
        g = np.zeros(min(_STEP, len(c) - first), np.uint64)
        for n in range(1, LONGEST + 1):
            own = c[first + n - 1 : first + n - 1 + len(g)]
            g = g[: len(own)] * np.uint64(0x100000001B3) + own
            h = (g + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
            out += np.bincount((h >> np.uint64(64 - BITS)).astype(np.int64), minlength=1 << BITS)
    return out


def vector(n: np.ndarray) -> np.ndarray:
    return np.sqrt(n / max(1, n.sum())).astype(np.float32)


def passages(c: np.ndarray, at: int) -> list[np.ndarray]:
    """Short passages of a text's characters, of as many words as PASSAGES say."""
    spaces = np.flatnonzero(c == 32)
    out = []
    for n in PASSAGES:
        if len(spaces) > n + 1:
            first = at % (len(spaces) - n)
            out.append(c[spaces[first] : spaces[first + n] + 1])
    return out


def fit_pair(x: np.ndarray, y: np.ndarray, rows: np.ndarray | None = None, cost: float = COST, rounds: int = 30) -> np.ndarray:
    """Weights and bias of a linear support vector machine with squared loss, by dual coordinate descent.

    y: 1 or -1 for each of the rows of x (all unless given; x is not copied).
    """
    at = (np.arange(len(x)) if rows is None else rows).tolist()
    n = len(at)
    c = np.where(y > 0, n / (2 * max(1, (y > 0).sum())), n / (2 * max(1, (y < 0).sum()))) * cost
    slack = (1 / (2 * c)).tolist()
    w, bias = np.zeros(x.shape[1], np.float32), 0.0
    square = [float(x[i] @ x[i]) + 1 for i in at]
    alpha, sign = [0.0] * n, y.astype(float).tolist()
    rng = np.random.default_rng(5)
    for _ in range(rounds):
        most = 0.0
        for i in rng.permutation(n).tolist():
            g = sign[i] * (float(w @ x[at[i]]) + bias) - 1 + slack[i] * alpha[i]
            if alpha[i] == 0 and g >= 0:
                continue
            most = max(most, abs(g))
            new = max(0.0, alpha[i] - g / (square[i] + slack[i]))
            step = (new - alpha[i]) * sign[i]
            alpha[i] = new
            w += np.float32(step) * x[at[i]]
            bias += step
        if most < 0.01:
            break
    return np.append(w, np.float32(bias))


def fit_sigmoid(margin: np.ndarray, y: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """(a, b) so that 1 / (1 + exp(-(a * margin + b))) is the probability of y > 0; counts are smoothed by one, a is not negative."""
    up, down = (y > 0).sum(), (y <= 0).sum()
    if not up or not down:
        return 4.0, 0.0
    t = np.where(y > 0, (up + 1) / (up + 2), 1 / (down + 2))
    z = np.column_stack([margin, np.ones_like(margin)]).astype(float)
    v = np.array([1.0, 0.0])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ v, -40, 40)))
        h = (z * (p * (1 - p))[:, None]).T @ z + 1e-6 * np.eye(2)
        v = v - np.clip(np.linalg.solve(h, z.T @ (p - t)), -2, 2)
    return max(float(v[0]), 0.0), float(v[1])


@dataclass
class Choice:
    """Machines for each pair of the classes."""

    classes: list[str]
    weights: np.ndarray = field(default_factory=lambda: np.zeros((0, (1 << BITS) + 1), np.float32))
    sigmoids: list[tuple[float, float]] = field(default_factory=list)

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, held: np.ndarray) -> Choice:
        """y: names of classes, null for rows that take no part; held: the rows that sigmoids are fitted on."""
        out = cls(sorted({c for c in y.tolist() if c is not None}))
        rows = []
        for a, b in combinations(out.classes, 2):
            either = (y == a) | (y == b)
            learn, check = np.flatnonzero(either & ~held), np.flatnonzero(either & held)
            rows.append(fit_pair(x, np.where(y[learn] == a, 1, -1), learn))
            margin = np.array([x[i] @ rows[-1][:-1] for i in check.tolist()]) + rows[-1][-1]
            out.sigmoids.append(fit_sigmoid(margin, np.where(y[check] == a, 1, -1)))
        if rows:
            out.weights = np.array(rows)
        return out

    def __call__(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each row's class (a place in classes) and the probability of the narrowest pair that it won."""
        n = len(self.classes)
        won, margins, least = np.zeros((len(x), n)), np.zeros((len(x), n)), np.ones((len(x), n))
        for k, (i, j) in enumerate(combinations(range(n), 2)):
            m = x @ self.weights[k, :-1] + self.weights[k, -1]
            a, b = self.sigmoids[k]
            p = 1 / (1 + np.exp(-np.clip(a * m + b, -40, 40)))
            won[:, i] += m > 0
            won[:, j] += m <= 0
            margins[:, i] += np.clip(m, -1, 1)
            margins[:, j] -= np.clip(m, -1, 1)
            least[:, i] = np.minimum(least[:, i], p)
            least[:, j] = np.minimum(least[:, j], 1 - p)
        best = np.argmax(won + margins / (2 * n), axis=1) if n else np.zeros(len(x), np.int64)
        return best, least[np.arange(len(x)), best] if n else np.zeros(len(x))


@dataclass
class Model:
    families: Choice
    within: dict[str, Choice]

    def __call__(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        """The language of each row and its score."""
        if not self.families.classes:
            return [UNKNOWN] * len(x), np.zeros(len(x))
        chosen, score = self.families(x)
        names = np.empty(len(x), object)
        for f, name in enumerate(self.families.classes):
            own = chosen == f
            if own.any():
                inner = self.within[name]
                k, p = inner(x[own])
                names[own] = np.array(inner.classes, object)[k]
                score[own] *= p
        return names.tolist(), score


def fit(rows: list[tuple[str, int, np.ndarray, np.ndarray]]) -> Model:
    """rows: (language, the text's number, its buckets, their counts). A third of the texts serve the sigmoids alone, where a language has three."""
    if not rows:
        return Model(Choice([]), {})
    x = np.zeros((len(rows), 1 << BITS), np.float32)
    for to, (_, _, at, n) in zip(x, rows, strict=True):
        to[at] = vector(n)
    lang = np.array([r[0] for r in rows], object)
    seen: dict[str, dict[int, int]] = defaultdict(dict)
    nth = [seen[r[0]].setdefault(r[1], len(seen[r[0]])) for r in rows]
    held = np.array([k % 3 == 2 for k in nth])
    of = np.array([family(v) for v in lang], object)
    within = {f: Choice.fit(x, np.where(of == f, lang, None), held) for f in sorted(set(of.tolist()))}
    return Model(Choice.fit(x, of, held), within)


def sample(docs: DataFrame, per_language: int = PER_LANGUAGE, in_all: int = IN_ALL, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", held_out: int = 2, folds: int = 4) -> list[tuple[str, int, np.ndarray, np.ndarray]]:
    """(language, hash of the text, buckets, counts) of whole texts and passages of about per_language texts a language, in_all at most of all."""
    rows = docs.select(F.col(id_col).cast("long").alias("k"), F.col(text_col).alias("t"), F.col(lang_col).cast("string").alias("l"))
    rows = rows.filter((crc_mod("k", folds) != held_out) & F.col("t").isNotNull() & F.col("l").isNotNull()).withColumn("h", F.xxhash64("t"))
    size = {r.l: r.n for r in rows.groupBy("l").agg(F.approx_count_distinct("h", 0.02).alias("n")).collect()}
    if not size:
        return []
    most = max(1, min(per_language, in_all // len(size)))
    share = docs.sparkSession.createDataFrame([(name, min(1.0, most / max(1, n))) for name, n in size.items()], "l string, share double")
    unit = F.shiftrightunsigned("h", 11) / float(1 << 53)
    some = rows.join(F.broadcast(share), "l").filter(unit < F.col("share")).select("l", "h", "t")  # a row a language

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for lang, h, t in zip(batch.column("l").to_pylist(), batch.column("h").to_pylist(), utf8(batch, "t"), strict=True):
            c = characters(t.decode())
            for part, own in enumerate([c, *passages(c, h)] if len(c) else []):
                n = counts(own)
                at = np.flatnonzero(n)
                out.append((lang, h, part, at.astype("<u2").tobytes(), n[at].astype("<u4").tobytes()))
        cols = zip(*out, strict=True) if out else ((),) * 5
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(cols, (pa.string(), pa.int64(), pa.int32(), pa.binary(), pa.binary()), strict=True)], ["l", "h", "part", "at", "n"])

    got = map_batches(some, run, "l string, h long, part int, at binary, n binary").groupBy("l", "h", "part").agg(F.first("at").alias("at"), F.first("n").alias("n"))
    got = got.orderBy(F.pmod("h", F.lit(1 << 20)), "l", "h", "part").limit(2 * in_all * (1 + len(PASSAGES))).collect()
    return [(r.l, r.h, np.frombuffer(r.at, "<u2"), np.frombuffer(r.n, "<u4")) for r in got]


def train(docs: DataFrame, **how) -> Model:
    return fit(sample(docs, **how))


def predicted(docs: DataFrame, model: Model, text_col: str = "text", lang_col: str = "lang_pred", score_col: str = "score") -> DataFrame:
    """The rows with their language and its score."""
    docs = docs.withColumn(lang_col, F.lit("")).withColumn(score_col, F.lit(0.0))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        names, scores = [UNKNOWN] * batch.num_rows, np.zeros(batch.num_rows)
        texts = utf8(batch, text_col)
        for first in range(0, len(texts), _BLOCK):
            at, x = [], []
            for i, t in enumerate(texts[first : first + _BLOCK], first):
                c = characters(t.decode())
                if len(c):
                    at.append(i)
                    x.append(vector(counts(c)))
            if at:
                got, scores[at] = model(np.array(x))
                for i, name in zip(at, got, strict=True):
                    names[i] = name
        made = {lang_col: pa.array(names, pa.string()), score_col: pa.array(scores)}
        return pa.RecordBatch.from_pydict({k: made.get(k, batch.column(k)) for k in batch.schema.names})

    return map_batches(docs, run, docs.schema)


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """doc_id, held_out, lang_pred, score."""
    model = train(docs, id_col=id_col, text_col=text_col, **how)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return predicted(rows, model).select("doc_id", F.coalesce(crc_mod("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")

"""Spelling variants: words of a vocabulary at distance one, by a trie self-join with active-node sets.

The vocabulary is dealt out by prefix, and for edits near a word's start by the
prefix of the reversed word. For words of m and of m or m + 1 code points that
differ by one edit, the part before the edit or the part behind it has m // 2
code points at least, so each pair meets in the trie of one of the two. Every such
trie hangs below its prefix, and the active nodes are propagated down it level by
level: a node's set holds the nodes within distance one of it. Those of its own
depth come from two children of one node (a replaced code point), those one
deeper from a node and its child (an inserted one), and either lives on where both
have a child by the same code point. Terminal nodes of an active pair are words
at distance one. The levels of all tries of a batch are propagated at once, as
arrays; the sets are symmetric, so each is kept from the shorter side alone.

A prefix with more than ``split_over`` words is dealt out again by twice as much:
either the next half of what is not yet fixed before the edit, or behind it. That
ends with one free code point of the alphabet (and two in the longer words), so no
trie grows with the corpus. A pair that more than one trie holds is given by that
of its longest common prefix.

Defined cases: null texts have no words; null identifiers and repeated rows
count like any others; equal words of several rows of ``words`` are added up; an
empty table gives no rows. Only the named columns are read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded, discard, utf8, written

LEAST = 6
OFTEN = 5
RATIO = 5
SPLIT_OVER = 20_000
SPLIT_CHARS = 4_000_000
_BROADCAST_TRIES = 100_000
_FLUSH = 200_000
_RUNS = re.compile("[A-Za-zÀ-ÿ]+")
_LOWER = {c: c + 32 for c in range(65, 91)}
PAIRS = "a string, na long, b string, nb long"


def counted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, often: int = OFTEN, change: Callable[[object, str], str] | None = None) -> DataFrame:
    """word and n: words of at least ``least`` code points that occur ``often`` times or more in all texts.

    change: gives the word that counts from a row's identifier and a word of its text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()

        def flushed() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["word", "n"])
            total.clear()
            return out

        for batch in batches:
            for key, text in zip(batch.column("k").to_pylist(), utf8(batch, "t"), strict=True):
                own = Counter(_RUNS.findall(text.decode().translate(_LOWER)))
                for word, n in own.items():
                    word = change(key, word) if change else word
                    if len(word) >= least:
                        total[word] += n
                if len(total) > _FLUSH:
                    yield flushed()
        yield flushed()

    rows = docs.select(F.col(id_col).cast("long").alias("k"), F.col(text_col).alias("t"))
    return bounded(rows).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= often)


def _dealt(words: DataFrame) -> DataFrame:
    """Entries of all words in their first tries: m, pre and suf fixed code points, lim (the pair's common prefix is shorter), part, word, n.

    ``part`` is the fixed part; before the edit where suf is 0, else behind it. Every word is of its own m and of the next smaller.
    """
    length = F.char_length("word")
    m = F.explode(F.filter(F.array(length - 1, length), lambda x: x >= 1)).alias("m")
    w = words.select("word", "n", m).withColumn("t", F.expr("m div 2"))
    sides = F.array(
        F.struct(F.col("t").alias("pre"), F.lit(0).alias("suf"), F.lit(1 << 30).alias("lim"), F.expr("left(word, t)").alias("part")),
        F.struct(F.lit(0).alias("pre"), F.col("t").alias("suf"), F.col("t").alias("lim"), F.expr("right(word, t)").alias("part")),
    )
    return w.withColumn("side", F.explode(sides)).select("m", "side.pre", "side.suf", "side.lim", "side.part", "word", "n")


def _dealt_again(entries: DataFrame) -> DataFrame:
    """The entries of tries that hold too many words, with half of the free code points fixed too."""
    e = entries.withColumn("t", F.expr("(m - pre - suf) div 2"))
    sides = F.array(
        F.struct((F.col("pre") + F.col("t")).alias("pre"), F.col("suf").alias("suf"), F.col("lim").alias("lim")),
        F.struct(F.col("pre").alias("pre"), (F.col("suf") + F.col("t")).alias("suf"), F.least(F.col("lim"), F.col("pre") + F.col("t")).alias("lim")),
    )
    e = e.withColumn("side", F.explode(sides)).select("m", "side.*", "word", "n")
    return e.select("m", "pre", "suf", "lim", F.expr("concat(left(word, pre), right(word, suf))").alias("part"), "word", "n")


_TRIE = ["m", "pre", "suf", "lim", "part"]


class _Tries:
    """The tries of sorted distinct words (group, code points), all of them by depth.

    Node i of depth d has the word (a row, or -1) ``word[d][i]``; nodes of depth d + 1 have
    ``parent[d]``, ``code[d]`` and both in one number as ``key[d]``, ascending; ``start[d]`` cuts them by parent.
    """

    def __init__(self, group: np.ndarray, codes: np.ndarray, length: np.ndarray):
        node = np.cumsum(np.concatenate([[0], group[1:] != group[:-1]]))
        on = np.arange(len(group))
        self.word, self.parent, self.code, self.key, self.start = [], [], [], [], []
        for depth in range(int(length.max()) + 1):
            here = length[on] == depth
            word = np.full(int(node[-1]) + 1, -1)
            word[node[here]] = on[here]
            on, above = on[~here], node[~here]
            key = above << 21 | codes[on, depth] if len(on) else above
            fresh = np.concatenate([[True], key[1:] != key[:-1]]) if len(on) else np.empty(0, bool)
            node = np.cumsum(fresh) - 1
            self.word.append(word)
            self.key.append(key[fresh])
            self.parent.append(above[fresh])
            self.code.append(key[fresh] & (1 << 21) - 1)
            self.start.append(np.searchsorted(self.parent[-1], np.arange(len(word) + 1)))

    def descended(self, a: np.ndarray, b: np.ndarray, da: int, db: int) -> tuple[np.ndarray, np.ndarray]:
        """Children by the same code point of the nodes a (of depth da) and b (of depth db)."""
        key = self.key[db]
        first, n = self.start[da][a], self.start[da][a + 1] - self.start[da][a]
        child = np.arange(n.sum()) + np.repeat(first - np.cumsum(n) + n, n)
        wanted = np.repeat(b, n) << 21 | self.code[da][child]
        at = np.minimum(np.searchsorted(key, wanted), len(key) - 1)
        same = key[at] == wanted if len(key) else np.zeros(len(wanted), bool)
        return child[same], at[same]

    def siblings(self, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of children of one node of the depth."""
        one = np.arange(len(self.key[depth]))
        later = self.start[depth][self.parent[depth] + 1] - one - 1
        a = np.repeat(one, later)
        return a, np.arange(len(a)) + np.repeat(one + 1 - np.cumsum(later) + later, later)

    def near(self) -> tuple[np.ndarray, np.ndarray]:
        """Rows of words at distance one, each pair once; where one is shorter, it is the first."""
        none = np.empty(0, np.int64)
        level, first, second = (none, none), [none], [none]
        step = self.parent[0], np.arange(len(self.key[0]))  # a node, and one within distance one that is one deeper
        for depth in range(len(self.word)):
            for (a, b), below in ((level, 0), (step, 1)):
                if len(a):
                    a, b = self.word[depth][a], self.word[depth + below][b]
                    both = (a >= 0) & (b >= 0)
                    first.append(a[both])
                    second.append(b[both])
            if depth + 1 < len(self.word):
                level = tuple(map(np.concatenate, zip(self.siblings(depth), self.descended(*level, depth, depth), strict=True)))
                a, b = self.descended(*step, depth, depth + 1)
                apart = self.parent[depth + 1][b] != a  # a child of a is its neighbour anyway
                step = np.concatenate([self.parent[depth + 1], a[apart]]), np.concatenate([np.arange(len(self.key[depth + 1])), b[apart]])
        return np.concatenate(first), np.concatenate(second)


def _pairs(rows: list[tuple]) -> Iterator[tuple[str, int, str, int]]:
    """Pairs of the tries of rows (m, pre, suf, lim, part, word, n), which are whole and sorted by trie."""
    trie = np.cumsum([0, *(x[:5] != y[:5] for x, y in zip(rows, rows[1:], strict=False))])
    shared = np.bincount(trie)[trie] > 1
    free = [(t, w[pre : len(w) - suf][:: 1 if pre else -1], m, lim, w, n) for t, s, (m, pre, suf, lim, _, w, n) in zip(trie.tolist(), shared.tolist(), rows, strict=True) if s]
    first = 0
    while first < len(free):
        last = first  # tries of words of alike lengths together, so that few places of the code points' array are empty
        while last < len(free) and (free[last][2] <= 2 * free[first][2] + 8 or free[last][0] == free[last - 1][0]):
            last += 1
        own = sorted(free[first:last], key=lambda x: x[:2])
        first = last
        length = np.fromiter((len(x[1]) for x in own), np.int64, len(own))
        codes = np.array([x[1] for x in own], f"<U{max(1, length.max())}").view(np.uint32).reshape(len(own), -1).astype(np.int64)
        group = np.fromiter((x[0] for x in own), np.int64, len(own))
        for i, j in zip(*(x.tolist() for x in _Tries(group, codes, length).near()), strict=True):
            _, _, m, lim, a, na = own[i]
            b, nb = own[j][4:]
            if min(len(a), len(b)) == m and a[:lim] != b[:lim]:  # words of m + 1 meet each other in their own tries
                yield a, na, b, nb


def _pairs_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by trie, which may go on in the next batch."""
    rest: list[tuple] = []

    def made(rows: list[tuple]) -> pa.RecordBatch:
        a, na, b, nb = zip(*p, strict=True) if (p := list(_pairs(rows))) else ((),) * 4
        return pa.RecordBatch.from_arrays([pa.array(a, pa.string()), pa.array(na, pa.int64()), pa.array(b, pa.string()), pa.array(nb, pa.int64())], ["a", "na", "b", "nb"])

    for batch in batches:
        rest += zip(*(c.to_pylist() for c in batch.columns), strict=True)
        cut = len(rest)
        while cut and rest[cut - 1][:5] == rest[-1][:5]:
            cut -= 1
        if cut:
            yield made(rest[:cut])
            rest = rest[cut:]
    if rest:
        yield made(rest)


def near_pairs(words: DataFrame, split_over: int = SPLIT_OVER, split_chars: int = SPLIT_CHARS) -> DataFrame:
    """a, na, b, nb: pairs of words at distance one with their n, each pair once. words: distinct word with n."""
    entries, out = _dealt(words), None
    while True:
        size = entries.groupBy(_TRIE).agg(F.count("*").alias("rows"), F.sum(F.char_length("word")).alias("chars"))
        many = (F.col("rows") > split_over) | (F.col("chars") > split_chars) & (F.col("rows") > 1)
        large = written(size.filter(many & (F.col("m") - F.col("pre") - F.col("suf") >= 2)).select(_TRIE), "tries")
        n = large.count()
        small = entries.join(F.broadcast(large) if n <= _BROADCAST_TRIES else large, _TRIE, "left_anti") if n else entries
        dealt = small.repartition(*_TRIE).sortWithinPartitions(*_TRIE).select(*_TRIE, "word", "n")
        found = bounded(dealt).mapInArrow(_pairs_of, PAIRS)
        out = found if out is None else out.unionByName(found)
        if not n:
            return out
        entries = written(_dealt_again(entries.join(F.broadcast(large) if n <= _BROADCAST_TRIES else large, _TRIE, "left_semi")), "entries")


def roots(forms: DataFrame) -> DataFrame:
    """word and root: its form's form and so on, for words with a form. forms: distinct word with form, without circles."""
    now = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        if now.join(on, "root", "left_semi").isEmpty():
            return now
        last, now = now, written(now.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "roots")
        discard(last)


def grouped(words: DataFrame, ratio: int = RATIO, **how) -> DataFrame:
    """word, n, form, root, n_near, form_n. words: word with n (rows of one word are added up).

    A word's form is the most frequent word at distance one (the least of equally frequent ones), if it occurs
    ``ratio`` times as often at least; so n grows along forms and they have no circles.
    """
    words = written(words.filter("word IS NOT NULL").groupBy("word").agg(F.sum("n").cast("long").alias("n")), "words")
    pairs = near_pairs(words, **how)
    both = F.explode(F.array(F.struct(F.col("a").alias("word"), (-F.col("nb")).alias("less"), F.col("b").alias("form")), F.struct(F.col("b").alias("word"), (-F.col("na")).alias("less"), F.col("a").alias("form"))))
    near = pairs.select(both.alias("p")).groupBy("p.word").agg(F.count("*").alias("n_near"), F.min(F.struct("p.less", "p.form")).alias("best"))
    enough = -F.col("best.less") >= ratio * F.col("n")
    known = written(words.join(near, "word", "left").select("word", "n", F.when(enough, F.col("best.form")).alias("form"), F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(enough, -F.col("best.less")).alias("form_n")), "near")
    out = known.join(roots(known.filter("form IS NOT NULL")), "word", "left")
    return out.select("word", "n", "form", F.coalesce("root", "word").alias("root"), "n_near", "form_n")

"""All keywords of all dictionaries found in one pass over a text.

The expressions of `classify` look for each keyword by itself, which suits short
records. Here the keywords are one automaton (goto and failure table), so that a
text is read once however many there are, and what `classify` gives follows from
the found keywords. The texts go to Python in Arrow batches; the automaton is
made once a worker from the keywords, which are arguments.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from telar.operators import classify


@cache
def _machine(terms: tuple[str, ...]):
    import ahocorasick

    machine = ahocorasick.Automaton()
    for i, t in enumerate(terms):
        machine.add_word(t, (i, len(t)))
    machine.make_automaton()
    return machine


def _in_word(c: str) -> bool:
    """What a word boundary of the expressions counts as part of a word."""
    return c == "_" or c.isalpha() or c.isdecimal()


def _whole(text: str, start: int, end: int) -> bool:
    before, after = start > 0 and _in_word(text[start - 1]), end < len(text) and _in_word(text[end])
    return before != _in_word(text[start]) and after != _in_word(text[end - 1])


def found(text: Column, terms: Iterable[str], whole_words: Iterable[str] = classify.WHOLE_WORDS) -> Column:
    """array<string>: the terms that occur in the (normalised) text, each once, in the order given; of null none.

    Terms in ``whole_words`` count as whole words only. An empty term is refused.
    """
    names = tuple(dict.fromkeys(terms))
    if "" in names:
        raise ValueError("an empty keyword occurs everywhere")
    if not names:
        return F.array().cast("array<string>")
    whole = frozenset(i for i, t in enumerate(names) if t in set(whole_words))

    def of(t: str | None) -> list[str]:
        seen = set()
        for end, (i, n) in _machine(names).iter(t or ""):
            if i not in seen and (i not in whole or _whole(t, end - n + 1, end + 1)):
                seen.add(i)
        return [names[i] for i in sorted(seen)]

    @F.pandas_udf("array<string>")
    def scan(s: pd.Series) -> pd.Series:
        return s.map(of, na_action=None)

    return scan(text)


def _of(terms: Sequence[str]) -> Column:
    return F.array(*map(F.lit, terms)) if terms else F.array().cast("array<string>")


def first_category(hits: Column, categories: Mapping[str, Sequence[str]] = classify.CATEGORIES) -> Column:
    """The first category of which a keyword was found, else null."""
    return F.coalesce(*(F.when(F.arrays_overlap(hits, _of(ts)), F.lit(name)) for name, ts in categories.items()))


def relevance(hits: Column, strong: Sequence[str] = classify.STRONG, generic: Sequence[str] = classify.GENERIC, none: str | None = None) -> Column:
    """As `classify.relevance`, of found keywords."""
    n = F.size(F.array_intersect(hits, _of(generic)))
    return F.when(F.arrays_overlap(hits, _of(strong)), "ALTA").when(n >= 2, "MEDIA").when(n == 1, "BAJA").otherwise(F.lit(none))


def detected(hits: Column, strong: Sequence[str] = classify.STRONG, generic: Sequence[str] = classify.GENERIC_WIDE) -> Column:
    """As `classify.detected`, of found keywords."""
    return F.array_join(F.array_intersect(_of([*strong, *generic]), hits), ", ")


def every_term(*dictionaries: Mapping[str, Sequence[str]] | Sequence[str]) -> tuple[str, ...]:
    """The keywords of dictionaries and lists, each once."""
    lists = (ts for d in dictionaries for ts in (d.values() if isinstance(d, Mapping) else [d]))
    return tuple(dict.fromkeys(t for ts in lists for t in ts))

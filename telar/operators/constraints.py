"""Constraints at write: what a database refuses row by row, said of a whole batch at once.

As in SQL, a check that gives null holds, keys with a null are unlike all others,
and a reference with a null refers to nothing. Parquet keeps no such promises,
so a batch is divided before it is written; violations are data with the names
of what they violate.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Constraints:
    """required: columns that are never null. checks: name -> condition. unique: name -> columns. references: name -> (columns, parent, its columns)."""

    required: Sequence[str] = ()
    checks: Mapping[str, Column] = field(default_factory=dict)
    unique: Mapping[str, Sequence[str]] = field(default_factory=dict)
    references: Mapping[str, tuple[Sequence[str], str, Sequence[str]]] = field(default_factory=dict)

    def names(self) -> list[str]:
        return [*(f"{c} required" for c in self.required), *self.checks, *self.unique, *self.references]


def _free(df: DataFrame, name: str) -> str:
    while name in df.columns:
        name += "_"
    return name


def _keys(df: DataFrame, columns: Sequence[str], names: Sequence[str]) -> DataFrame:
    return df.select(*(F.col(f"`{c}`").alias(n) for c, n in zip(columns, names))).dropna()


def _taken(rows: DataFrame, columns: Sequence[str], existing: DataFrame | None, order: Sequence[Column], mark: str) -> DataFrame:
    """Marks rows whose key stands in ``existing`` or more than once in the batch (but for the first by ``order``)."""
    names = [_free(rows, f"__k{i}") for i in range(len(columns))]
    n, old = _free(rows, "__n"), _free(rows, "__old")
    counts = _keys(rows, columns, names).groupBy(*names).agg(F.count(F.lit(1)).alias(n))
    if existing is None:
        clashes = counts.filter(F.col(n) > 1).withColumn(old, F.lit(False))
    else:
        there = _keys(existing, columns, names).distinct().withColumn(old, F.lit(True))
        clashes = counts.join(there, names, "left").withColumn(old, F.coalesce(old, F.lit(False))).filter((F.col(n) > 1) | F.col(old))
    same = [F.col(f"`{c}`") == F.col(k) for c, k in zip(columns, names)]
    both = rows.join(clashes, same, "left")
    if not order:
        return both.withColumn(mark, F.col(n).isNotNull()).drop(*names, n, old)
    place, clash = _free(rows, "__place"), F.col(n).isNotNull()
    alone = both.filter(~clash).withColumn(mark, F.lit(False)).drop(*names, n, old)
    ranked = both.filter(clash).withColumn(place, F.row_number().over(Window.partitionBy(*names).orderBy(*order)))
    return alone.unionByName(ranked.withColumn(mark, F.col(old) | (F.col(place) > 1)).drop(*names, n, old, place))


def _orphaned(rows: DataFrame, columns: Sequence[str], parent: DataFrame, of: Sequence[str], mark: str) -> DataFrame:
    names, there = [_free(rows, f"__p{i}") for i in range(len(columns))], _free(rows, "__there")
    known = _keys(parent, of, names).distinct().withColumn(there, F.lit(True))
    given = F.lit(True)
    for c in columns:
        given = given & F.col(f"`{c}`").isNotNull()
    both = rows.join(known, [F.col(f"`{c}`") == F.col(k) for c, k in zip(columns, names)], "left")
    return both.withColumn(mark, given & F.col(there).isNull()).drop(*names, there)


def violations(rows: DataFrame, constraints: Constraints, parents: Mapping[str, DataFrame] | None = None, existing: DataFrame | None = None, order: Sequence[Column] = (), column: str = "violated") -> DataFrame:
    """The rows with ``violated`` array<string>: names of the constraints that a row violates, in the order of their declaration.

    ``existing``: rows that stand already, with which a batch may share no unique key. ``order``: of rows of the batch that
    share a key the first stays; without it none does. ``parents``: the tables that references name.
    Keys are counted before anything is joined, and only those that clash are; the batch's rows are shuffled by a key where those are many.
    """
    marks: dict[str, str] = {}
    out = rows
    for name, columns in constraints.unique.items():
        marks[name] = _free(out, f"__u{len(marks)}")
        out = _taken(out, columns, existing, order, marks[name])
    for name, (columns, parent, of) in constraints.references.items():
        if parents is None or parent not in parents:
            raise ValueError(f"{name} refers to {parent}, which was not given")
        marks[name] = _free(out, f"__u{len(marks)}")
        out = _orphaned(out, columns, parents[parent], of, marks[name])
    broken = [F.when(F.col(f"`{c}`").isNull(), F.lit(f"{c} required")) for c in constraints.required]
    broken += [F.when(~F.coalesce(c, F.lit(True)), F.lit(n)) for n, c in constraints.checks.items()]
    broken += [F.when(F.col(m), F.lit(n)) for n, m in marks.items()]
    named = F.array_compact(F.array(*broken)) if broken else F.array().cast("array<string>")
    return out.withColumn(column, named).drop(*marks.values())


def enforced(rows: DataFrame, constraints: Constraints, column: str = "violated", **how) -> tuple[DataFrame, DataFrame]:
    """(rows that may be written, the others with what they violate)."""
    marked = violations(rows, constraints, column=column, **how)
    return marked.filter(F.size(column) == 0).drop(column), marked.filter(F.size(column) > 0)

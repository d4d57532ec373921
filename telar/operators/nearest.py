"""The k nearest rows of each query, exactly, a block of rows against a block of queries at a time.

Blocks have at most about ``BLOCK_VALUES`` numbers; each pair of blocks is a group of its own, so no task
holds all rows or all queries and nothing passes through the driver. A group multiplies its blocks as
matrices. What comes within rounding of a query's k best there is computed again by sums in the order of
the vectors, as ``V.dot`` does: equal vectors tie, and similarities and ranks are those of ``V.dot``.

All pairs are compared, so the work is rows times queries; what is shuffled is rows
times blocks of queries, queries times blocks of rows, and k rows a query and block.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

BLOCK_VALUES = 1 << 20
MOST_PAIRS = 1 << 21  # of a multiplication: 16 MB
_SLACK = 1e-9  # of products of unit vectors, far beyond their rounding


def _best(k: int, least: float) -> Callable:
    def of(rows, queries):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        n, m = rows.num_rows, queries.num_rows
        out = [[], [], []]
        if n and m:
            r = np.asarray(rows["v"].combine_chunks().flatten()).reshape(n, -1 if len(rows["v"][0]) else 0)
            q = np.asarray(queries["q"].combine_chunks().flatten()).reshape(m, r.shape[1])
            columns, place = np.ascontiguousarray(r.T), np.empty(n, np.int64)
            place[np.asarray(pc.sort_indices(rows["id"], null_placement="at_start"))] = np.arange(n)
            step = max(1, MOST_PAIRS // n)
            for a in range(0, m, step):
                some = q[a : a + step]
                near = some @ columns
                bound = np.partition(near, n - k, axis=1)[:, n - k] if n > k else np.full(len(some), -np.inf)
                qi, ri = np.nonzero(near >= np.maximum(bound, least)[:, None] - _SLACK)
                exact = np.zeros(len(qi))
                for j in range(r.shape[1]):
                    exact += columns[j][ri] * some[qi, j]
                order = np.lexsort((place[ri], -exact, qi))
                order = order[exact[order] > least]
                qi, ri, exact = qi[order], ri[order], exact[order]
                keep = np.arange(len(qi)) - np.searchsorted(qi, qi) < k
                for own, x in zip(out, (qi[keep] + a, ri[keep], exact[keep]), strict=True):
                    own.append(x)
        qi, ri, exact = (np.concatenate(x) if x else np.empty(0, t) for x, t in zip(out, (np.int64, np.int64, np.float64), strict=True))
        whole = lambda c, at: c.combine_chunks().take(pa.array(at)) if n and m else pa.array([], c.type)
        return pa.table({"query_id": whole(queries["query_id"], qi), "id": whole(rows["id"], ri), "similarity": pa.array(exact)})

    return of


def nearest(rows: DataFrame, queries: DataFrame, k: int, least: float = -1.0, on: Sequence[str] = ()) -> DataFrame:
    """query_id, id, similarity, rank of the k rows nearest to each query and nearer than ``least``; ties by id.

    rows: id, v; queries: query_id, q; v and q of unit length or zero. With ``on``, a query meets the rows that agree
    with it in these columns. Vectors with a null or NaN value, and of another length than the query's, are never near.
    """
    good = lambda c: ~F.exists(c, lambda x: x.isNull() | F.isnan(x))
    bound = lambda df, c: df.withColumn(c, F.explode(F.array(c))).filter(good(F.col(c))).withColumn("__d", F.size(c))  # noqa: E731  # made once a row
    rows, queries, key = bound(rows.select("id", "v", *on), "v"), bound(queries.select("query_id", "q", *on), "q"), [*on, "__d"]
    blocks = lambda df, n: F.broadcast(df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).select(*key, F.ceil((F.col("n") * F.col("__d") + 1) / BLOCK_VALUES).cast("int").alias(n)))  # noqa: E731  # a row per length and value of ``on``
    both = blocks(rows, "__r").join(blocks(queries, "__q"), key)
    one = lambda c, n: F.pmod(F.xxhash64(*c), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = rows.join(F.broadcast(both), key).select(*key, "id", "v", one(("id", "v"), "__r").alias("__i"), each("__q").alias("__j"))
    right = queries.join(F.broadcast(both), key).select(*key, "query_id", "q", one(("query_id", "q"), "__q").alias("__j"), each("__r").alias("__i"))
    group = [*key, "__i", "__j"]
    schema = StructType([StructField("query_id", queries.schema["query_id"].dataType), StructField("id", rows.schema["id"].dataType), StructField("similarity", DoubleType())])
    hits = left.groupBy(*group).cogroup(right.groupBy(*group)).applyInArrow(_best(max(1, k), least), schema)
    w = Window.partitionBy("query_id").orderBy(F.desc("similarity"), "id")
    return hits.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)

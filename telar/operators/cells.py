"""Vector search by cells (an extension): an inverted file of k-means cells, probed and re-ranked exactly.

Vectors are dealt to the cell of their nearest centre and written partitioned by
cell, as unit vectors. A query opens the partitions of its nearest cells, and what it
finds there is ranked by the exact similarity. With ``probes`` that is approximate; how many
cells a share of the true hits takes depends on the data and is fitted (``probes_for``). Without, it is
exact at any data: each cell has its radius, the k best of the first cells bound what can
still be better, and by the triangle inequality the other cells are opened or not.

The centres are fitted on a bounded sample (``SAMPLE`` vectors, chosen by hash); every
vector is dealt and written. Centres, at most a few thousand, are broadcast; queries are a
stated set of checked size. A cell that holds most vectors is many files of ``FILE_ROWS`` rows,
so neither its write nor a search of it is one task.

Defined cases: zero vectors, vectors with a null or NaN value and vectors of
another length than the centres are never near anything and are not written;
repeated identifiers are found each; fewer vectors than cells give fewer cells; without vectors
no query finds anything.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from telar.functions import vector as V

from . import search
from .nearest import nearest

CELLS = 64
SAMPLE = 20_000
FILE_ROWS = 200_000
ROWS = 1000  # compared with all centres at once
SCHEMA = "id long, v array<double>, cell int"
_SLACK = 1e-9  # rounding of distances, beside the least difference that a double tells


def _unit(c: str) -> Column:
    """The unit vector; null where there is none."""
    v = F.transform(c, lambda x: x.cast("double"))
    good = ~F.exists(v, lambda x: x.isNull() | F.isnan(x)) & (V.norm(F.col(c)) > 0)
    return F.when(good, V.l2_normalize(F.col(c)))


def fit_centres(vectors: DataFrame, cells: int = CELLS, sample: int = SAMPLE, seed: int = 11) -> DataFrame:
    """cell, centre: k-means on a sample by hash of the unit vectors ``v``."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    n = vectors.count()
    few = vectors.filter(F.pmod(F.xxhash64("v"), F.lit(1 << 20)) < F.lit(min(1.0, sample / max(1, n)) * (1 << 20))).limit(2 * sample)
    few = few.select(array_to_vector("v").alias("features")).cache()
    try:
        if few.isEmpty():
            return vectors.sparkSession.createDataFrame([], "cell int, centre array<double>")
        centres = KMeans(k=max(2, cells), seed=seed, maxIter=10).fit(few).clusterCenters()
    finally:
        few.unpersist()
    return vectors.sparkSession.createDataFrame([(i, [float(x) for x in c]) for i, c in enumerate(centres)], "cell int, centre array<double>")


def _distances(rows: DataFrame, centres: DataFrame, v: str) -> DataFrame:
    """The rows with all centres by distance, as an array of struct<d, cell>, nearest first. One row of centres is broadcast."""
    all_ = centres.agg(F.collect_list(F.struct("cell", "centre")).alias("__centres"))
    squared = lambda c: F.aggregate(F.zip_with(F.col(v), c, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x)
    near = F.array_sort(F.transform("__centres", lambda c: F.struct(F.sqrt(squared(c["centre"])).alias("d"), c["cell"].alias("cell"))))
    return rows.crossJoin(F.broadcast(all_)).withColumn("near", near).drop("__centres")  # one row


def _dealt(rows: DataFrame, centres: list[tuple[int, list[float]]]) -> DataFrame:
    """id, v and the cell of the nearest centre (of equally near ones any: the radius of a cell is measured afterwards)."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        cells, at = np.array([c for c, _ in centres], np.int32), np.array([x for _, x in centres])
        for b in (x.slice(i, ROWS) for x in batches for i in range(0, x.num_rows, ROWS)):
            v = np.asarray(b.column("v").flatten()).reshape(b.num_rows, -1)
            nearest_ = ((at * at).sum(1) - 2 * (v @ at.T)).argmin(1)
            yield pa.record_batch([b.column("id"), b.column("v"), pa.array(cells[nearest_])], ["id", "v", "cell"])

    return rows.select("id", "v").mapInArrow(run, SCHEMA)


@dataclass(frozen=True)
class CellIndex:
    """An index at a path that the driver and all executors share: ``vectors`` by cell, and ``cells`` with centre, radius and n."""

    spark: SparkSession
    path: str

    def build(self, rows: DataFrame, id_col: str = "vec_id", vector: str = "embedding", cells: int = CELLS, sample: int = SAMPLE) -> CellIndex:
        unit = rows.select(F.col(id_col).cast("long").alias("id"), F.explode(F.array(_unit(vector))).alias("v")).filter("v IS NOT NULL")
        centres = fit_centres(unit, cells, sample)
        size = centres.agg(F.max(F.size("centre"))).first()[0]
        dealt = _dealt(unit.filter(F.size("v") == F.lit(size)), [tuple(c) for c in centres.select("cell", "centre").collect()])  # a few thousand at most
        dealt.write.option("maxRecordsPerFile", FILE_ROWS).mode("overwrite").partitionBy("cell").parquet(f"{self.path}/vectors")
        own = self.vectors().join(F.broadcast(centres), "cell")
        far = F.sqrt(F.aggregate(F.zip_with("v", "centre", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x))
        own.groupBy("cell").agg(F.first("centre").alias("centre"), F.max(far).alias("radius"), F.count(F.lit(1)).alias("n")).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/cells")
        return self

    def probes_for(self, share: float = 0.95, k: int = 10, queries: int = 200) -> int:
        """How many cells a query has to open so that this share of the k nearest is found.

        Fitted on about so many of the vectors, chosen by hash: where the cell of
        each of their nearest, exactly found, stands in the order that a search opens them.
        """
        v = self.vectors()
        n = max(1, v.count())
        some = v.filter(F.pmod(F.xxhash64("id", F.lit(7)), F.lit(1 << 20)) < F.lit(min(1.0, queries / n) * (1 << 20))).limit(2 * queries)
        q = _distances(some.select(F.col("id").alias("query_id"), F.col("v").alias("query")).dropDuplicates(["query_id"]), self.cells().select("cell", "centre"), "query")
        near = search.vector_search_many(v, q.select("query_id", "query"), k + 1, "id", "v").filter("id <> query_id").select("query_id", "id")
        near = near.join(v.select("id", F.col("cell").alias("own")), "id").join(q.select("query_id", "near"), "query_id")
        place = F.array_position(F.transform("near", lambda c: c["cell"]), F.col("own"))
        return int(near.agg(F.percentile(place, F.lit(share))).first()[0] or 1) + 1

    def built(self) -> bool:
        try:
            return not self.cells().isEmpty()
        except AnalysisException:
            return False

    def vectors(self) -> DataFrame:
        return self.spark.read.schema(SCHEMA).parquet(f"{self.path}/vectors")

    def cells(self) -> DataFrame:
        return self.spark.read.schema("cell int, centre array<double>, radius double, n long").parquet(f"{self.path}/cells")

    def _ranked(self, pairs: DataFrame, k: int) -> DataFrame:
        """The k nearest vectors of each query among the cells of pairs (query_id, q, cell)."""
        own = self.vectors().join(F.broadcast(pairs.select("cell").distinct()), "cell", "left_semi")  # cells are bounded
        return nearest(own, pairs, k, on=["cell"])

    def search(self, queries: DataFrame, k: int = 10, probes: int | None = None, first: int = 2) -> DataFrame:
        """query_id, id, similarity, rank of the k nearest vectors of each query (columns query_id, query).

        probes: how many cells a query opens; None for all that can hold one of
        the k nearest, seen from the k best of its ``first`` cells.
        """
        q = queries.select("query_id", F.explode(F.array(_unit("query"))).alias("q")).filter("q IS NOT NULL")
        q = _distances(q, self.cells().select("cell", "centre"), "q")
        at = lambda n: q.select("query_id", "q", F.explode(F.slice("near", 1, n)).alias("c")).select("query_id", "q", "c.cell")
        if probes is not None:
            return self._ranked(at(probes), k)
        bound = self._ranked(at(first), k).groupBy("query_id").agg(F.min("similarity").alias("least"), F.count(F.lit(1)).alias("found"))
        reach = F.when(F.col("found") == k, F.sqrt(F.greatest(F.lit(0.0), 2 - 2 * F.col("least"))))  # of unit vectors; null: not enough yet
        open_ = q.join(bound, "query_id", "left").select("query_id", "q", reach.alias("reach"), F.explode("near").alias("c"))
        open_ = open_.join(F.broadcast(self.cells().select(F.col("cell").alias("cell_"), "radius")), F.col("c.cell") == F.col("cell_"))
        may = F.col("reach").isNull() | (F.col("c.d") - F.col("radius") <= F.col("reach") + _SLACK)
        return self._ranked(open_.filter(may).select("query_id", "q", F.col("cell_").alias("cell")), k)


def recall(found: DataFrame, exact: DataFrame, query: str = "query_id", key: str = "id") -> DataFrame:
    """Per query the share of the exact hits that were found."""
    both = exact.select(query, key).join(found.select(query, key).withColumn("__hit", F.lit(1)), [query, key], "left")
    return both.groupBy(query).agg((F.count("__hit") / F.count(F.lit(1))).alias("recall"))

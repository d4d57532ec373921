"""A written full-text index: postings in blocks, upkeep by generations, compaction.

The index is a folder of Parquet tables. A row of ``postings`` is a block of a
stem's list: the documents of one range of ``span`` identifiers, ascending, with
their places. Rows are partitioned by a hash of the stem and sorted by stem and
block, so a search reads the partitions of its stems, and of those the row
groups and pages that the stems' statistics leave. A search for several stems
first reads stems and block numbers alone, and opens only the blocks that all
of them have; no list is longer in one row than its range, however common the stem.

Upkeep is by generation: a batch of new versions and deletions appends its own
postings, and a tombstone for each of its identifiers, which ends what
older generations say of it (where a batch has both, the new version stays). ``compact`` writes what is still valid as the base
of a new generation. Each generation writes its own folders and is there once
its row in ``commits`` is, so a repeated batch overwrites itself, a failed one
is never read, and readers of older generations are not disturbed. Identifiers are
integers and keys; documents without one are not found.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from telar.functions.spanish import STOP, stemmed
from telar.shared import removed

from . import search

SPAN = 4096
PARTS = 64
TASK_DOCUMENTS = 1 << 17
TASK_ENTRIES = 1 << 21
SLOT_TASKS = 16  # a stem's blocks are dealt over a task in so many
POSTINGS = "part int, stem string, block long, ids array<long>, places array<array<int>>, gen int"
TOMBSTONES = "id long, gen int"
COMMITS = "base boolean, gen int"
_LISTS = "part int, stem string, block long, list array<struct<id: long, place: int>>"


def _by_id(s: Column) -> Column:
    """Sorted pairs of id and place as a list of id and its places."""
    starts = F.filter(F.sequence(F.lit(1), F.size(s)), lambda i: (i == 1) | (F.element_at(s, i)["id"] != F.get(s, i - 2)["id"]))
    own = lambda n, i, k: F.array_distinct(F.transform(F.sequence(i, F.coalesce(F.get(n, k + 1) - 1, F.size(s))), lambda j: F.element_at(s, j)["place"]))
    return F.transform(F.array(starts), lambda n: F.transform(n, lambda i, k: F.struct(F.element_at(s, i)["id"].alias("id"), own(n, i, k).alias("places"))))[0]


@dataclass(frozen=True)
class TextIndex:
    """An index at a path that the driver and all executors share."""

    spark: SparkSession
    path: str
    columns: tuple[str, ...]
    id_col: str = "id"
    span: int = SPAN
    parts: int = PARTS

    # writing: one batch at a time

    def build(self, df: DataFrame) -> TextIndex:
        """The index of these documents, as a new base: what was there before counts no more."""
        self._write(df, None, self._last() + 1, base=True)
        return self

    def apply(self, upserts: DataFrame | None = None, deletes: DataFrame | None = None, gen: int | None = None) -> int:
        """One batch: documents in their new version, and identifiers that are gone. A batch that is repeated says its ``gen`` and writes the same again."""
        gen = self._last() + 1 if gen is None else gen
        ids = [x.select(F.col(self.id_col).cast("long").alias("id")) for x in (upserts, deletes) if x is not None]
        ended = ids[0].union(ids[1]).distinct() if len(ids) > 1 else ids[0].distinct() if ids else None
        self._write(upserts, ended, gen, base=False)
        return gen

    def compact(self) -> int:
        """All that is valid, as one base."""
        gen = self._last() + 1
        commits = self._commits()
        blocks = self._read(commits)
        entries = blocks.agg(F.coalesce(F.sum(F.size("ids")), F.lit(0))).first()[0]
        tasks = max(self.spark.sparkContext.defaultParallelism, -(-entries // TASK_ENTRIES))
        valid = self._valid_blocks(blocks, commits).select("part", "stem", "block", "docs")
        self._write_postings(valid, F.array_sort(F.flatten(F.collect_list("docs"))), tasks, gen)
        self._commit(gen, base=True)
        return gen

    def vacuum(self) -> None:
        """Delete the folders of generations before the last base; readers that began on them must be done."""
        base = max((r.gen for r in self._commits() if r.base), default=0)
        for r in self._commits():
            if r.gen < base:
                for name in ("commits", "postings", "tombstones"):
                    removed(self.spark, f"{self.path}/{name}/gen={r.gen}")

    def _write(self, docs: DataFrame | None, ended: DataFrame | None, gen: int, base: bool) -> None:
        """Both tables are written, also empty ones: an attempt that failed may have left rows under the same number."""
        blocks, tasks = (self.spark.createDataFrame([], _LISTS), 1) if docs is None else self._blocks(docs)
        self._write_postings(blocks, F.transform(F.array(F.array_sort(F.flatten(F.collect_list("list")))), _by_id)[0], tasks, gen)
        ended = self.spark.createDataFrame([], "id long") if ended is None else ended.filter("id IS NOT NULL")
        ended.write.mode("overwrite").parquet(f"{self.path}/tombstones/gen={gen}")
        self._commit(gen, base)

    def _blocks(self, docs: DataFrame) -> tuple[DataFrame, int]:
        """part, stem, block, list (id and place of each occurrence; a row a word), and how many tasks they are work for.

        Documents are dealt by block once, as text; then a block's words are listed, and stemmed once each, where they are.
        """
        text = F.concat_ws(" ", *(F.coalesce(c, F.lit("")) for c in self.columns))
        docs = docs.select(F.col(self.id_col).cast("long").alias("id"), text.alias("text")).filter("id IS NOT NULL")
        tasks = max(self.spark.sparkContext.defaultParallelism, -(-docs.count() // TASK_DOCUMENTS))
        own = docs.withColumn("block", F.floor(F.col("id") / self.span).cast("long")).repartition(tasks, "block")
        rows = own.select("block", "id", F.posexplode(search.spanish_words(F.col("text"))).alias("at", "w")).filter(~F.col("w").isin(*STOP))
        words = rows.groupBy("w", "block").agg(F.collect_list(F.struct("id", (F.col("at") + 1).alias("place"))).alias("list"))
        return stemmed(words, "w").select(self._part(), "stem", "block", "list"), tasks

    def _write_postings(self, blocks: DataFrame, docs: Column, tasks: int, gen: int) -> None:
        """blocks: part, stem, block and what ``docs`` makes one list (id, places) a block of. Groups are bounded by the range; a common stem is dealt over many tasks by its blocks."""
        slots = -(-tasks // SLOT_TASKS)
        dealt = blocks.withColumn("slot", F.pmod("block", F.lit(slots))).repartition(tasks, "part", "slot")
        lists = dealt.groupBy("part", "slot", "stem", "block").agg(docs.alias("docs")).filter(F.size("docs") > 0)
        rows = lists.select("part", "stem", "block", F.col("docs.id").alias("ids"), F.col("docs.places").alias("places"))
        rows.sortWithinPartitions("part", "stem", "block").write.mode("overwrite").partitionBy("part").parquet(f"{self.path}/postings/gen={gen}")

    def _commit(self, gen: int, base: bool) -> None:
        self.spark.createDataFrame([(base,)], "base boolean").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/commits/gen={gen}")

    # reading

    def _table(self, name: str, schema: str) -> DataFrame:
        """A table over the generations; empty where none wrote it yet."""
        try:
            return self.spark.read.schema(schema).option("basePath", f"{self.path}/{name}").parquet(f"{self.path}/{name}")
        except AnalysisException:
            return self.spark.createDataFrame([], schema)

    def _commits(self) -> list:
        return self._table("commits", COMMITS).collect()  # a row a generation

    def built(self) -> bool:
        return bool(self._commits())

    def _last(self) -> int:
        return max((r.gen for r in self._commits()), default=0)

    def _read(self, commits: list) -> DataFrame:
        """Postings of the committed generations since the last base."""
        base = max((r.gen for r in commits if r.base), default=0)
        return self._table("postings", POSTINGS).filter(F.col("gen").isin([r.gen for r in commits if r.gen >= base]))

    def _valid_blocks(self, blocks: DataFrame, commits: list) -> DataFrame:
        """The blocks with the list ``docs`` (id, places) of what no later tombstone ends, without empty ones.

        Blocks meet the tombstones of their range as one array of the last generation that ended each identifier; entries are not joined.
        """
        docs = F.transform(F.arrays_zip("ids", "places"), lambda e: F.struct(e["ids"].alias("id"), e["places"].alias("places")))
        base = max((r.gen for r in commits if r.base), default=0)
        later = [r.gen for r in commits if r.gen > base]
        if not later:
            return blocks.withColumn("docs", docs).drop("ids", "places")
        at = (F.col("id") - F.col("block") * self.span).cast("int")
        last = self._table("tombstones", TOMBSTONES).filter(F.col("gen").isin(later)).groupBy(F.floor(F.col("id") / self.span).cast("long").alias("block"), "id").agg(F.max("gen").alias("gen"))
        ends = last.groupBy("block").agg(F.array_sort(F.collect_list(F.struct(at.alias("at"), "gen"))).alias("t"))
        none = lambda t, x, k: F.array_repeat(F.lit(0), x["at"] - F.coalesce(F.when(k > 0, F.get(t, k - 1)["at"]), F.lit(-1)) - 1)
        ended = F.transform(F.array("t"), lambda t: F.flatten(F.transform(t, lambda x, k: F.concat(none(t, x, k), F.array(x["gen"])))))[0]
        both = blocks.join(ends.select("block", ended.alias("ended")).hint("shuffle_hash"), "block", "left")
        kept = F.filter(docs, lambda e: F.coalesce(F.get("ended", (e["id"] - F.col("block") * self.span).cast("int")), F.lit(0)) <= F.col("gen"))
        return both.withColumn("docs", F.when(F.col("ended").isNull(), docs).otherwise(kept)).drop("ended", "ids", "places")

    def _valid(self, blocks: DataFrame, commits: list) -> DataFrame:
        """Entries of the blocks (stem, id, places, more columns of the blocks) that no later tombstone ends."""
        more = [c for c in blocks.columns if c not in ("part", "block", "ids", "places", "gen")]
        return self._valid_blocks(blocks, commits).select(*more, F.explode("docs").alias("e")).select(*more, "e.id", "e.places")

    def lexemes(self, stems: Sequence[str] | None = None) -> DataFrame:
        """stem, id, places, as ``search.lexemes`` gives them; of these stems alone, or of all."""
        commits = self._commits()
        blocks = self._read(commits)
        if stems is not None:
            wanted = self.spark.createDataFrame([(s,) for s in stems], "stem string").select("stem", self._part()).collect()
            blocks = self._of(blocks, wanted)
        return self._valid(blocks, commits).select("stem", "id", "places")

    def _part(self) -> Column:
        return F.pmod(F.xxhash64("stem"), F.lit(self.parts)).cast("int").alias("part")

    @staticmethod
    def _of(blocks: DataFrame, wanted: list) -> DataFrame:
        """The blocks of some stems, by values that prune partitions and row groups."""
        return blocks.filter(F.col("part").isin([r.part for r in wanted]) & F.col("stem").isin([r.stem for r in wanted]))

    def hits(self, queries: DataFrame, k: int = 0, order: Sequence[Column] = (), about: DataFrame | None = None, term: str = "term") -> DataFrame:
        """As ``search.spanish_hits``, from the blocks that all stems of a term share."""
        commits = self._commits()
        asked = search.asked_stems(queries, term).withColumn("part", self._part())
        few = asked.limit(search.BLOCK_QUERIES + 1).collect()
        blocks = self._read(commits)
        if len(few) <= search.BLOCK_QUERIES:  # a stated query set of checked size
            asked = F.broadcast(self.spark.createDataFrame([tuple(r) for r in few], asked.schema))
            blocks = self._of(blocks, few)
        blocks = blocks.join(asked, ["part", "stem"])
        if any(r.n > 1 for r in few):  # stems and block numbers alone; a block may have rows in several generations
            shared = blocks.select("term", "block", "stem", "n").groupBy("term", "block", "n").agg(F.count_distinct("stem").alias("found")).filter("found = n").select("term", "block")
            blocks = blocks.join(shared, ["term", "block"], "left_semi")
        return search.ranked_hits(self._valid(blocks, commits), k, order, about)


def of_files(*frames: DataFrame) -> str:
    """A name for the files that frames read, by their paths, sizes and times: an index of the same files serves again."""
    names = []
    for df in frames:
        files = df.sparkSession.read.format("binaryFile").load(df.inputFiles()).select("path", "length", "modificationTime")  # contents stay unread
        names.append(files.agg(F.hex(F.bit_xor(F.xxhash64(*files.columns)))).first()[0])
    return "-".join(names)

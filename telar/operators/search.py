"""Full-text and exact vector search, fusion of rankings, and evaluation.

Query sets are data: all queries run in one job. Queries are a stated set whose
size is checked before they are broadcast; vectors meet their queries in blocks.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from telar.functions import vector as V
from telar.functions.spanish import STOP, stemmed
from telar.functions.text import fold

from .nearest import nearest

RRF_K = 60
MOST_ROWS = 200
BLOCK_QUERIES = 10_000


def tokens(c: Column, stop: Sequence[str] = ()) -> Column:
    """Folded words without stop words."""
    words = F.filter(F.split(fold(c), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    return F.filter(words, lambda w: ~w.isin(*stop)) if stop else words


def postings(df: DataFrame, id_col: str, columns: Sequence[str], stop: Sequence[str] = ()) -> DataFrame:
    """The inverted index: token, id, tf, and the document's length. Write it bucketed by token to serve many searches."""
    words = tokens(F.concat_ws(" ", *(F.coalesce(c, F.lit("")) for c in columns)), stop)
    rows = df.select(F.col(id_col).alias("id"), words.alias("ws"))
    return rows.select("id", F.size("ws").alias("length"), F.explode("ws").alias("token")).groupBy("token", "id").agg(F.count(F.lit(1)).alias("tf"), F.first("length").alias("length"))


def text_hits(index: DataFrame, docs: DataFrame, query: str, stop: Sequence[str] = (), k1: float = 1.2, b: float = 0.75) -> DataFrame | None:
    """id and BM25 rank of the documents that hold all of the query's words; None for a query without words. docs: one row per document with ``length``."""
    row = index.sparkSession.range(1).select(F.array_distinct(tokens(F.lit(query), stop)).alias("w")).first()
    if not row.w:
        return None
    stats = docs.agg(F.count(F.lit(1)).alias("n"), F.avg("length").alias("mean"))
    own = index.filter(F.col("token").isin(row.w))
    df = own.groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    scored = own.join(F.broadcast(df), "token").crossJoin(F.broadcast(stats))  # a row per query word; one row
    part = F.log1p((F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5)) * F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("length") / F.col("mean")))
    return scored.groupBy("id").agg(F.count(F.lit(1)).alias("found"), F.sum(part).alias("rank")).filter(F.col("found") == len(row.w)).drop("found")


def scan_hits(df: DataFrame, id_col: str, columns: Sequence[str], query: str, stop: Sequence[str] = (), k1: float = 1.2, b: float = 0.75) -> DataFrame | None:
    """As text_hits, for one search without an index: words are counted in place, and only statistics are shuffled."""
    words = df.sparkSession.range(1).select(F.array_distinct(tokens(F.lit(query), stop)).alias("w")).first().w
    if not words:
        return None
    ws = tokens(F.concat_ws(" ", *(F.coalesce(c, F.lit("")) for c in columns)), stop)
    tf = lambda w, q: F.size(F.filter(w, lambda x: x == q))
    counted = F.transform(F.array(ws), lambda w: F.struct(F.size(w).alias("length"), F.array(*(tf(w, q) for q in words)).alias("tf")))[0]  # the words are made once a row
    rows = df.select(F.col(id_col).alias("id"), counted.alias("c")).select("id", "c.length", "c.tf")
    stats = rows.agg(F.count(F.lit(1)).alias("n"), F.avg("length").alias("mean"), *(F.count_if(F.col("tf")[i] > 0).alias(f"df{i}") for i in range(len(words))))
    found = rows.filter(reduce(lambda x, y: x & y, (F.col("tf")[i] > 0 for i in range(len(words))))).crossJoin(F.broadcast(stats))  # one row
    part = lambda i: F.log1p((F.col("n") - F.col(f"df{i}") + 0.5) / (F.col(f"df{i}") + 0.5)) * F.col("tf")[i] * (k1 + 1) / (F.col("tf")[i] + k1 * (1 - b + b * F.col("length") / F.col("mean")))
    return found.select("id", sum((part(i) for i in range(len(words))), F.lit(0.0)).alias("rank"))


def spanish_words(c: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(c, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def spanish_terms(queries: DataFrame, term: str = "term") -> DataFrame:
    """term, stem: the distinct stems of each distinct search term, without stop words."""
    words = queries.select(F.col(term).alias("term")).distinct().select("term", F.explode(F.array_distinct(spanish_words(F.col("term")))).alias("w")).filter(~F.col("w").isin(*STOP))
    return stemmed(words, "w").select("term", "stem").distinct()


def lexemes(df: DataFrame, id_col: str, columns: Sequence[str], stems: Sequence[str] | None = None, most_places: int | None = None, last_place: int | None = None) -> DataFrame:
    """The inverted index of Spanish text: stem, id, places (ascending). With ``stems``, of these alone.

    The SQL database keeps 256 places of a word and tells none apart from 16,383 on; ask for that with ``most_places`` and ``last_place``.

    Stemming leaves a word's first two letters but for their accents, so with
    ``stems`` only words that begin like one of them are exploded and stemmed.
    """
    placed = F.transform(spanish_words(F.concat_ws(" ", *(F.coalesce(c, F.lit("")) for c in columns))), lambda w, i: F.struct((i + 1 if last_place is None else F.least(i + 1, F.lit(last_place))).alias("place"), w.alias("w")))
    if stems is not None:
        heads = sorted({x[:2] for x in stems})
        placed = F.filter(placed, lambda p: F.translate(F.substring(p["w"], 1, 2), "áéíóú", "aeiou").isin(*heads)) if heads else F.slice(placed, 1, 0)
    rows = df.select(F.col(id_col).alias("id"), F.explode(placed).alias("p")).select("id", "p.place", "p.w").filter(~F.col("w").isin(*STOP))
    if stems is None:
        own = rows.join(stemmed(rows.select("w").distinct(), "w"), "w").drop("w")  # each word is stemmed once
    else:
        own = stemmed(rows, "w").drop("w").filter(F.col("stem").isin(*stems))
    places = F.sort_array(F.collect_set("place"))
    return own.groupBy("stem", "id").agg((places if most_places is None else F.slice(places, 1, most_places)).alias("places"))


def write_lexemes(index: DataFrame, table: str, buckets: int = 64) -> DataFrame:
    """The index as a table in buckets by stem, so that a search reads the buckets of its stems and joins without a shuffle of the index."""
    index.write.mode("overwrite").bucketBy(buckets, "stem").sortBy("stem").saveAsTable(table)
    return index.sparkSession.table(table)


def _apart(a: Column, b: Column) -> Column:
    """How much two places of different words do not say: 1 - 0.1 times the root of their nearness."""
    d = F.abs(a - b)
    return F.when(d == 0, 1.0).otherwise(1 - 0.1 * F.sqrt(F.when(d > 100, 1e-30).otherwise(1 / (1.005 + 0.05 * F.exp(d / 1.5 - 2)))))


def text_rank(places: Column) -> Column:
    """The rank of a document by the places of all words asked for (array of arrays), as the SQL database computes it for words of equal weight.

    One word: 0.1 / j^2 summed over its places, by the limit of that series.
    More: one minus the product over pairs of places of different words.
    """
    one = F.aggregate(F.transform(places[0], lambda _, j: 0.1 / ((j + 1) * (j + 1))), F.lit(0.0), lambda a, x: a + x) / 1.64493406685
    product = lambda xs, f: F.aggregate(xs, F.lit(1.0), lambda a, x: a * f(x))
    pairs = lambda k: product(F.slice(places, 1, k), lambda own: product(own, lambda x: product(F.get(places, k), lambda y: _apart(x, y))))
    many = 1 - product(F.sequence(F.lit(1), F.size(places) - 1), pairs)
    return F.when(F.size(places) == 1, one).when(many > 0, many).otherwise(1e-20)


def spanish_hits(index: DataFrame, queries: DataFrame, k: int = 0, order: Sequence[Column] = (), about: DataFrame | None = None, term: str = "term") -> DataFrame:
    """term, id, rank of the documents with all stems of a term; the k best of each (by rank, then ``order`` over ``about``'s columns, then id) with ``pos``.

    Distinct terms are searched once, however many queries share them. The
    stems of the terms are a stated query set of checked size.
    """
    stems = asked_stems(queries, term)
    return ranked_hits(index.join(asked(stems), "stem"), k, order, about)


def asked(queries: DataFrame) -> DataFrame:
    """A stated query set, marked to be broadcast if its rows are counted and few."""
    return F.broadcast(queries) if queries.limit(BLOCK_QUERIES + 1).count() <= BLOCK_QUERIES else queries


def asked_stems(queries: DataFrame, term: str = "term") -> DataFrame:
    """term, n (how many stems it has), stem."""
    terms = spanish_terms(queries, term).groupBy("term").agg(F.collect_set("stem").alias("stems"))
    return terms.select("term", F.size("stems").alias("n"), F.explode("stems").alias("stem"))


def ranked_hits(entries: DataFrame, k: int = 0, order: Sequence[Column] = (), about: DataFrame | None = None) -> DataFrame:
    """term, id, rank (and pos) from entries of the index beside the terms that ask for them: term, n, stem, id, places.

    Ranks are single-precision numbers, as in the SQL database, so equal ones tie whatever the order of multiplication.
    """
    found = entries.groupBy("term", "id").agg(F.first("n").alias("n"), F.array_sort(F.collect_list(F.struct("stem", "places"))).alias("own")).filter(F.size("own") == F.col("n"))
    hits = found.select("term", "id", text_rank(F.col("own.places")).cast("float").cast("double").alias("rank"))
    if about is not None:
        hits = hits.join(about, "id")
    if not k:
        return hits
    w = Window.partitionBy("term").orderBy(F.desc("rank"), *order, "id")
    return hits.withColumn("pos", F.row_number().over(w)).filter(F.col("pos") <= k)


def search_records(df: DataFrame, term: str | None = "", equals: dict[str, str | None] | None = None, like: dict[str, str | None] | None = None, text: Sequence[str] = ("descripcion", "entidad", "descripcion_contrato", "objeto"), id_col: str = "id", date_col: str = "fecha_publica", limit: int = 50, offset: int = 0, most: int | None = None) -> DataFrame:
    """All stems of the term, optional filters (null: none), by rank, then newest; a page of ``limit`` rows, and of ``most`` (the SQL function's is ``MOST_ROWS``) if that is less. A term that is blank, or all stop words, finds all rows at rank 1 or none, as in the database."""
    for c, v in (equals or {}).items():
        df = df.filter(F.col(c) == v) if v is not None else df
    for c, v in (like or {}).items():
        df = df.filter(F.col(c).ilike(f"%{v}%")) if v is not None else df
    found = df.withColumn("rank", F.lit(1.0))
    if term and term.strip():
        asked = df.sparkSession.range(1).select(F.lit(term).alias("term"))
        stems = [r.stem for r in spanish_terms(asked).collect()]
        hits = spanish_hits(lexemes(df, id_col, text, stems), asked).select(F.col("id").alias("__id"), "rank")
        found = df.join(hits, F.col(id_col) == F.col("__id")).drop("__id")
    return found.orderBy(F.desc("rank"), F.col(date_col).desc_nulls_last(), F.asc(id_col)).offset(offset).limit(limit if most is None else min(limit, most))


def vector_search(chunks: DataFrame, query: Sequence[float], k: int = 10, min_similarity: float = 0.2, vector: str = "embedding_v2", parents: DataFrame | None = None, state: str | None = "Vigente", ties: Sequence[str] = ("contrato_id", "chunk_index")) -> DataFrame:
    """The k nearest chunks above (not at) the similarity, of parents in a state (null: any). A zero query finds nothing."""
    if parents is not None:
        own = parents if state is None else parents.filter(F.col("estado") == state)
        chunks = chunks.join(own.select(F.col("id").alias("contrato_id")), "contrato_id", "left_semi")
    q = F.array(*(F.lit(float(x)) for x in query))
    near = chunks.withColumn("similarity", V.cosine_similarity(F.col(vector), q)).filter(F.col("similarity") > min_similarity)
    return near.orderBy(F.desc("similarity"), *ties).limit(k)


def vector_search_many(rows: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id", vector: str = "embedding", min_similarity: float = -1.0) -> DataFrame:
    """query_id, id, similarity, rank of the k nearest rows of each query (columns query_id, query).

    All rows are compared with all queries, by blocks of both (``nearest``).
    """
    unit = lambda c: V.l2_normalize(F.col(c))
    return nearest(rows.select(F.col(id_col).alias("id"), unit(vector).alias("v")), queries.select("query_id", unit("query").alias("q")), k, min_similarity)


def mean_pairwise(df: DataFrame, group: Sequence[str], vector: str) -> DataFrame:
    """Pairs and mean cosine of all pairs of a group, without making pairs: of unit vectors, (|sum|^2 - n) / (n (n - 1)). Zero vectors are left out."""
    v = df.select(*group, V.l2_normalize(F.col(vector)).alias("v"), V.norm(F.col(vector)).alias("len")).filter("len > 0")
    sums = v.select(*group, F.posexplode("v").alias("i", "x")).groupBy(*group, "i").agg(F.sum("x").alias("s"), F.count(F.lit(1)).alias("n"))
    return sums.groupBy(*group).agg(F.max("n").alias("n"), F.sum(F.col("s") * F.col("s")).alias("ss")).filter("n > 1").select(*group, (F.col("n") * (F.col("n") - 1) / 2).cast("long").alias("pairs"), ((F.col("ss") - F.col("n")) / (F.col("n") * (F.col("n") - 1))).alias("mean_cosine"))


def first_hits(hits: DataFrame, query: Sequence[str], key: str, *order: Column) -> DataFrame:
    """The best hit of each key, with ``pos``, its place among the keys (from 1)."""
    best = hits.withColumn("__n", F.row_number().over(Window.partitionBy(*query, key).orderBy(*order))).filter("__n = 1").drop("__n")
    return best.withColumn("pos", F.row_number().over(Window.partitionBy(*query).orderBy(*order)))


def reciprocal_rank_fusion(a: DataFrame, b: DataFrame, key: str, query: Sequence[str] = ("query_id",), k: int = 10, constant: int = RRF_K) -> DataFrame:
    """Two rankings (columns query, key, pos from 1, and more from ``a``) as one: rrf to six digits, ties by the order in a, then in b."""
    on = [*query, key]
    both = a.withColumnRenamed("pos", "pos_a").join(b.select(*on, F.col("pos").alias("pos_b")), on, "full_outer")
    share = lambda c: F.coalesce(1.0 / (constant + F.col(c)), F.lit(0.0))
    w = Window.partitionBy(*query).orderBy(F.desc(share("pos_a") + share("pos_b")), F.col("pos_a").asc_nulls_last(), F.col("pos_b").asc_nulls_last(), key)
    return both.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= k).withColumn("rrf", F.bround(share("pos_a") + share("pos_b"), 6))


def at_most_per_key(hits: DataFrame, query: Sequence[str], key: str, most: int, *order: Column) -> DataFrame:
    return hits.withColumn("__n", F.row_number().over(Window.partitionBy(*query, key).orderBy(*order))).filter(F.col("__n") <= most).drop("__n")


def text_when_few(vector_hits: DataFrame, text_hits_: DataFrame, query: Sequence[str], least: int = 3) -> DataFrame:
    """Text hits are added only for queries with fewer than ``least`` vector hits."""
    enough = vector_hits.groupBy(*query).count().filter(F.col("count") >= least).select(*query)
    return vector_hits.unionByName(text_hits_.join(enough, list(query), "left_anti"), allowMissingColumns=True)


def reranked(hits: DataFrame, score: Column | None, query: Sequence[str], k: int = 5, *fallback: Column) -> DataFrame:
    """The k best by a reranker's score; by the fallback order where there is none."""
    order = [*([score.desc_nulls_last()] if score is not None else []), *fallback]
    return hits.withColumn("__n", F.row_number().over(Window.partitionBy(*query).orderBy(*order))).filter(F.col("__n") <= k).drop("__n")


def retrieval_metrics(hits: DataFrame, queries: DataFrame, gold: DataFrame | None = None, query: str = "query_id", key: str = "id") -> DataFrame:
    """Per query: n_hits, n_relevant, p_at_5, p_at_k, success, gold, recall.

    hits: query, key, rank, relevant. Precision divides by the hits returned
    (at most 5 of them); recall is null without gold.
    """
    rel = F.col("relevant").cast("int")
    per = hits.groupBy(query).agg(F.count(F.lit(1)).alias("n_hits"), F.sum(rel).alias("n_relevant"), F.sum(F.when(F.col("rank") <= 5, rel)).alias("r5"))
    out = queries.select(query).join(per, query, "left")
    n, r = F.coalesce("n_hits", F.lit(0)), F.coalesce("n_relevant", F.lit(0))
    out = out.select(
        query, n.alias("n_hits"), r.alias("n_relevant"), F.bround(F.coalesce(F.try_divide(F.coalesce("r5", F.lit(0)), F.least(F.lit(5), n)), F.lit(0.0)), 3).alias("p_at_5"), F.bround(F.coalesce(F.try_divide(r, n), F.lit(0.0)), 3).alias("p_at_k"), (r > 0).alias("success"),
    )
    if gold is None:
        return out.withColumns({"gold": F.lit(0), "recall": F.lit(None).cast("double")})
    gold = gold.select(query, key).distinct()
    both = gold.join(hits.select(query, key).distinct().withColumn("__in", F.lit(1)), [query, key], "left").groupBy(query).agg(F.count(F.lit(1)).alias("gold"), F.bround(F.count("__in") / F.count(F.lit(1)), 3).alias("recall"))
    return out.join(both, query, "left").withColumn("gold", F.coalesce("gold", F.lit(0)))


def macro(metrics: DataFrame) -> DataFrame:
    """One row of means over queries; recall over those that have one."""
    mean = lambda c, n: F.bround(F.avg(c), 3).alias(n)
    return metrics.agg(
        F.count(F.lit(1)).alias("n_queries"), F.avg(F.col("success").cast("int")).alias("success_at_k"), mean("p_at_5", "macro_p_at_5"), mean("p_at_k", "macro_p_at_k"), mean("recall", "macro_recall"), F.count_if(F.col("n_hits") == 0).alias("without_hits"),
    )


def known_item(hits: DataFrame, expected: DataFrame, query: str = "query_id", key: str = "id", top: int = 5) -> DataFrame:
    """Per query: the rank of the expected key, and whether it is in the top."""
    both = expected.select(query, F.col(key).alias("__want")).join(hits, query, "left")
    at = F.min(F.when(F.col(key) == F.col("__want"), F.col("rank")))
    return both.groupBy(query).agg(at.alias("rank"), F.coalesce(at <= top, F.lit(False)).alias("in_top"))


def overlap(a: DataFrame, b: DataFrame, query: str = "query_id", key: str = "id") -> DataFrame:
    """Per query: keys in both lists, only in a, only in b."""
    both = a.select(query, key).distinct().withColumn("a", F.lit(1)).join(b.select(query, key).distinct().withColumn("b", F.lit(1)), [query, key], "full_outer")
    return both.groupBy(query).agg(F.count(F.col("a") + F.col("b")).alias("n_both"), F.count_if(F.col("b").isNull()).alias("only_a"), F.count_if(F.col("a").isNull()).alias("only_b"))


def context_text(contracts: DataFrame, chunks: DataFrame, most_chunks: int | None = None, most_chars: int | None = None) -> DataFrame:
    """id, context, origin: the stored text, or else the chunks joined, or else nothing. The original takes 80 chunks and 60,000 characters: ask for that with the bounds."""
    few = chunks.filter(F.col("chunk_index").isNotNull()).withColumn("texto", F.concat(F.lit("["), F.coalesce("fuente", F.lit("api")), F.lit(" · "), F.coalesce("tipo", F.lit("chunk")), F.lit("]\n"), F.coalesce("texto", F.lit("")))).withColumn("__n", F.row_number().over(Window.partitionBy("contrato_id").orderBy("chunk_index"))).filter(F.lit(True) if most_chunks is None else F.col("__n") <= most_chunks)
    joined = few.groupBy(F.col("contrato_id").alias("id")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("__n", "texto"))), lambda s: s["texto"]), "\n\n").alias("joined"))
    stored = F.nullif(F.trim(F.coalesce("tdr_texto", F.lit(""))), F.lit(""))
    both, text = contracts.select("id", stored.alias("stored")).join(joined, "id", "left"), F.coalesce("stored", "joined", F.lit(""))
    return both.select("id", (text if most_chars is None else F.substring(text, 1, most_chars)).alias("context"), F.when(F.col("stored").isNotNull(), "tdr_texto").when(F.col("joined").isNotNull(), "chunks").otherwise("ficha").alias("origin"))


def find_contract(contracts: DataFrame, key: int | None = None, number: str | None = None) -> DataFrame:
    """By id, else the first whose title or number holds the text."""
    if key is not None:
        return contracts.filter(F.col("id") == key)
    return contracts.filter(F.col("descripcion_contrato").ilike(f"%{number}%") | F.col("nro_contratacion").ilike(f"%{number}%")).orderBy(F.desc("id")).limit(1)


def query_filters(c: Column) -> Column:
    """What a question asks for besides its words: struct<estado, objeto, anio>."""
    t = fold(c)
    state = F.when(t.rlike(r"\bvigentes?\b|\babiert[oa]s?\b"), "Vigente").when(t.rlike(r"\bculminad[oa]s?\b"), "Culminado").when(t.rlike(r"\ben evaluacion\b"), "En Evaluación")
    kind = F.when(t.rlike(r"\bservicios?\b"), "Servicio").when(t.rlike(r"\bbienes\b|\bbien\b"), "Bien").when(t.rlike(r"\bobras?\b"), "Obra")
    return F.struct(state.alias("estado"), kind.alias("objeto"), F.nullif(F.regexp_extract(t, r"\b(20\d\d)\b", 1), F.lit("")).try_cast("int").alias("anio"))


def mean_similarity(hits: DataFrame, queries: DataFrame, query: str = "query_id") -> DataFrame:
    """Per query the mean similarity of its hits, 0 without hits; average these for the overall mean."""
    return queries.select(query).join(hits.groupBy(query).agg(F.avg("similarity").alias("m")), query, "left").select(query, F.coalesce("m", F.lit(0.0)).alias("mean_similarity"))

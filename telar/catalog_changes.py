"""Registered queries of operators that keep something up: quotas, changed documents, and all keywords in one pass; and of sources that are asked over a network."""

from __future__ import annotations

from functools import reduce
from io import BytesIO
from urllib.error import HTTPError

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telar.catalog_records import _LOCAL, query, table
from telar.catalog_more import _PHRASE_SQL, _any_sql, _folder, _phrases, _sum_sql
from telar.operators import automaton, classify, constraints, embedding, state
from telar.plans import changes
from telar.sources import captured
from telar.sources.rest import CapturedPages, PagedSource
from telar.streaming import quota

_CASES = " ".join(f"WHEN {_any_sql(ts)} THEN '{c}'" for c, ts in classify.CATEGORIES.items())
_TERMS = ", ".join(f"CASE WHEN contains(t, '{x}') THEN '{x}' END" for x in dict.fromkeys([*classify.STRONG, *classify.GENERIC_WIDE]))


@query(
    f"""SELECT k, CASE {_CASES} END AS category, CASE WHEN {_any_sql(classify.STRONG)} THEN 'ALTA' WHEN {_sum_sql(classify.GENERIC)} >= 2 THEN 'MEDIA' WHEN {_sum_sql(classify.GENERIC)} = 1 THEN 'BAJA' END AS level,
    concat_ws(', ', {_TERMS}) AS terms FROM {_PHRASE_SQL}"""
)
def classified_in_one_pass(spark, sf_dir):
    """Category, relevance and terms of records from one automaton of all dictionaries."""
    terms = automaton.every_term(classify.CATEGORIES, classify.STRONG, classify.GENERIC, classify.GENERIC_WIDE)
    rows = _phrases(spark, sf_dir).select("k", automaton.found(F.col("t"), terms).alias("hits"))
    return rows.select("k", automaton.first_category(F.col("hits")).alias("category"), automaton.relevance(F.col("hits")).alias("level"), automaton.detected(F.col("hits")).alias("terms"))


# Keywords that the texts hold, some within others; the last is a whole word only.
_NESTED = ("the", "he", "her", "here", "there", " in ", "ing", "tion", "ation", "ion", "que", "une", "der", "und", "ia")
_WHOLE = r"(^|[^\p{L}\p{Nd}_])ia([^\p{L}\p{Nd}_]|$)"


@query(f"SELECT doc_id, concat_ws(',', {', '.join(f'''CASE WHEN {f"contains(t, '{x}')" if x != 'ia' else f"regexp_matches(t, '{_WHOLE}')"} THEN '{x}' END''' for x in _NESTED)}) AS terms FROM (SELECT doc_id, lower(text) AS t FROM documents)")
def document_terms(spark, sf_dir):
    """The keywords of whole texts, each text read once."""
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", F.array_join(automaton.found(F.lower("text"), _NESTED), ",").alias("terms"))


_DAY_OF = _LOCAL.format("ts")


@query(
    f"""SELECT event_id, round(running, 4) AS running, running <= 300 AS planned, CASE WHEN running > 300 THEN 'quota' END AS reason
    FROM (SELECT event_id, sum(value) OVER (PARTITION BY event_type, {_DAY_OF} ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS running FROM events)"""
)
def quota_stream(spark, sf_dir):
    """A day's budget by type of event, kept by a stream that is stopped and started again between three deliveries."""
    folder = _folder(spark)
    e = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    first, last = e.agg(F.min("ts"), F.max("ts")).first() or (None, None)
    for part in range(3):
        edge = lambda i: F.lit(first) + (F.lit(last) - F.lit(first)) * F.lit(i / 3)
        lower, upper = (F.col("ts") >= edge(part)) if part else F.lit(True), (F.col("ts") < edge(part + 1)) if part < 2 else F.lit(True)
        e.filter(lower & upper).write.mode("append").parquet(f"{folder}/in")
        calls = spark.readStream.schema(e.schema).parquet(f"{folder}/in")
        with quota.state_store(spark):
            kept = quota.planned_calls(calls, ["event_type"], "ts", "event_id", "value", 300.0)
            run = kept.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
            run.awaitTermination()
    return spark.read.parquet(f"{folder}/out").select("event_id", F.round("running", 4).alias("running"), "planned", "reason")


_PAGES_SQL = """(SELECT doc_id, i - 1 AS n, CASE WHEN doc_id % 10 = 3 AND i = 1 THEN concat(s[i], ' cambio') ELSE s[i] END AS line, s[i] AS was
    FROM (SELECT doc_id, s, unnest(range(1, len(s) + 1)) AS i FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS s FROM documents))) p"""


@query(
    f"""SELECT doc_id, CASE WHEN doc_id % 10 = 7 THEN 0 ELSE 2 * n END AS n_chunks, CASE WHEN doc_id % 10 = 7 THEN 0 ELSE 2 * n END AS n_vectors, CASE WHEN doc_id % 10 = 3 AND n > 0 THEN 2 * n - new END AS n_reused, CASE WHEN doc_id % 10 = 3 AND n > 0 THEN new END AS n_embedded
    FROM (SELECT doc_id, count(*) FILTER (regexp_matches(line, '[\\p{{L}}\\p{{N}}]')) AS n, CASE WHEN count(*) FILTER (regexp_matches(was, '[\\p{{L}}\\p{{N}}]')) = 0 THEN 2 ELSE 1 END AS new FROM {_PAGES_SQL} GROUP BY doc_id)"""
)
def changes_propagated(spark, sf_dir):
    """Pages made from lines; then one page of every tenth document changes and every tenth document loses its pages: what is chunked and embedded again."""
    folder, embedder = _folder(spark), embedding.hashing_embedder(8)
    d = table(spark, sf_dir, "documents")
    no = F.lit(None).cast("string")
    records = d.select(F.col("doc_id").alias("id"), F.col("source").alias("entidad"), F.col("lang").alias("descripcion"), no.alias("objeto"), no.alias("descripcion_contrato"), F.col("doc_id").cast("string").alias("nro_contratacion"), F.lit("Vigente").alias("estado"))
    pages = d.select(F.col("doc_id").alias("id"), F.posexplode_outer(F.split(F.coalesce("text", F.lit("")), "\n")).alias("pagina", "texto"))  # outer, or texts are split once more to leave out empty arrays, of which there are none
    how = {"least_chars": 1, "split_over": 0, "target": 1}  # each line a page, each line a chunk
    _, first = changes.propagate(records, pages, changes.empty_chunks(records), f"{folder}/first", embedder, **how)
    later = pages.filter("id % 10 <> 7").withColumn("texto", F.when((F.col("id") % 10 == 3) & (F.col("pagina") == 0), F.concat("texto", F.lit(" cambio"))).otherwise(F.col("texto")))
    _, chunks = changes.propagate(records, later, first, f"{folder}/second", embedder, **how)
    counts = chunks.groupBy(F.col("contrato_id").alias("doc_id")).agg(F.count(F.lit(1)).alias("n_chunks"), F.count("embedding_v2").alias("n_vectors"))
    again = changes.work(chunks).select(F.col("contrato_id").alias("doc_id"), "n_reused", "n_embedded")
    n = {c: F.coalesce(c, F.lit(0)).cast("long") for c in ("n_chunks", "n_vectors")}
    return d.select("doc_id").join(counts, "doc_id", "left").join(again, "doc_id", "left").select("doc_id", *(c.alias(k) for k, c in n.items()), "n_reused", "n_embedded")


_LINES = "SELECT l_orderkey AS k, l_linenumber AS n, l_quantity AS q, CASE WHEN l_suppkey % 9 <> 0 THEN l_returnflag END AS f, l_extendedprice AS p"


@query(
    f"""WITH old AS (SELECT DISTINCT l_orderkey AS k, l_linenumber AS n FROM lineitem WHERE l_orderkey % 20 = 7), r AS ({_LINES}, 0 AS again FROM lineitem UNION ALL {_LINES}, 1 FROM lineitem WHERE l_suppkey % 5 = 0),
    m AS (SELECT r.*, row_number() OVER (PARTITION BY k, n ORDER BY again, p, q, f NULLS FIRST) AS place, EXISTS (SELECT 1 FROM old WHERE old.k = r.k AND old.n = r.n) AS was, EXISTS (SELECT 1 FROM orders WHERE o_orderkey = k AND o_orderstatus <> 'P') AS parent FROM r)
    SELECT k, n, again, CAST(round(p * 100) AS BIGINT) AS cents, concat_ws(',', CASE WHEN f IS NULL THEN 'f required' END, CASE WHEN q > 45 THEN 'few' END, CASE WHEN was OR place > 1 THEN 'one line' END, CASE WHEN NOT parent THEN 'of an order' END) AS violated FROM m
    WHERE f IS NULL OR q > 45 OR was OR place > 1 OR NOT parent"""
)
def constraints_enforced(spark, sf_dir):
    """Line items of which some come twice, some stand already and some have no order: what a database would refuse."""
    li = table(spark, sf_dir, "lineitem")
    own = [F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n"), F.col("l_quantity").alias("q"), F.when(F.col("l_suppkey") % 9 != 0, F.col("l_returnflag")).alias("f"), F.col("l_extendedprice").alias("p")]
    rows = li.select(*own, F.lit(0).alias("again")).unionByName(li.filter("l_suppkey % 5 = 0").select(*own, F.lit(1).alias("again")))
    rules = constraints.Constraints(required=["f"], checks={"few": F.col("q") <= 45}, unique={"one line": ["k", "n"]}, references={"of an order": (["k"], "orders", ["o_orderkey"])})
    orders = table(spark, sf_dir, "orders").filter("o_orderstatus <> 'P'")
    _, bad = constraints.enforced(rows, rules, parents={"orders": orders}, existing=li.filter("l_orderkey % 20 = 7").select(*own), order=[F.col("again"), F.col("p"), F.col("q"), F.col("f").asc_nulls_first()])
    return bad.select("k", "n", "again", F.round(F.col("p") * 100).cast("long").alias("cents"), F.array_join("violated", ",").alias("violated"))


class Unreliable(CapturedPages):
    """Kept answers behind a base that refuses everybody, and each answer only at the second try."""

    def __init__(self, options: dict):
        super().__init__(options)
        self.asked: set[tuple] = set()

    def get(self, base: str, query: dict):
        if base == "refuses":
            raise HTTPError(base, 403, "refused", None, BytesIO())
        if (of := tuple(query.items())) not in self.asked:
            self.asked.add(of)
            raise HTTPError(base, 503, "busy", None, BytesIO())
        return super().get(base, query)


def _asked(spark, folder, size):
    spark.dataSource.register(PagedSource)
    return spark.read.format("paged").option("transport", "telar.catalog_changes:Unreliable").option("base", "refuses").option("fallback", folder).option("pause", 0).option("size", size)


_LANGUAGES = ("", "de", "en", "es", "fr", "other")  # the object that is asked for; a null is the empty one


@query(
    f"""SELECT doc_id AS id, l AS objeto, CAST((row_number() OVER (PARTITION BY l ORDER BY doc_id DESC) - 1) // 100 + 1 AS INT) AS page, md5(text) AS digest, count(*) OVER (PARTITION BY l) AS total
    FROM (SELECT *, CASE WHEN lang IS NULL THEN '' WHEN lang IN {_LANGUAGES} THEN lang ELSE 'other' END AS l FROM documents)"""
)
def asked_by_object(spark, sf_dir):
    """Whole texts kept as answers by language, and read page by page with the language pushed to a source that refuses, falls back and has to be asked again."""
    folder = _folder(spark)
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("idContrato"), "text", F.when(F.col("lang").isin(*_LANGUAGES) | F.col("lang").isNull(), F.col("lang")).otherwise("other").alias("l"))
    numbered = captured.paged(d, "idContrato", 100, f"{folder}/ranged", "l")
    record = F.transform("rows", lambda r: F.struct(r["idContrato"].alias("idContrato"), r["text"].alias("text"), F.col("total").alias("all")))
    body = F.to_json(F.struct(F.struct(F.col("total").alias("totalElements")).alias("pageable"), record.alias("data")))
    pages = captured.write_pages(captured.answers(numbered, "idContrato", body), f"{folder}/pages")
    parts = [_asked(spark, pages, 100).option("param.objeto", x).load().withColumn("objeto", F.lit(x)) for x in _LANGUAGES]
    rows = reduce(DataFrame.unionByName, parts).withColumn("r", F.from_json("payload", "struct<text string, all long>"))
    return rows.select("id", "objeto", "page", F.md5("r.text").alias("digest"), F.col("r.all").alias("total"))


@query(
    """SELECT o_orderkey AS id, o_orderkey % 3 <> 0 AS analizado, o_orderstatus = 'F' AS cotizado, CASE WHEN o_orderkey % 3 <> 0 THEN CAST(o_orderdate AS TIMESTAMP) + INTERVAL 5 HOUR END AS fecha_analisis,
    CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS TIMESTAMP) + INTERVAL 29 HOUR END AS fecha_cotizacion FROM orders WHERE o_orderkey > 0 AND (o_orderkey % 3 <> 0 OR o_orderstatus = 'F')"""
)
def asked_funnel(spark, sf_dir):
    """The two lists of marks in answers that are objects, fetched whole with a token from the same source, then merged by id."""
    folder = _folder(spark)
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", F.col("o_orderdate").cast("timestamp").alias("d"))
    numbered = captured.paged(o, "o_orderkey", 500, f"{folder}/ranged")
    at = lambda d, days: F.concat(F.date_format(F.date_add(d, days), "yyyy-MM-dd"), F.lit("T00:00:00-05:00"))
    entries = lambda keep, days: F.transform(F.filter("rows", keep), lambda r: F.struct(r["o_orderkey"].cast("string").alias("id"), at(r["d"], days).alias("fecha")))
    lists = F.struct(entries(lambda r: r["o_orderkey"] % 3 != 0, 0).alias("analizados"), entries(lambda r: r["o_orderstatus"] == "F", 1).alias("cotizados"), F.struct(F.col("pages").alias("totalPages")).alias("pageable"))
    pages = captured.write_pages(captured.answers(numbered, "o_orderkey", F.to_json(lists)), f"{folder}/pages")
    funnel = state.merge_funnel(*state.funnel_lists(_asked(spark, pages, 500).option("whole", True).option("token", "of the test").load()))
    ntz = lambda c: F.col(c).cast("timestamp_ntz").alias(c)
    return funnel.select("id", "analizado", "cotizado", ntz("fecha_analisis"), ntz("fecha_cotizacion"))


class Refusal(RuntimeError):
    pass


def _refusing(texts: list[str]) -> list[list[float]]:
    """Takes no batch that holds a text with the word."""
    if any("the" in t.split() for t in texts):
        raise Refusal("not taken")
    return embedding.hashing_embedder(16)(texts)


_TAKEN = "NOT regexp_matches(coalesce(text, ''), '(^|\\s)the(\\s|$)')"


@query(f"SELECT doc_id, CASE WHEN {_TAKEN} THEN 16 END AS dimension, CASE WHEN NOT ({_TAKEN}) THEN 'Refusal: not taken' END AS error FROM documents")
def embedding_refused(spark, sf_dir):
    """Whole texts embedded one a batch by a model that refuses some: a refused one is an error of its own, the others get and keep their vectors."""
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    made = embedding.embedded(d, F.col("text"), _refusing, batch=1, retries=2)
    return made.select(F.col("id").alias("doc_id"), F.nullif(F.size("vector"), F.lit(-1)).alias("dimension"), "error")

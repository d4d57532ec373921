"""More registered queries: the operators of the document and ingestion side, each beside its SQL.

The roles are those of catalog_records.py; payloads, pages and marks that the driver's
tables lack are made from their keys in both languages.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telar.catalog_records import AS_OF, CONTRACTS_SQL, NOW, _with, contracts, query, table
from telar.catalog_records import QUERIES as CATALOG
from telar.catalog_records import SQL as CATALOG_SQL
from telar.functions import spanish
from telar.functions import text as T
from telar.functions import time as D
from telar.functions import vector as V
from telar.operators import chunking, classify, embedding, merge, quality, reports, search, state
from telar.operators.cells import CellIndex
from telar.operators.text_index import TextIndex, of_files
from telar.shared import shared_dir
from telar.sources.upsert import FolderTransport, UnknownColumn, UpsertSink

_C = f"WITH c AS ({CONTRACTS_SQL}) "


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders")


# Ingestion: records and dead letters

_RAW_SQL = """r AS (SELECT o_orderkey AS k, o_orderkey % 9 AS n, strftime(o_orderdate, '%d/%m/%Y %H:%M:%S') AS d FROM orders) """


def _raw(spark, sf_dir):
    """Records as JSON text: of every nine, three are invalid, each in a way of its own."""
    o = _orders(spark, sf_dir)
    k, n = F.col("o_orderkey"), F.col("o_orderkey") % 9
    d = F.date_format("o_orderdate", "dd/MM/yyyy HH:mm:ss")
    good = F.concat(F.lit('{"idContrato": '), k.cast("string"), F.lit(', "desContratacion": " T-'), k.cast("string"), F.lit(' ", "nomEntidad": "   ", "nomObjetoContrato": "Bien", "fecPublica": "'), d, F.lit('", "cotizar": '), F.when(n == 3, "true").otherwise("false"), F.lit(', "more": [1]}'))
    bad_id = F.concat(F.lit('{"idContrato": 0, "nomEntidad": "E'), k.cast("string"), F.lit('", "Cookie": "c", "x-y": 1}'))
    bad_text = F.concat(F.lit('{"idContrato": '), k.cast("string"), F.lit(', "nomEntidad": {"a": 1}, "access_token": "t"}'))
    return o.select(F.when(n == 0, F.concat(F.lit("no json "), k.cast("string"))).when(n == 1, bad_id).when(n == 2, bad_text).otherwise(good).alias("payload"))


@query(
    "WITH "
    + _RAW_SQL
    + """SELECT k AS id, '' AS nro_contratacion, 'T-' || k AS descripcion_contrato, 'Bien' AS objeto, CAST(NULL AS VARCHAR) AS entidad, CAST(strptime(d, '%d/%m/%Y %H:%M:%S') AS TIMESTAMP) AS fecha_publica, CAST(NULL AS TIMESTAMP) AS fecha_fin_cotizacion, n = 3 AS cotizar
    FROM r WHERE n > 2 AND k > 0"""
)
def ingest_records(spark, sf_dir):
    valid, _ = quality.split_valid(_raw(spark, sf_dir))
    ntz = lambda c: F.col(c).cast("timestamp_ntz").alias(c)
    return quality.to_contracts(valid).select("id", "nro_contratacion", "descripcion_contrato", "objeto", "entidad", ntz("fecha_publica"), ntz("fecha_fin_cotizacion"), "cotizar")


@query(
    "WITH "
    + _RAW_SQL
    + """SELECT CASE WHEN n = 2 THEN k END AS id_contrato, 'ingesta' AS origen, CASE n WHEN 0 THEN 'record is no JSON object' WHEN 1 THEN 'idContrato: a positive integer is required' ELSE 'nomEntidad: text expected, found a structure' END AS motivo,
    CASE n WHEN 0 THEN '{"_raw":"no json ' || k || '"}' WHEN 1 THEN '{"idContrato":"0","nomEntidad":"E' || k || '"}' ELSE '{"idContrato":"' || k || '","nomEntidad":"{\\"a\\":1}"}' END AS payload, false AS resuelto FROM r WHERE n < 3"""
)
def dead_letters(spark, sf_dir):
    return quality.split_valid(_raw(spark, sf_dir))[1].drop("created_at")


@query(
    "WITH "
    + _RAW_SQL
    + """SELECT CASE WHEN n > 2 AND k % 5 <> 0 THEN k END AS id, CASE WHEN n = 2 OR (n > 2 AND k % 5 = 0) THEN k END AS id_contrato,
    CASE n WHEN 0 THEN 'record is no JSON object' WHEN 1 THEN 'idContrato: a positive integer is required' WHEN 2 THEN 'nomEntidad: text expected, found a structure' ELSE CASE WHEN k % 5 = 0 THEN 'mapping: id of five' END END AS motivo,
    count(*) OVER () AS n, count(*) FILTER (n > 2 AND k % 5 <> 0) OVER () AS valid, count(*) FILTER (n < 3 OR k % 5 = 0) OVER () AS rejected, count(*) FILTER (n > 2 AND k % 5 = 0) OVER () AS unmapped FROM r"""
)
def ingest_once(spark, sf_dir):
    """Records and dead letters from one scan and one parse; records that the mapping fails are dead letters too."""
    good, bad, n = quality.write_split(_raw(spark, sf_dir), f"{_folder(spark)}/split", checks={"id of five": F.col("id") % 5 != 0})
    both = good.select("id").unionByName(bad.select("id_contrato", "motivo"), allowMissingColumns=True)
    return both.withColumns({k: F.lit(v).cast("long") for k, v in n.items()})


@query("SELECT c_custkey, concat_ws(',', CASE WHEN NOT c_acctbal > 0 THEN 'balance' END, CASE WHEN NOT c_mktsegment = 'BUILDING' THEN 'segment' END) AS errors FROM customer WHERE NOT (c_acctbal > 0 AND c_mktsegment = 'BUILDING')")
def rejected_rows(spark, sf_dir):
    c = quality.rejected_by(table(spark, sf_dir, "customer"), {"balance": F.col("c_acctbal") > 0, "segment": F.col("c_mktsegment") == "BUILDING"})
    return c.filter(F.size("errors") > 0).select("c_custkey", F.concat_ws(",", "errors").alias("errors"))


@query("SELECT count(*) AS n, count(*) FILTER (l_returnflag = 'N') AS open, count(*) FILTER (l_linenumber < 7) AS low, concat_ws(',', CASE WHEN count(*) FILTER (l_returnflag = 'N') < 0.9 * count(*) THEN 'open' END, CASE WHEN count(*) FILTER (l_linenumber < 7) < 0.9 * count(*) THEN 'low' END) AS alerts FROM lineitem")
def coverage_of_parts(spark, sf_dir):
    li = reports.counts(table(spark, sf_dir, "lineitem"), {"n": F.lit(True), "open": F.col("l_returnflag") == "N", "low": F.col("l_linenumber") < 7})
    return quality.coverage_alerts(li, "n", ["open", "low"]).withColumn("alerts", F.array_join("alerts", ","))


@query(
    """SELECT event_id, CASE WHEN s = 'cancelled' OR NOT (s = 'failure' OR bad) THEN 'none' WHEN event_id % 2 = 0 THEN 'comment' ELSE 'open' END AS alert, bad AS anomaly FROM (SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'success' WHEN 1 THEN 'failure' ELSE 'cancelled' END AS s,
    event_id % 5 = 0 OR user_id = 0 OR (event_id % 4 = 0 AND event_id % 7 = 0) AS bad FROM events)"""
)
def run_alerts(spark, sf_dir):
    k = F.col("event_id")
    e = table(spark, sf_dir, "events").withColumn("anomaly", quality.run_anomaly(F.when(k % 5 == 0, 500).otherwise(200), F.col("user_id"), k % 7, k % 4 == 0))
    conclusion = F.when(k % 3 == 0, "success").when(k % 3 == 1, "failure").otherwise("cancelled")
    return e.select("event_id", quality.alert(conclusion, F.col("anomaly"), k % 2 == 0).alias("alert"), "anomaly")


# Dictionaries as they stand

_PHRASES = [
    "servicio de Firma Digital", "compra de LAPTOP y proyector", "suscripción de ChatGPT", "Azure OpenAI en la nube pública", "seguridad informática", "red de datos y switch", "correo electrónico", "sistema web de trámite", "licencia de software", "mantenimiento de sistema",
    "Oracle Database", "Microsoft 365", "PostgreSQL y ERP", "inteligencia artificial", "visión computacional y big data", "aprendizaje automático", "redes neuronales", "chatbot", "agua de mesa", "cámaras",
]
_PHRASE_SQL = f"(SELECT o_orderkey AS k, ' ' || lower(strip_accents(p[1 + o_orderkey % {len(_PHRASES)}] || ' ' || p[1 + (o_orderkey // 32) % {len(_PHRASES)}])) || ' ' AS t FROM orders, (SELECT {_PHRASES!r} AS p)) q"


def _phrases(spark, sf_dir):
    p, k, n = F.array(*map(F.lit, _PHRASES)), F.col("o_orderkey"), len(_PHRASES)
    at = lambda i: F.element_at(p, (i % n + 1).cast("int"))
    return _orders(spark, sf_dir).select(k.alias("k"), classify.blob(at(k), at(F.floor(k / 32))).alias("t"))


def _any_sql(terms) -> str:
    return " OR ".join(f"contains(t, '{x}')" for x in terms)


def _sum_sql(terms) -> str:
    return " + ".join(f"CAST(contains(t, '{x}') AS INT)" for x in terms)


@query("SELECT k, CASE " + " ".join(f"WHEN {_any_sql(ts)} THEN '{c}'" for c, ts in classify.CATEGORIES.items()) + f" END AS category FROM {_PHRASE_SQL}")
def default_category(spark, sf_dir):
    return _phrases(spark, sf_dir).select("k", classify.first_category(F.col("t")).alias("category"))


@query(f"SELECT k, CASE WHEN {_any_sql(classify.STRONG)} THEN 'ALTA' WHEN {_sum_sql(classify.GENERIC)} >= 2 THEN 'MEDIA' WHEN {_sum_sql(classify.GENERIC)} = 1 THEN 'BAJA' END AS level FROM {_PHRASE_SQL}")
def default_relevance(spark, sf_dir):
    return _phrases(spark, sf_dir).select("k", classify.relevance(F.col("t")).alias("level"))


@query("SELECT k, concat_ws(', ', " + ", ".join(f"CASE WHEN contains(t, '{x}') THEN '{x}' END" for x in dict.fromkeys([*classify.STRONG, *classify.GENERIC_WIDE])) + f") AS terms FROM {_PHRASE_SQL}")
def default_terms(spark, sf_dir):
    return _phrases(spark, sf_dir).select("k", classify.detected(F.col("t")).alias("terms"))


@query(f"SELECT k FROM {_PHRASE_SQL} WHERE (contains(t, 'laptop') OR contains(t, 'sistema')) AND NOT contains(t, 'agua')")
def relevant_records(spark, sf_dir):
    words = lambda *w: F.array(*map(F.lit, w))
    return _phrases(spark, sf_dir).filter(classify.relevant(F.col("t"), words("laptop", "", "sistema"), words("agua"))).select("k")


# Scalars


@query("SELECT o_orderkey, CAST(o_orderdate AS TIMESTAMP) + INTERVAL 5 HOUR AS instant, CASE WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '-05:00' END AS iso, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE 'b' END AS blank, o_orderdate > TIMESTAMP '1996-01-01' AS window_open, CASE WHEN o_orderkey > 0 THEN o_orderkey END AS pid FROM orders")
def source_instants(spark, sf_dir):
    o, k = _orders(spark, sf_dir), F.col("o_orderkey")
    iso = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("-05:00"))
    return o.select(
        "o_orderkey", D.parse_iso(F.concat(F.lit(" "), iso)).cast("timestamp_ntz").alias("instant"), D.iso_or_null(F.when(k % 2 == 0, iso).otherwise("no date")).alias("iso"), T.blank_to_null(F.when(k % 3 == 0, " \t ").otherwise(" b ")).alias("blank"),
        D.window_open(F.col("o_orderdate").cast("timestamp"), F.lit("1996-01-01").cast("timestamp")).alias("window_open"), D.positive_id(F.concat(k.cast("string"), F.lit(".0"))).alias("pid"),
    )


@query("SELECT p_partkey, p_name ILIKE '%RING%' AS like_name, lower(p_name) LIKE '%ring%' AND true AS keyword, regexp_matches(lower(p_name), '\\bia\\b') AS whole_word FROM part")
def keyword_filters(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return p.select("p_partkey", T.like_anywhere(F.col("p_name"), "RING").alias("like_name"), T.matches_keyword([F.col("p_name")], "Ríng").alias("keyword"), T.matches_keyword([F.col("p_name")], "IA").alias("whole_word"))


@query(
    """SELECT o_orderkey AS k, o_orderkey || ',7' AS ints, o_orderkey || ',12' AS ids, CASE WHEN o_orderkey % 2 = 0 THEN 'vigente' END AS label, CASE WHEN o_orderkey % 4 = 0 THEN 'nativo_puro' WHEN o_orderkey % 4 = 3 THEN 'imagen_total' ELSE 'mixto' END AS kind, '--- pagina ' || o_orderkey || ' ---' AS mark,
    CASE WHEN o_orderkey % 3 = 0 THEN '--- pagina 2 (ocr) ---' || chr(10) || 'x' WHEN o_orderkey % 3 = 1 THEN 'a' || chr(10) || chr(10) || '--- pagina 2 (ocr) ---' || chr(10) || 'x' ELSE '--- pagina 2 (ocr) --- old' END AS appended, o_orderkey || ':h:' || sha256('what is it') AS cache FROM orders"""
)
def page_scalars(spark, sf_dir):
    k = F.col("o_orderkey")
    old = F.when(k % 3 == 0, " ").when(k % 3 == 1, "a \n").otherwise("--- pagina 2 (ocr) --- old")
    state_of = T.canonical(F.when(k % 2 == 0, " VIGENTE ").otherwise("other"), {"vigente": 2, "culminado": 4})
    return _orders(spark, sf_dir).select(
        k.alias("k"), F.array_join(T.int_list(F.concat(F.lit("["), k.cast("string"), F.lit(', "7", x]'))), ",").alias("ints"), F.array_join(T.id_list(F.concat(F.lit(" "), k.cast("string"), F.lit(", 12 no"))), ",").alias("ids"), state_of["name"].alias("label"),
        T.page_kind(F.lit(3), k % 4).alias("kind"), T.page_mark(k).alias("mark"), T.append_page(old, F.lit(2), F.lit(" x "), "ocr").alias("appended"), T.cache_key(k, F.lit("h"), F.lit("What  IS\tit ")).alias("cache"),
    )


@query("SELECT o_orderkey AS k, 'servidores ' || o_orderkey || ' nube' AS term, CASE WHEN o_orderkey % 2 = 0 THEN 'Vigente' END AS estado, CASE WHEN o_orderkey % 2 = 1 THEN 'Servicio' END AS objeto, CAST(2020 + o_orderkey % 5 AS INT) AS anio FROM orders")
def question_terms(spark, sf_dir):
    k = F.col("o_orderkey")
    q = F.concat(F.lit("¿Qué contratos "), F.when(k % 2 == 0, "vigentes").otherwise("de servicios"), F.lit(" de "), (k % 5 + 2020).cast("string"), F.lit(" hay?"))
    f = search.query_filters(q)
    return _orders(spark, sf_dir).select(k.alias("k"), T.search_term(F.concat(F.lit("¿Qué servidores "), k.cast("string"), F.lit(" hay en la nube?"))).alias("term"), f["estado"].alias("estado"), f["objeto"].alias("objeto"), f["anio"].alias("anio"))


@query("SELECT vec_id, round(list_distance(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[])), 6) AS zero, len(embedding) AS n, round(list_sum(CAST(embedding AS DOUBLE[])), 4) AS total FROM embeddings")
def vector_literals(spark, sf_dir):
    v = F.col("embedding")
    back = V.from_literal(V.to_literal(v, 8))
    e = table(spark, sf_dir, "embeddings").select("vec_id", F.round(F.abs(V.cosine_distance(v, v)), 6).alias("zero"), F.size(back).cast("long").alias("n"), F.round(F.aggregate(back, F.lit(0.0), lambda a, x: a + x), 4).alias("total"))
    return e


# Chunks and documents

_HEAD = "'[' || entidad || ' | ' || left(descripcion, 80) || ' | ' || descripcion_contrato || ']'"


@query(
    _C
    + f"""SELECT id AS contrato_id, 0 AS chunk_index, 'Descripción general' AS tipo, md5({_HEAD} || chr(10) || descripcion) AS digest FROM c
    UNION ALL SELECT id, 1, 'Ítem técnico 1', md5({_HEAD} || chr(10) || 'CUBSO: 1 - x. Cantidad: 2 . Lugar: . Especificaciones:') FROM c
    UNION ALL SELECT id, 2, 'Metadata', md5({_HEAD} || chr(10) || 'Entidad: ' || entidad || '. Área usuaria: area. Objeto: ' || objeto || '. Estado: ' || coalesce(estado, '') || '. Número: ' || nro_contratacion || '.') FROM c"""
)
def contract_chunks(spark, sf_dir):
    c = contracts(spark, sf_dir).withColumns({"nom_area_usuaria": F.lit("area"), "items_json": F.from_json(F.lit('[{"cod_cubso":"1","nom_cubso":"x","cantidad":2.0}]'), _ITEMS)})
    return chunking.contract_chunks(c).select("contrato_id", "chunk_index", "tipo", F.md5("texto").alias("digest"))


_ITEMS = "array<struct<cod_cubso: string, nom_cubso: string, descripcion: string, cantidad: double, unidad: string, distrito: string>>"

_LINES = r"""l AS (SELECT doc_id, list_transform(string_split(regexp_replace('MINISTERIO' || chr(10) || chr(10) || chr(10) || text, '\r\n?', chr(10), 'g'), chr(10)), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')) AS s, string_split(regexp_replace('MINISTERIO' || chr(10) || chr(10) || chr(10) || text, '\r\n?', chr(10), 'g'), chr(10)) AS raw FROM documents),
    k AS (SELECT doc_id, list_filter(list_zip(s, raw), lambda p: NOT (p[1] <> '' AND (regexp_full_match(p[1], {head}) OR (length(p[1]) <= 40 AND NOT ends_with(p[1], ':') AND NOT regexp_matches(p[1], '\p{{Ll}}') AND regexp_matches(p[1], '\pL') AND NOT regexp_matches(p[1], '^\d') AND len(string_split_regex(p[1], '\s+')) <= 4)))) AS z FROM l),
    j AS (SELECT doc_id, array_to_string(list_transform(z, lambda p: CASE WHEN p[1] = '' THEN '' ELSE p[2] END), chr(10)) AS t FROM k)""".replace(
    "{head}", "'(?i)(?:" + "|".join(p.replace("'", "''") for p in T.LETTERHEAD) + ")'"
).replace("{{", "{").replace("}}", "}")


@query("WITH " + _LINES + r" SELECT doc_id, md5(regexp_replace(regexp_replace(t, '\n{3,}', chr(10) || chr(10), 'g'), '^\s+|\s+$', '', 'g')) AS digest FROM j")
def strip_boilerplate(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", F.md5(T.without_letterhead(F.concat(F.lit("MINISTERIO\n\n\n"), F.col("text")))).alias("digest"))


def _with_texts(spark, sf_dir):
    """Contracts whose extracted text is a page under its mark."""
    c = contracts(spark, sf_dir)
    return c.withColumn("tdr_texto", F.when(F.col("id") % 4 != 0, F.concat(F.lit("--- pagina 1 ---\nel bien "), F.col("id").cast("string"), F.lit(" se entrega."))))




@query(
    _C
    + f"""SELECT id AS contrato_id, CAST(CASE WHEN id % 8 = 1 THEN 6 ELSE 0 END AS INT) AS chunk_index, 'TDR PDF' AS tipo, 'pdf' AS fuente, md5({_HEAD} || chr(10) || 'el bien ' || id || ' se entrega.') AS embed, entidad AS meta_entidad, descripcion_contrato AS meta_nro,
    'el bien ' || id || ' se entrega.' AS due_text FROM c WHERE id % 4 <> 0"""
)
def document_chunks(spark, sf_dir):
    c = _with_texts(spark, sf_dir).filter("tdr_texto IS NOT NULL")
    have = c.filter("id % 8 = 1").select(F.col("id").alias("contrato_id"), F.lit(5).alias("chunk_index"))
    d = chunking.document_chunks(c, have)
    due = F.element_at(F.split(chunking.text_to_embed(F.col("fuente"), F.col("texto"), F.col("chunk_embed_text")), "\n"), -1)
    return d.select("contrato_id", "chunk_index", "tipo", "fuente", F.md5("chunk_embed_text").alias("embed"), "meta_entidad", "meta_nro", due.alias("due_text"))


@query("SELECT l_orderkey AS contrato_id, l_linenumber AS chunk_index, l_returnflag AS tipo FROM lineitem WHERE NOT (l_orderkey % 5 = 0 AND l_returnflag = 'R') UNION ALL SELECT o_orderkey, 0, 'new' FROM orders WHERE o_orderkey % 5 = 0")
def rechunked(spark, sf_dir):
    old = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("contrato_id"), F.col("l_linenumber").alias("chunk_index"), F.col("l_returnflag").alias("tipo"), F.when(F.col("l_returnflag") == "R", "pdf").otherwise("api").alias("fuente"))
    fresh = _orders(spark, sf_dir).filter("o_orderkey % 5 = 0").select(F.col("o_orderkey").alias("contrato_id"), F.lit(0).cast(old.schema["chunk_index"].dataType).alias("chunk_index"), F.lit("new").alias("tipo"), F.lit("pdf").alias("fuente"))
    return chunking.rechunk(old, fresh, "pdf").drop("fuente")


@query(_C + "SELECT c.id FROM c WHERE id NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def chunks_pending(spark, sf_dir):
    have = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("contrato_id"), F.when(F.col("l_returnflag") == "R", "pdf").otherwise("api").alias("fuente"))
    return chunking.pending(contracts(spark, sf_dir), have, "pdf").select("id")


@query("SELECT tipo, count(*) AS n_chunks, count(DISTINCT k) AS n_contracts, round(avg(greatest(1, length(t) // 4)), 4) AS mean_tokens FROM (SELECT l_orderkey AS k, CASE WHEN l_linenumber % 3 = 0 THEN 'Metadata' WHEN l_linenumber % 3 = 1 THEN 'Ítem técnico' ELSE 'TDR PDF' END AS tipo, repeat('x', CAST(l_linenumber * 9 AS INT)) AS t FROM lineitem) GROUP BY 1")
def chunk_statistics(spark, sf_dir):
    n = F.col("l_linenumber")
    kind = F.when(n % 3 == 0, "Metadata").when(n % 3 == 1, F.concat(F.lit("Ítem técnico "), n.cast("string"))).otherwise(F.concat(F.lit("TDR PDF ("), n.cast("string"), F.lit("/9)")))
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("contrato_id"), kind.alias("tipo"), F.repeat(F.lit("x"), (n * 9).cast("int")).alias("texto"))
    return chunking.chunk_statistics(rows).withColumn("mean_tokens", F.round("mean_tokens", 4))


_LI = "(SELECT l_orderkey, l_linenumber, max(l_returnflag) AS l_returnflag FROM lineitem GROUP BY 1, 2) li"


def _chunk_rows(spark, sf_dir):
    """Line items as chunks; those of even line numbers have a vector."""
    n = F.col("l_linenumber")
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.max("l_returnflag").alias("l_returnflag")).select(
        (F.col("l_orderkey") * 10 + n).alias("id"), F.col("l_orderkey").alias("contrato_id"), n.cast("int").alias("chunk_index"), F.when(F.col("l_returnflag") == "R", "pdf").otherwise("api").alias("fuente"),
        F.concat(F.lit("[e | 1]\n--- pagina 1 ---\nbody "), n.cast("string")).alias("texto"), F.lit(None).cast("string").alias("chunk_embed_text"), F.when(n % 2 == 0, F.array(F.lit(1.0).cast("float"))).alias("embedding_v2"),
    )


@query(_C + "SELECT l_orderkey * 10 + l_linenumber AS id FROM " + _LI + " JOIN c ON l_orderkey = c.id WHERE estado = 'Vigente' AND l_linenumber % 2 = 1 AND l_returnflag = 'R'")
def embedding_pending(spark, sf_dir):
    return embedding.pending(_chunk_rows(spark, sf_dir), contracts(spark, sf_dir), source="pdf").select("id")


@query(_C + "SELECT CASE WHEN l_returnflag = 'R' THEN 'pdf' ELSE 'api' END AS fuente, count(*) AS n, count(*) FILTER (l_linenumber % 2 = 0) AS with_vector, count(DISTINCT l_orderkey) AS n_contracts FROM " + _LI + " JOIN c ON l_orderkey = c.id WHERE estado = 'Vigente' GROUP BY 1")
def embedding_coverage(spark, sf_dir):
    return embedding.coverage(_chunk_rows(spark, sf_dir), contracts(spark, sf_dir))


@query("SELECT l_orderkey * 10 + l_linenumber AS id, l_linenumber % 2 = 0 OR l_orderkey % 2 = 0 AS has_vector, CASE WHEN l_linenumber % 2 = 1 AND l_orderkey % 2 = 0 THEN 64 WHEN l_linenumber % 2 = 0 THEN 1 END AS dimension, CASE WHEN l_linenumber % 2 = 0 OR l_orderkey % 2 = 0 THEN 1.0::DOUBLE END AS length FROM " + _LI + "")
def embedding_stored(spark, sf_dir):
    """Due chunks of even contracts are embedded by the offline stand-in and stored; the others stay."""
    chunks = _chunk_rows(spark, sf_dir)
    due = embedding.pending(chunks).filter("contrato_id % 2 = 0")
    made = embedding.embedded(due.select("id", "fuente", "texto", "chunk_embed_text"), chunking.text_to_embed(F.col("fuente"), F.col("texto"), F.col("chunk_embed_text")), embedding.hashing_embedder())
    out = embedding.store(chunks, made)
    v = F.col("embedding_v2")
    return out.select("id", v.isNotNull().alias("has_vector"), F.nullif(F.size(v), F.lit(-1)).alias("dimension"), F.round(V.norm(v), 4).alias("length"))


@query("SELECT l_orderkey AS contrato_id, CAST(l_linenumber AS INT) AS chunk_index, CASE WHEN l_returnflag = 'R' THEN 'body ' || l_linenumber END AS last_line, l_returnflag = 'R' OR l_linenumber % 2 = 1 AS due FROM " + _LI + " JOIN orders ON l_orderkey = o_orderkey")
def embed_text_backfill(spark, sf_dir):
    out = chunking.backfill(_chunk_rows(spark, sf_dir), contracts(spark, sf_dir))
    return out.select("contrato_id", "chunk_index", F.element_at(F.split("chunk_embed_text", "\n"), -1).alias("last_line"), F.col("embedding_v2").isNull().alias("due"))


# Refresh, enrichment, queues


@query(_C + "SELECT id, CASE WHEN id % 3 = 0 THEN 'Culminado' ELSE estado END AS estado, CASE WHEN id % 3 = 0 THEN TIMESTAMP '" + NOW + "' END AS seen FROM c")
def refreshed_states(spark, sf_dir):
    c = contracts(spark, sf_dir).withColumn("estado_verificado_at", F.lit(None).cast("timestamp"))
    seen = c.filter("id % 3 = 0").select("id", F.lit("Culminado").alias("estado"))
    return state.refresh(c, seen, F.lit(NOW).cast("timestamp")).select("id", "estado", F.col("estado_verificado_at").cast("timestamp_ntz").alias("seen"))


@query(_C + "SELECT id, CASE WHEN id % 4 = 0 AND id % 8 <> 0 THEN 'more' ELSE descripcion END AS descripcion, id % 4 = 0 AS detalle_cargado, CASE WHEN id % 4 = 0 THEN 'c1|||d2' END AS item FROM c")
def enriched_details(spark, sf_dir):
    c = contracts(spark, sf_dir).withColumns({"detalle_cargado": F.lit(False), "items_json": F.lit(None).cast("array<struct<cod_cubso: string, nom_cubso: string, descripcion: string, cantidad: double, unidad: string, distrito: string>>")})
    items = state.clean_items(F.from_json(F.lit('[{"codCubso":" c1 ","nomCubso":"","cantidad":1.5,"nomDistritoExt":"d2"}]'), "array<struct<codCubso: string, nomCubso: string, descripcionItem: string, cantidad: double, nomUnidadMedida: string, nomDistrito: string, nomDistritoExt: string>>"))
    details = c.filter("id % 4 = 0").select("id", F.when(F.col("id") % 8 == 0, " ").otherwise("more").alias("descripcion"), items.alias("items_json"))
    it = F.col("items_json")[0]
    return state.enrich(c, details).select("id", "descripcion", "detalle_cargado", F.when(F.col("items_json").isNotNull(), F.array_join(F.array(*(F.coalesce(it[x], F.lit("")) for x in ("cod_cubso", "nom_cubso", "unidad", "distrito"))), "|")).alias("item"))


@query(
    _with("""SELECT id, CASE WHEN id % 2 = 0 THEN '2,4' ELSE '5' END AS pages FROM s WHERE estado = 'Vigente' AND fecha_fin_cotizacion > TIMESTAMP '""" + NOW + "' AND id % 5 <> 0 AND (id % 2 = 0 OR id % 3 = 0)")
)
def ocr_page_queue(spark, sf_dir):
    c = contracts(spark, sf_dir)
    ints = lambda *x: F.array(*map(F.lit, x)) if x else F.array().cast("array<int>")
    c = c.withColumns({"paginas_ocr_pendientes": F.when(F.col("id") % 2 == 0, ints(2, 3, 4)).otherwise(ints()), "paginas_ocr_hechas": F.when(F.col("id") % 2 == 0, ints(3))})
    side = c.filter("id % 3 = 0 OR id % 2 = 0").select("id", ints(5).alias("paginas_ocr_pendientes"), ints().alias("paginas_ocr_hechas"))
    return state.page_queue(c, side, F.lit(NOW).cast("timestamp")).filter("id % 5 <> 0").select("id", F.array_join("pages", ",").alias("pages"))


def _downloads(spark, sf_dir):
    none = lambda t: F.lit(None).cast(t)
    return contracts(spark, sf_dir).withColumns({
        "tdr_texto": none("string"), "pdf_hash": F.lit("old"), "pdf_es_imagen": none("boolean"), "pdf_descargado": F.lit(False), "pdf_procesado": F.lit(False), "req_url": none("string"), "tdr_tipo_extraccion": none("string"), "paginas_ocr_pendientes": none("array<int>"),
        "paginas_ocr_hechas": none("array<int>"), "tdr_n_paginas": none("int"), "tdr_n_paginas_nativas": none("int"), "tdr_n_paginas_ocr": none("int"), "pdf_archivo_id": none("long"), "pdf_nombre": none("string"),
    })


@query(
    _C
    + """SELECT id, CASE id % 4 WHEN 1 THEN 't' END AS tdr_texto, CASE id % 4 WHEN 0 THEN 'old' WHEN 2 THEN NULL ELSE 'h' || id END AS pdf_hash, CASE id % 4 WHEN 1 THEN true WHEN 3 THEN true END AS pdf_es_imagen, id % 4 IN (1, 2) AS pdf_descargado, id % 4 IN (1, 2) AS pdf_procesado,
    CASE id % 4 WHEN 1 THEN 'http://u' WHEN 2 THEN 'sin_pdf' WHEN 3 THEN 'pendiente_ocr' END AS req_url, CASE id % 4 WHEN 1 THEN 3 END AS tdr_n_paginas FROM c"""
)
def recorded_downloads(spark, sf_dir):
    c = _downloads(spark, sf_dir)
    k, ints = F.col("id") % 4, F.array(F.lit(1))
    out = c.filter(k > 0).select(
        "id", F.when(k == 1, "ok").when(k == 2, "sin_pdf").otherwise("pendiente").alias("outcome"), F.lit("t").alias("tdr_texto"), F.concat(F.lit("h"), F.col("id").cast("string")).alias("pdf_hash"), F.lit("mixto").alias("tdr_tipo_extraccion"), F.lit("http://u").alias("url"),
        ints.alias("paginas_ocr_pendientes"), ints.alias("paginas_ocr_hechas"), F.lit(3).alias("tdr_n_paginas"), F.lit(2).alias("tdr_n_paginas_nativas"), F.lit(1).alias("tdr_n_paginas_ocr"), F.lit(9).cast("long").alias("pdf_archivo_id"), F.lit("n.pdf").alias("pdf_nombre"),
    )
    return state.record_downloads(c, out).select("id", "tdr_texto", "pdf_hash", "pdf_es_imagen", "pdf_descargado", "pdf_procesado", "req_url", "tdr_n_paginas")


@query(
    _C
    + """SELECT id, CASE WHEN id % 3 = 0 THEN 'mixto' WHEN estado = 'Vigente' AND id % 2 = 0 THEN 'nativo_puro' END AS tdr_tipo_extraccion, CASE WHEN id % 3 = 0 THEN true WHEN estado = 'Vigente' AND id % 2 = 0 THEN false ELSE true END AS pdf_es_imagen FROM c"""
)
def synced_sidecar(spark, sf_dir):
    c = _downloads(spark, sf_dir).withColumns({"pdf_es_imagen": F.lit(True), "tdr_texto": F.when(F.col("id") % 2 == 0, F.repeat(F.lit("letra "), F.lit(40))).otherwise("corto")})
    ints = F.array(F.lit(1))
    side = c.filter("id % 3 = 0").select("id", F.lit("mixto").alias("tdr_tipo_extraccion"), ints.alias("paginas_ocr_pendientes"), ints.alias("paginas_ocr_hechas"), F.lit(2).alias("tdr_n_paginas"), F.lit(1).alias("tdr_n_paginas_nativas"), F.lit(1).alias("tdr_n_paginas_ocr"), F.lit(True).alias("pdf_es_imagen"))
    return state.sync_sidecar(c, side).select("id", "tdr_tipo_extraccion", "pdf_es_imagen")


@query("SELECT o_orderkey AS k, CASE o_orderkey % 3 WHEN 0 THEN 2 WHEN 1 THEN 1 END AS chosen FROM orders")
def chosen_pdf(spark, sf_dir):
    k = F.col("o_orderkey")
    f = lambda i, t, mime: F.struct(F.lit(i).alias("id"), t.alias("idTipoArchivo"), F.lit(mime).alias("descripcionMime"))
    files = F.when(k % 3 == 2, F.array(f(3, F.lit(1), "text/html"))).otherwise(F.array(f(1, F.lit(2), "Application/PDF"), f(2, F.when(k % 3 == 0, 1).otherwise(2), "application/pdf")))
    return _orders(spark, sf_dir).select(k.alias("k"), state.choose_pdf(files)["id"].alias("chosen"))


@query(
    """WITH p AS (SELECT conv_id AS id, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS pagina, text, length(regexp_replace(text, '[^\\pL\\pN]', '', 'g')) < 80 AS scan FROM conversations)
    SELECT id, count(*)::INT AS n, count(*) FILTER (scan)::INT AS n_scans, array_to_string((list(pagina ORDER BY pagina) FILTER (scan))[:40], ',') AS due, CASE WHEN count(*) FILTER (scan) = 0 THEN 'nativo_puro' WHEN count(*) FILTER (scan) = count(*) THEN 'imagen_total' ELSE 'mixto' END AS kind FROM p GROUP BY 1"""
)
def extracted_pages(spark, sf_dir):
    from pyspark.sql import Window

    n = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text"))
    pages = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("id"), n.alias("pagina"), F.col("text").alias("texto"))
    out = state.extracted_pages(pages, most_scans=40)
    return out.select("id", F.col("tdr_n_paginas").alias("n"), F.col("tdr_n_paginas_ocr").alias("n_scans"), F.nullif(F.array_join("paginas_ocr_pendientes", ","), F.lit("")).alias("due"), F.col("tdr_tipo_extraccion").alias("kind"))


@query("SELECT o_orderkey AS id, true AS analizado, o_orderkey % 2 = 0 AS cotizado, TIMESTAMP '2026-01-01 05:00:00' AS fecha_analisis FROM orders WHERE o_orderkey > 0")
def applied_funnel(spark, sf_dir):
    """Two lists from JSON, merged by id and laid over records that have no marks yet."""
    k = F.col("o_orderkey")
    entry = lambda c: F.concat(F.lit('[{"id": "'), c.cast("string"), F.lit('", "fecha": "2026-01-01T00:00:00-05:00"}, {"id": "x", "fecha": "2026-01-01"}]'))
    payload = _orders(spark, sf_dir).select(F.concat(F.lit('{"analizados": '), entry(k), F.lit(', "cotizados": '), F.when(k % 2 == 0, entry(k)).otherwise("[]"), F.lit("}")).alias("payload"))
    base = _orders(spark, sf_dir).filter(k > 0).select(k.alias("id"), *(F.lit(None).cast(t).alias(n) for n, t in (("analizado", "boolean"), ("fecha_analisis", "timestamp"), ("cotizado", "boolean"), ("fecha_cotizacion", "timestamp"))))
    out = state.apply_funnel(base, state.merge_funnel(*state.funnel_lists(payload)))
    return out.select("id", "analizado", "cotizado", F.col("fecha_analisis").cast("timestamp_ntz").alias("fecha_analisis"))


@query(_C + "SELECT id FROM c WHERE estado = 'Vigente' AND id % 4 <> 0 ORDER BY fecha_publica DESC NULLS LAST, id DESC LIMIT 50")
def download_due(spark, sf_dir):
    c = _downloads(spark, sf_dir).withColumn("pdf_descargado", F.when(F.col("id") % 4 == 0, True).when(F.col("id") % 4 == 1, False))
    return state.download_queue(c, limit=50).select("id")


@query(_C + "SELECT count(*) AS n, count(*) FILTER (id % 4 = 0) AS nativo_puro, count(*) FILTER (id % 4 = 1) AS mixto, count(*) FILTER (id % 4 = 2) AS imagen_total, count(*) FILTER (id % 7 = 0) AS sin_pdf, count(*) FILTER (id % 7 = 1) AS pendiente_ocr, CAST(sum(3) FILTER (id % 7 <> 0) AS BIGINT) AS tdr_n_paginas, CAST(sum(2) FILTER (id % 7 <> 0) AS BIGINT) AS tdr_n_paginas_nativas, CAST(sum(1) FILTER (id % 7 <> 0) AS BIGINT) AS tdr_n_paginas_ocr FROM c")
def extraction_report(spark, sf_dir):
    k = F.col("id")
    c = contracts(spark, sf_dir).withColumns({
        "tdr_tipo_extraccion": F.when(k % 4 == 0, "nativo_puro").when(k % 4 == 1, "mixto").when(k % 4 == 2, "imagen_total"), "req_url": F.when(k % 7 == 0, "sin_pdf").when(k % 7 == 1, "pendiente_ocr"),
        "tdr_n_paginas": F.lit(3), "tdr_n_paginas_nativas": F.lit(2), "tdr_n_paginas_ocr": F.lit(1),
    })
    return reports.extraction_report(c)


@query("SELECT coalesce(max(o_orderkey) FILTER (o_orderstatus = 'none'), -1) AS o_orderkey FROM orders")
def max_or_default(spark, sf_dir):
    return reports.max_or(_orders(spark, sf_dir).filter("o_orderstatus = 'none'"), "o_orderkey", -1)


# Merges


@query("SELECT doc_id, CASE WHEN doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1) AND lang = 'en' THEN NULL ELSE source END AS source FROM documents")
def nulled_out(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    return merge.null_out(d, "source", table(spark, sf_dir, "labels").filter("toxic = 1"), "doc_id", F.col("lang") == "en").drop("lang")


@query("SELECT doc_id, lang FROM documents WHERE doc_id IN (7, 3, 5) UNION ALL SELECT -1, 'missing'")
def keys_asked(spark, sf_dir):
    found, missing = merge.keys_in_order(table(spark, sf_dir, "documents").select("doc_id", "lang"), [7, -1, 3, 5], "doc_id")
    return found.unionByName(missing.select("doc_id", F.lit("missing").alias("lang")))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN c_name ELSE 'own' END AS name, c_mktsegment AS segment FROM orders JOIN customer ON o_custkey = c_custkey")
def filled_missing(spark, sf_dir):
    o = _orders(spark, sf_dir).select("o_orderkey", F.col("o_custkey").alias("k"), F.when(F.col("o_orderkey") % 4 == 0, "").when(F.col("o_orderkey") % 2 == 1, "own").alias("name"))
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    return merge.fill_missing(o, c, "k", ["name", "segment"]).drop("k")


@query("SELECT event_id FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 7 DAY")
def cache_kept(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    newest = e.agg(F.max("ts")).first()[0]
    return merge.kept_for(e, "ts", F.lit(newest), 7).select("event_id")


# Search and its audit

_NEAR = "SELECT a.vec_id AS query_id, b.vec_id AS id, a.label = b.label AS relevant, b.label AS label, list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) AS similarity, row_number() OVER (PARTITION BY a.vec_id ORDER BY list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) DESC, b.vec_id) AS rank FROM embeddings a, embeddings b WHERE a.vec_id % 100 = 0 QUALIFY rank <= 10"


def _near(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    q = e.filter("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"), F.col("label").alias("want"))
    hits = search.vector_search_many(e, q.drop("want"), 10).join(e.select(F.col("vec_id").alias("id"), "label"), "id").join(F.broadcast(q.select("query_id", "want")), "query_id")  # a stated query set
    return hits.withColumn("relevant", F.col("label") == F.col("want")), q


def _cells(spark, sf_dir) -> CellIndex:
    """The written cells of the embeddings; the first search of these files builds them."""
    e = table(spark, sf_dir, "embeddings")
    index = CellIndex(spark, f"{shared_dir(spark)}/telar-index/cells-{of_files(e)}")
    return index if index.built() else index.build(e)


_HUNDREDTH = "SELECT vec_id AS query_id, CAST(embedding AS DOUBLE[]) AS q FROM embeddings WHERE vec_id % 100 = 0"


def _hundredth(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").filter("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"))


@query(f"SELECT query_id, vec_id AS id, round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), q), 6) AS similarity, CAST(row_number() OVER (PARTITION BY query_id ORDER BY list_cosine_similarity(CAST(embedding AS DOUBLE[]), q) DESC, vec_id) AS INT) AS rank FROM embeddings, ({_HUNDREDTH}) QUALIFY rank <= 10")
def vector_cells_exact(spark, sf_dir):
    """By cells, opened until none left can hold one of the ten nearest."""
    return _cells(spark, sf_dir).search(_hundredth(spark, sf_dir)).select("query_id", "id", F.round("similarity", 6).alias("similarity"), "rank")


@query()
def vector_cells_probed(spark, sf_dir):
    """By as many cells a query as 19 in 20 of the nearest take; approximate (its recall is tested), so without SQL."""
    index = _cells(spark, sf_dir)
    return index.search(_hundredth(spark, sf_dir), probes=index.probes_for(0.95)).select("query_id", "id", F.round("similarity", 6).alias("similarity"), "rank")


@query(f"WITH h AS ({_NEAR}) SELECT query_id, count(*) FILTER (rank <= 6 AND rank > 3) AS n_both, count(*) FILTER (rank <= 3) AS only_a, count(*) FILTER (rank > 6) AS only_b FROM h GROUP BY 1")
def overlap_of_lists(spark, sf_dir):
    h, _ = _near(spark, sf_dir)
    return search.overlap(h.filter("rank <= 6"), h.filter("rank > 3"))


@query(f"WITH h AS ({_NEAR}) SELECT query_id, round(coalesce(avg(similarity) FILTER (rank <= 5), 0), 6) AS mean_similarity FROM h GROUP BY 1")
def mean_similarity(spark, sf_dir):
    h, q = _near(spark, sf_dir)
    return search.mean_similarity(h.filter("rank <= 5"), q).withColumn("mean_similarity", F.round("mean_similarity", 6))


@query(f"WITH h AS ({_NEAR}), g AS (SELECT query_id, id FROM h WHERE rank % 2 = 0 UNION ALL SELECT vec_id, -1 FROM embeddings WHERE vec_id % 100 = 0) SELECT query_id, CAST(count(*) AS BIGINT) AS n_hits, round_even(count(*) FILTER (relevant AND rank <= 5) / 5.0, 3)::DOUBLE AS p_at_5, CAST(6 AS BIGINT) AS gold, round_even(5 / 6.0, 3)::DOUBLE AS recall FROM h GROUP BY 1")
def retrieval_with_gold(spark, sf_dir):
    h, q = _near(spark, sf_dir)
    gold = h.filter("rank % 2 = 0").select("query_id", "id").unionByName(q.select("query_id", F.lit(-1).cast("long").alias("id")))
    return search.retrieval_metrics(h, q, gold).select("query_id", "n_hits", "p_at_5", F.col("gold").cast("long").alias("gold"), "recall")


@query(f"WITH h AS ({_NEAR}), m AS (SELECT *, row_number() OVER (PARTITION BY query_id, label ORDER BY rank) AS n FROM h QUALIFY n <= 2) SELECT query_id, id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY id DESC) AS INT) AS place FROM m QUALIFY place <= 5")
def reranked_diverse(spark, sf_dir):
    """At most two hits of a label, then the five best by a score."""
    h, _ = _near(spark, sf_dir)
    few = search.at_most_per_key(h, ["query_id"], "label", 2, F.col("rank"))
    best = search.reranked(few, F.col("id"), ["query_id"], 5, F.col("rank"))
    from pyspark.sql import Window

    return best.select("query_id", "id", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("id"))).alias("place"))


@query(f"WITH h AS ({_NEAR}) SELECT query_id, id FROM h WHERE rank <= CASE WHEN query_id % 200 = 0 THEN 2 ELSE 4 END UNION ALL SELECT query_id, -id FROM h WHERE rank <= 3 AND query_id % 200 = 0")
def text_when_few(spark, sf_dir):
    h, _ = _near(spark, sf_dir)
    vector = h.filter(F.col("rank") <= F.when(F.col("query_id") % 200 == 0, 2).otherwise(4)).select("query_id", "id")
    return search.text_when_few(vector, h.filter("rank <= 3").select("query_id", (-F.col("id")).alias("id")), ["query_id"])


@query(
    _C
    + """SELECT id, CASE WHEN id % 3 = 0 THEN 'stored' WHEN l IS NOT NULL THEN l ELSE '' END AS context, CASE WHEN id % 3 = 0 THEN 'tdr_texto' WHEN l IS NOT NULL THEN 'chunks' ELSE 'ficha' END AS origin
    FROM c LEFT JOIN (SELECT l_orderkey, string_agg('[api · R]' || chr(10) || 'line ' || l_linenumber, chr(10) || chr(10) ORDER BY l_linenumber) AS l FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) ON id = l_orderkey"""
)
def context_of_contracts(spark, sf_dir):
    c = contracts(spark, sf_dir).withColumn("tdr_texto", F.when(F.col("id") % 3 == 0, " stored ").otherwise(" "))
    chunks = table(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("contrato_id"), F.col("l_linenumber").alias("chunk_index"), F.lit(None).cast("string").alias("fuente"), F.col("l_returnflag").alias("tipo"), F.concat(F.lit("line "), F.col("l_linenumber").cast("string")).alias("texto"))
    return search.context_text(c, chunks, 80, 60_000)


@query(_C + "(SELECT id FROM c WHERE nro_contratacion ILIKE '%n-3%' ORDER BY id DESC LIMIT 1) UNION ALL SELECT id FROM c WHERE id = 5")
def found_contract(spark, sf_dir):
    c = contracts(spark, sf_dir)
    return search.find_contract(c, number="n-3").select("id").unionByName(search.find_contract(c, key=5).select("id"))


# Spanish full text

_TOKENS = "SELECT {id} AS id, list_filter(string_split(regexp_replace(lower({text}), '[^\\pL\\pN]+', ' ', 'g'), ' '), lambda w: w <> '') AS ws FROM {table}"
_STOP = "(" + ", ".join(f"'{w}'" for w in spanish.STOP) + ")"


@query("WITH d AS (" + _TOKENS.format(id="doc_id", text="text", table="documents") + "), v AS (SELECT DISTINCT unnest(ws) AS w FROM d) " + spanish.stem_sql("v"))
def spanish_stems(spark, sf_dir):
    words = table(spark, sf_dir, "documents").select(F.explode(search.spanish_words(F.col("text"))).alias("w")).distinct()
    return spanish.stemmed(words, "w")


def _described(spark, sf_dir):
    """Contracts with the phrases as descriptions."""
    c = contracts(spark, sf_dir)
    p, n = F.array(*map(F.lit, _PHRASES)), len(_PHRASES)
    at = lambda i: F.element_at(p, (i % n + 1).cast("int"))
    return c.withColumn("descripcion", F.concat(at(F.col("id")), F.lit(" para las "), at(F.floor(F.col("id") / 32)), F.lit(" de "), F.col("entidad"), F.when(F.col("id") % 6 == 0, F.concat(F.lit(" y "), at(F.col("id")))).otherwise("")))


_DESCRIBED = f"""c AS ({CONTRACTS_SQL}), g AS (SELECT c.* REPLACE (p[1 + id % {len(_PHRASES)}] || ' para las ' || p[1 + (id // 32) % {len(_PHRASES)}] || ' de ' || entidad || CASE WHEN id % 6 = 0 THEN ' y ' || p[1 + id % {len(_PHRASES)}] ELSE '' END AS descripcion) FROM c, (SELECT {_PHRASES!r} AS p)),
    k AS ({_TOKENS.format(id="id", text="concat_ws(' ', coalesce(descripcion, ''), coalesce(entidad, ''), coalesce(descripcion_contrato, ''), coalesce(objeto, ''))", table="g")}),
    u AS (SELECT id, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS place FROM k), v AS (SELECT DISTINCT w FROM u WHERE w NOT IN {_STOP}), z AS ({spanish.stem_sql("v")}), lex AS (SELECT DISTINCT stem, id, place FROM u JOIN z USING (w))"""


def _rank_sql(terms: str) -> str:
    """hits (term, id, rank) of a table terms (term, stem) in SQL."""
    return f"""t AS ({terms}), n AS (SELECT term, count(*) AS n FROM t GROUP BY 1), f AS (SELECT term, id, n FROM t JOIN (SELECT DISTINCT stem, id FROM lex) USING (stem) JOIN n USING (term) GROUP BY ALL HAVING count(*) = n),
    o AS (SELECT term, id, stem, place, row_number() OVER (PARTITION BY term, id, stem ORDER BY place) AS j FROM f JOIN t USING (term) JOIN lex USING (stem, id)),
    one AS (SELECT term, id, sum(0.1::DOUBLE / (j * j)) / 1.64493406685 AS rank FROM o JOIN f USING (term, id) WHERE n = 1 GROUP BY 1, 2),
    two AS (SELECT a.term, a.id, 1 - product(CASE WHEN a.place = b.place THEN 1 ELSE 1 - 0.1 * sqrt(CASE WHEN abs(a.place - b.place) > 100 THEN 1e-30 ELSE 1 / (1.005 + 0.05 * exp(abs(a.place - b.place) / 1.5 - 2)) END) END) AS rank FROM o a JOIN o b ON a.term = b.term AND a.id = b.id AND a.stem < b.stem GROUP BY 1, 2),
    hits AS (SELECT term, id, CAST(CAST(rank AS REAL) AS DOUBLE) AS rank FROM (SELECT * FROM one UNION ALL SELECT term, id, CASE WHEN rank > 0 THEN rank ELSE 1e-20 END FROM two))"""


@query(f"WITH {_DESCRIBED}, {_rank_sql("SELECT 'x' AS term, unnest(['servici', 'sistem']) AS stem")} SELECT id, round(rank, 6) AS rank FROM hits JOIN g USING (id) WHERE estado = 'Vigente' AND entidad ILIKE '%0%' ORDER BY hits.rank DESC, fecha_publica DESC NULLS LAST, id LIMIT 200")
def spanish_record_search(spark, sf_dir):
    found = search.search_records(_described(spark, sf_dir), "los Servicios de SISTEMAS", {"estado": "Vigente", "objeto": None}, {"entidad": "0"}, limit=500, most=search.MOST_ROWS)
    return found.select("id", F.round("rank", 6).alias("rank"))


SEARCHED = ("descripcion", "entidad", "descripcion_contrato", "objeto")


def _index(spark, sf_dir) -> TextIndex:
    """The written index of the described contracts; the first search of these files builds it."""
    files = of_files(table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer"))
    index = TextIndex(spark, f"{shared_dir(spark)}/telar-index/contracts-{files}", SEARCHED)
    return index if index.built() else index.build(_described(spark, sf_dir))


_TERMS = {"servidores": "el mantenimiento de sistemas", "digital": "firmas digitales", "big": "big data", "web": "sistema web", "agua": "aguas"}
_TERM_STEMS = {"servidores": ["manten", "sistem"], "digital": ["firm", "digital"], "big": ["big", "dat"], "web": ["sistem", "web"], "agua": ["agu"]}


def _terms(spark):
    rows = [(k, v) for k, v in _TERMS.items()]
    return spark.createDataFrame(rows, "query_id string, term string")


@query(f"WITH {_DESCRIBED}, {_rank_sql('SELECT * FROM (VALUES ' + ', '.join(f"('{k}', '{s}')" for k, ss in _TERM_STEMS.items() for s in ss) + ') AS x(term, stem)')} SELECT term AS query_id, id, round(rank, 6) AS rank, CAST(row_number() OVER (PARTITION BY term ORDER BY hits.rank DESC, fecha_publica DESC NULLS LAST, id) AS INT) AS pos FROM hits JOIN g USING (id) WHERE estado = 'Vigente' QUALIFY pos <= 20")
def spanish_search_many(spark, sf_dir):
    c = _described(spark, sf_dir)
    hits = _index(spark, sf_dir).hits(_terms(spark), 20, [F.col("fecha_publica").desc_nulls_last()], c.filter("estado = 'Vigente'").select("id", "fecha_publica"))
    return hits.join(_terms(spark), "term").select("query_id", "id", F.round("rank", 6).alias("rank"), "pos")


_KEPT = "g2 AS (SELECT * REPLACE (CASE WHEN id % 4 = 0 THEN 'sistemas web de ' || entidad ELSE descripcion END AS descripcion) FROM g WHERE id % 10 <> 3)"


@query(
    f"WITH {_DESCRIBED.replace('k AS (', _KEPT + ', k AS (', 1).replace('FROM g)', 'FROM g2)')}, {_rank_sql('SELECT * FROM (VALUES ' + ', '.join(f"('{k}', '{s}')" for k, ss in _TERM_STEMS.items() for s in ss) + ') AS x(term, stem)')} SELECT term AS query_id, id, round(rank, 6) AS rank FROM hits"
)
def index_upkeep(spark, sf_dir):
    """The index of all records, then batches of new versions and deletions, compaction, and one more batch; hits of all terms."""
    c = _described(spark, sf_dir)
    new = c.withColumn("descripcion", F.concat(F.lit("sistemas web de "), F.col("entidad")))
    index = TextIndex(spark, f"{_folder(spark)}/index", SEARCHED).build(c)
    index.apply(new.filter("id % 8 = 0"), c.filter("id % 20 = 3").select("id"))
    index.apply(c.filter("id % 8 = 4").withColumn("descripcion", F.lit("aguas")))
    index.compact()
    index.apply(new.filter("id % 8 = 4"), c.filter("id % 20 = 13").select("id"))
    return index.hits(_terms(spark)).join(_terms(spark), "term").select("query_id", "id", F.round("rank", 6).alias("rank"))


_HYBRID_TERMS = "SELECT vec_id AS query_id, CAST(embedding AS DOUBLE[]) AS q, (['servidores', 'digital', 'big', 'web', 'agua'])[1 + (vec_id // 100) % 5] AS term FROM embeddings WHERE vec_id % 100 = 0"


@query(
    f"""WITH {_DESCRIBED}, {_rank_sql('SELECT * FROM (VALUES ' + ', '.join(f"('{k}', '{s}')" for k, ss in _TERM_STEMS.items() for s in ss) + ') AS x(term, stem)')},
    q AS ({_HYBRID_TERMS}), oids AS (SELECT id, estado, row_number() OVER (ORDER BY id) - 1 AS r FROM g), m AS (SELECT count(*) AS m FROM g), ch AS (SELECT vec_id, id AS contrato_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings, m JOIN oids ON r = (vec_id // 3) % m WHERE estado = 'Vigente'),
    near AS (SELECT query_id, contrato_id AS id, row_number() OVER (PARTITION BY query_id ORDER BY list_cosine_similarity(v, q) DESC, vec_id) AS rank FROM ch, q WHERE list_cosine_similarity(v, q) > -0.5 QUALIFY rank <= 20),
    fa AS (SELECT query_id, id, row_number() OVER (PARTITION BY query_id ORDER BY min(rank)) AS pa FROM near GROUP BY 1, 2),
    fb AS (SELECT query_id, id, row_number() OVER (PARTITION BY query_id ORDER BY hits.rank DESC, fecha_publica DESC NULLS LAST, id) AS pb FROM q JOIN hits USING (term) JOIN g USING (id) WHERE estado = 'Vigente' QUALIFY pb <= 20)
    SELECT query_id, id, round_even(coalesce(1.0::DOUBLE / (60 + pa), 0) + coalesce(1.0::DOUBLE / (60 + pb), 0), 6) AS rrf, CAST(row_number() OVER (PARTITION BY query_id ORDER BY coalesce(1.0::DOUBLE / (60 + pa), 0) + coalesce(1.0::DOUBLE / (60 + pb), 0) DESC, pa NULLS LAST, pb NULLS LAST, id) AS INT) AS place FROM fa FULL JOIN fb USING (query_id, id) QUALIFY place <= 10"""
)
def hybrid_records(spark, sf_dir):
    """Twenty chunks and twenty records by all words of a term, the first hit of each record, fused."""
    from pyspark.sql import Window

    from telar.plans.hybrid import hybrid_records as plan

    c, e = _described(spark, sf_dir), table(spark, sf_dir, "embeddings")
    m = c.count()
    rank = c.select("id", (F.row_number().over(Window.orderBy("id")) - 1).cast("long").alias("r"))  # which record a vector belongs to
    chunks = e.withColumn("r", F.floor(F.col("vec_id") / 3) % m).join(rank.withColumnRenamed("id", "contrato_id"), "r").select(F.col("vec_id").alias("id"), "contrato_id", F.col("embedding").alias("embedding_v2"))
    names = F.array(*map(F.lit, _TERMS.values()))
    q = e.filter("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"), F.element_at(names, (F.floor(F.col("vec_id") / 100) % len(_TERMS) + 1).cast("int")).alias("term"))
    return plan(chunks, c, _index(spark, sf_dir), q, min_similarity=-0.5)


# Sources and files


class Numbered:
    """A paged source of as many records as the option ``param.rows`` says, ids falling to 1."""

    def __init__(self, options: dict):
        self.rows = int(options["param.rows"])

    def fetch(self, page: int, size: int, params: dict) -> dict:
        first = self.rows - (page - 1) * size
        return {"pageable": {"totalPages": -(-self.rows // size)}, "data": [{"idContrato": i} for i in range(first, max(0, first - size), -1)]}


def _folder(spark) -> str:
    return f"{shared_dir(spark)}/telar-files-{uuid.uuid4().hex}"


@query("SELECT i AS id, CAST((n - i) // 10 + 1 AS INT) AS page, '{\"idContrato\": ' || i || '}' AS payload FROM (SELECT unnest(range(41, n + 1)) AS i, n FROM (SELECT count(*) AS n FROM customer))")
def paged_records(spark, sf_dir):
    from telar.sources.rest import PagedSource

    spark.dataSource.register(PagedSource)
    n = table(spark, sf_dir, "customer").count()
    return spark.read.format("paged").option("transport", "telar.catalog_more:Numbered").option("size", 10).option("param.rows", n).option("known_id", 40).load()


_EXPORTED = ["c_name", "c_custkey", "c_mktsegment"]  # in this order in the file


def _exported(spark, sf_dir, most_bytes=0):
    from telar.sources.files import write_csv

    path = f"{_folder(spark)}/csv"
    write_csv(table(spark, sf_dir, "customer"), path, _EXPORTED, "c_custkey", most_bytes)
    return spark.read.schema("c_name string, c_custkey long, c_mktsegment string").option("header", True).option("enforceSchema", True).csv(path)


@query("SELECT c_name, c_custkey, c_mktsegment FROM customer")
def csv_export(spark, sf_dir):
    """All rows as CSV with byte-order mark and fixed columns, read back."""
    return _exported(spark, sf_dir)


@query("SELECT c_name, c_custkey, c_mktsegment FROM customer ORDER BY c_custkey DESC LIMIT 1000")
def csv_newest(spark, sf_dir):
    """Beyond the bytes asked for, the newest thousand rows."""
    return _exported(spark, sf_dir, most_bytes=1000)


@query(CATALOG_SQL["retrieval_macro"])
def report_written(spark, sf_dir):
    """The evaluation's report as JSON lines, read back."""
    from telar.sources.files import append_json

    report, path = CATALOG["retrieval_macro"](spark, sf_dir), f"{_folder(spark)}/report"
    append_json(report, path)
    return spark.read.schema(report.schema).json(path)


_FILE = "CASE n_nationkey % 3 WHEN 0 THEN '%PDF-1.7 ' WHEN 1 THEN ' <!DOCTYPE html><p>' ELSE '' END || n_name"


@query(f"SELECT n_nationkey AS k, strlen({_FILE}) + 1 AS length, sha256({_FILE} || chr(10)) AS sha256, n_nationkey % 3 = 0 AS is_pdf, n_nationkey % 3 = 1 AS is_html FROM nation")
def document_files(spark, sf_dir):
    """A file a nation: documents, web pages in their disguise, and others."""
    from telar.sources.files import read_documents

    n, path = table(spark, sf_dir, "nation"), f"{_folder(spark)}/files"
    head = F.when(F.col("n_nationkey") % 3 == 0, "%PDF-1.7 ").when(F.col("n_nationkey") % 3 == 1, " <!DOCTYPE html><p>").otherwise("")
    n.select(F.col("n_nationkey").alias("key"), F.concat(head, "n_name").alias("value")).write.partitionBy("key").text(path)
    files = read_documents(spark, f"{path}/*", "*.txt")
    return files.select(F.regexp_extract("path", r"key=(\d+)", 1).cast("long").alias("k"), "length", "sha256", "is_pdf", "is_html")


class Hesitant(FolderTransport):
    """A target that refuses every batch once, and does not know one of the columns."""

    def __init__(self, options: dict):
        super().__init__(options)
        self.seen: set[str] = set()

    def upsert(self, rows: list[dict], keys: list[str], token: str) -> None:
        if "objeto" in rows[0]:
            raise UnknownColumn("objeto")
        if token not in self.seen:
            self.seen.add(token)
            raise OSError("busy")
        super().upsert(rows, keys, token)


@query(_C + "SELECT id, nro_contratacion, estado, true AS complete FROM c")
def sent_records(spark, sf_dir):
    """Contracts sent in batches of 500 to a target that hesitates, and read back from it."""
    spark.dataSource.register(UpsertSink)
    folder = f"{_folder(spark)}/sent"
    c = contracts(spark, sf_dir).select("id", "nro_contratacion", "estado", "objeto")
    c.write.format("upsert").option("transport", "telar.catalog_more:Hesitant").option("folder", folder).option("pause", 0).mode("append").save()
    back = spark.read.schema("id long, nro_contratacion string, estado string, objeto string").json(folder)
    return back.select("id", "nro_contratacion", "estado", F.col("objeto").isNull().alias("complete"))


@query(
    """WITH g AS (SELECT c_nationkey AS nation, count(*) AS n FROM customer GROUP BY 1), h AS (SELECT nation, sum(k * (k - 1)) AS same FROM (SELECT c_nationkey AS nation, count(*) AS k FROM customer GROUP BY 1, c_custkey % 3) GROUP BY 1),
    b AS (SELECT nation, sum(k * (k - 1)) AS same FROM (SELECT c_nationkey AS nation, count(*) AS k FROM customer GROUP BY 1, c_custkey % 2) GROUP BY 1)
    SELECT nation, round(h.same / (n * (n - 1.0)), 6) AS header, round(b.same / (n * (n - 1.0)), 6) AS body, CASE WHEN h.same / (n * (n - 1.0)) < b.same / (n * (n - 1.0)) - 0.01 THEN 'header' ELSE 'body' END AS better FROM g JOIN h USING (nation) JOIN b USING (nation) WHERE n > 1"""
)
def embedded_modes(spark, sf_dir):
    """Two ways of making the texts to embed, by how far apart their vectors lie in a nation."""
    word = lambda n: F.element_at(F.array(*map(F.lit, ("agua", "red", "nube")[:n])), (F.col("c_custkey") % n + 1).cast("int"))
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("nation"))
    means = embedding.compare_modes(rows, {"header": word(3), "body": word(2)}, embedding.hashing_embedder(), "nation")
    means = means.groupBy("nation").agg(*(F.max(F.when(F.col("mode") == m, F.col("mean_cosine"))).alias(m) for m in ("header", "body")))
    return means.select("nation", F.round("header", 6).alias("header"), F.round("body", 6).alias("body"), F.when(F.col("header") < F.col("body") - 0.01, "header").otherwise("body").alias("better"))


def _detail(key: int) -> dict | None:
    if key % 7 == 0:
        raise ValueError("refused")
    return None if key % 5 == 0 else {"estado": f"s{key % 3}", "more": 1}


@query("SELECT c_custkey, CASE WHEN c_custkey % 7 <> 0 AND c_custkey % 5 <> 0 THEN 's' || c_custkey % 3 END AS estado, CASE WHEN c_custkey % 7 = 0 THEN 'ValueError: refused' END AS error FROM customer")
def looked_up(spark, sf_dir):
    from telar.sources.lookup import lookup

    got = lookup(table(spark, sf_dir, "customer"), "c_custkey", _detail, "estado string", tries=2)
    return got.select("c_custkey", "payload.estado", "error")


@query("SELECT o_orderkey AS k, CASE WHEN o_orderkey % 3 = 2 THEN NULL ELSE o_orderkey END AS file_id, CASE WHEN o_orderkey % 3 = 2 THEN '' ELSE CASE WHEN o_orderkey % 3 = 1 THEN '.data' ELSE '' END || '[0].nombre=anexo ' || o_orderkey END AS hints FROM orders")
def attachment_lists(spark, sf_dir):
    from telar.sources.files import attachments
    from telar.sources.lookup import json_hints

    k = F.col("o_orderkey")
    item = F.concat(F.lit('[{"idContratoArchivo": '), k.cast("string"), F.lit(', "nombre": "anexo '), k.cast("string"), F.lit('"}]'))
    payload = F.when(k % 3 == 0, item).when(k % 3 == 1, F.concat(F.lit('{"n": 1, "data": '), item, F.lit("}"))).otherwise("{}")
    rows = _orders(spark, sf_dir).select(k.alias("k"), payload.alias("p"))
    return rows.select("k", F.get(attachments(F.col("p")), 0)["idContratoArchivo"].alias("file_id"), F.array_join(json_hints(F.col("p")), ";").alias("hints"))


@query("SELECT event_id AS id, CASE WHEN event_id % 3 = 0 THEN 'second' ELSE 'first' END AS v, CASE WHEN event_id % 3 = 0 THEN 2 ELSE 1 END AS seq FROM events")
def sidecar_round_trip(spark, sf_dir):
    """Lines appended in two runs; the later line of a key counts."""
    from telar.sources.files import append_json, read_sidecar

    path = f"{_folder(spark)}/side"
    e = table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), F.lit("first").alias("v"), F.lit(1).alias("seq"))
    append_json(e, path)
    append_json(e.filter("id % 3 = 0").withColumns({"v": F.lit("second"), "seq": F.lit(2)}), path)
    return read_sidecar(spark, path, "id long, v string, seq int", seq="seq")


@query("SELECT doc_id, lang, md5(text) AS digest, (SELECT count(*) FROM documents) AS n FROM documents")
def snapshot_round_trip(spark, sf_dir):
    """A snapshot by language and the log of its run, written and read back; the first source has no rows."""
    from telar.sources.files import first_nonempty, read_log, summary_lines

    folder = _folder(spark)
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", F.md5("text").alias("digest"))
    back = merge.write_snapshot(d, f"{folder}/snapshot", ["lang"])
    spark.createDataFrame([(summary_lines({"n": back.count(), "url": "a=b"}).rstrip(),)], "t string").coalesce(1).write.text(f"{folder}/log")
    log = read_log(spark, f"{folder}/log/part-*").select(F.col("kv")["n"].cast("long").alias("n"))
    return first_nonempty(d.limit(0), back).crossJoin(F.broadcast(log))  # one row


@query("SELECT o_orderkey AS id, CAST(o_orderpriority AS VARCHAR) AS objeto, CAST(NULL AS VARCHAR) AS entidad, CAST(NULL AS BOOLEAN) AS cotizar FROM orders")
def conformed_records(spark, sf_dir):
    from telar import schema

    o = _orders(spark, sf_dir).select(F.col("o_orderkey").cast("string").alias("id"), F.col("o_orderpriority").alias("objeto"), F.lit("x").alias("dropped"))
    assert "entidad" in schema.missing_columns(o, "contratos")
    return schema.conform(o, "contratos").select("id", "objeto", "entidad", "cotizar")


@query("SELECT 'telar_customer' AS \"table\", column_name AS \"column\" FROM (DESCRIBE customer) UNION ALL SELECT 'telar_missing', NULL")
def described_tables(spark, sf_dir):
    from telar import schema

    table(spark, sf_dir, "customer").createOrReplaceTempView("telar_customer")
    return schema.describe(spark, "telar_customer", "telar_missing").select("table", "column")


@query("SELECT k, lower(strip_accents(t0)) AS folded, contains(lower(strip_accents(t0)), 'chatbot') OR contains(lower(strip_accents(t0)), 'chatgpt') OR contains(lower(strip_accents(t0)), 'openai') OR contains(lower(strip_accents(t0)), 'inteligencia artificial') OR contains(lower(strip_accents(t0)), 'big data') OR contains(lower(strip_accents(t0)), 'aprendizaje automatico') AS ai, CASE k % 3 WHEN 0 THEN 'nucleo' WHEN 1 THEN 'marginal' END AS level FROM (SELECT o_orderkey AS k, p[1 + o_orderkey % " + str(len(_PHRASES)) + f"] AS t0 FROM orders, (SELECT {_PHRASES!r} AS p))")
def sql_functions(spark, sf_dir):
    from telar.functions import rubric

    rubric.register(spark)
    p, k = F.array(*map(F.lit, _PHRASES)), F.col("o_orderkey")
    _orders(spark, sf_dir).select(k.alias("k"), F.element_at(p, (k % len(_PHRASES) + 1).cast("int")).alias("t")).createOrReplaceTempView("telar_phrases")
    return spark.sql("SELECT k, fold_text(t) AS folded, has_real_ai(t) AS ai, level_of(CASE k % 3 WHEN 0 THEN 'IA/analytics' WHEN 1 THEN 'Hardware' ELSE 'none' END) AS level FROM telar_phrases")


@query(
    """WITH e AS (SELECT event_id AS t, 'http://h/' || CASE WHEN event_id % 4 = 0 THEN 'archivo/' ELSE 'x/' END || event_id || CASE WHEN event_id % 5 = 0 THEN '.js' ELSE '' END AS url, event_id % 3 = 0 AS pdf, event_id % 2 = 0 AS xhr FROM events),
    s AS (SELECT url, t, CASE WHEN t >= 500 THEN 25 ELSE 0 END + CASE WHEN pdf THEN 100 ELSE 0 END + CASE WHEN contains(url, 'archivo') THEN 35 ELSE 0 END + CASE WHEN xhr THEN 10 ELSE 0 END + CASE WHEN contains(url, '42') THEN 8 ELSE 0 END - CASE WHEN contains(url, '.js') THEN 40 ELSE 0 END - CASE WHEN xhr THEN 0 ELSE 50 END AS score FROM e)
    SELECT url, CAST(score AS INT) AS score, regexp_replace(url, '/42(/|$)', '/{id}\\1') AS template FROM s WHERE score >= 30 ORDER BY score DESC, t LIMIT 12"""
)
def ranked_events(spark, sf_dir):
    from telar.sources import discovery

    k = F.col("event_id")
    url = F.concat(F.lit("http://h/"), F.when(k % 4 == 0, "archivo/").otherwise("x/"), k.cast("string"), F.when(k % 5 == 0, ".js").otherwise(""))
    none = F.lit(None).cast("string")
    e = table(spark, sf_dir, "events").select(F.lit("GET").alias("method"), url.alias("url"), F.when(k % 3 == 0, "application/pdf").alias("content_type"), none.alias("content_disposition"), none.alias("kind"), F.lit(False).alias("magic_pdf"), F.when(k % 2 == 0, "xhr").otherwise("script").alias("resource_type"), k.cast("double").alias("t"))
    best = discovery.candidates(e, F.lit(42), F.lit(500.0), most=12)
    return best.select("url", F.col("score").cast("int").alias("score"), discovery.url_template(F.col("url"), F.lit(42)).alias("template"))


@query(
    _C
    + """SELECT id, CAST(ceil(id / 80.0) AS BIGINT) AS batch FROM c WHERE estado = 'Vigente' AND fecha_fin_cotizacion IS NOT NULL AND fecha_publica < TIMESTAMP '1998-01-01'
    ORDER BY CASE WHEN relevancia_ia = 'ALTA' THEN 0 WHEN coalesce(categoria_it, '') <> '' THEN 1 WHEN relevancia_ia = 'MEDIA' THEN 2 WHEN relevancia_ia = 'BAJA' THEN 3 ELSE 9 END, strftime(fecha_publica, '%d/%m/%Y'), id LIMIT 100"""
)
def ordered_records(spark, sf_dir):
    """Plain filters, an order by priority and by the date as text, and a limit."""
    c = contracts(spark, sf_dir).filter((F.col("estado") == state.OPEN) & F.col("fecha_fin_cotizacion").isNotNull() & (F.col("fecha_publica") < F.lit("1998-01-01").cast("timestamp")))
    return c.orderBy(state.priority(), F.date_format("fecha_publica", "dd/MM/yyyy"), "id").limit(100).select("id", F.ceil(F.col("id") / 80.0).alias("batch"))


@query("SELECT l_orderkey AS id, l_linenumber, l_returnflag FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_partkey DESC, l_suppkey, l_quantity, l_extendedprice) AS n FROM lineitem) WHERE n = 1")
def merged_stream(spark, sf_dir):
    """Line items upserted by a stream that takes all files there are as one batch; the last line of an order stays."""
    from telar.streaming.events import merge_sink

    folder = _folder(spark)
    li = table(spark, sf_dir, "lineitem")
    own = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_returnflag"]
    li.select(*own).write.parquet(f"{folder}/in")
    state_of = {"df": spark.createDataFrame([], li.select(*own).schema)}

    def publish(df, number):
        df.write.parquet(f"{folder}/out-{number}")
        state_of["df"] = spark.read.parquet(f"{folder}/out-{number}")

    stream = spark.readStream.schema(li.select(*own).schema).parquet(f"{folder}/in")
    order = [F.desc("l_linenumber"), F.desc("l_partkey"), F.col("l_suppkey"), F.col("l_quantity"), F.col("l_extendedprice")]
    merge_sink(stream, lambda: state_of["df"], publish, ["l_orderkey"], order, f"{folder}/checkpoint").awaitTermination()
    return state_of["df"].select(F.col("l_orderkey").alias("id"), "l_linenumber", "l_returnflag")

"""The registry of queries, and those of records, chunks, vectors and logs, each beside its SQL.

Each runs an operator over whole driver tables that play the relations' parts:
orders as records, documents as chunks, embeddings as vectors, events as logs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telar.functions import rubric as R
from telar.functions import text as T
from telar.functions import time as D
from telar.functions import vector as V
from telar.operators import chunking, classify, merge, quality, reports, search, state
from telar.plans.hybrid import hybrid

AS_OF = "2001-07-15T03:00:00"  # 2001-07-14 in the local zone
NOW = "2001-07-15 03:00:00"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

# The driver tables in the roles of the relations.
STATES = {"O": "Vigente", "P": "En Evaluación", "F": "Culminado"}
SEGMENTS = {"AUTOMOBILE": "IA/analytics", "BUILDING": "Oracle", "FURNITURE": "Hardware", "MACHINERY": "Soporte tecnico"}
PRIORITIES = {"1-URGENT": "ALTA", "2-HIGH": "MEDIA", "3-MEDIUM": "BAJA"}


def _case(c: str, m: dict[str, str]) -> str:
    return f"CASE {c} {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in m.items())} END"


#: contratos from orders and customer, in SQL that both engines read.
CONTRACTS_SQL = f"""
    SELECT o_orderkey AS id, concat('N-', CAST(o_orderkey AS VARCHAR(20))) AS nro_contratacion, o_orderpriority AS descripcion_contrato,
           CASE WHEN o_orderkey % 3 = 0 THEN 'Servicio' ELSE 'Bien' END AS objeto,
           CASE WHEN o_orderkey % 7 = 0 THEN 'Integración y gpt' WHEN o_orderkey % 11 = 0 THEN 'red OT' ELSE concat('compra ', c_name) END AS descripcion,
           c_name AS entidad, {_case('o_orderstatus', STATES)} AS estado, o_orderdate AS fecha_publica,
           CASE WHEN o_orderkey % 5 <> 0 THEN o_orderdate + INTERVAL '30' DAY END AS fecha_fin_cotizacion,
           {_case('c_mktsegment', SEGMENTS)} AS categoria_it, {_case('o_orderpriority', PRIORITIES)} AS relevancia_ia
    FROM orders JOIN customer ON o_custkey = c_custkey"""
_LOCAL = "CAST(timezone('America/Lima', timezone('UTC', {})) AS DATE)"
_DAY = "DATE '2001-07-14'"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, c = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    k = F.col("o_orderkey")
    pick = lambda col, m: F.try_element_at(F.create_map(*(F.lit(x) for kv in m.items() for x in kv)), F.col(col))
    return o.join(c, F.col("o_custkey") == F.col("c_custkey")).select(
        k.alias("id"), F.concat(F.lit("N-"), k.cast("string")).alias("nro_contratacion"), F.col("o_orderpriority").alias("descripcion_contrato"), F.when(k % 3 == 0, "Servicio").otherwise("Bien").alias("objeto"),
        F.when(k % 7 == 0, "Integración y gpt").when(k % 11 == 0, "red OT").otherwise(F.concat(F.lit("compra "), F.col("c_name"))).alias("descripcion"), F.col("c_name").alias("entidad"), pick("o_orderstatus", STATES).alias("estado"),
        F.col("o_orderdate").cast("timestamp").alias("fecha_publica"), F.when(k % 5 != 0, F.col("o_orderdate").cast("timestamp") + F.expr("INTERVAL 30 DAY")).alias("fecha_fin_cotizacion"),
        pick("c_mktsegment", SEGMENTS).alias("categoria_it"), pick("o_orderpriority", PRIORITIES).alias("relevancia_ia"),
    )


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _with(body: str) -> str:
    """SQL over c (contracts) and s (with local days and the open flag)."""
    return f"""WITH c AS ({CONTRACTS_SQL}),
    s AS (SELECT *, {_LOCAL.format('fecha_fin_cotizacion')} AS fin, {_LOCAL.format('fecha_publica')} AS pub, {_DAY} AS d FROM c WHERE coalesce(categoria_it, '') <> '' OR coalesce(relevancia_ia, '') <> ''),
    p AS (SELECT *, estado = 'Vigente' AND (fin IS NULL OR fin >= d) AS post FROM s) {body}"""


# Rollups and KPIs


@query("SELECT o_orderstatus, o_orderpriority, CAST(date_trunc('month', o_orderdate) AS DATE) AS mes, count(*) AS total FROM orders GROUP BY ALL")
def rollup_month_status(spark, sf_dir):
    return state.month_rollup(table(spark, sf_dir, "orders"), ["o_orderstatus", "o_orderpriority"], "o_orderdate")


@query("SELECT o_orderkey, o_orderdate, o_totalprice FROM orders WHERE o_orderstatus = 'O' ORDER BY o_orderdate NULLS LAST, o_totalprice DESC NULLS LAST, o_orderkey LIMIT 100")
def urgent_open_orders(spark, sf_dir):
    o = table(spark, sf_dir, "orders").filter("o_orderstatus = 'O'")
    return o.orderBy(F.col("o_orderdate").asc_nulls_last(), F.col("o_totalprice").desc_nulls_last(), "o_orderkey").limit(100).select("o_orderkey", "o_orderdate", "o_totalprice")


FLAGS = ("es_postulable", "es_vigente_ventana_vencida", "es_en_evaluacion", "es_culminado", "cierra_hoy", "cierra_manana", "cierra_7d", "cierra_semana", "es_nuevo_hoy")


@query(
    _with("""SELECT id, fin AS fecha_fin_lima, pub AS fecha_publica_lima, post AS es_postulable, estado = 'Vigente' AND fin IS NOT NULL AND fin < d AS es_vigente_ventana_vencida, estado = 'En Evaluación' AS es_en_evaluacion, estado = 'Culminado' AS es_culminado,
    estado = 'Vigente' AND fin = d AS cierra_hoy, estado = 'Vigente' AND fin = d + 1 AS cierra_manana, estado = 'Vigente' AND fin BETWEEN d AND d + 7 AS cierra_7d, estado = 'Vigente' AND fin BETWEEN d + 2 AND d + 7 AS cierra_semana, pub = d AS es_nuevo_hoy FROM p""")
)
def status_flags(spark, sf_dir):
    c = contracts(spark, sf_dir).filter(state.in_scope())
    out = state.day_flags(c, F.col("estado"), F.col("fecha_fin_cotizacion"), F.col("fecha_publica"), AS_OF)
    return out.select("id", F.col("fin").alias("fecha_fin_lima"), F.col("pub").alias("fecha_publica_lima"), *FLAGS)


_RUBRIC = """CASE WHEN regexp_matches(t, 'telemetria|scada|internet de las cosas|tecnologia operacional') OR regexp_matches(t, '(^|[^a-z0-9])(ot|iot)([^a-z0-9]|$)') THEN 'telemetria' WHEN regexp_matches(t, 'digital twin|gemelo digital|integracion|automatizacion') THEN 'integracion' END"""
_SCORED = f""", t AS (SELECT *, lower(strip_accents(concat(coalesce(descripcion, ''), ' ', coalesce(descripcion_contrato, '')))) AS t FROM p),
    o AS (SELECT *, {_RUBRIC} AS overlay, regexp_matches(t, 'gpt|llm|copilot|machine learning|openai|claude|gemini|chatbot|big data') AS ai,
          CASE categoria_it {' '.join(f"WHEN '{k}' THEN {R.LEVELS.index(v) + 1}" for k, v in R.LEVEL_OF.items())} ELSE 0 END AS base FROM t),
    r AS (SELECT *, greatest(base, CASE overlay WHEN 'telemetria' THEN 4 WHEN 'integracion' THEN 3 ELSE 0 END, CASE WHEN relevancia_ia = 'ALTA' AND ai AND coalesce(categoria_it, '') <> 'Firma digital' THEN 4 ELSE 0 END) AS lvl FROM o),
    x AS (SELECT *, CASE lvl WHEN 4 THEN 'nucleo' WHEN 3 THEN 'adyacente' WHEN 2 THEN 'oportunista' WHEN 1 THEN 'marginal' END AS rubro FROM r) """
_BY_LINE = """(SELECT coalesce('[' || string_agg(j, ',' ORDER BY n DESC, k) || ']', '[]') FROM (SELECT k, n, '{"linea":"' || k || '","total":' || n || '}' AS j FROM (SELECT coalesce(categoria_it, '(sin línea)') AS k, count(*) AS n FROM x WHERE post GROUP BY 1))) AS por_linea"""
_BY_RUBRIC = """(SELECT coalesce('[' || string_agg(j, ',' ORDER BY o) || ']', '[]') FROM (SELECT CASE k WHEN 'nucleo' THEN 0 WHEN 'adyacente' THEN 1 WHEN 'oportunista' THEN 2 WHEN 'marginal' THEN 3 ELSE 4 END AS o, '{"rubro":"' || k || '","total":' || n || '}' AS j FROM (SELECT coalesce(rubro, 'sin_clasificar') AS k, count(*) AS n FROM x WHERE post GROUP BY 1))) AS por_rubro"""


@query(
    _with(
        _SCORED
        + f"""SELECT CAST(count(*) FILTER (post) AS INT) AS total_postulables, CAST(count(*) FILTER (post AND fin = d) AS INT) AS cierran_hoy, CAST(count(*) FILTER (post AND fin = d + 1) AS INT) AS cierran_manana, CAST(count(*) FILTER (post AND fin BETWEEN d + 2 AND d + 7) AS INT) AS cierran_semana,
    CAST(count(*) FILTER (post AND pub = d) AS INT) AS nuevos_hoy_postulables, CAST(count(*) FILTER (estado = 'Vigente' AND fin < d) AS INT) AS vigentes_ventana_vencida, CAST(count(*) FILTER (estado = 'En Evaluación') AS INT) AS en_evaluacion, CAST(count(*) FILTER (estado = 'Culminado') AS INT) AS culminados_it,
    CAST(count(*) FILTER (pub BETWEEN d - 6 AND d) AS INT) AS altas_it_7d, CAST(count(*) FILTER (pub BETWEEN d - 13 AND d - 7) AS INT) AS altas_it_7d_prev, {_BY_LINE}, {_BY_RUBRIC} FROM x"""
    )
)
def kpi_single_pass(spark, sf_dir):
    return state.kpis(contracts(spark, sf_dir), AS_OF)


@query(
    _with(
        _SCORED
        + f"""SELECT CAST(count(*) FILTER (rubro = 'nucleo') AS INT) AS nucleo_postulables, CAST(count(*) FILTER (rubro = 'adyacente') AS INT) AS adyacente_postulables, CAST(count(*) FILTER (rubro = 'oportunista') AS INT) AS oportunista_postulables, CAST(count(*) FILTER (rubro = 'marginal') AS INT) AS marginal_postulables,
    CAST(count(*) FILTER (rubro IS NULL) AS INT) AS sin_rubro_postulables, CAST(count(*) FILTER (categoria_it = 'IA/analytics') AS INT) AS nucleo_ia, CAST(count(*) FILTER (categoria_it = 'Cloud/hosting') AS INT) AS nucleo_cloud, CAST(count(*) FILTER (categoria_it = 'Desarrollo software') AS INT) AS nucleo_dev,
    CAST(count(*) FILTER (overlay = 'telemetria') AS INT) AS nucleo_tel, {_BY_LINE}, {_BY_RUBRIC} FROM x WHERE post"""
    )
)
def kpi_business(spark, sf_dir):
    return state.business_kpis(contracts(spark, sf_dir), AS_OF)


_CHANGED = f"""SELECT * REPLACE (CASE WHEN id % 4 = 0 THEN 'Vigente' WHEN id % 4 = 1 THEN 'Culminado' ELSE estado END AS estado, CASE WHEN id % 8 = 0 THEN NULL WHEN id % 4 = 0 THEN TIMESTAMP '2001-07-18' ELSE fecha_fin_cotizacion END AS fecha_fin_cotizacion,
    CASE WHEN id % 12 = 0 THEN NULL ELSE categoria_it END AS categoria_it, CASE WHEN id % 24 = 0 THEN NULL ELSE relevancia_ia END AS relevancia_ia) FROM ({CONTRACTS_SQL}) WHERE id % 10 <> 7"""


def _kept_up(spark, sf_dir):
    """The cube of three records in four, after a batch of new and changed records and one of deletions."""
    from telar.operators import kpi_cube

    c, k = contracts(spark, sf_dir), F.col("id")
    start = c.filter(k % 4 != 2)
    none = lambda x: F.lit(None).cast(c.schema[x].dataType)
    batch = c.filter(k % 4 != 3).withColumns({
        "estado": F.when(k % 4 == 0, "Vigente").when(k % 4 == 1, "Culminado").otherwise(F.col("estado")), "fecha_fin_cotizacion": F.when(k % 8 == 0, none("fecha_fin_cotizacion")).when(k % 4 == 0, F.lit("2001-07-18").cast("timestamp")).otherwise(F.col("fecha_fin_cotizacion")),
        "categoria_it": F.when(k % 12 != 0, F.col("categoria_it")), "relevancia_ia": F.when(k % 24 != 0, F.col("relevancia_ia")),
    })
    rows, counts = kpi_cube.upserted(start, batch, kpi_cube.cube(start))
    return kpi_cube.deleted(rows, rows.filter(k % 10 == 7).select("id"), counts)[1]


@query(SQL["kpi_single_pass"].replace(CONTRACTS_SQL, _CHANGED))
def kpi_kept_up(spark, sf_dir):
    from telar.operators import kpi_cube

    return kpi_cube.kpis(_kept_up(spark, sf_dir), AS_OF)


@query(SQL["kpi_business"].replace(CONTRACTS_SQL, _CHANGED).replace(_DAY, "DATE '2001-07-18'"))
def kpi_business_next_days(spark, sf_dir):
    """The same counts asked four days later."""
    from telar.operators import kpi_cube

    return kpi_cube.business_kpis(_kept_up(spark, sf_dir), AS_OF.replace("07-14", "07-18").replace("07-15", "07-19"))


@query(_with(_SCORED + "SELECT id, rubro, overlay FROM x"))
def rubric_of_contracts(spark, sf_dir):
    c = contracts(spark, sf_dir).filter(state.in_scope())
    text = F.concat_ws(" ", F.coalesce("descripcion", F.lit("")), F.coalesce("descripcion_contrato", F.lit("")))
    return c.select("id", R.rubric(*map(F.col, ("categoria_it", "relevancia_ia", "descripcion", "descripcion_contrato"))).alias("rubro"), R.overlay(text).alias("overlay"))


@query(
    _with(
        _SCORED
        + """, y AS (SELECT *, fin - d AS n FROM x WHERE estado IN ('Vigente', 'En Evaluación') AND post), z AS (SELECT id, rubro, fecha_fin_cotizacion,
    least(100, CASE lvl WHEN 4 THEN 50 WHEN 3 THEN 38 WHEN 2 THEN 24 WHEN 1 THEN 12 ELSE 0 END + 25 + CASE WHEN n IS NULL THEN 3 WHEN n < 0 THEN 0 WHEN n = 0 THEN 10 WHEN n = 1 THEN 12 WHEN n <= 7 THEN 15 WHEN n <= 30 THEN 8 ELSE 5 END
    + least(10, CASE WHEN relevancia_ia = 'ALTA' AND ai THEN 6 WHEN relevancia_ia = 'MEDIA' THEN 3 WHEN relevancia_ia = 'BAJA' THEN 1 ELSE 0 END + CASE WHEN objeto = 'Servicio' THEN 2 ELSE 0 END)) AS score FROM y)
    SELECT id, rubro, CAST(score AS INT) AS score FROM z ORDER BY score DESC, fecha_fin_cotizacion NULLS LAST, id DESC LIMIT 15"""
    )
)
def opportunity_score_topk(spark, sf_dir):
    return state.ranking(contracts(spark, sf_dir), AS_OF).select("id", "rubro", F.col("score").cast("int").alias("score"))


@query(_with("SELECT CASE WHEN coalesce(estado, 'Vigente') <> 'Vigente' THEN 'no_vigente' WHEN fecha_fin_cotizacion IS NULL THEN 'ventana_null' WHEN fecha_fin_cotizacion <= TIMESTAMP '" + NOW + "' THEN 'vencidos' WHEN coalesce(categoria_it, '') = '' AND coalesce(relevancia_ia, '') = '' THEN 'no_ti' ELSE 'ok' END AS reason, count(*) AS n FROM c GROUP BY 1"))
def queue_discard_reasons(spark, sf_dir):
    return state.work_queue(contracts(spark, sf_dir), F.lit(NOW).cast("timestamp"))[1].filter("n > 0")


@query(_with("SELECT id FROM s WHERE estado = 'Vigente' AND fecha_fin_cotizacion > TIMESTAMP '" + NOW + "' ORDER BY CASE WHEN relevancia_ia = 'ALTA' THEN 0 WHEN coalesce(categoria_it, '') <> '' THEN 1 WHEN relevancia_ia = 'MEDIA' THEN 2 WHEN relevancia_ia = 'BAJA' THEN 3 ELSE 9 END, id DESC LIMIT 20"))
def queue_top(spark, sf_dir):
    return state.work_queue(contracts(spark, sf_dir), F.lit(NOW).cast("timestamp"))[0].select("id").limit(20)


@query(_with("SELECT id, CASE WHEN coalesce(estado, '') <> 'Vigente' THEN 'estado=' || coalesce(estado, 'None') WHEN fecha_fin_cotizacion IS NULL THEN 'ventana_null' WHEN fecha_fin_cotizacion <= TIMESTAMP '" + NOW + "' THEN 'vencido' WHEN coalesce(categoria_it, '') = '' AND coalesce(relevancia_ia, '') = '' THEN 'no_ti' ELSE 'ok' END AS why FROM c"))
def queue_still_due(spark, sf_dir):
    return state.still_due(contracts(spark, sf_dir), F.lit(NOW).cast("timestamp")).select("id", "why")


@query(_with("SELECT id FROM c WHERE estado = 'Vigente' UNION ALL (SELECT id FROM c WHERE estado = 'En Evaluación' ORDER BY fecha_fin_cotizacion NULLS FIRST, id LIMIT 50)"))
def rotation_batch(spark, sf_dir):
    return state.rotation(contracts(spark, sf_dir), "fecha_fin_cotizacion", 50).select("id")


@query(_with("SELECT categoria_it AS label, count(*) AS n FROM (SELECT coalesce(categoria_it, 'NULL') AS categoria_it FROM c) GROUP BY 1"))
def count_by_label(spark, sf_dir):
    return reports.by_label(contracts(spark, sf_dir), F.col("categoria_it"), "label")


# Classification and scalar functions

_CATS = {"Rojo": ("red", "hot"), "Azul": ("blue",), "Ruedas": ("gear", "wheel"), "Anillos": ("ring",)}


@query(
    "SELECT p_partkey, CASE WHEN p_name LIKE '%red%' OR p_name LIKE '%hot%' THEN 'Rojo' WHEN p_name LIKE '%blue%' THEN 'Azul' WHEN p_name LIKE '%gear%' OR p_name LIKE '%wheel%' THEN 'Ruedas' WHEN p_name LIKE '%ring%' THEN 'Anillos' END AS category FROM part"
)
def category_first_match(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", classify.first_category(classify.blob(F.col("p_name"), normalise=T.fold), _CATS).alias("category"))


@query(
    "SELECT p_partkey, CASE WHEN p_name LIKE '%widget%' THEN 'ALTA' WHEN n >= 2 THEN 'MEDIA' WHEN n = 1 THEN 'BAJA' END AS level FROM (SELECT *, CAST(p_name LIKE '%red%' AS INT) + CAST(p_name LIKE '%ring%' AS INT) + CAST(p_name LIKE '%gear%' AS INT) AS n FROM part)"
)
def relevance_level(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", classify.relevance(classify.blob(F.col("p_name"), normalise=T.fold), ("widget",), ("red", "ring", "gear")).alias("level"))


@query("SELECT p_partkey, concat_ws(', ', CASE WHEN p_name LIKE '%widget%' THEN 'widget' END, CASE WHEN p_name LIKE '%red%' THEN 'red' END, CASE WHEN p_name LIKE '%ring%' THEN 'ring' END) AS terms FROM part")
def detected_terms(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", classify.detected(classify.blob(F.col("p_name"), normalise=T.fold), ("widget",), ("red", "ring")).alias("terms"))


@query("SELECT doc_id, md5(lower(strip_accents(text))) AS folded FROM documents")
def unaccented_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(T.unaccented(F.col("text"))).alias("folded"))


@query("SELECT doc_id, md5(lower(translate(text, 'áéíóúüñÁÉÍÓÚÜÑàèìòùÀÈÌÒÙ', 'aeiouunAEIOUUNaeiouAEIOU'))) AS folded FROM documents")
def folded_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(T.fold(F.col("text"))).alias("folded"))


@query("SELECT doc_id, CASE WHEN length(text) = 0 THEN 0 ELSE greatest(1, length(text) // 4) END AS tokens, length(regexp_replace(text, '[^\\pL\\pN]', '', 'g')) AS useful, left(text, 20) || CASE WHEN length(text) > 20 THEN '…' ELSE '' END AS clipped FROM documents")
def text_measures(spark, sf_dir):
    t = F.col("text")
    return table(spark, sf_dir, "documents").select("doc_id", T.approx_tokens(t).cast("long").alias("tokens"), T.useful_chars(t).cast("long").alias("useful"), T.clip(t, 20).alias("clipped"))


@query("SELECT doc_id, md5(trim(regexp_replace(regexp_replace(regexp_replace(replace(text, chr(0), ' '), '[ \\t]+\\n', chr(10), 'g'), '\\n{3,}', chr(10) || chr(10), 'g'), '[ \\t]{2,}', ' ', 'g'), ' ' || chr(10) || chr(9) || chr(13))) AS cleaned FROM documents")
def cleaned_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(T.clean_text(F.col("text"))).alias("cleaned"))


@query("SELECT s_suppkey, upper(left(s_name, 1)) || '0' AS a FROM supplier")
def acronyms(spark, sf_dir):
    return table(spark, sf_dir, "supplier").select("s_suppkey", T.acronym(F.regexp_replace("s_name", "#", " ")).alias("a"))


@query("SELECT c_custkey, '[' || c_name || ' | ' || c_mktsegment || ' | ' || CAST(c_custkey AS VARCHAR) || ']' AS header FROM customer")
def long_headers(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return c.select("c_custkey", T.long_header(F.col("c_name"), T.subject(F.lit(""), F.col("c_mktsegment")), T.contract_number(F.lit(" "), F.lit(""), F.col("c_custkey"))).alias("header"))


@query("SELECT event_id, CAST(timezone('America/Lima', timezone('UTC', ts)) AS DATE) AS local_day FROM events")
def local_days(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", D.local_date(F.col("ts")).alias("local_day"))


@query("SELECT o_orderkey, try_strptime(strftime(o_orderdate, '%d/%m/%Y') || ' ' || CAST(o_orderkey % 30 AS VARCHAR) || ':05:00', '%d/%m/%Y %H:%M:%S') AS at FROM orders")
def parsed_dates(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    text = F.concat(F.date_format("o_orderdate", "dd/MM/yyyy"), F.lit(" "), (F.col("o_orderkey") % 30).cast("string"), F.lit(":05:00"))
    return o.select("o_orderkey", D.parse_source_date(text).cast("timestamp_ntz").alias("at"))


# Vectors and search


@query("SELECT a.vec_id AS query_id, b.vec_id AS id, CAST(row_number() OVER (PARTITION BY a.vec_id ORDER BY list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) DESC, b.vec_id) AS INT) AS rank FROM embeddings a, embeddings b WHERE a.vec_id % 100 = 0 QUALIFY rank <= 10")
def vector_topk(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    q = e.filter("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"))
    return search.vector_search_many(e, q, 10).select("query_id", "id", "rank")


@query("WITH q AS (SELECT CAST(embedding AS DOUBLE[]) AS q FROM embeddings WHERE vec_id = 0) SELECT vec_id, round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), q), 6) AS similarity FROM embeddings, q WHERE label = 3 AND list_cosine_similarity(CAST(embedding AS DOUBLE[]), q) > 0.0 ORDER BY list_cosine_similarity(CAST(embedding AS DOUBLE[]), q) DESC, vec_id LIMIT 10")
def vector_topk_filtered(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    q = e.filter("vec_id = 0").select("embedding").first()[0]
    near = search.vector_search(e.filter("label = 3"), q, 10, 0.0, "embedding", ties=("vec_id",))
    return near.select("vec_id", F.round("similarity", 6).alias("similarity"))


@query("SELECT vec_id, round(sqrt(list_inner_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))), 6) AS norm, round(list_inner_product(CAST(embedding AS DOUBLE[])[:16], CAST(embedding AS DOUBLE[])[:16]), 6) AS part FROM embeddings")
def vector_norms(spark, sf_dir):
    v = F.col("embedding")
    return table(spark, sf_dir, "embeddings").select("vec_id", F.round(V.norm(v), 6).alias("norm"), F.round(V.dot_truncated(V.fit_dimension(v, 16), v), 6).alias("part"))


@query("SELECT label, count(*) AS pairs, round(avg(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[]))), 6) AS mean_cosine FROM embeddings a JOIN embeddings b USING (label) WHERE a.vec_id < b.vec_id GROUP BY label")
def pairwise_mean_by_label(spark, sf_dir):
    return search.mean_pairwise(table(spark, sf_dir, "embeddings"), ["label"], "embedding").select("label", "pairs", F.round("mean_cosine", 6).alias("mean_cosine"))


_WORDS_SQL = "SELECT doc_id, list_filter(string_split(regexp_replace(lower(translate(text, 'áéíóúüñÁÉÍÓÚÜÑàèìòùÀÈÌÒÙ', 'aeiouunAEIOUUNaeiouAEIOU')), '[^\\pL\\pN]+', ' ', 'g'), ' '), lambda w: w <> '') AS ws FROM documents"


@query(
    f"""WITH d AS ({_WORDS_SQL}), l AS (SELECT doc_id, len(ws) AS n, ws FROM d), i AS (SELECT doc_id, n, w, count(*) AS tf FROM (SELECT doc_id, n, unnest(ws) AS w FROM l) WHERE w IN ('the', 'this') GROUP BY ALL), f AS (SELECT w, count(*) AS df FROM i GROUP BY 1), s AS (SELECT count(*) AS c, avg(n) AS m FROM l)
    SELECT doc_id, round(sum(ln(1 + (c - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * n / m))), 6) AS rank FROM i JOIN f USING (w), s GROUP BY doc_id HAVING count(*) = 2"""
)
def fts_search_documents(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    hits = search.text_hits(search.postings(d, "doc_id", ["text"]), d.select(F.size(search.tokens(F.col("text"))).alias("length")), "the this")
    return hits.select(F.col("id").alias("doc_id"), F.round("rank", 6).alias("rank"))


@query(
    f"""WITH d AS ({_WORDS_SQL}), l AS (SELECT doc_id, len(ws) AS n, ws FROM d), i AS (SELECT doc_id, n, w, count(*) AS tf FROM (SELECT doc_id, n, unnest(ws) AS w FROM l) WHERE w IN ('the', 'this') GROUP BY ALL), f AS (SELECT w, count(*) AS df FROM i GROUP BY 1), s AS (SELECT count(*) AS c, avg(n) AS m FROM l)
    SELECT doc_id, round(sum(ln(1 + (c - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * n / m))), 6) AS rank FROM i JOIN f USING (w), s GROUP BY doc_id HAVING count(*) = 2"""
)
def fts_scan_documents(spark, sf_dir):
    hits = search.scan_hits(table(spark, sf_dir, "documents"), "doc_id", ["text"], "the this")
    return hits.select(F.col("id").alias("doc_id"), F.round("rank", 6).alias("rank"))


@query("SELECT doc_id, lang, 1.0::DOUBLE AS rank FROM documents WHERE lang = 'en' AND source ILIKE '%SRC1%' ORDER BY n_chars DESC NULLS LAST, doc_id LIMIT 200")
def record_search_filters(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return search.search_records(d, " ", {"lang": "en"}, {"source": "SRC1"}, ["text"], "doc_id", "n_chars", 1000, most=search.MOST_ROWS).select("doc_id", "lang", "rank")


_HYBRID = f"""WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings), q AS (SELECT vec_id AS query_id, v AS q FROM e WHERE vec_id % 100 = 0),
    a AS (SELECT query_id, vec_id AS id, row_number() OVER (PARTITION BY query_id ORDER BY list_cosine_similarity(v, q) DESC, vec_id) AS pa FROM e, q QUALIFY pa <= 20),
    w AS (SELECT doc_id, w, count(*) AS tf FROM (SELECT doc_id, unnest(ws) AS w FROM ({_WORDS_SQL})) WHERE w = 'the' GROUP BY ALL),
    b AS (SELECT query_id, doc_id AS id, row_number() OVER (PARTITION BY query_id ORDER BY tf DESC, doc_id) AS pb FROM w, q QUALIFY pb <= 20)
    SELECT query_id, id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY coalesce(1.0::DOUBLE / (60 + pa), 0) + coalesce(1.0::DOUBLE / (60 + pb), 0) DESC, pa NULLS LAST, pb NULLS LAST, id) AS INT) AS place FROM a FULL JOIN b USING (query_id, id) QUALIFY place <= 10"""


@query(_HYBRID)
def hybrid_rrf(spark, sf_dir):
    e, d = table(spark, sf_dir, "embeddings"), table(spark, sf_dir, "documents")
    q = e.filter("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"), F.lit("the").alias("word"))
    return hybrid(e, search.postings(d, "doc_id", ["text"]), q).select("query_id", "id", "place")


_JUDGED = """WITH h AS (SELECT a.vec_id AS query_id, b.vec_id AS id, a.label = b.label AS relevant, row_number() OVER (PARTITION BY a.vec_id ORDER BY list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) DESC, b.vec_id) AS rank FROM embeddings a, embeddings b WHERE a.vec_id % 100 = 0 QUALIFY rank <= 10) """


def _judged(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    q = e.filter("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"), F.col("label").alias("want"))
    hits = search.vector_search_many(e, q.drop("want"), 10).join(e.select(F.col("vec_id").alias("id"), "label"), "id").join(F.broadcast(q.select("query_id", "want")), "query_id")
    return hits.withColumn("relevant", F.col("label") == F.col("want")), q


@query(_JUDGED + "SELECT query_id, CAST(count(*) AS BIGINT) AS n_hits, CAST(count(*) FILTER (relevant) AS BIGINT) AS n_relevant, round_even(count(*) FILTER (relevant AND rank <= 5) / 5.0, 3)::DOUBLE AS p_at_5, round_even(count(*) FILTER (relevant) / 10.0, 3)::DOUBLE AS p_at_k, count(*) FILTER (relevant) > 0 AS success FROM h GROUP BY 1")
def retrieval_metrics(spark, sf_dir):
    hits, q = _judged(spark, sf_dir)
    return search.retrieval_metrics(hits, q).select("query_id", "n_hits", "n_relevant", "p_at_5", "p_at_k", "success")


@query(_JUDGED + "SELECT count(*) AS n_queries, round(avg(s), 6) AS success_at_k, round(avg(p5), 3) AS macro_p_at_5 FROM (SELECT query_id, CAST(count(*) FILTER (relevant) > 0 AS INT) AS s, count(*) FILTER (relevant AND rank <= 5) / 5.0 AS p5 FROM h GROUP BY 1)")
def retrieval_macro(spark, sf_dir):
    hits, q = _judged(spark, sf_dir)
    return search.macro(search.retrieval_metrics(hits, q)).select("n_queries", F.round("success_at_k", 6).alias("success_at_k"), "macro_p_at_5")


@query(_JUDGED + "SELECT query_id, min(rank) FILTER (id = query_id)::INT AS rank, coalesce(min(rank) FILTER (id = query_id) <= 5, false) AS in_top FROM h GROUP BY 1")
def known_item(spark, sf_dir):
    hits, q = _judged(spark, sf_dir)
    return search.known_item(hits, q.select("query_id", F.col("query_id").alias("id")))


# Merges and maintenance

_LATEST_EVENT = "SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"


@query(_LATEST_EVENT)
def latest_per_key(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return merge.latest(e, ["user_id"], F.desc("ts"), F.desc("event_id")).select("user_id", "event_id", "event_type")


@query("SELECT conv_id, turn, role, md5(text) AS digest FROM conversations QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn, role) = 1")
def first_per_key(spark, sf_dir):
    return merge.latest(table(spark, sf_dir, "conversations"), ["conv_id"], F.col("turn"), F.col("role")).select("conv_id", "turn", "role", F.md5("text").alias("digest"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, CASE WHEN o_orderkey % 10 = 0 THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice FROM orders UNION ALL SELECT -o_orderkey - 1, 'X', o_totalprice * 2 FROM orders WHERE o_orderkey % 1000 = 0")
def upsert_orders(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    new = o.withColumns({"o_orderstatus": F.lit("X"), "o_totalprice": F.col("o_totalprice") * 2})
    batch = new.filter("o_orderkey % 10 = 0").unionByName(new.filter("o_orderkey % 1000 = 0").withColumn("o_orderkey", -F.col("o_orderkey") - 1))
    return merge.upsert(o, batch, ["o_orderkey"])


@query("SELECT doc_id, lang, CASE WHEN doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1) THEN 'toxic' ELSE source END AS source FROM documents")
def partial_update(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    return merge.partial_update(d, table(spark, sf_dir, "labels").filter("toxic = 1").select("doc_id", F.lit("toxic").alias("source")), ["doc_id"])


@query("SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' AND o_totalprice > 100000 THEN 0 ELSE o_totalprice END AS o_totalprice FROM orders")
def guarded_update(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return merge.guarded_update(o, (F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 100000), {"o_totalprice": F.lit(0.0)}).select("o_orderkey", "o_totalprice")


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def anti_join_pending(spark, sf_dir):
    return merge.delete_keys(table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "labels"), "doc_id")


@query("SELECT l_orderkey, count(*) AS n_deleted FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P') GROUP BY 1")
def deleted_counts(spark, sf_dir):
    gone = table(spark, sf_dir, "orders").filter("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("l_orderkey"))
    return merge.deleted_count(table(spark, sf_dir, "lineitem"), gone, "l_orderkey")


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F')")
def cascade_delete(spark, sf_dir):
    parents = table(spark, sf_dir, "orders").filter("o_orderstatus <> 'F'")
    return merge.delete_children(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber"), parents, "l_orderkey", "o_orderkey")


@query("SELECT event_id, user_id FROM events WHERE event_id > (SELECT max(event_id) FROM events WHERE ts < TIMESTAMP '2024-01-20')")
def incremental_after_max(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return merge.incremental(e, e.filter("ts < TIMESTAMP_NTZ '2024-01-20'"), "event_id").select("event_id", "user_id")


@query("SELECT doc_id, lang FROM documents WHERE doc_id % 2 = 0 UNION ALL SELECT doc_id, 'new' FROM documents WHERE doc_id % 2 = 1 AND doc_id % 3 = 0")
def first_wins_union(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return merge.first_wins(d.filter("doc_id % 2 = 0"), d.filter("doc_id % 3 = 0").withColumn("lang", F.lit("new")), ["doc_id"])


@query("SELECT change, state, count(*) AS n FROM (SELECT CASE WHEN o_orderkey % 13 = 0 THEN 'unseen' WHEN o_orderkey % 4 = 0 AND o_orderstatus <> 'F' THEN 'changed' ELSE 'unchanged' END AS change, CASE WHEN o_orderkey % 13 <> 0 AND o_orderkey % 4 = 0 THEN 'F' ELSE o_orderstatus END AS state FROM orders) GROUP BY ALL")
def state_transitions(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    new = o.filter("o_orderkey % 13 <> 0").withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 4 == 0, "F").otherwise(F.col("o_orderstatus")))
    return merge.transitions(o, new, "o_orderkey", "o_orderstatus")


@query("SELECT coalesce(v.user_id, p.user_id) AS id, v.user_id IS NOT NULL AS analizado, p.user_id IS NOT NULL AS cotizado, v.f AS fecha_analisis, p.f AS fecha_cotizacion FROM (SELECT user_id, min(ts) AS f FROM events WHERE event_type = 'view' AND user_id > 0 GROUP BY 1) v FULL JOIN (SELECT user_id, min(ts) AS f FROM events WHERE event_type = 'purchase' AND user_id > 0 GROUP BY 1) p USING (user_id)")
def funnel_merge(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    of = lambda kind: e.filter(F.col("event_type") == kind).select(F.col("user_id").alias("id"), F.col("ts").alias("fecha"))
    return state.merge_funnel(of("view"), of("purchase"))


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' AND o_orderdate < TIMESTAMP '2001-07-15 03:00:00' - INTERVAL 60 DAY)")
def retention_gc(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.when(F.col("o_orderstatus") == "F", "Culminado").alias("estado"), F.col("o_orderdate").cast("timestamp").alias("estado_verificado_at"))
    li = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("contrato_id"), "l_linenumber")
    return state.collect_garbage(li, o, F.lit(NOW).cast("timestamp")).select(F.col("contrato_id").alias("l_orderkey"), "l_linenumber")


@query("SELECT event_id, round(running, 4) AS running, running <= 500 AS planned FROM (SELECT event_id, sum(value) OVER (PARTITION BY CAST(ts AS DATE) ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS running FROM events)")
def quota_running_sum(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    return state.planned(e, "value", 500, ["day"], F.col("ts"), F.col("event_id")).select("event_id", F.round("running", 4).alias("running"), "planned")


@query("SELECT CAST(timezone('America/Lima', timezone('UTC', ts)) AS DATE) AS dia, count(*) AS requests, CAST(sum(user_id) AS BIGINT) AS prompt_tokens, CAST(sum(event_id) AS BIGINT) AS output_tokens, round(sum((user_id * 0.5 + event_id * 3.0) / 1e6), 4) AS usd FROM events GROUP BY 1")
def quota_by_day(spark, sf_dir):
    q = reports.daily_quota(table(spark, sf_dir, "events"), "ts", "user_id", "event_id")
    return q.withColumn("usd", F.round("usd", 4))


# Validation and coverage


@query("SELECT event_id, CASE WHEN event_id % 10 = 0 THEN 'record is no JSON object' WHEN event_id % 10 = 1 THEN 'idContrato: a positive integer is required' WHEN event_id % 10 = 2 THEN 'nomEntidad: text expected, found a structure' ELSE '' END AS errors FROM events")
def validate_deadletter(spark, sf_dir):
    k = F.col("event_id").cast("string")
    n = F.col("event_id") % 10
    payload = F.when(n == 0, "[1]").when(n == 1, '{"idContrato": -3}').when(n == 2, F.concat(F.lit('{"idContrato": 5'), k, F.lit(', "nomEntidad": {"a": 1}}'))).otherwise(F.concat(F.lit('{"idContrato": 5'), k, F.lit(', "extra": [1]}')))
    rows = quality.validated(table(spark, sf_dir, "events").select("event_id", payload.alias("payload")))
    return rows.select("event_id", F.array_join("errors", "; ").alias("errors"))


@query("SELECT count(*) AS n_keys, count(*) FILTER (a) AS with_api, count(*) FILTER (b) AS with_pdf, count(*) FILTER (a AND b) AS with_both, count(*) FILTER (a AND NOT b) AS only_api, count(*) FILTER (b AND NOT a) AS only_pdf FROM (SELECT l_orderkey, bool_or(l_returnflag = 'R') AS a, bool_or(l_returnflag = 'A') AS b FROM lineitem GROUP BY 1)")
def coverage_sources(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", F.when(F.col("l_returnflag") == "R", "api").when(F.col("l_returnflag") == "A", "pdf").otherwise("none").alias("fuente"))
    return reports.source_coverage(rows, "l_orderkey", "fuente", ("api", "pdf"))


@query("SELECT count(*) FILTER (l_discount > 0.05) AS discounted, count(*) FILTER (l_shipdate >= TIMESTAMP '1998-01-01') AS late, count(*) FILTER (l_returnflag = 'R' AND l_tax = 0) AS untaxed FROM lineitem")
def conditional_counts(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return reports.counts(li, {"discounted": F.col("l_discount") > 0.05, "late": F.col("l_shipdate") >= F.lit("1998-01-01").cast("timestamp_ntz"), "untaxed": (F.col("l_returnflag") == "R") & (F.col("l_tax") == 0)})


@query("SELECT min(doc_id) AS doc_id, sha256(text) AS digest, count(*) AS copies FROM documents GROUP BY text")
def content_hash_dedupe(spark, sf_dir):
    return table(spark, sf_dir, "documents").groupBy(F.sha2(F.col("text").cast("binary"), 256).alias("digest")).agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies"))


# Chunking

_CHUNKS = """WITH RECURSIVE l AS (SELECT doc_id, list_filter(list_transform(string_split(replace(text, chr(13) || chr(10), chr(10)), chr(10)), lambda x: trim(x)), lambda x: x <> '') AS ls FROM documents),
    r AS (SELECT doc_id, ls, 1 AS i, 1 AS chunk, greatest(1, length(ls[1]) // 4) AS n FROM l WHERE len(ls) > 0
          UNION ALL SELECT doc_id, ls, i + 1, CASE WHEN n + greatest(1, length(ls[i + 1]) // 4) > 500 THEN chunk + 1 ELSE chunk END, CASE WHEN n + greatest(1, length(ls[i + 1]) // 4) > 500 THEN greatest(1, length(ls[i + 1]) // 4) ELSE n + greatest(1, length(ls[i + 1]) // 4) END FROM r WHERE i < len(ls)),
    c AS (SELECT doc_id, CAST(chunk - 1 AS INT) AS chunk_index, string_agg(ls[i], chr(10) ORDER BY i) AS t FROM r GROUP BY 1, 2) """


def _chunks(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", F.posexplode(chunking.split_paragraphs(F.col("text"))).alias("chunk_index", "t"))


@query(_CHUNKS + "SELECT doc_id, chunk_index, md5(t) AS digest FROM c")
def chunk_paragraphs(spark, sf_dir):
    return _chunks(spark, sf_dir).select("doc_id", "chunk_index", F.md5("t").alias("digest"))


@query(_CHUNKS + "SELECT count(*) AS n_chunks, count(DISTINCT doc_id) AS n_docs, round(avg(greatest(1, length(t) // 4)), 4) AS mean_tokens FROM c")
def chunk_stats(spark, sf_dir):
    return _chunks(spark, sf_dir).agg(F.count(F.lit(1)).alias("n_chunks"), F.countDistinct("doc_id").alias("n_docs"), F.round(F.avg(T.approx_tokens(F.col("t"))), 4).alias("mean_tokens"))


@query("SELECT doc_id, md5(text) AS body FROM documents")
def chunk_body(spark, sf_dir):
    """A header put before each text and taken off again."""
    d = table(spark, sf_dir, "documents")
    headed = F.concat(T.short_header(F.col("source"), F.col("doc_id").cast("string")), F.lit("\n"), F.col("text"))
    return d.select("doc_id", F.md5(F.when(F.col("text").rlike(r"^\s"), F.col("text")).otherwise(T.body(headed))).alias("body"))


# Streams (an extension)


@query("SELECT time_bucket(INTERVAL 1 DAY, ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def daily_event_windows(spark, sf_dir):
    """The stream's windows over the whole table as a batch."""
    from telar.streaming.events import windowed

    e = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return windowed(e, "1 day", "event_type").select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n", F.round("total", 4).alias("total"))

import json
import math
from datetime import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from telar import schema
from telar.operators import chunking, classify, embedding, merge, quality, reports, search, state
from telar.plans import documents, ingest

def now_():
    return F.lit("2026-08-20 12:00:00").cast("timestamp")


def rows(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=repr)


def test_merge(spark):
    old = spark.createDataFrame([(1, "a", 1.0), (2, "b", None), (None, "n", 0.0)], "k int, s string, x double")
    new = spark.createDataFrame([(2, "c", None), (3, "d", 3.0), (None, "m", 5.0)], "k int, s string, x double")
    assert rows(merge.upsert(old, new, ["k"])) == [(1, "a", 1.0), (2, "c", None), (3, "d", 3.0), (None, "m", 5.0)]
    assert rows(merge.partial_update(old, new, ["k"], ["x"])) == [(1, "a", 1.0), (2, "b", None), (None, "n", 5.0)]
    assert rows(merge.partial_update(old, new, ["k"], ["s"], insert=True)) == [(1, "a", 1.0), (2, "c", None), (3, "d", None), (None, "m", 0.0)]
    assert rows(merge.partial_update(old, new, ["k"], ["s"], when=F.col("l.x").isNull())) == [(1, "a", 1.0), (2, "c", None), (None, "n", 0.0)]
    assert rows(merge.first_wins(old, new, ["k"])) == [(1, "a", 1.0), (2, "b", None), (3, "d", 3.0), (None, "n", 0.0)]
    twice = new.unionByName(new.withColumn("s", F.lit("z")))
    assert rows(merge.upsert(old, twice, ["k"], [F.desc("s")]), "k", "s") == [(1, "a"), (2, "z"), (3, "z"), (None, "z")]
    with pytest.raises(ValueError, match="condition"):
        merge.null_out(old, "x")
    assert rows(merge.null_out(old, "x", spark.createDataFrame([(1,)], "k int"), "k"), "k", "x") == [(1, None), (2, None), (None, 0.0)]
    assert rows(merge.delete_keys(old, new, "k"), "k") == [(1,), (None,)]
    got, missing = merge.keys_in_order(old.filter("k IS NOT NULL").withColumn("k", F.col("k").cast("long")), [2, 9, 1], "k")
    assert [r.k for r in got.collect()] == [2, 1]
    assert [r.k for r in missing.collect()] == [9]
    empty = old.limit(0)
    assert rows(merge.upsert(empty, new, ["k"])) == rows(new)
    assert rows(merge.incremental(old, empty, "k"), "k") == [(1,), (2,)]


def test_validation(spark):
    ok = {"idContrato": 5, "nomEntidad": " E ", "fecPublica": "1/8/2026 00:30:00", "nroContratacion": 12, "cotizar": True, "otra": 1}
    bad = [{"idContrato": 0}, {"nomEntidad": "x"}, {"idContrato": "7x"}, {"idContrato": 5, "nomEntidad": {"a": 1}}, [1], "text"]
    raw = spark.createDataFrame([(json.dumps(x),) for x in [ok, *bad]] + [("not json",), (None,)], "payload string")
    valid, dead = quality.split_valid(raw)
    assert valid.count() == 1
    assert dead.count() == 8
    c = quality.to_contracts(valid).first()
    assert (c.id, c.entidad, c.nro_contratacion, c.fecha_publica, c.cotizar, c.objeto) == (5, "E", "12", datetime(2026, 8, 1, 0, 30), True, None)
    secret = spark.createDataFrame([(json.dumps({"idContrato": -1, "Cookie": "s", "x-key": "s", "access_token": "s", "ok": "v"}),)], "payload string")
    assert json.loads(quality.split_valid(secret)[1].first().payload) == {"idContrato": "-1", "ok": "v"}
    marked = quality.rejected_by(spark.createDataFrame([(1,), (None,)], "x int"), {"positive": F.col("x") > 0})
    assert [r.errors for r in marked.collect()] == [[], ["positive"]]


def test_classify(spark):
    texts = [("Servicio AWS", "Cloud/hosting", None), ("firma digital y machine learning", "Firma digital", "BAJA"), ("ChatGPT con big data", "IA/analytics", "ALTA"), ("chatbot, deep learning", "IA/analytics", "MEDIA"), ("lawsuit", None, None), (None, None, None), ("Switch", "Redes/cableado", None)]
    df = spark.createDataFrame([(i, t) for i, (t, _, _) in enumerate(texts)], "i int, a string").withColumn("b", classify.blob(F.col("a")))
    got = df.orderBy("i").select(classify.first_category(F.col("b")).alias("c"), classify.relevance(F.col("b")).alias("r"), classify.relevance(F.col("b"), none="BAJA").alias("n"), classify.detected(F.col("b")).alias("d")).collect()
    assert [(g.c, g.r) for g in got] == [(c, r) for _, c, r in texts]
    assert [g.n for g in got] == [r or "BAJA" for _, _, r in texts]
    assert got[2].d == "gpt, big data"
    judged = spark.createDataFrame([("la nube", ["nube"], ["red"]), ("nube y red", ["nube"], ["red"]), ("x", None, None)], "t string, m array<string>, e array<string>").select(classify.relevant(F.col("t"), F.col("m"), F.col("e")).alias("x")).collect()
    assert [j.x for j in judged] == [True, False, False]


def pack(text, target):
    """An independent statement of greedy packing."""
    out, size = [], 0
    for line in filter(None, (x.strip() for x in text.replace("\r\n", "\n").split("\n"))):
        n = max(1, len(line) // 4)
        if out and size + n <= target:
            out[-1], size = out[-1] + "\n" + line, size + n
        else:
            out, size = [*out, line], n
    return out


@settings(max_examples=15, deadline=None)
@given(st.lists(st.lists(st.text("ab é", max_size=60), max_size=12).map("\n".join), min_size=1, max_size=8), st.integers(1, 30))
def test_packing_property(spark, texts, target):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, a string").select("i", chunking.split_paragraphs(F.col("a"), target).alias("x")).orderBy("i")
    assert [r.x for r in df.collect()] == [pack(t, target) for t in texts]


def contract(**kw):
    base = dict.fromkeys(f.name for f in schema.schema_of("contratos")) | {"id": 1, "estado": "Vigente", "entidad": "Banco de la Nación", "descripcion": "Compra", "nro_contratacion": "N1"}
    return base | kw


def test_chunks_and_vectors(spark):
    long = "\n".join("palabra " * 40 for _ in range(60))
    items = [("c", "n", "d", 2.0, "u", "Lima"), ("c", None, None, 0.0, None, None)]
    df = spark.createDataFrame([contract(items_json=items), contract(id=2, descripcion=long, tdr_texto="--- pagina 1 ---\nPERÚ\ntexto"), contract(id=3, descripcion=None)], schema.schema_of("contratos"))
    chunks = chunking.contract_chunks(df)
    one = chunks.filter("contrato_id = 1").orderBy("chunk_index").collect()
    assert [c.tipo for c in one] == ["Descripción general", "Ítem técnico 1", "Ítem técnico 2", "Metadata"]
    assert one[1].texto == "[Banco de la Nación | Compra | N1]\nCUBSO: c - n. Cantidad: 2 u. Lugar: Lima. Especificaciones: d"
    assert "Cantidad:  ." in one[2].texto
    assert chunks.filter("contrato_id = 2 AND tipo LIKE 'Descripción general (%'").count() > 1
    assert [c.tipo for c in chunks.filter("contrato_id = 3").collect()] == ["Metadata"]
    none = spark.createDataFrame([], schema.schema_of("chunks_tdr"))
    every = documents.with_chunks(df, none)
    pdf = every.filter("fuente = 'pdf'").first()
    assert (pdf.contrato_id, pdf.tipo, pdf.texto) == (2, "TDR PDF", "[BLN | N1]\n--- pagina 1 ---\nPERÚ\ntexto")
    assert pdf.chunk_embed_text.endswith("]\ntexto")
    assert pdf.chunk_index == 1 + every.filter("fuente = 'api' AND contrato_id = 2").agg(F.max("chunk_index")).first()[0]
    assert documents.with_chunks(df, every).count() == every.count()
    vectors = documents.with_vectors(df, every, embedding.hashing_embedder(8))
    assert vectors.filter("embedding_v2 IS NULL").count() == 0
    cover = embedding.coverage(vectors, df).filter("fuente = 'pdf'").first()
    assert (cover.n, cover.with_vector) == (1, 1)

    def broken(texts):
        raise OSError("down")

    failed = embedding.embedded(every.select("id", "texto"), F.col("texto"), broken, retries=1)
    assert failed.filter("vector IS NULL AND error LIKE 'OSError%'").count() == every.count()
    fresh = chunking.rechunk(every, chunks.filter("contrato_id = 2"), "api")
    assert fresh.filter("fuente = 'pdf'").count() == 1
    again = chunking.backfill(vectors, df).filter("fuente = 'pdf'").first()
    assert again.embedding_v2 is None
    assert embedding.better_mode(0.5, 0.6) == "header"
    assert embedding.better_mode(0.6, 0.6) == "body"
    assert chunking.chunk_statistics(every).filter("tipo = 'Descripción general'").first().n_contracts == 2


def test_search(spark):
    docs = spark.createDataFrame([contract(id=i, descripcion=t, fecha_publica=datetime(2026, 1, i)) for i, t in ((1, "nube pública nube"), (2, "nube"), (3, "red y nube"), (4, None))], schema.schema_of("contratos"))
    assert [r.id for r in search.search_records(docs, "Nube").collect()][0] == 1
    assert [r.id for r in search.search_records(docs, "nube red").collect()] == [3]
    assert [r.id for r in search.search_records(docs, "", limit=2, offset=1).collect()] == [3, 2]
    assert search.search_records(docs, "", {"estado": "Culminado"}).count() == 0
    assert search.search_records(docs, "zzz").count() == 0
    chunks = spark.createDataFrame([(1, 0, [1.0, 0.0]), (2, 0, [0.6, 0.8]), (3, 0, [0.0, 0.0]), (4, 0, None)], "contrato_id long, chunk_index int, embedding_v2 array<double>")
    assert [r.contrato_id for r in search.vector_search(chunks, [1.0, 0.0], 5, 0.6).collect()] == [1]
    assert search.vector_search(chunks, [0.0, 0.0], 5, -1).count() == 0
    metrics = search.retrieval_metrics(spark.createDataFrame([("q", 1, 1, True), ("q", 2, 2, False)], "query_id string, id int, rank int, relevant boolean"), spark.createDataFrame([("q",), ("z",)], "query_id string"), spark.createDataFrame([("q", 1), ("q", 9)], "query_id string, id int"))
    assert rows(metrics) == [("q", 2, 1, 0.5, 0.5, True, 2, 0.5), ("z", 0, 0, 0.0, 0.0, False, 0, None)]
    m = search.macro(metrics).first()
    assert (m.n_queries, m.success_at_k, m.macro_recall, m.without_hits) == (2, 0.5, 0.5, 1)
    two = search.at_most_per_key(spark.createDataFrame([("q", 1, i) for i in range(4)], "q string, k int, r int"), ["q"], "k", 2, F.col("r"))
    assert two.count() == 2
    f = spark.createDataFrame([("¿Qué servicios vigentes de 2026?",)], "a string").select(search.query_filters(F.col("a")).alias("f")).first().f
    assert (f.estado, f.objeto, f.anio) == ("Vigente", "Servicio", 2026)
    ctx = search.context_text(docs.withColumn("tdr_texto", F.when(F.col("id") == 1, "whole")), spark.createDataFrame([(2, 1, "b", "api", "T"), (2, 0, "a", None, None)], "contrato_id long, chunk_index int, texto string, fuente string, tipo string"))
    assert rows(ctx) == [(1, "whole", "tdr_texto"), (2, "[api · chunk]\na\n\n[api · T]\nb", "chunks"), (3, "", "ficha"), (4, "", "ficha")]


@settings(max_examples=12, deadline=None)
@given(st.lists(st.integers(0, 8), max_size=8), st.lists(st.integers(0, 8), max_size=8))
def test_fusion_property(spark, a, b):
    a, b = list(dict.fromkeys(a)), list(dict.fromkeys(b))
    score = {x: sum(1 / (60 + y.index(x) + 1) for y in (a, b) if x in y) for x in {*a, *b}}
    want = sorted(score, key=lambda x: (-score[x], a.index(x) if x in a else 99, b.index(x) if x in b else 99))[:5]
    frame = lambda xs: spark.createDataFrame([("q", x, i + 1) for i, x in enumerate(xs)], "query_id string, id int, pos int")
    got = search.reciprocal_rank_fusion(frame(a), frame(b), "id", k=5).orderBy("place").collect()
    assert [g.id for g in got] == want
    assert all(math.isclose(g.rrf, round(score[g.id], 6), abs_tol=1e-9) for g in got)


def test_mean_pairwise(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (0, [0.0, 1.0]), (0, [1.0, 1.0]), (1, [1.0, 0.0]), (2, [0.0, 0.0]), (2, [1.0, 0.0])], "g int, v array<double>")
    r = search.mean_pairwise(df, ["g"], "v").collect()
    assert len(r) == 1
    assert r[0].pairs == 3
    assert r[0].mean_cosine == pytest.approx((0 + 2 / math.sqrt(2)) / 3)


def test_state(spark):
    ends = [None, datetime(2026, 8, 19, 12), datetime(2026, 8, 20, 6), datetime(2026, 8, 21, 6), datetime(2026, 8, 22, 6), datetime(2026, 8, 27, 6), datetime(2026, 8, 28, 6)]
    data = [contract(id=i * 10 + j, estado=e, fecha_fin_cotizacion=f, categoria_it="Oracle") for i, e in enumerate(["Vigente", "En Evaluación", "Culminado", None]) for j, f in enumerate(ends)]
    df = spark.createDataFrame(data, schema.schema_of("contratos"))
    flags = state.day_flags(df, F.col("estado"), F.col("fecha_fin_cotizacion"), F.col("fecha_publica"), "2026-08-20T12:00:00")
    got = {r.id: r for r in flags.collect()}
    assert [got[i].es_postulable for i in range(7)] == [True, False, True, True, True, True, True]
    assert [got[i].cierra_semana for i in range(7)] == [None, False, False, False, True, True, False]
    assert got[10].cierra_hoy is False
    assert got[30].es_postulable is None
    k = state.kpis(df, "2026-08-20T12:00:00").first()
    assert (k.total_postulables, k.cierran_hoy, k.cierran_manana, k.cierran_semana, k.vigentes_ventana_vencida, k.en_evaluacion) == (6, 1, 1, 2, 1, 7)
    assert json.loads(k.por_rubro) == [{"rubro": "adyacente", "total": 6}]
    empty = state.kpis(df.limit(0), "2026-08-20T12:00:00").first()
    assert (empty.total_postulables, empty.por_linea) == (0, "[]")
    due, counts = state.work_queue(df, now_())
    assert {r.reason: r.n for r in counts.collect()} == {"no_vigente": 14, "ventana_null": 2, "vencidos": 4, "no_ti": 0, "ok": 8}
    assert due.count() == 8
    funnel = state.merge_funnel(*(spark.createDataFrame(x, "id long, fecha timestamp") for x in ([(1, datetime(2026, 1, 2)), (1, datetime(2026, 1, 1)), (-1, datetime(2026, 1, 1))], [(1, datetime(2026, 1, 3)), (2, None)])))
    assert rows(funnel) == [(1, True, True, datetime(2026, 1, 1), datetime(2026, 1, 3))]
    marked = state.apply_funnel(df.filter("id = 1").withColumns({"analizado": F.lit(True), "fecha_analisis": F.lit("2025-01-01").cast("timestamp")}), funnel).first()
    assert (marked.fecha_analisis, marked.cotizado) == (datetime(2025, 1, 1), True)
    enriched = state.enrich(df.filter("id < 2"), spark.createDataFrame([(0, " ", "a"), (1, "new", "b")], "id long, descripcion string, nom_area_usuaria string"))
    assert rows(enriched, "id", "descripcion", "nom_area_usuaria", "detalle_cargado") == [(0, "Compra", "a", True), (1, "new", "b", True)]
    pages = spark.createDataFrame([(1, 1, "x" * 90), (1, 2, "y"), (2, 1, None)], "id long, pagina int, texto string")
    assert rows(state.extracted_pages(pages), "id", "tdr_n_paginas", "paginas_ocr_pendientes", "tdr_tipo_extraccion") == [(1, 2, [2], "mixto"), (2, 1, [1], "imagen_total")]
    files = [(1, 2, "a.pdf", "application/pdf"), (2, 1, "b.pdf", "application/PDF"), (3, 1, "c.doc", "x")]
    f = spark.createDataFrame([(files,), ([],), (files[2:],)], "f array<struct<idContratoArchivo: long, idTipoArchivo: int, nombre: string, descripcionMime: string>>").select(state.choose_pdf(F.col("f"))["idContratoArchivo"].alias("x")).collect()
    assert [x.x for x in f] == [2, None, None]
    q = state.planned(spark.createDataFrame([("d", i, 2) for i in range(4)], "d string, i int, c int"), "c", 5, ["d"], F.col("i"))
    assert q.filter("planned").count() == 2
    p = spark.createDataFrame([([1, 2, 2, 3], [2])], "a array<int>, b array<int>").select(state.pages_due(F.col("a"), F.col("b")).alias("x")).first().x
    assert p == [1, 3]


def test_reports(spark):
    df = spark.createDataFrame([("a", "mixto", 4), ("sin_pdf", None, 9), (None, "nativo_puro", 2)], "req_url string, tdr_tipo_extraccion string, tdr_n_paginas int").withColumns({"tdr_n_paginas_nativas": F.lit(1), "tdr_n_paginas_ocr": F.lit(0)})
    r = reports.extraction_report(df).first()
    assert (r.n, r.mixto, r.sin_pdf, r.tdr_n_paginas) == (3, 1, 1, 6)
    assert [tuple(x) for x in reports.by_label(df, F.col("tdr_tipo_extraccion"), "t").collect()] == [("NULL", 1), ("mixto", 1), ("nativo_puro", 1)]
    assert reports.max_or(df.limit(0), "tdr_n_paginas", -1).first()[0] == -1
    low = quality.coverage_alerts(spark.createDataFrame([(10, 8, 10)], "n int, a int, b int"), "n", ["a", "b"]).first()
    assert low.alerts == ["a"]


def test_ingest(spark):
    raw = spark.createDataFrame([(json.dumps({"idContrato": i, "desObjetoContrato": "hosting", "fecPublica": "01/08/2026 10:00:00"}),) for i in (3, 4, 4, 9)] + [("{}",)], "payload string")
    now = spark.createDataFrame([contract(id=4, descripcion="old"), contract(id=5)], schema.schema_of("contratos"))
    out = ingest.ingest(raw, now)
    assert rows(out.snapshot, "id", "categoria_it") == [(4, None), (5, None), (9, "Cloud/hosting")]
    m = out.metrics.first()
    assert (m.nuevos, m.con_categoria, m.rechazados) == (1, 1, 1)
    full = ingest.ingest(raw, now, incremental=False)
    assert rows(full.snapshot, "id", "descripcion") == [(3, "hosting"), (4, "hosting"), (5, "Compra"), (9, "hosting")]


def test_schema(spark):
    df = schema.conform(spark.createDataFrame([("7", "x")], "id string, otra string"), "chunks_tdr")
    assert df.schema == schema.schema_of("chunks_tdr") or [f.name for f in df.schema] == [f.name for f in schema.schema_of("chunks_tdr")]
    assert df.first().id == 7
    assert "texto" in schema.missing_columns(spark.createDataFrame([(1,)], "id int"), "chunks_tdr")


def test_fill_and_cache(spark):
    df = spark.createDataFrame([(1, "", None), (2, "x", 5), (3, None, None)], "id int, s string, n int")
    other = spark.createDataFrame([(1, "a", 1, "z"), (2, "b", 2, "z")], "id int, s string, n int, w string")
    assert rows(merge.fill_missing(df, other, "id", ["s", "n", "w"])) == [(1, "a", 1, "z"), (2, "x", 5, "z"), (3, None, None, None)]
    cache = spark.createDataFrame([(datetime(2026, 8, 18),), (datetime(2026, 8, 1),)], "at timestamp")
    assert merge.kept_for(cache, "at", now_(), 3).count() == 1


def test_similarity_and_modes(spark):
    hits = spark.createDataFrame([("q", 0.5), ("q", 0.7)], "query_id string, similarity double")
    got = search.mean_similarity(hits, spark.createDataFrame([("q",), ("z",)], "query_id string"))
    assert [(r.query_id, round(r.mean_similarity, 6)) for r in got.orderBy("query_id").collect()] == [("q", 0.6), ("z", 0.0)]
    texts = spark.createDataFrame([(1, i, "same head", f"body {i} {i * 7}") for i in range(3)], "g int, i int, h string, b string")
    modes = {r.mode: r.mean_cosine for r in embedding.compare_modes(texts, {"header": F.col("h"), "body": F.col("b")}, embedding.hashing_embedder(32), "g").collect()}
    assert modes["header"] == pytest.approx(1)
    assert embedding.better_mode(modes["header"], modes["body"]) == "body"


def test_download_outcomes(spark):
    df = spark.createDataFrame([contract(id=i, pdf_es_imagen=True, tdr_texto="t" * 90 if i == 4 else None, pdf_nombre="old") for i in (1, 2, 3, 4)], schema.schema_of("contratos"))
    out = spark.createDataFrame([(1, "ok", "text", "h", "mixto", [2], None, 3, 2, 1, "http://u", 9, "n.pdf"), (2, "sin_pdf", None, None, None, None, None, None, None, None, None, None, None), (3, "pendiente", None, "h3", None, None, None, None, None, None, None, 5, "p.pdf")],
        "id long, outcome string, tdr_texto string, pdf_hash string, tdr_tipo_extraccion string, paginas_ocr_pendientes array<int>, paginas_ocr_hechas array<int>, tdr_n_paginas int, tdr_n_paginas_nativas int, tdr_n_paginas_ocr int, url string, pdf_archivo_id long, pdf_nombre string")
    got = state.record_downloads(df, out)
    assert rows(got, "id", "pdf_descargado", "pdf_procesado", "pdf_es_imagen", "req_url", "pdf_nombre") == [(1, True, True, True, "http://u", "n.pdf"), (2, True, True, None, "sin_pdf", None), (3, False, False, True, "pendiente_ocr", "p.pdf"), (4, None, None, True, None, "old")]
    side = spark.createDataFrame([(1, "imagen_total", [1, 2], [], 2, 0, 2, True)], "id long, tdr_tipo_extraccion string, paginas_ocr_pendientes array<int>, paginas_ocr_hechas array<int>, tdr_n_paginas int, tdr_n_paginas_nativas int, tdr_n_paginas_ocr int, pdf_es_imagen boolean")
    synced = state.sync_sidecar(df, side)
    assert rows(synced, "id", "tdr_tipo_extraccion", "pdf_es_imagen") == [(1, "imagen_total", True), (2, None, True), (3, None, True), (4, "nativo_puro", False)]
    queue = state.page_queue(df.withColumn("fecha_fin_cotizacion", F.lit("2026-09-01").cast("timestamp")).withColumn("categoria_it", F.lit("Oracle")), side, now_())
    assert rows(queue, "id", "pages") == [(1, [1, 2])]


def test_funnel_lists(spark):
    p = spark.createDataFrame([(json.dumps({"analizados": [{"id": 1, "fecha": "2026-01-02T00:00:00Z"}, {"id": "2.5", "fecha": "2026-01-02"}, {"id": 3, "fecha": "bad"}], "cotizados": [{"id": "4", "fecha": "2026-01-03"}]}),), ("{}",)], "payload string")
    a, c = state.funnel_lists(p)
    assert rows(a) == [(1, datetime(2026, 1, 2))]
    assert rows(c) == [(4, datetime(2026, 1, 3))]


def test_write_split_parses_once(spark, tmp_path):
    """Both results of one write; what the mapping fails is a dead letter too."""
    texts = ['{"idContrato": 1, "nomEntidad": " E ", "fecPublica": "1/2/2024 03:04:05"}', '{"idContrato": "2", "fecPublica": "x"}', '{"idContrato": 0}', '[{"idContrato": 3}]', "no", None, '{"idContrato": 4, "nomEntidad": {"a": 1}, "token": "t"}', '{"idContrato": 5, "idContrato": 6}']
    raw = spark.createDataFrame([(t,) for t in texts], "payload string")
    good, bad, n = quality.write_split(raw, f"file://{tmp_path}/s", checks={"fecha_publica": F.col("fecha_publica").isNotNull() | (F.col("id") != 2)})
    assert n == {"n": 8, "valid": 2, "rejected": 6, "unmapped": 1}
    assert {(r.id, r.entidad) for r in good.collect()} == {(1, "E"), (6, None)}
    reasons = sorted((r.id_contrato or 0, r.motivo) for r in bad.collect())
    assert reasons == [(0, "idContrato: a positive integer is required"), *[(0, "record is no JSON object")] * 3, (2, "mapping: fecha_publica"), (4, "nomEntidad: text expected, found a structure")]
    assert good.columns == quality.to_contracts(quality.records(quality.validated(raw))).columns
    for df in quality.split_valid(raw):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json(StructField(idContrato") == 1
    with pytest.raises(ValueError):
        quality.write_split(raw, f"file://{tmp_path}/t", mapping=lambda r: r.select("idContrato"))

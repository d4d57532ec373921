"""Calendar-day flags, KPIs, refresh, retention and work queues."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from telar.functions import rubric as R
from telar.functions.time import ZONE, local_date, today
from .merge import partial_update

OPEN, EVALUATED, CLOSED = "Vigente", "En Evaluación", "Culminado"
STATE_IDS = {2: OPEN, 3: EVALUATED, 4: CLOSED}
TERMINAL = (CLOSED, "Cancelado", "Desierto", "Anulado", "Cerrado")
RETENTION_DAYS = 60
QUEUE_REASONS = ("no_vigente", "ventana_null", "vencidos", "no_ti", "ok")


def in_scope() -> Column:
    """Of interest: a category or a relevance, neither null nor empty."""
    return (F.coalesce("categoria_it", F.lit("")) != "") | (F.coalesce("relevancia_ia", F.lit("")) != "")


def day_flags(df: DataFrame, state: Column, end: Column, published: Column, as_of: str | None = None, zone: str = ZONE) -> DataFrame:
    """The nine flags by local calendar day; null where an open record's end is unknown, as comparisons give it."""
    return flagged(df, state, local_date(end, zone), local_date(published, zone), as_of, zone)


def flagged(df: DataFrame, state: Column, fin: Column, pub: Column, as_of: str | None = None, zone: str = ZONE) -> DataFrame:
    """The flags from local days; with the days themselves as ``hoy``, ``fin`` and ``pub``."""
    d = today(as_of, zone)
    open_ = state == OPEN
    return df.withColumns({
        "hoy": d, "fin": fin, "pub": pub,
        "es_postulable": open_ & (fin.isNull() | (fin >= d)),
        "es_vigente_ventana_vencida": open_ & fin.isNotNull() & (fin < d),
        "es_en_evaluacion": state == EVALUATED, "es_culminado": state == CLOSED,
        "cierra_hoy": open_ & (fin == d), "cierra_manana": open_ & (fin == F.date_add(d, 1)),
        "cierra_7d": open_ & fin.between(d, F.date_add(d, 7)), "cierra_semana": open_ & fin.between(F.date_add(d, 2), F.date_add(d, 7)),
        "es_nuevo_hoy": pub == d,
    })


def _count(c: Column, name: str, n: Column) -> Column:
    """The sum of n where the condition holds."""
    return F.coalesce(F.sum(F.when(c, n)), F.lit(0)).cast("int").alias(name)


def _listed(rows: Column, label: str, order) -> Column:
    """An array of struct<label, n> summed by label and shown as an ordered JSON array."""
    labels = F.array_distinct(F.transform(rows, lambda r: r[label]))
    total = lambda x: F.aggregate(F.filter(rows, lambda r: r[label] == x), F.lit(0), lambda a, r: a + r["n"])
    keyed = F.transform(labels, lambda x: F.struct(total(x).alias("n"), x.alias("x")))
    ordered = F.array_sort(F.transform(keyed, lambda s: F.struct(order(s["x"], s["n"]).alias("k"), s["x"].alias(label), s["n"].alias("total"))))
    return F.to_json(F.transform(ordered, lambda s: F.struct(s[label].alias(label), s["total"].alias("total"))))


def _lists() -> list[Column]:
    """por_linea and por_rubro from groups (linea, rubro, n): a few rows, as many as there are categories and levels."""
    rows = F.filter(F.collect_list(F.struct("linea", F.coalesce("rubro", F.lit("sin_clasificar")).alias("rubro"), F.col("n"))), lambda r: r["n"] > 0)
    place = lambda x, _: F.when(x == "sin_clasificar", 4).otherwise(4 - R.rank(x))
    return [_listed(rows, "linea", lambda x, n: F.struct((-n).alias("a"), x.alias("b"))).alias("por_linea"), _listed(rows, "rubro", place).alias("por_rubro")]


def text_of() -> Column:
    return F.concat_ws(" ", F.coalesce("descripcion", F.lit("")), F.coalesce("descripcion_contrato", F.lit("")))


def rubric_of() -> Column:
    return R.rubric(*map(F.col, ("categoria_it", "relevancia_ia", "descripcion", "descripcion_contrato")))


def kpis(contracts: DataFrame, as_of: str | None = None) -> DataFrame:
    """The dashboard's ten counts and two JSON lists over the open records.

    One scan: counts by line and level, and those few groups summed. Only open records meet the regular expressions of the rubric.
    """
    it = day_flags(contracts.filter(in_scope()), F.col("estado"), F.col("fecha_fin_cotizacion"), F.col("fecha_publica"), as_of)
    return kpis_of(it, F.coalesce("categoria_it", F.lit("(sin línea)")), rubric_of(), F.lit(1))


def kpis_of(it: DataFrame, line: Column, level: Column, n: Column) -> DataFrame:
    """The dashboard of flagged rows that stand for n records each."""
    d, post = F.col("hoy"), F.coalesce("es_postulable", F.lit(False))
    numbers = {
        "total_postulables": post, "cierran_hoy": post & F.col("cierra_hoy"), "cierran_manana": post & F.col("cierra_manana"), "cierran_semana": post & F.col("cierra_semana"), "nuevos_hoy_postulables": post & F.col("es_nuevo_hoy"),
        "vigentes_ventana_vencida": F.col("es_vigente_ventana_vencida"), "en_evaluacion": F.col("es_en_evaluacion"), "culminados_it": F.col("es_culminado"),
        "altas_it_7d": F.col("pub").between(F.date_sub(d, 6), d), "altas_it_7d_prev": F.col("pub").between(F.date_sub(d, 13), F.date_sub(d, 7)),
    }
    groups = it.groupBy(line.alias("linea"), F.when(post, level).alias("rubro")).agg(*(_count(c, name, n) for name, c in numbers.items()), _count(post, "n", n))
    return groups.agg(*(F.coalesce(F.sum(name), F.lit(0)).cast("int").alias(name) for name in numbers), *_lists())


def business_kpis(contracts: DataFrame, as_of: str | None = None) -> DataFrame:
    """Open records by rubric, lines and overlay, and the two lists; one scan, as kpis."""
    it = day_flags(contracts.filter(in_scope()), F.col("estado"), F.col("fecha_fin_cotizacion"), F.col("fecha_publica"), as_of)
    return business_kpis_of(it, F.coalesce("categoria_it", F.lit("(sin línea)")), rubric_of(), R.overlay(text_of()), F.lit(1))


def business_kpis_of(it: DataFrame, line: Column, level: Column, overlay: Column, n: Column) -> DataFrame:
    """The same of flagged rows that stand for n records each."""
    groups = it.filter("es_postulable").groupBy(line.alias("linea"), level.alias("rubro"), overlay.alias("overlay")).agg(F.sum(n).cast("int").alias("n"))
    of = lambda c, name: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0)).cast("int").alias(name)
    levels = [of(F.col("rubro") == x, f"{x}_postulables") for x in reversed(R.LEVELS)]
    lines = [of(F.col("linea") == c, name) for c, name in (("IA/analytics", "nucleo_ia"), ("Cloud/hosting", "nucleo_cloud"), ("Desarrollo software", "nucleo_dev"))]
    return groups.agg(*levels, of(F.col("rubro").isNull(), "sin_rubro_postulables"), *lines, of(F.col("overlay") == "telemetria", "nucleo_tel"), *_lists())


def month_rollup(df: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """Counts by keys (null keys too) and month."""
    return df.groupBy(*keys, F.to_date(F.date_trunc("month", F.col(ts))).alias("mes")).agg(F.count(F.lit(1)).alias("total"))


def ranking(contracts: DataFrame, as_of: str | None = None, open_only: bool = True, limit: int = 15) -> DataFrame:
    """Opportunities by score, best first, then the sooner end, then id."""
    it = day_flags(contracts.filter(in_scope() & F.col("estado").isin(OPEN, EVALUATED)), F.col("estado"), F.col("fecha_fin_cotizacion"), F.col("fecha_publica"), as_of)
    it = it.filter("es_postulable") if open_only else it
    level = rubric_of()
    score = R.opportunity_score(level, F.col("estado"), F.datediff("fin", "hoy"), R.signal_points(F.col("relevancia_ia"), F.col("objeto"), R.has_real_ai(text_of())))
    ranked = it.withColumns({"rubro": level, "score": score}).orderBy(F.desc("score"), F.col("fecha_fin_cotizacion").asc_nulls_last(), F.desc("id"))
    return ranked.limit(limit) if limit else ranked


def refresh(contracts: DataFrame, seen: DataFrame, verified_at: Column) -> DataFrame:
    """States as last seen (id, estado); every row seen is stamped, also if unchanged."""
    new = seen.select("id", "estado").withColumn("estado_verificado_at", verified_at)
    return partial_update(contracts, new, ["id"])


def terminal(state: Column, state_id: Column | None = None) -> Column:
    by_name = state.isin(*TERMINAL)
    return F.coalesce(by_name if state_id is None else (state_id == 4) | by_name, F.lit(False))


def expired(contracts: DataFrame, now: Column, days: int = RETENTION_DAYS) -> DataFrame:
    """Closed records last verified more than so many days ago."""
    return contracts.filter(terminal(F.col("estado")) & (F.col("estado_verificado_at") < now - F.make_interval(days=F.lit(days))))


def collect_garbage(chunks: DataFrame, contracts: DataFrame, now: Column, days: int = RETENTION_DAYS) -> DataFrame:
    return chunks.join(expired(contracts, now, days).select(F.col("id").alias("contrato_id")), "contrato_id", "left_anti")


def rotation(df: DataFrame, verified: str, cap: int, state: str = "estado") -> DataFrame:
    """All open records, and at most ``cap`` evaluated ones, the longest unverified (never first)."""
    rest = df.filter(F.col(state) == EVALUATED).orderBy(F.col(verified).asc_nulls_first(), "id").limit(cap)
    return df.filter(F.col(state) == OPEN).unionByName(rest)


def enrich(contracts: DataFrame, details: DataFrame) -> DataFrame:
    """Detail fields for the records whose detail came; a blank description does not replace one."""
    new = details.withColumn("detalle_cargado", F.lit(True))
    if "descripcion" in new.columns:
        old = contracts.select("id", F.col("descripcion").alias("__old"))
        new = new.join(old, "id", "left").withColumn("descripcion", F.coalesce(F.nullif(F.trim("descripcion"), F.lit("")), F.col("__old"))).drop("__old")
    return partial_update(contracts, new, ["id"])


def clean_items(items: Column) -> Column:
    """Source items as stored items; the district falls back to the outer one."""
    text = lambda c: F.nullif(F.trim(c), F.lit(""))
    return F.transform(items, lambda it: F.struct(text(it["codCubso"]).alias("cod_cubso"), text(it["nomCubso"]).alias("nom_cubso"), text(it["descripcionItem"]).alias("descripcion"), it["cantidad"].alias("cantidad"), text(it["nomUnidadMedida"]).alias("unidad"), F.coalesce(text(it["nomDistrito"]), text(it["nomDistritoExt"])).alias("distrito")))


def merge_funnel(analysed: DataFrame, quoted: DataFrame) -> DataFrame:
    """id, marks and first dates from two lists (id, fecha): one row an id; the first mark wins."""
    first = lambda df, mark, at: df.filter("id > 0 AND fecha IS NOT NULL").groupBy("id").agg(F.min("fecha").alias(at)).withColumn(mark, F.lit(True))
    both = first(analysed, "analizado", "fecha_analisis").join(first(quoted, "cotizado", "fecha_cotizacion"), "id", "full_outer")
    return both.select("id", *(F.coalesce(c, F.lit(False)).alias(c) for c in ("analizado", "cotizado")), "fecha_analisis", "fecha_cotizacion")


def apply_funnel(contracts: DataFrame, funnel: DataFrame) -> DataFrame:
    """Marks stay once set, with their original date."""
    both = contracts.alias("l").join(funnel.alias("r"), "id", "left")
    merged = {}
    for mark, at in (("analizado", "fecha_analisis"), ("cotizado", "fecha_cotizacion")):
        merged[mark] = F.coalesce(F.col(f"l.{mark}"), F.lit(False)) | F.coalesce(F.col(f"r.{mark}"), F.lit(False))
        merged[at] = F.coalesce(F.col(f"l.{at}"), F.col(f"r.{at}"))
    return both.select(*(merged[c].alias(c) if c in merged else F.col("id") if c == "id" else F.col(f"l.{c}") for c in contracts.columns))


def priority() -> Column:
    """ALTA, then a category, then MEDIA, BAJA, the rest."""
    ia = F.upper(F.trim(F.coalesce("relevancia_ia", F.lit(""))))
    return F.when(ia == "ALTA", 0).when(F.coalesce("categoria_it", F.lit("")) != "", 1).when(ia == "MEDIA", 2).when(ia == "BAJA", 3).otherwise(9)


def queue_reason(now: Column, only_it: bool = True, need_window: bool = True) -> Column:
    """Why a record is not due, in fixed precedence; ``ok`` if it is. A missing state counts as open."""
    end = F.col("fecha_fin_cotizacion")
    r = F.when(F.coalesce(F.nullif("estado", F.lit("")), F.lit(OPEN)) != OPEN, "no_vigente")
    r = r.when(end.isNull(), "ventana_null").when(end <= now, "vencidos") if need_window else r
    r = r.when(~in_scope(), "no_ti") if only_it else r
    return r.otherwise("ok")


def work_queue(df: DataFrame, now: Column, only_it: bool = True, need_window: bool = True) -> tuple[DataFrame, DataFrame]:
    """(due records in order, counts by reason with zeros)."""
    marked = df.withColumn("reason", queue_reason(now, only_it, need_window))
    due = marked.filter("reason = 'ok'").drop("reason").orderBy(priority(), F.desc("id"))
    counts = marked.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
    every = df.sparkSession.createDataFrame([(r,) for r in QUEUE_REASONS], "reason string")
    return due, every.join(counts, "reason", "left").select("reason", F.coalesce("n", F.lit(0)).alias("n"))


def still_due(df: DataFrame, now: Column, only_it: bool = True) -> DataFrame:
    """Each record's eligibility just now: due boolean, why string."""
    end = F.col("fecha_fin_cotizacion")
    why = F.when(F.coalesce("estado", F.lit("")) != OPEN, F.concat(F.lit("estado="), F.coalesce("estado", F.lit("None")))).when(end.isNull(), "ventana_null").when(end <= now, "vencido")
    why = (why.when(~in_scope(), "no_ti") if only_it else why).otherwise("ok")
    return df.withColumn("why", why).withColumn("due", F.col("why") == "ok")


def pages_due(pending: Column, done: Column) -> Column:
    """Pending pages that are not done, repeats and order kept."""
    return F.filter(F.coalesce(pending, F.array().cast("array<int>")), lambda p: ~F.array_contains(F.coalesce(done, F.array().cast("array<int>")), p))


def page_queue(df: DataFrame, sidecar: DataFrame, now: Column, limit: int = 0, **how) -> DataFrame:
    """Due records with the pages left: stored page lists, or else those of the sidecar (latest per id)."""
    s = sidecar.select("id", *(F.col(c).alias(f"__{c}") for c in ("paginas_ocr_pendientes", "paginas_ocr_hechas")))
    own = lambda c: F.when(F.size(F.coalesce(F.col(c), F.array().cast("array<int>"))) > 0, F.col(c)).otherwise(F.col(f"__{c}"))
    rows = df.join(s, "id", "left").withColumn("pages", pages_due(own("paginas_ocr_pendientes"), own("paginas_ocr_hechas"))).filter(F.size("pages") > 0)
    due = work_queue(rows.drop("__paginas_ocr_pendientes", "__paginas_ocr_hechas"), now, **how)[0]
    return due.limit(limit) if limit else due


def download_queue(df: DataFrame, mode: str | None = None, limit: int = 0) -> DataFrame:
    """Open records not downloaded yet (false or null), newest first; mode ``ocr``: those waiting for it."""
    due = df.filter((F.col("estado") == OPEN) & ~F.coalesce("pdf_descargado", F.lit(False))).orderBy(F.col("fecha_publica").desc_nulls_last(), F.desc("id"))
    due = due.filter(F.col("req_url") == "pendiente_ocr") if mode == "ocr" else due
    return due.limit(limit) if limit else due


def choose_pdf(files: Column) -> Column:
    """Of attachments, the first PDF of type 1, or else the first PDF; null if there is none."""
    pdf = lambda f: F.lower(F.coalesce(f["descripcionMime"], F.lit(""))) == "application/pdf"
    return F.coalesce(F.try_element_at(F.filter(files, lambda f: pdf(f) & (f["idTipoArchivo"] == 1)), F.lit(1)), F.try_element_at(F.filter(files, pdf), F.lit(1)))


def planned(df: DataFrame, cost: str, budget: float, group: Sequence[str], *order: Column) -> DataFrame:
    """Work whose running cost (with its own) stays within the budget of its group, e.g. a day's quota."""
    w = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn("running", F.sum(cost).over(w)).withColumn("planned", F.col("running") <= budget)


def extracted_pages(pages: DataFrame, least_chars: int = 80, most_scans: int | None = None) -> DataFrame:
    """Per document from its pages (id, pagina, texto): the text with page marks, page lists and type.

    A page with fewer than ``least_chars`` letters is an image; all of them are due, or the first ``most_scans`` (40 in the original).
    """
    from telar.functions.text import clean_text, fewer_useful, page_kind, page_mark

    p = pages.withColumn("scan", fewer_useful(F.col("texto"), least_chars))
    mark = F.concat(page_mark(F.col("pagina")), F.lit("\n"), clean_text(F.coalesce("texto", F.lit(""))))
    doc = p.groupBy("id").agg(
        F.count(F.lit(1)).cast("int").alias("tdr_n_paginas"), F.count_if("scan").cast("int").alias("tdr_n_paginas_ocr"), F.array_sort(F.collect_list(F.when(F.col("scan"), F.col("pagina")))).alias("scans"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.when(~F.col("scan"), F.struct("pagina", mark.alias("t"))))), lambda s: s["t"]), "\n\n").alias("tdr_texto"),
    )
    return doc.select("id", "tdr_texto", "tdr_n_paginas", (F.col("tdr_n_paginas") - F.col("tdr_n_paginas_ocr")).alias("tdr_n_paginas_nativas"), "tdr_n_paginas_ocr", (F.col("scans") if most_scans is None else F.slice("scans", 1, most_scans)).alias("paginas_ocr_pendientes"), page_kind(F.col("tdr_n_paginas"), F.col("tdr_n_paginas_ocr")).alias("tdr_tipo_extraccion"))


def funnel_lists(payload: DataFrame, column: str = "payload") -> tuple[DataFrame, DataFrame]:
    """The two lists (id, fecha) of a funnel payload in JSON; entries without a positive id and a date are left out."""
    from telar.functions.time import parse_iso, positive_id

    item = "array<struct<id: string, fecha: string>>"
    p = payload.select(F.from_json(column, f"struct<analizados: {item}, cotizados: {item}>").alias("p"))

    def of(name: str) -> DataFrame:
        rows = p.select(F.explode(f"p.{name}").alias("x")).select(positive_id(F.col("x.id")).alias("id"), parse_iso(F.col("x.fecha")).alias("fecha"))
        return rows.filter("id IS NOT NULL AND fecha IS NOT NULL")

    return of("analizados"), of("cotizados")


def record_downloads(contracts: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Contracts after a run. outcomes: id, outcome (ok, sin_pdf, pendiente) and, for ok, the extraction's columns with url, pdf_hash, pdf_nombre, pdf_archivo_id.

    ok: stored, processed unless every page is an image. sin_pdf: done, nothing
    to keep. pendiente: waits for another run.
    """
    ok, none = F.col("outcome") == "ok", F.col("outcome") == "sin_pdf"
    kind = F.col("tdr_tipo_extraccion")
    of = lambda c: F.when(ok, F.col(c))
    empty = F.array().cast("array<int>")
    new = outcomes.select(
        "id", F.when(ok, F.nullif("tdr_texto", F.lit(""))).alias("tdr_texto"), F.when(~none, F.col("pdf_hash")).alias("pdf_hash"), F.when(ok, kind != "nativo_puro").when(none, F.lit(None)).otherwise(True).alias("pdf_es_imagen"),
        (ok | none).alias("pdf_descargado"), (none | ok & (kind != "imagen_total")).alias("pdf_procesado"), F.when(ok, F.substring(F.coalesce("url", F.lit("")), 1, 2000)).when(none, "sin_pdf").otherwise("pendiente_ocr").alias("req_url"), of("tdr_tipo_extraccion").alias("tdr_tipo_extraccion"),
        F.coalesce(of("paginas_ocr_pendientes"), empty).alias("paginas_ocr_pendientes"), F.coalesce(of("paginas_ocr_hechas"), empty).alias("paginas_ocr_hechas"), *(of(c).alias(c) for c in ("tdr_n_paginas", "tdr_n_paginas_nativas", "tdr_n_paginas_ocr")),
        F.when(~none, F.col("pdf_archivo_id")).alias("pdf_archivo_id"), F.when(~none, F.nullif(F.substring("pdf_nombre", 1, 500), F.lit(""))).alias("pdf_nombre"),
    )
    return partial_update(contracts, new, ["id"])


EXTRACTION = ("tdr_tipo_extraccion", "paginas_ocr_pendientes", "paginas_ocr_hechas", "tdr_n_paginas", "tdr_n_paginas_nativas", "tdr_n_paginas_ocr", "pdf_es_imagen")


def sync_sidecar(contracts: DataFrame, sidecar: DataFrame, least_chars: int = 80) -> DataFrame:
    """Extraction fields from the sidecar (latest per id); open image records without one whose text is native become so."""
    from telar.functions.text import useful_chars
    from .merge import guarded_update

    synced = partial_update(contracts, sidecar.select("id", *EXTRACTION), ["id"])
    text = F.coalesce("tdr_texto", F.lit(""))
    marked = synced.join(sidecar.select("id").distinct().withColumn("__side", F.lit(True)), "id", "left")
    orphan = F.col("__side").isNull() & (F.col("estado") == OPEN) & F.col("pdf_es_imagen") & F.col("tdr_tipo_extraccion").isNull() & (F.coalesce("req_url", F.lit("")) != "sin_pdf") & ~text.contains("(ocr)") & (useful_chars(text) >= least_chars)
    empty = F.array().cast("array<int>")
    fixed = guarded_update(marked, orphan, {"tdr_tipo_extraccion": F.lit("nativo_puro"), "pdf_es_imagen": F.lit(False), "paginas_ocr_pendientes": empty, "paginas_ocr_hechas": empty, "tdr_n_paginas_ocr": F.lit(0)})
    return fixed.select(*contracts.columns)

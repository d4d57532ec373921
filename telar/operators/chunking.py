"""Contextual chunking with array functions; no Python on the executors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telar.functions import text as T

SPLIT_OVER = 800
TARGET = 500


def split_paragraphs(c: Column, target: int = TARGET) -> Column:
    """Lines packed greedily until the next would go over the target; a longer line stays whole; no overlap."""
    lines = F.filter(F.transform(F.split(F.replace(F.coalesce(c, F.lit("")), F.lit("\r\n"), F.lit("\n")), "\n"), T.strip), lambda x: x != "")
    if target < 2:
        return lines  # each has a token at least, so no two go together
    lines = F.transform(lines, lambda x: F.struct(x.alias("t"), T.approx_tokens(x).alias("n")))  # counted once a line
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("buf"), F.lit(0).alias("n"))

    def step(acc: Column, x: Column) -> Column:
        line, n = x["t"], x["n"]
        full = (acc["buf"] != "") & (acc["n"] + n > target)
        return F.struct(
            F.when(full, F.concat(acc["done"], F.array(acc["buf"]))).otherwise(acc["done"]).alias("done"),
            F.when(full | (acc["buf"] == ""), line).otherwise(F.concat(acc["buf"], F.lit("\n"), line)).alias("buf"),
            F.when(full, n).otherwise(acc["n"] + n).alias("n"),
        )

    return F.aggregate(lines, start, step, lambda acc: F.when(acc["buf"] == "", acc["done"]).otherwise(F.concat(acc["done"], F.array(acc["buf"]))))


def parts(c: Column, split_over: int = SPLIT_OVER, target: int = TARGET) -> Column:
    """The text whole, or in chunks if it has more than ``split_over`` tokens; nothing if blank."""
    t = T.strip(F.coalesce(c, F.lit("")))
    return F.when(t == "", F.array().cast("array<string>")).when(T.approx_tokens(t) > split_over, split_paragraphs(t, target)).otherwise(F.array(t))


def _label(name: str, i: Column, n: Column) -> Column:
    return F.when(n == 1, F.lit(name)).otherwise(F.concat(F.lit(f"{name} ("), i.cast("string"), F.lit("/"), n.cast("string"), F.lit(")")))


def _text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def _quantity(c: Column) -> Column:
    """Without a needless fraction; zero and null are empty."""
    whole = F.when(c == F.floor(c), F.floor(c).cast("string")).otherwise(c.cast("string"))
    return F.when(F.coalesce(c, F.lit(0.0)) == 0, "").otherwise(whole)


def _item(it: Column) -> Column:
    return T.strip(
        F.concat(
            F.lit("CUBSO: "), _text(it["cod_cubso"]), F.lit(" - "), _text(it["nom_cubso"]), F.lit(". Cantidad: "), _quantity(it["cantidad"]), F.lit(" "), _text(it["unidad"]), F.lit(". Lugar: "), _text(it["distrito"]), F.lit(". Especificaciones: "), _text(it["descripcion"]),
        )
    )


def _number() -> Column:
    return T.contract_number(F.col("descripcion_contrato"), F.col("nro_contratacion"), F.col("id"))


def contract_chunks(contracts: DataFrame) -> DataFrame:
    """Description parts, one chunk an item, one of metadata; chunk_index runs on from 0."""
    header = T.long_header(F.col("entidad"), T.subject(F.col("descripcion"), F.col("objeto")), _number())
    rows = contracts.withColumns({"__h": header, "__parts": parts(F.col("descripcion"))}).withColumn("__n", F.size("__parts"))  # each once a row
    own = F.transform("__parts", lambda p, i: F.struct(_label("Descripción general", i + 1, F.col("__n")).alias("tipo"), p.alias("t")))
    items = F.transform(F.coalesce("items_json", F.array().cast(contracts.schema["items_json"].dataType)), lambda it, i: F.struct(F.concat(F.lit("Ítem técnico "), (i + 1).cast("string")).alias("tipo"), _item(it).alias("t")))
    fields = (("Entidad", "entidad"), ("Área usuaria", "nom_area_usuaria"), ("Objeto", "objeto"), ("Estado", "estado"), ("Número", "nro_contratacion"))
    meta = F.concat_ws(" ", *(F.concat(F.lit(f"{k}: "), _text(F.col(c)), F.lit(".")) for k, c in fields))
    every = F.concat(own, items, F.array(F.struct(F.lit("Metadata").alias("tipo"), meta.alias("t"))))
    rows = rows.select("id", F.col("__h").alias("h"), F.posexplode(every).alias("chunk_index", "c"))
    return rows.select(F.col("id").alias("contrato_id"), "chunk_index", F.col("c.tipo").alias("tipo"), F.concat("h", F.lit("\n"), F.col("c.t")).alias("texto"), F.lit("api").alias("fuente"))


def document_chunks(contracts: DataFrame, existing: DataFrame | None = None, split_over: int = SPLIT_OVER, target: int = TARGET, start: Column | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Chunks of the extracted text, numbered on from the contract's highest existing chunk, or from ``start`` of the contract. ``keep``: columns of the contract that its chunks have too.

    What is the same for all chunks of a contract is made once, before they are rows; a chunk's row never holds the whole text.
    """
    base = contracts.withColumn("__from", F.lit(0) if start is None else start)
    if existing is not None:
        base = contracts.join(existing.groupBy(F.col("contrato_id").alias("id")).agg((F.max("chunk_index") + 1).cast("int").alias("__from")), "id", "left").withColumn("__from", F.coalesce("__from", F.lit(0)))
    number = _number()
    heads = {"nro": number, "short": T.short_header(F.col("entidad"), number), "long": T.long_header(F.col("entidad"), T.subject(F.col("descripcion"), F.col("objeto")), number), "own": F.nullif(T.strip(F.col("entidad")), F.lit(""))}
    heads["plain"] = F.instr(heads["short"], "]") == F.length(heads["short"])  # the first bracket ends it, so that body() takes it off, with the white space behind
    rows = base.select("id", "__from", *keep, *(c.alias(f"__{k}") for k, c in heads.items()), parts(F.col("tdr_texto"), split_over, target).alias("ts")).withColumn("n", F.size("ts"))
    # outer, then without nulls: the inner one filters by the array's size first, which would make the array twice
    rows = rows.select("id", "__from", *keep, *(f"__{k}" for k in heads), "n", F.posexplode_outer("ts").alias("i", "part")).filter("i IS NOT NULL")
    shown = F.concat("__short", F.lit("\n"), "part")
    body = F.when(F.col("__plain"), F.ltrim("part", F.lit(" \t\n\x0b\f\r"))).otherwise(T.body(shown))
    return rows.select(
        F.col("id").alias("contrato_id"), (F.col("__from") + F.col("i")).alias("chunk_index"), _label("TDR PDF", F.col("i") + 1, F.col("n")).alias("tipo"), shown.alias("texto"), F.lit("pdf").alias("fuente"),
        _below(F.col("__long"), body).alias("chunk_embed_text"), F.col("__own").alias("meta_entidad"), F.nullif("__nro", F.lit("")).alias("meta_nro"), *keep,
    )


def embed_text(entity: Column, description: Column, kind: Column, number: Column, shown: Column) -> Column:
    """A semantic header and the body without its letterhead."""
    return _below(T.long_header(entity, T.subject(description, kind), number), T.body(shown))


def _below(header: Column, body: Column) -> Column:
    return F.concat(header, F.lit("\n"), T.without_letterhead(body))


def text_to_embed(source: Column, shown: Column, stored: Column, mode: str = "auto", longest: int | None = None) -> Column:
    """pdf: the stored text, or else the body; api: the text with its header. ``mode``: auto, header or body."""
    own = T.first_nonblank(stored, T.body(shown))
    c = {"header": shown, "body": T.body(shown)}.get(mode)
    text = F.when(source == "pdf", own).otherwise(shown) if c is None else c
    return text if longest is None else F.substring(text, 1, longest)


def pending(contracts: DataFrame, chunks: DataFrame, source: str | None = None) -> DataFrame:
    """Contracts without chunks (of a source)."""
    have = chunks if source is None else chunks.filter(F.col("fuente") == source)
    return contracts.join(have.select(F.col("contrato_id").alias("id")), "id", "left_anti")


def rechunk(chunks: DataFrame, fresh: DataFrame, source: str) -> DataFrame:
    """Chunks with those of a source replaced for the contracts in ``fresh``; other sources stay."""
    doomed = fresh.select("contrato_id").distinct().withColumn("fuente", F.lit(source))
    return chunks.join(doomed, ["contrato_id", "fuente"], "left_anti").unionByName(fresh, allowMissingColumns=True)


def chunk_statistics(chunks: DataFrame) -> DataFrame:
    """By type without its numbering: chunks, contracts, mean tokens."""
    kind = F.regexp_replace("tipo", r"\s*(\(\d+/\d+\)|\d+)$", "")
    return chunks.groupBy(kind.alias("tipo")).agg(F.count(F.lit(1)).alias("n_chunks"), F.countDistinct("contrato_id").alias("n_contracts"), F.avg(T.approx_tokens(F.col("texto"))).alias("mean_tokens"))


def backfill(chunks: DataFrame, contracts: DataFrame) -> DataFrame:
    """pdf chunks with a page mark get their text to embed, and their vector is due again."""
    due = chunks.filter((F.col("fuente") == "pdf") & F.col("texto").ilike("%--- pagina %")).join(contracts.select(F.col("id").alias("contrato_id"), "entidad", "descripcion", "objeto", _number().alias("nro")), "contrato_id")
    new = due.select("contrato_id", "chunk_index", embed_text(F.col("entidad"), F.col("descripcion"), F.col("objeto"), F.col("nro"), F.col("texto")).alias("chunk_embed_text"), F.lit(None).cast("array<float>").alias("embedding_v2"))
    from .merge import partial_update

    return partial_update(chunks, new, ["contrato_id", "chunk_index"])

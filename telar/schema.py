"""The relations of the data model as explicit schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from telar.operators.constraints import Constraints

ITEM = "struct<cod_cubso: string, nom_cubso: string, descripcion: string, cantidad: double, unidad: string, distrito: string>"

CONTRACTS = (
    "id long, nro_contratacion string, descripcion_contrato string, objeto string, descripcion string, entidad string, estado string, "
    "fecha_publica timestamp, fecha_ini_cotizacion timestamp, fecha_fin_cotizacion timestamp, tipo_cotizacion string, cotizar boolean, "
    f"categoria_it string, relevancia_ia string, created_at timestamp, nom_area_usuaria string, items_json array<{ITEM}>, detalle_cargado boolean, "
    "req_url string, pdf_descargado boolean, pdf_procesado boolean, pdf_es_imagen boolean, tdr_texto string, pdf_hash string, pdf_archivo_id long, "
    "pdf_nombre string, estado_verificado_at timestamp, tdr_tipo_extraccion string, paginas_ocr_pendientes array<int>, paginas_ocr_hechas array<int>, "
    "tdr_n_paginas int, tdr_n_paginas_nativas int, tdr_n_paginas_ocr int, analizado boolean, cotizado boolean, fecha_analisis timestamp, fecha_cotizacion timestamp"
)
CHUNKS = "id long, contrato_id long, chunk_index short, tipo string, texto string, embedding array<float>, embedding_v2 array<float>, fuente string, meta_entidad string, meta_nro string, chunk_embed_text string, created_at timestamp"
REJECTS = "id long, id_contrato long, origen string, motivo string, payload string, resuelto boolean, created_at timestamp"
RELATIONS = {"contratos": CONTRACTS, "chunks_tdr": CHUNKS, "ingesta_rechazados": REJECTS}

#: Keys by which rows are unique, and the parent of rows that go with it.
KEYS = {"contratos": ["id"], "chunks_tdr": ["contrato_id", "chunk_index"], "ingesta_rechazados": ["id"]}
PARENT = {"chunks_tdr": ("contrato_id", "contratos", "id")}

#: The kinds of extraction that a record may have.
EXTRACTIONS = ("nativo_puro", "mixto", "imagen_total")


def constraints_of(relation: str) -> Constraints:
    """What the relation asks of its rows beyond their types."""
    keys, parent = KEYS[relation], PARENT.get(relation)
    kind = {"tdr_tipo_extraccion": F.col("tdr_tipo_extraccion").isin(*EXTRACTIONS)} if relation == "contratos" else {}
    refers = {f"{parent[0]} of {parent[1]}": ([parent[0]], parent[1], [parent[2]])} if parent else {}
    return Constraints(required=keys, checks=kind, unique={", ".join(keys): keys}, references=refers)


def schema_of(relation: str) -> StructType:
    return StructType.fromDDL(RELATIONS[relation])


def conform(df: DataFrame, relation: str) -> DataFrame:
    """The relation's columns in order and type: missing ones null, others dropped, uncastable values null."""
    have = set(df.columns)
    out = []
    for f in schema_of(relation):
        if f.name not in have:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif isinstance(df.schema[f.name].dataType, type(f.dataType)):
            out.append(F.col(f.name).cast(f.dataType).alias(f.name))
        else:
            out.append(F.col(f.name).try_cast(f.dataType).alias(f.name))
    return df.select(*out)


def missing_columns(df: DataFrame, relation: str) -> list[str]:
    """Which of the relation's columns a frame lacks (writers then leave them out)."""
    return [f.name for f in schema_of(relation) if f.name not in df.columns]


def describe(spark: SparkSession, *tables: str) -> DataFrame:
    """Catalog introspection: a row per column of the tables, and one with a null column for a table that is missing."""
    rows = []
    for t in tables:
        rows += [(t, c.name, c.dataType, c.nullable) for c in spark.catalog.listColumns(t)] if spark.catalog.tableExists(t) else [(t, None, None, None)]
    return spark.createDataFrame(rows, "table string, column string, type string, nullable boolean")

"""Validation, dead letters and audits."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from telar.functions.text import strip
from telar.functions.time import parse_source_date, positive_id

# Fields of a source record, and keys that must not be stored.
TEXT_FIELDS = ("desContratacion", "nomObjetoContrato", "desObjetoContrato", "nomEntidad", "nomEstadoContrato", "fecPublica", "fecIniCotizacion", "fecFinCotizacion")
SCALAR_FIELDS = ("nroContratacion", "idTipoCotizacion")
SESSION_KEYS = (
    "cookie", "cookies", "authorization", "token", "access_token", "refresh_token", "set-cookie", "headers", "header", "csrf",
    "x-csrf-token", "api_key", "apikey", "session", "playwright", "request", "response",
)


def _kind(v: Column) -> Column:
    return F.schema_of_variant(v)


FLAG = "cotizar"
_PARSED = ", ".join(f"{f} variant" for f in ("idContrato", *TEXT_FIELDS, *SCALAR_FIELDS, FLAG)) + ", _corrupt string"


def _field(name: str, kind: str = "string") -> Column:
    return F.try_variant_get(F.col("v")[name], "$", kind)


def _is_structure(name: str) -> Column:
    return F.coalesce(_kind(F.col("v")[name]).rlike("^(OBJECT|ARRAY)"), F.lit(False))


def validated(raw: DataFrame, column: str = "payload") -> DataFrame:
    """The rows with ``v`` (the record's fields as variants) and ``errors`` (array, empty if the record is valid).

    A record is a JSON object with a positive integer idContrato; text fields
    are no structures; other keys are allowed. The text is parsed once, behind
    a generator of one row: a projected parse would be repeated in each expression
    that reads it.
    """
    rows = raw.withColumn("v", F.explode(F.array(F.from_json(column, _PARSED, {"columnNameOfCorruptRecord": "_corrupt"}))))
    no_object = F.col("v").isNull() | F.col("v")["_corrupt"].isNotNull() | ~F.coalesce(F.col(column).rlike(r"^\s*\{"), F.lit(False))
    errors = [F.when(positive_id(_field("idContrato")).isNull(), F.lit("idContrato: a positive integer is required"))]
    errors += [F.when(_is_structure(f), F.lit(f"{f}: text expected, found a structure")) for f in (*TEXT_FIELDS, *SCALAR_FIELDS)]
    return rows.withColumn("errors", F.when(no_object, F.array(F.lit("record is no JSON object"))).otherwise(F.array_compact(F.array(*errors))))


def split_valid(raw: DataFrame, column: str = "payload", origin: str = "ingesta") -> tuple[DataFrame, DataFrame]:
    """(valid records by name, dead letters). Reads the input twice; ``write_split`` reads it once."""
    rows = validated(raw, column)
    return records(rows.filter(F.size("errors") == 0)), dead_letters(rows.filter(F.size("errors") > 0), column, origin)


def write_split(raw: DataFrame, path: str, mapping: Callable[[DataFrame], DataFrame] | None = None, checks: dict[str, Column] | None = None, column: str = "payload", origin: str = "ingesta") -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """(mapped records, dead letters, counts), from one scan, one parse and one write.

    mapping: the stored columns from the columns of ``records`` (``to_contracts``
    unless given); it must keep the rows as they are. checks: by name, what must hold
    of the mapped columns; a record of which it does not is a dead letter too, with the names. The rows
    are written once, partitioned by outcome, and both results read their own
    part; the counts (n, valid, rejected, unmapped) are observed while that is written.
    """
    rows = validated(raw, column).withColumn("errors", F.explode(F.array("errors")))
    fields = records(rows, column, "errors").withColumn("__own", F.struct(column, "errors", F.col("idContrato").alias("id_contrato")))
    kept = F.col("__own")
    mapped = (mapping or to_contracts)(fields)
    if "__own" not in mapped.columns:
        raise ValueError("the mapping dropped __own: it has to select its columns beside those it does not know")
    stored = [c for c in mapped.columns if c != "__own"]
    failed = F.array_compact(F.array(*(F.when(~F.coalesce(c, F.lit(False)), F.lit(f"mapping: {n}")) for n, c in (checks or {}).items()))) if checks else F.array().cast("array<string>")
    valid = F.size(kept["errors"]) == 0
    letter = letter_of(kept[column], kept["id_contrato"], F.when(valid, failed).otherwise(kept["errors"]), origin)
    good = valid & (F.size(failed) == 0)
    out = mapped.select(
        F.when(good, "valid").otherwise("rejected").alias("outcome"), F.when(good, F.struct(*stored)).alias("record"), F.when(~good, letter).alias("letter"), (valid & ~good).alias("unmapped")
    )
    seen = Observation()
    out.observe(seen, F.count(F.lit(1)).alias("n"), F.count("record").alias("valid"), F.count("letter").alias("rejected"), F.count_if("unmapped").alias("unmapped")).drop("unmapped").write.partitionBy("outcome").parquet(path)
    back = raw.sparkSession.read.schema(out.drop("unmapped").schema).parquet(path)
    return back.filter("outcome = 'valid'").select("record.*"), back.filter("outcome = 'rejected'").select("letter.*"), dict(seen.get)


def records(valid: DataFrame, *more: str) -> DataFrame:
    """The declared fields, trimmed, blank as null."""
    text = [F.nullif(strip(_field(f)), F.lit("")).alias(f) for f in (*TEXT_FIELDS, *SCALAR_FIELDS)]
    return valid.select(positive_id(_field("idContrato")).alias("idContrato"), *text, F.coalesce(_field(FLAG, "boolean"), F.lit(False)).alias(FLAG), *more)


def to_contracts(valid: DataFrame, category: Column | None = None, relevance: Column | None = None, source_zone: str = "UTC") -> DataFrame:
    """Records mapped to the stored columns."""
    when = lambda c: parse_source_date(F.col(c), source_zone)
    none = F.lit(None).cast("string")
    own = ["__own"] if "__own" in valid.columns else []  # of write_split
    return valid.select(
        F.col("idContrato").alias("id"), F.coalesce("nroContratacion", F.lit("")).alias("nro_contratacion"), F.col("desContratacion").alias("descripcion_contrato"), F.col("nomObjetoContrato").alias("objeto"),
        F.col("desObjetoContrato").alias("descripcion"), F.col("nomEntidad").alias("entidad"), F.col("nomEstadoContrato").alias("estado"), when("fecPublica").alias("fecha_publica"),
        when("fecIniCotizacion").alias("fecha_ini_cotizacion"), when("fecFinCotizacion").alias("fecha_fin_cotizacion"), F.coalesce("idTipoCotizacion", F.lit("")).alias("tipo_cotizacion"), "cotizar",
        (none if category is None else category).alias("categoria_it"), (none if relevance is None else relevance).alias("relevancia_ia"), *own,
    )


def scrubbed(payload: Column, keys: Sequence[str] = SESSION_KEYS) -> Column:
    """A JSON object without session data: keys of the list, and those that name cookies, tokens or headers."""
    k = lambda key: F.lower(key)
    m = F.from_json(payload, "map<string,string>")
    kept = F.map_filter(m, lambda key, _: ~(k(key).isin(*keys) | k(key).contains("cookie") | k(key).contains("token") | k(key).startswith("authorization") | k(key).startswith("x-")))
    return F.to_json(kept)


def letter_of(payload: Column, key: Column, errors: Column, origin: str = "ingesta", longest: int | None = None) -> Column:
    """What is stored of a rejected record. The original keeps 2,000 characters of an unreadable payload and of the reasons: ask for that with ``longest``."""
    cut = lambda c: c if longest is None else F.substring(c, 1, longest)
    data = F.coalesce(scrubbed(payload), F.to_json(F.struct(cut(payload).alias("_raw"))))
    return F.struct(key.alias("id_contrato"), F.lit(origin).alias("origen"), cut(F.array_join(errors, "; ")).alias("motivo"), data.alias("payload"), F.lit(False).alias("resuelto"), F.current_timestamp().alias("created_at"))


def dead_letters(invalid: DataFrame, column: str = "payload", origin: str = "ingesta", longest: int | None = None) -> DataFrame:
    letter = letter_of(F.col(column), positive_id(_field("idContrato")), F.col("errors"), origin, longest)
    return invalid.select(F.explode(F.array(letter)).alias("letter")).select("letter.*")


def rejected_by(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """The rows with ``errors``: names of the checks that do not hold (a null check does not hold)."""
    return df.withColumn("errors", F.array_compact(F.array(*(F.when(~F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in checks.items()))))


def coverage_alerts(counts: DataFrame, total: str, parts: Sequence[str], least: float = 0.9) -> DataFrame:
    """``alerts``: the parts whose share of the total is below the least."""
    share = lambda p: F.coalesce(F.try_divide(F.col(p), F.col(total)), F.lit(1.0))
    return counts.withColumn("alerts", F.array_compact(F.array(*(F.when(share(p) < least, F.lit(p)) for p in parts))))


def run_anomaly(status: Column, total: Column, rows: Column, full_run: Column) -> Column:
    """A source that fails, is empty, or gives nothing on a full run."""
    return F.coalesce((status != 200) | (total == 0) | (full_run & (rows == 0)), F.lit(True))


def alert(conclusion: Column, anomaly: Column, open_alert: Column) -> Column:
    """``none``, ``comment`` (one is open already) or ``open``; a cancelled run alerts nobody."""
    bad = (conclusion == "failure") | F.coalesce(anomaly, F.lit(False))
    return F.when((conclusion == "cancelled") | ~bad, "none").when(open_alert, "comment").otherwise("open")

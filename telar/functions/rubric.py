"""The rubric of a record's line of business, text overlays and the opportunity score."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import fold

# Levels from low to high, the level of each category, and the words that count as real AI.
LEVELS = ("marginal", "oportunista", "adyacente", "nucleo")
LEVEL_OF = {
    "IA/analytics": "nucleo", "Cloud/hosting": "nucleo", "Desarrollo software": "nucleo", "Base de datos/ERP": "adyacente", "Oracle": "adyacente", "Soporte tecnico": "oportunista",
    "Redes/cableado": "oportunista", "Licencias": "oportunista", "Ciberseguridad": "oportunista", "Microsoft": "oportunista", "Correo electronico": "oportunista", "Firma digital": "oportunista", "Hardware": "marginal",
}
REAL_AI = (
    "gpt", "llm", "copilot", "machine learning", "aprendizaje automatico", "inteligencia artificial", "ia generativa", "deep learning", "red neuronal", "modelo de lenguaje",
    "azure openai", "openai", "claude", "gemini", "chatbot", "asistente virtual", "ciencia de datos", "big data", "tokens de procesamiento", "tokens de ia",
)
TELEMETRY = ("telemetria", "scada", "internet de las cosas", "tecnologia operacional", "tecnologias operacionales")
TELEMETRY_WORDS = ("ot", "iot")
INTEGRATION = ("digital twin", "gemelo digital", "integracion", "automatizacion")
LEVEL_POINTS = {"nucleo": 50, "adyacente": 38, "oportunista": 24, "marginal": 12}
STATE_POINTS = {"Vigente": 25, "En Evaluación": 12}


def _any(text: Column, terms: tuple[str, ...]) -> Column:
    """Whether one of the terms occurs; plain searches are faster than an alternation."""
    return reduce(lambda a, b: a | b, (text.contains(t) for t in terms))


def _telemetry(t: Column) -> Column:
    words = "|".join(TELEMETRY_WORDS)
    return _any(t, TELEMETRY) | t.rlike(f"(^|[^a-z0-9])({words})([^a-z0-9]|$)")


def has_real_ai(text: Column) -> Column:
    return _any(fold(text), REAL_AI)


def overlay(text: Column) -> Column:
    """``telemetria``, else ``integracion``, else null."""
    t = fold(text)
    return F.when(_telemetry(t), "telemetria").when(_any(t, INTEGRATION), "integracion")


def rank(level: Column) -> Column:
    return F.coalesce(F.array_position(F.array(*map(F.lit, LEVELS)), level), F.lit(0))


def higher(a: Column, b: Column) -> Column:
    """The higher level; null counts for nothing, and a stays if equal."""
    return F.when(a.isNull(), b).when(b.isNull(), a).when(rank(a) >= rank(b), a).otherwise(b)


def level_of(category: Column, levels: dict[str, str] = LEVEL_OF) -> Column:
    return F.try_element_at(F.create_map(*(F.lit(x) for kv in levels.items() for x in kv)), category)


def rubric(category: Column, relevance: Column, description: Column, title: Column) -> Column:
    """The category's level, raised by overlays and by real AI of high relevance; never lowered."""
    t = fold(F.concat_ws(" ", F.coalesce(description, F.lit("")), F.coalesce(title, F.lit(""))))
    place = {level: i + 1 for i, level in enumerate(LEVELS)}
    own = F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for c, level in LEVEL_OF.items() for x in (c, place[level]))), category), F.lit(0))
    raised = F.when(_telemetry(t), place["nucleo"]).when(_any(t, INTEGRATION), place["adyacente"]).otherwise(0)
    core = F.when((F.upper(F.coalesce(relevance, F.lit(""))) == "ALTA") & (F.coalesce(category, F.lit("")) != "Firma digital") & _any(t, REAL_AI), place["nucleo"]).otherwise(0)
    return F.try_element_at(F.array(*map(F.lit, LEVELS)), F.nullif(F.greatest(own, raised, core), F.lit(0)))


def urgency_points(days: Column) -> Column:
    """By days to the end of the window; null is no end date."""
    return F.when(days.isNull(), 3).when(days < 0, 0).when(days == 0, 10).when(days == 1, 12).when(days <= 7, 15).when(days <= 30, 8).otherwise(5)


def signal_points(relevance: Column, kind: Column, real_ai: Column) -> Column:
    ia = F.upper(F.coalesce(relevance, F.lit("")))
    points = F.when((ia == "ALTA") & real_ai, 6).when(ia == "MEDIA", 3).when(ia == "BAJA", 1).otherwise(0) + F.when(fold(kind) == "servicio", 2).otherwise(0)
    return F.least(F.lit(10), points)


def _points(c: Column, table: dict[str, int]) -> Column:
    return F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for kv in table.items() for x in kv)), c), F.lit(0))


def opportunity_score(level: Column, state: Column, days: Column, signals: Column) -> Column:
    """0 to 100: level 50, state 25, urgency 15 (open records only), signals 10."""
    urgent = F.when(state == "Vigente", urgency_points(days)).otherwise(0)
    return F.least(F.lit(100), _points(level, LEVEL_POINTS) + _points(state, STATE_POINTS) + urgent + signals)


def register(spark) -> None:
    """The scalar functions for SQL text, as temporary functions of the session."""
    quoted = lambda terms: "|".join(terms)
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION fold_text(t STRING) RETURNS STRING RETURN lower(translate(coalesce(t, ''), '{'áéíóúüñÁÉÍÓÚÜÑàèìòùÀÈÌÒÙ'}', 'aeiouunAEIOUUNaeiouAEIOU'))")
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION local_date(ts TIMESTAMP) RETURNS DATE RETURN to_date(from_utc_timestamp(ts, 'America/Lima'))")
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION has_real_ai(t STRING) RETURNS BOOLEAN RETURN fold_text(t) RLIKE '{quoted(REAL_AI)}'")
    cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in LEVEL_OF.items())
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION level_of(c STRING) RETURNS STRING RETURN CASE c {cases} END")

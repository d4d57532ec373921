"""Keyword classification: dictionaries are arguments; these are the defaults."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from telar.functions.text import contains_term, unaccented

# Categories in the order of their priority, with their keywords.
CATEGORIES = {
    "Firma digital": ("firma digital", "certificado digital", "certificado electronico", "token criptografico"),
    "IA/analytics": (
        "inteligencia artificial", "machine learning", "ia generativa", "chatbot", "asistente virtual", "llm", "gpt", "copilot", "gemini", "claude", "openai", "azure openai", "analytics",
        "business intelligence", "ciencia de datos", "big data", "procesamiento de lenguaje", "red neuronal", "deep learning", "tokens de procesamiento",
    ),
    "Ciberseguridad": ("ciberseguridad", "seguridad informatica", "seguridad de la informacion", "firewall", "pentest", "ethical hacking"),
    "Cloud/hosting": ("nube publica", "cloud computing", "hosting", "servidor virtual", " aws ", "google cloud"),
    "Microsoft": ("microsoft", "office 365", "microsoft 365", "sharepoint", "exchange", "windows server"),
    "Oracle": ("oracle database", "oracle ebs", "peoplesoft"),
    "Base de datos/ERP": ("base de datos", "sql server", "postgresql", "mysql", "mongodb", "data warehouse", " sap ", " erp "),
    "Desarrollo software": (
        "desarrollo de software", "desarrollo de sistema", "sistema de informacion", "aplicativo", "software a medida", "plataforma web", "portal web", "sistema web", "sistema administrativo", "aplicacion movil", "app movil",
    ),
    "Licencias": ("licencia de software", "licenciamiento", "suscripcion de software"),
    "Soporte tecnico": ("soporte tecnico", "mantenimiento de software", "mantenimiento de sistema", "mesa de ayuda", "helpdesk", "help desk"),
    "Redes/cableado": ("red de datos", "cableado estructurado", " switch ", "router", "fibra optica", " wifi", "wireless", "access point", "punto de acceso"),
    "Correo electronico": ("correo electronico", "mensajeria electronica"),
    "Hardware": (
        "computadora", "laptop", "impresora", " monitor ", "disco duro", "memoria ram", " ups ", "proyector", " tablet ", "equipos informaticos", "equipos de computo", "scanner", "escaner",
    ),
}
STRONG = ("token", "azure openai", "openai", "gpt", "llm", "claude", "copilot", "gemini")
GENERIC = (
    "inteligencia artificial", "ia generativa", "chatbot", "asistente virtual", "machine learning", "aprendizaje automatico", "procesamiento de lenguaje",
    "vision computacional", "deep learning", "red neuronal", "modelo de lenguaje", "ciencia de datos", "big data",
)
GENERIC_WIDE = (
    "inteligencia artificial", "ia generativa", "chatbot", "asistente virtual", "machine learning", "aprendizaje automatico", "aprendizaje de maquina", "procesamiento de lenguaje", "vision computacional",
    "vision artificial", "deep learning", "aprendizaje profundo", "red neuronal", "redes neuronales", "modelo de lenguaje", "ciencia de datos", "big data",
)
WHOLE_WORDS = frozenset({"ia"})


def blob(*columns: Column, normalise=unaccented) -> Column:
    """The normalised columns joined and padded by blanks, so that keywords with blanks match at the ends."""
    return F.concat(F.lit(" "), normalise(F.concat_ws(" ", *(F.coalesce(c, F.lit("")) for c in columns))), F.lit(" "))


def _holds(text: Column, term: str) -> Column:
    return contains_term(text, term, term in WHOLE_WORDS)


def first_category(text: Column, categories: Mapping[str, Sequence[str]] = CATEGORIES) -> Column:
    """The first category of which a keyword occurs, else null."""
    any_of = lambda terms: reduce(lambda a, b: a | b, (_holds(text, t) for t in terms))
    return F.coalesce(*(F.when(any_of(terms), F.lit(name)) for name, terms in categories.items()))


def found_terms(text: Column, terms: Sequence[str]) -> Column:
    return F.array_compact(F.array(*(F.when(_holds(text, t), F.lit(t)) for t in terms)))


def relevance(text: Column, strong: Sequence[str] = STRONG, generic: Sequence[str] = GENERIC, none: str | None = None) -> Column:
    """ALTA for a strong term, MEDIA for two generic ones, BAJA for one, else ``none``."""
    n = F.size(found_terms(text, generic))
    return F.when(F.size(found_terms(text, strong)) > 0, "ALTA").when(n >= 2, "MEDIA").when(n == 1, "BAJA").otherwise(F.lit(none))


def detected(text: Column, strong: Sequence[str] = STRONG, generic: Sequence[str] = GENERIC_WIDE) -> Column:
    """The terms found, strong ones first, each once."""
    return F.array_join(F.array_distinct(F.concat(found_terms(text, strong), found_terms(text, generic))), ", ")


def relevant(text: Column, must: Column, exclude: Column) -> Column:
    """Of arrays of normalised terms: one of ``must`` occurs and none of ``exclude``."""
    has = lambda terms: F.exists(F.coalesce(terms, F.array().cast("array<string>")), lambda t: (t != "") & F.contains(text, t))
    return ~has(exclude) & has(must)

"""Ranking captured network events by how likely they carry a document."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telar.operators.merge import latest

# Words of URLs that carry documents, and of those that are noise.
WANTED = ("requerimiento", "documento", "descarg", "archivo", "pdf", "tdr", "anexo", "adjunto")
NOISE = ("listar-completo", "googleapis", "gstatic", "fonts.", ".js", ".css", "assets/", "sockjs", "hot-update")
STATIC = ("stylesheet", "script", "image", "font")


# The points of what an event shows.
POINTS = {"after_click": 25, "pdf_content_type": 100, "pdf_disposition": 90, "download": 80, "pdf_magic": 100, "wanted_word": 35, "called_by_script": 10, "holds_key": 8, "noise": -40, "static": -50}


def score(key: Column, clicked: Column | None = None) -> Column:
    """Points of an event with url, content_type, content_disposition, kind, magic_pdf, resource_type and t; each wanted word counts."""
    url = F.coalesce("url", F.lit(""))
    low, kind, disposition = F.lower(url), F.lower(F.coalesce("content_type", F.lit(""))), F.lower(F.coalesce("content_disposition", F.lit("")))
    shown = {
        "after_click": F.lit(False) if clicked is None else F.col("t") >= clicked,
        "pdf_content_type": kind.contains("application/pdf"),
        "pdf_disposition": disposition.rlike(r"\.pdf|application/pdf"),
        "download": F.col("kind") == "download",
        "pdf_magic": F.col("magic_pdf"),
        "called_by_script": F.col("resource_type").isin("xhr", "fetch"),
        "holds_key": url.contains(key.cast("string")),
        "noise": low.rlike("|".join(n.replace(".", r"\.") for n in NOISE)),
        "static": F.col("resource_type").isin(*STATIC),
    }
    words = F.size(F.filter(F.array(*map(F.lit, WANTED)), lambda w: low.contains(w))) * POINTS["wanted_word"]
    return sum((F.when(F.coalesce(c, F.lit(False)), POINTS[name]).otherwise(0) for name, c in shown.items()), words)


def url_template(url: Column, key: Column) -> Column:
    """The URL with the key's place in its path or query shown as {id}."""
    k = key.cast("string")
    return F.regexp_replace(F.regexp_replace(url, F.concat(F.lit("(^|/)"), k, F.lit("(?=/|$|\\?)")), F.lit("$1{id}")), F.concat(F.lit("="), k, F.lit("(?=&|$)")), F.lit("={id}"))


def candidates(events: DataFrame, key: Column, clicked: Column | None = None, least: int = 30, most: int | None = None, on: Sequence[str] = ("method", "url")) -> DataFrame:
    """The best events, each method and URL once; ``most`` of them (12 in the original) if that is given."""
    scored = events.withColumn("score", score(key, clicked))
    best = latest(scored, on, F.desc("score"), F.col("t")).filter(F.col("score") >= least).orderBy(F.desc("score"), "t")
    return best if most is None else best.limit(most)

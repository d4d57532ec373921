"""Text functions as Column expressions."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# The characters of Unicode's White_Space, as the regular expression (?U)\s has them.
SPACE = "\t\n\x0b\f\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"

# The accented letters that fold() maps, and what it maps them to.
FOLD_FROM = "áéíóúüñÁÉÍÓÚÜÑàèìòùÀÈÌÒÙ"
FOLD_TO = "aeiouunAEIOUUNaeiouAEIOU"

# Words that an acronym leaves out, and words that a search term leaves out.
ACRONYM_STOP = ("DE", "DEL", "Y", "E", "DA", "DO", "DAS", "AL", "A")
TERM_STOP = (
    "que", "qué", "cuales", "cuáles", "hay", "contratos?", "contrataciones?", "vigentes?", "culminad\\w*", "piden?", "pide", "compra", "compran", "requisitos?", "para",
    "proveedores?", "del", "de", "la", "el", "los", "las", "un", "una", "unos", "unas", "con", "o", "y", "en", "por",
)

# Lines of letterheads and page marks.
LETTERHEAD = (
    r"---\s*pagina\s+\d+\s*---", r"per[uú]", r"ministerio de defensa", r"av\.\s*del parque norte\b.*", r"https?://\S+", r"www\.gob\.pe/\S*", r"facilita\.gob\.pe\S*", r"mesadepartes@\S+",
    r"[“\"']decenio de la igualdad.*", r"[“\"']año de la esperanza.*", r"centro nacional de estimaci[oó]n,?", r"centro nacional de estimaci[oó]n,?\s*prevenci[oó]n y reducci[oó]n.*",
    r"prevenci[oó]n y reducci[oó]n del", r"riesgo de desastres\s*[-–]\s*cenepred", r"cenepred", r"subdirecci[oó]n de", r"gesti[oó]n de la", r"informaci[oó]n",
)


@F.pandas_udf(StringType())
def _unaccented(s: pd.Series) -> pd.Series:
    return s.map(lambda t: "" if not t else t.lower() if t.isascii() else "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c)).lower())


def unaccented(c: Column) -> Column:
    """NFKD without combining marks, lower case; null is empty. Spark has no normalize(), hence a pandas UDF, to which ASCII text goes as null."""
    text = F.coalesce(c, F.lit(""))
    ascii_ = F.length(text) == F.octet_length(text)
    return F.when(ascii_, F.lower(text)).otherwise(_unaccented(F.when(~ascii_, text)))


def fold(c: Column) -> Column:
    """Lower case with the common Spanish accents folded; null is empty. Stays in the JVM."""
    return F.lower(F.translate(F.coalesce(c, F.lit("")), FOLD_FROM, FOLD_TO))


def strip(c: Column) -> Column:
    """Without Unicode white space at the ends."""
    return F.btrim(c, F.lit(SPACE))


def blank_to_null(c: Column) -> Column:
    return F.nullif(strip(c), F.lit(""))


def first_nonblank(*cs: Column) -> Column:
    """The first that is neither null nor empty; later ones also replace empty text."""
    return F.coalesce(*(F.nullif(c, F.lit("")) for c in cs))


def contains_term(text: Column, term: str, word: bool = False) -> Column:
    """Whether normalised text holds the (already normalised) term, as a whole word if asked."""
    if word:
        return text.rlike(r"\b" + "".join("\\" + c if not c.isalnum() and c != " " else c for c in term) + r"\b")
    return text.contains(term)


def matches_keyword(columns: Sequence[Column], keyword: str, normalise=unaccented) -> Column:
    """A keyword in any of the columns; an empty keyword matches all rows."""
    k = "".join(c for c in unicodedata.normalize("NFKD", keyword) if not unicodedata.combining(c)).lower()
    return F.lit(True) if not k else contains_term(normalise(F.concat_ws(" ", *(F.coalesce(c, F.lit("")) for c in columns))), k, word=k == "ia")


def like_anywhere(c: Column, part: str) -> Column:
    """Case-blind LIKE with the part anywhere; its % and _ stay wildcards."""
    return c.ilike(f"%{part}%")


def useful_chars(c: Column) -> Column:
    return F.length(F.regexp_replace(F.coalesce(c, F.lit("")), r"[^\p{L}\p{N}]", ""))


def fewer_useful(c: Column, n: int) -> Column:
    """Whether a text has fewer than n letters and digits; up to a hundred are looked for, not counted."""
    if not 0 < n <= 100:
        return useful_chars(c) < n
    return ~F.coalesce(c, F.lit("")).rlike(r"\A(?:[^\p{L}\p{N}]*+[\p{L}\p{N}]){%d}" % n)


def _bound(c: Column, f: Callable[[Column], Column]) -> Column:
    """f of a value that is computed once, however often f names it."""
    return F.transform(F.array(c), f)[0]


def clean_text(c: Column) -> Column:
    """NUL to space, no blanks before line ends, at most one blank line, single blanks, trimmed. What a text has nothing of is not searched for by expressions."""
    lines = _bound(F.replace(c, F.lit("\u0000"), F.lit(" ")), lambda t: F.when(t.contains("\n"), F.regexp_replace(F.regexp_replace(t, r"[ \t]+\n", "\n"), r"\n{3,}", "\n\n")).otherwise(t))
    return strip(_bound(lines, lambda t: F.when(t.contains("  ") | t.contains("\t"), F.regexp_replace(t, r"[ \t]{2,}", " ")).otherwise(t)))


def approx_tokens(c: Column) -> Column:
    """A quarter of the characters, at least one unless empty."""
    n = F.length(F.coalesce(c, F.lit("")))
    return F.when(n == 0, 0).otherwise(F.greatest(F.lit(1), F.floor(n / 4).cast("int")))


def squeeze(c: Column) -> Column:
    return strip(F.regexp_replace(c, r"(?U)\s+", " "))


def clip(c: Column, n: int) -> Column:
    """Line breaks to \\n; over n characters, the first n and an ellipsis."""
    t = F.replace(F.coalesce(c, F.lit("")), F.lit("\r\n"), F.lit("\n"))
    return F.when(F.length(t) <= n, t).otherwise(F.concat(F.substring(t, 1, n), F.lit("…")))


def acronym(c: Column) -> Column:
    """Initials of the last part (after a dash or slash), stop words left out; else up to twelve letters of it; ``s/e`` if there are none."""
    parts = F.filter(F.transform(F.split(strip(F.coalesce(c, F.lit(""))), r"\s*[-–—/]\s*"), strip), lambda x: x != "")
    part = F.coalesce(F.try_element_at(parts, F.lit(-1)), strip(F.coalesce(c, F.lit(""))))
    words = F.transform(F.regexp_extract_all(part, F.lit("([A-Za-zÁÉÍÓÚÜÑáéíóúüñ0-9]+)"), 1), F.upper)
    initials = F.array_join(F.transform(F.filter(words, lambda w: ~w.isin(*ACRONYM_STOP)), lambda w: F.substring(w, 1, 1)), "")
    letters = F.upper(F.substring(F.regexp_replace(part, "[^A-Za-z0-9]", ""), 1, 12))
    return F.substring(F.when(F.length(initials) >= 2, initials).otherwise(first_nonblank(letters, F.lit("s/e"))), 1, 16)


def contract_number(title: Column, number: Column, key: Column) -> Column:
    return F.coalesce(F.nullif(strip(title), F.lit("")), F.nullif(number.cast("string"), F.lit("")), key.cast("string"), F.lit(""))


def subject(description: Column, kind: Column) -> Column:
    """The description, or else the kind, on one line and at most 80 characters; ``s/a`` if neither."""
    return first_nonblank(F.substring(squeeze(first_nonblank(description, kind)), 1, 80), F.lit("s/a"))


def long_header(entity: Column, subject_: Column, number: Column) -> Column:
    return F.concat(F.lit("["), first_nonblank(strip(entity), F.lit("s/e")), F.lit(" | "), subject_, F.lit(" | "), number, F.lit("]"))


def short_header(entity: Column, number: Column) -> Column:
    return F.concat(F.lit("["), acronym(entity), F.lit(" | "), number, F.lit("]"))


def body(c: Column) -> Column:
    """Without a first line that is a bracketed header."""
    t = F.coalesce(c, F.lit(""))
    return F.when(t.rlike(r"^\[[^\]]+\]\s*(?:\n|$)"), F.regexp_replace(t, r"^\[[^\]]+\]\s*(?:\n|$)\s*", "")).otherwise(t)


def without_letterhead(c: Column, patterns: Sequence[str] = LETTERHEAD) -> Column:
    """Letterhead lines, page marks and short capital labels dropped; runs of blank lines collapsed."""
    lines = F.split(F.replace(F.replace(F.coalesce(c, F.lit("")), F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n")), "\n")
    head = "(?iu)^(?:" + "|".join(patterns) + ")$"

    def drop(s: Column) -> Column:
        words = F.size(F.split(s, r"\s+"))
        label = (F.length(s) <= 40) & ~s.endswith(":") & ~s.rlike(r"\p{Ll}") & s.rlike(r"\p{L}") & ~s.rlike(r"^\d") & words.between(1, 4)
        return (s != "") & (label | s.rlike(head))

    kept = F.filter(F.transform(lines, lambda x: F.struct(x.alias("line"), strip(x).alias("s"))), lambda p: ~drop(p["s"]))
    blank = F.transform(kept, lambda p: F.when(p["s"] == "", F.lit("")).otherwise(p["line"]))
    return strip(_bound(F.array_join(blank, "\n"), lambda t: F.when(t.contains("\n\n\n"), F.regexp_replace(t, r"\n{3,}", "\n\n")).otherwise(t)))


def search_term(c: Column) -> Column:
    """A question as a search term: lower case, no punctuation, no stop words."""
    t = F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[¿?¡!.,;:()]", " ")
    return squeeze(F.regexp_replace(t, r"(?iU)\b(?:" + "|".join(TERM_STOP) + r")\b", " "))


def int_list(c: Column) -> Column:
    """JSON array or text of numbers to array<int>; what is no integer is left out."""
    return F.filter(F.transform(F.split(F.regexp_replace(F.coalesce(c, F.lit("")), r"[\[\]\"\s]", ""), ","), lambda x: x.try_cast("int")), lambda x: x.isNotNull())


def id_list(c: Column) -> Column:
    return F.filter(F.transform(F.split(strip(F.coalesce(c, F.lit(""))), r"[,\s]+"), lambda x: x.try_cast("long")), lambda x: x.isNotNull())


def canonical(c: Column, names: dict[str, int]) -> Column:
    """struct<id, name> of a known label, else null. Labels are matched unaccented."""
    key, known = fold(strip(c)), F.create_map(*(F.lit(x) for kv in names.items() for x in kv))
    return F.when(F.array_contains(F.map_keys(known), key), F.struct(F.try_element_at(known, key).alias("id"), key.alias("name")))


def page_kind(pages: Column, scanned: Column) -> Column:
    """By how many of a document's pages are images."""
    return F.when(F.coalesce(scanned, F.lit(0)) <= 0, "nativo_puro").when((pages > 0) & (scanned >= pages), "imagen_total").otherwise("mixto")


def page_mark(page: Column, note: str = "") -> Column:
    return F.concat(F.lit("--- pagina "), page.cast("string"), F.lit(f" ({note}) ---" if note else " ---"))


def append_page(text: Column, page: Column, more: Column, note: str = "") -> Column:
    """Append a page's text under its mark, once; ``note`` (``ocr`` for recognised text) is part of the mark."""
    t, mark = strip(F.coalesce(text, F.lit(""))), page_mark(page, note)
    added = strip(F.concat(mark, F.lit("\n"), strip(F.coalesce(more, F.lit("")))))
    return F.when(t.contains(mark), t).when(t == "", added).otherwise(F.concat(t, F.lit("\n\n"), added))


def cache_key(key: Column, digest: Column, query: Column) -> Column:
    return F.concat_ws(":", key.cast("string"), F.coalesce(digest, F.lit("")), F.sha2(squeeze(F.lower(F.coalesce(query, F.lit("")))), 256))


def rounded(c: Column, digits: int) -> Column:
    """Half to even, as the reference's reports round."""
    return F.bround(c, digits)

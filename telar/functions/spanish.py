"""Spanish words for full-text search: stop words, and the published Snowball rules as SQL expressions.

The expressions read alike in Spark and other SQL engines, so the steps can be
checked there: ``STEPS`` names columns of a table that has the word as ``w``.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The stop words that are no verb forms.
_PLAIN = (
    "de la que el en y a los del se las por un para con no una su al lo como más pero sus le ya o este sí porque esta entre cuando muy sin sobre también me hasta hay donde quien desde todo nos durante todos uno les ni contra otros ese eso ante ellos "
    "e esto mí antes algunos qué unos yo otro otras otra él tanto esa estos mucho quienes nada muchos cual poco ella estar estas algunas algo nosotros mi mis tú te ti tu tus ellas nosotras vosotros vosotras os mío mía míos mías tuyo tuya tuyos tuyas "
    "suyo suya suyos suyas nuestro nuestra nuestros nuestras vuestro vuestra vuestros vuestras esos esas"
)
# By stem, the endings of the auxiliary verbs.
_FUTURE, _CONDITIONAL = "é ás á emos éis án", "ía ías íamos íais ían"
_PAST = "e iste o imos isteis ieron iera ieras iéramos ierais ieran iese ieses iésemos ieseis iesen"
_VERBS = {
    "est": "oy ás á amos áis án é és emos éis én aba abas ábamos abais aban ando ado ada ados adas ad", "estar": f"{_FUTURE} {_CONDITIONAL}", "estuv": _PAST, "h": "e as a emos an", "hab": f"éis iendo ido ida idos idas {_CONDITIONAL}", "hay": "a as amos áis an",
    "habr": f"{_FUTURE} {_CONDITIONAL}", "hub": _PAST, "": "soy eres es somos sois son sea seas seamos seáis sean era eras éramos erais eran siendo sido", "ser": f"{_FUTURE} {_CONDITIONAL}", "fu": "i iste e imos isteis eron era eras éramos erais eran ese eses ésemos eseis esen",
    "ten": f"emos éis iendo ido ida idos idas ed {_CONDITIONAL}", "tien": "es e en", "teng": "o a as amos áis an", "tendr": f"{_FUTURE} {_CONDITIONAL}", "tuv": _PAST,
}
STOP = tuple(dict.fromkeys([*_PLAIN.split(), *(stem + e for stem, ends in _VERBS.items() for e in ends.split())]))

# The endings that the steps look for.
_V = "aeiouáéíóúü"
_PRONOUNS = "selas|selos|sela|selo|las|les|los|nos|me|se|la|le|lo"
_BEFORE = "iéndo|ándo|ár|ér|ír|yendo|iendo|ando|ar|er|ir"
_PLAIN_ENDS = "anza anzas ico ica icos icas ismo ismos able ables ible ibles ista istas oso osa osos osas amiento amientos imiento imientos"
_IC_ENDS = "adora ador ación adoras adores aciones ante antes ancia ancias"
_Y_ENDS = "yeron|yendo|yamos|yais|yan|yen|yas|yes|ya|ye|yo|yó"
_GU_ENDS = "en es éis emos"
_VERB_ENDS = (
    "arían arías arán arás aríais aría aréis aríamos aremos ará aré erían erías erán erás eríais ería eréis eríamos eremos erá eré irían irías irán irás iríais iría iréis iríamos iremos irá iré aba ada ida ía ara iera ad ed id ase iese aste iste an "
    "aban ían aran ieran asen iesen aron ieron ado ido ando iendo ió ar er ir as abas adas idas ías aras ieras ases ieses ís áis abais íais arais ierais aseis ieseis asteis isteis ados idos amos ábamos íamos imos áramos iéramos iésemos ásemos"
)


def _end(text: str, ends: str) -> str:
    """The longest of the endings that the text has."""
    return f"regexp_extract({text}, '(?:{'|'.join(ends.split()) if ' ' in ends else ends})$', 0)"


def _in(ends: str) -> str:
    return "(" + ", ".join(f"'{e}'" for e in ends.split()) + ")"


def _after(pattern: str, text: str) -> str:
    """How far the pattern goes from the start; the text's length if it is not there."""
    got = f"length(regexp_extract({text}, '^{pattern}', 0))"
    return f"CASE WHEN {got} > 0 THEN {got} ELSE length({text}) END"


_NEXT = f"[^{_V}]*[{_V}]+[^{_V}]"
_RV2 = "substring({w}, pv + 1, 99)"

#: (column, expression), in order. pv, p1, p2: where the regions RV, R1, R2 start.
STEPS: list[tuple[str, str]] = [
    ("pv", f"CASE WHEN length(regexp_extract(w, '^.[^{_V}]', 0)) > 0 THEN {_after(f'.[^{_V}]+[{_V}]', 'w')} WHEN length(regexp_extract(w, '^[{_V}][{_V}]', 0)) > 0 THEN {_after(f'[{_V}]+[^{_V}]', 'w')} ELSE least(3, length(w)) END"),
    ("p1", _after(_NEXT, "w")),
    ("p2", f"p1 + {_after(_NEXT, 'substring(w, p1 + 1, 99)')}"),
    # 0: an attached pronoun after a gerund or an infinitive
    ("s0", _end("w", _PRONOUNS)),
    ("b0", "left(w, length(w) - length(s0))"),
    ("a0", _end(_RV2.format(w="b0"), _BEFORE)),
    ("w0", f"CASE WHEN s0 = '' OR a0 = '' THEN w WHEN a0 IN {_in('iéndo ándo ár ér ír')} THEN concat(left(b0, length(b0) - length(a0)), translate(a0, 'áéí', 'aei')) WHEN a0 = 'yendo' AND right(left(b0, length(b0) - 5), 1) <> 'u' THEN w ELSE b0 END"),
    # 1: standard endings
    ("s1", _end("w0", f"{_PLAIN_ENDS} {_IC_ENDS} logía logías ución uciones encia encias amente mente idad idades iva ivo ivas ivos")),
    ("q", "length(w0) - length(s1)"),
    ("b1", "left(w0, q)"),
    (
        "g1",
        f"""CASE WHEN s1 = '' THEN NULL
        WHEN s1 = 'amente' THEN CASE WHEN q < p1 THEN NULL WHEN right(b1, 4) = 'ativ' AND q - 4 >= p2 THEN left(w0, q - 4) WHEN right(b1, 2) IN ('iv', 'os', 'ic', 'ad') AND q - 2 >= p2 THEN left(w0, q - 2) ELSE b1 END
        WHEN q < p2 THEN NULL
        WHEN s1 IN {_in(_IC_ENDS)} THEN CASE WHEN right(b1, 2) = 'ic' AND q - 2 >= p2 THEN left(w0, q - 2) ELSE b1 END
        WHEN s1 IN ('logía', 'logías') THEN concat(b1, 'log') WHEN s1 IN ('ución', 'uciones') THEN concat(b1, 'u') WHEN s1 IN ('encia', 'encias') THEN concat(b1, 'ente')
        WHEN s1 = 'mente' THEN CASE WHEN right(b1, 4) IN ('ante', 'able', 'ible') AND q - 4 >= p2 THEN left(w0, q - 4) ELSE b1 END
        WHEN s1 IN ('idad', 'idades') THEN CASE WHEN right(b1, 4) = 'abil' AND q - 4 >= p2 THEN left(w0, q - 4) WHEN right(b1, 2) IN ('ic', 'iv') AND q - 2 >= p2 THEN left(w0, q - 2) ELSE b1 END
        WHEN s1 IN {_in('iva ivo ivas ivos')} THEN CASE WHEN right(b1, 2) = 'at' AND q - 2 >= p2 THEN left(w0, q - 2) ELSE b1 END
        ELSE b1 END""",
    ),
    ("w1", "coalesce(g1, w0)"),
    # 2a and 2b: verb endings, where step 1 took nothing
    ("t2", _end(_RV2.format(w="w1"), _Y_ENDS)),
    ("y2", "g1 IS NULL AND t2 <> '' AND right(left(w1, length(w1) - length(t2)), 1) = 'u'"),
    ("u2", _end(_RV2.format(w="w1"), f"{_GU_ENDS} {_VERB_ENDS}")),
    ("r2", "left(w1, length(w1) - length(u2))"),
    ("w2", f"CASE WHEN g1 IS NOT NULL THEN w1 WHEN y2 THEN left(w1, length(w1) - length(t2)) WHEN u2 IN {_in(_GU_ENDS)} AND right(r2, 2) = 'gu' THEN left(r2, length(r2) - 1) ELSE r2 END"),
    # 3: what is left
    ("v3", _end(_RV2.format(w="w2"), "os|a|o|á|í|ó|e|é")),
    ("r3", "left(w2, length(w2) - length(v3))"),
    ("stem", "translate(CASE WHEN v3 IN ('e', 'é') AND right(r3, 2) = 'gu' AND length(r3) - 1 >= pv THEN left(r3, length(r3) - 1) ELSE r3 END, 'áéíóú', 'aeiou')"),
]


def stem_expression(column: str) -> str:
    """The steps as one Spark expression over a column. Each step binds a struct with all before it, so the expression grows with the steps alone."""
    names = ["w", *(name for name, _ in STEPS)]
    known = re.compile(r"\b(" + "|".join(names) + r")\b")

    def bound(expression: str) -> str:
        parts = expression.split("'")  # names stand outside the quotes
        return "'".join(known.sub(r"s.\1", x) if i % 2 == 0 else x for i, x in enumerate(parts))

    used = [set(known.findall(" ".join(e.split("'")[::2]))) for _, e in STEPS]
    out = f"array(named_struct('w', {column}))"
    for i, (name, expression) in enumerate(STEPS):
        later = set().union(*used[i + 1 :])
        kept = "".join(f"'{n}', s.{n}, " for n in names[: i + 1] if n in later)
        out = f"transform({out}, s -> named_struct({kept}'{name}', {bound(expression)}))"
    return f"element_at({out}, 1).stem"


def stemmed(df: DataFrame, column: str, to: str = "stem") -> DataFrame:
    """The rows with the stem of a (lower-case) word. In the JVM. No ending ends in a digit, so words that do lose accents alone."""
    plain = F.when(F.col(column).rlike("[0-9]$"), F.translate(column, "áéíóú", "aeiou"))
    return df.withColumn(to, plain.otherwise(F.expr(stem_expression(f"`{column}`"))))


def stem_sql(source: str) -> str:
    """A SELECT of w and stem from a table or subquery with the column w: the same steps as SQL text."""
    for name, expression in STEPS:
        source = f"(SELECT *, {expression} AS {name} FROM {source})"
    return f"SELECT w, stem FROM {source}"

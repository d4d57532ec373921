import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from telar.functions import rubric as R
from telar.functions import text as T
from telar.functions import time as D
from telar.functions import vector as V


def one(spark, column, schema="a string", *values):
    return spark.createDataFrame([values], schema).select(column.alias("x")).first().x


def each(spark, fn, cases, schema="a string"):
    rows = spark.createDataFrame([(i, c) for i, (c, _) in enumerate(cases)], "i int, " + schema).select("i", fn(F.col("a")).alias("x")).orderBy("i").collect()
    assert [r.x for r in rows] == [e for _, e in cases]


def test_text(spark):
    each(spark, T.unaccented, [("CÁMARA ñandú", "camara nandu"), ("ﬁn ç â", "fin c a"), (None, ""), ("ABC", "abc")])
    each(spark, T.fold, [("CÁMARA Ñ ç", "camara n ç"), (None, "")])
    each(spark, T.blank_to_null, [("  ", None), (" a ", "a"), (None, None)])
    each(spark, T.useful_chars, [("a1 ñ-", 3), (None, 0)])
    each(spark, T.clean_text, [("a\u0000b  c \n\n\n\nd\t\te ", "a b c\n\nd e")])
    each(spark, T.approx_tokens, [("", 0), ("abc", 1), ("a" * 9, 2), (None, 0)])
    each(spark, lambda c: T.clip(c, 3), [("abcd", "abc…"), ("abc", "abc"), (None, "")])
    each(spark, T.acronym, [("MINISTERIO DE SALUD - HOSPITAL DEL NIÑO", "HN"), ("", "s/e"), ("OSCE", "OSCE"), (None, "s/e"), ("A / Banco de la Nación", "BLN")])
    each(spark, T.body, [("[x | y]\n\n body", "body"), ("plain", "plain"), (None, "")])
    each(spark, T.without_letterhead, [("--- pagina 2 ---\nPERÚ\nOBJETO:\nTexto útil\n\n\nOFICINA DE TI\nfin", "OBJETO:\nTexto útil\n\nfin")])
    each(spark, T.search_term, [("¿Qué contratos vigentes hay de nube?", "nube"), ("Culminadas, la red", "red"), (None, "")])
    each(spark, T.int_list, [("[1, 2,x]", [1, 2]), ("3,4", [3, 4]), (None, []), ("", [])])
    each(spark, T.id_list, [("1, 2 3", [1, 2, 3]), ("", [])])
    assert one(spark, T.append_page(F.col("a"), F.lit(2), F.lit(" t ")), "a string", "x") == "x\n\n--- pagina 2 ---\nt"
    once = "--- pagina 2 ---\nt"
    assert one(spark, T.append_page(F.col("a"), F.lit(2), F.lit("u")), "a string", once) == once
    assert one(spark, T.subject(F.lit(None).cast("string"), F.lit(" a   b ")), "a string", "") == "a b"
    assert one(spark, T.contract_number(F.lit(" "), F.lit(None).cast("string"), F.lit(7)), "a string", "") == "7"
    each(spark, lambda c: T.canonical(c, {"bien": 1, "obra": 3})["id"], [("Bien", 1), ("x", None)])
    assert [one(spark, T.page_kind(F.lit(p), F.lit(s)), "a string", "") for p, s in ((3, 0), (3, 3), (3, 1), (0, 1))] == ["nativo_puro", "imagen_total", "mixto", "mixto"]
    each(spark, lambda c: T.matches_keyword([c], "ia"), [("la IA", True), ("materia", False)])
    each(spark, lambda c: T.matches_keyword([c], ""), [("x", True)])


def test_time(spark):
    each(spark, lambda c: D.parse_source_date(c).cast("string"), [("01/02/2026 03:04:05", "2026-02-01 03:04:05"), ("1/2/2026 3:4:5", "2026-02-01 03:04:05"), ("31/02/2026 00:00:00", None), ("x", None), (None, None)])
    each(spark, lambda c: D.local_date(D.parse_iso(c)).cast("string"), [("2026-08-20T04:59:59Z", "2026-08-19"), ("2026-08-20T05:00:00", "2026-08-20"), ("bad", None)])
    each(spark, D.positive_id, [("3", 3), ("3.0", 3), ("3.5", None), ("-1", None), ("0", None), ("x", None), (None, None)])
    each(spark, D.iso_or_null, [(" 2026-01-01 ", "2026-01-01"), ("no", None)])
    assert one(spark, D.today("2026-08-20T04:00:00Z").cast("string"), "a string", "") == "2026-08-19"


def test_vectors(spark):
    s = "a array<double>, b array<double>"
    assert one(spark, V.cosine_similarity(F.col("a"), F.col("b")), s, [1.0, 0.0], [0.0, 2.0]) == 0
    assert one(spark, V.cosine_similarity(F.col("a"), F.col("b")), s, [0.0, 0.0], [1.0, 2.0]) is None
    assert one(spark, V.cosine_similarity(F.col("a"), F.col("b")), s, [float("nan"), 0.0], [1.0, 2.0]) is None
    assert one(spark, V.cosine_similarity(F.col("a"), F.col("b")), s, [1.0], [1.0, 2.0]) is None
    assert one(spark, V.l2_normalize(F.col("a")), s, [3.0, 4.0], None) == pytest.approx([0.6, 0.8])
    assert one(spark, V.l2_normalize(F.col("a")), s, [0.0, 0.0], None) == [0, 0]
    assert one(spark, V.from_literal(V.to_literal(F.col("a"))), s, [0.5, -1.0], None) == [0.5, -1.0]
    assert one(spark, V.from_literal(F.lit("{1,x}")), s, None, None) is None
    assert one(spark, V.fit_dimension(F.col("a"), 1), s, [1.0, 2.0], None) == [1.0]


def test_rubric(spark):
    cases = [
        (("Hardware", None, "laptop", ""), "marginal"), (("Hardware", None, "sistema SCADA", ""), "nucleo"), (("Hardware", None, "red OT.", ""), "nucleo"), (("Hardware", None, "robot", ""), "marginal"),
        ((None, None, "integración", ""), "adyacente"), (("IA/analytics", None, "integración", ""), "nucleo"), (("Firma digital", "ALTA", "gpt", ""), "oportunista"), (("Licencias", "alta", "", "Copilot"), "nucleo"), ((None, None, "x", None), None),
    ]
    df = spark.createDataFrame([(i, *c) for i, (c, _) in enumerate(cases)], "i int, c string, r string, d string, t string")
    got = df.select("i", R.rubric(*map(F.col, "crdt")).alias("x")).orderBy("i").collect()
    assert [g.x for g in got] == [e for _, e in cases]
    days = spark.createDataFrame([(None,), (-1,), (0,), (1,), (2,), (7,), (8,), (30,), (31,)], "d int").select(R.urgency_points(F.col("d")).alias("x")).collect()
    assert [d.x for d in days] == [3, 0, 10, 12, 15, 15, 8, 8, 5]
    R.register(spark)
    assert spark.sql("SELECT level_of('Oracle') a, has_real_ai('un ChatGPT') b, fold_text('ÑÁ') c, level_of('zzz') d").first()[:] == ("adyacente", True, "na", None)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(max_size=30), min_size=1, max_size=20))
def test_unaccented_property(spark, texts):
    want = ["".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c)).lower() for t in texts]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, a string").select("i", T.unaccented(F.col("a")).alias("x")).orderBy("i").collect()
    assert [r.x for r in rows] == want


def test_normalising_is_linear_in_the_dimension(spark):
    """Sixteen times the values take far less than 256 times as long."""
    import time

    def seconds(n):
        rows = spark.range(300).select(F.transform(F.sequence(F.lit(1), F.lit(n)), lambda x: x * 0.5 + F.col("id")).alias("v")).cache()
        rows.count()
        best = 1e9
        for _ in range(3):
            began = time.perf_counter()
            rows.select(V.l2_normalize(F.col("v"))).write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - began)
        rows.unpersist()
        return best

    seconds(64)
    assert seconds(4096) < 64 * max(seconds(256), 0.02)

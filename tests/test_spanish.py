"""The stemmer against a fixed word list, in Spark and as SQL text, and ranks by hand."""

import math

import duckdb
import pytest
from pyspark.sql import functions as F

from telar.functions import spanish as S
from telar.operators import search

# Words of the published sample vocabulary with their stems.
WORDS = (
    "che che checa chec checar chec checo chec checoslovaquia checoslovaqui chefs chefs chelo chel chemise chemis cheque chequ chequeo cheque cheques chequ chetumaleños chetumaleñ chi chi chía chi chiapaneca chiapanec chica chic chicago chicag chicana chican chicas chic "
    "chicharrones chicharron chichimecas chichimec chicles chicl torá tor tórax torax torcer torc toreado tor toreados tor toreándolo tor torear tor toreara tor torearlo tor toreó tore torero torer toreros torer torio tori tormenta torment tormentas torment "
    "tornado torn tornar torn tornen torn torneo torne torneos torne tornillo tornill tornillos tornill torniquete torniquet torno torn toronto toront toros tor torpedearon torped torpeza torpez torrado torr torre torr torrencial torrencial torrenciales torrencial torreón torreon torres torr"
).split()
PAIRS = list(zip(WORDS[::2], WORDS[1::2], strict=True))


def test_stems(spark):
    got = {r.w: r.stem for r in S.stemmed(spark.createDataFrame([(w, 0) for w, _ in PAIRS], "w string, s1 int"), "w").collect()}
    assert got == dict(PAIRS)
    assert dict(duckdb.sql(S.stem_sql(f"(SELECT unnest({[w for w, _ in PAIRS]!r}) AS w) t")).fetchall()) == dict(PAIRS)


@pytest.mark.parametrize(("a", "b"), [("servicio", "servicios"), ("contratación", "contrataciones"), ("informática", "informáticas"), ("adquirir", "adquirido"), ("nacional", "nacionales"), ("impresora", "impresoras")])
def test_forms_of_a_word_meet(spark, a, b):
    one, two = (r.stem for r in S.stemmed(spark.createDataFrame([(a,), (b,)], "w string"), "w").collect())
    assert one == two


def test_stop_words():
    assert {"de", "la", "estuviéramos", "hubiesen", "tendrán", "habéis", "fuimos", "seríamos"} <= set(S.STOP)
    assert not {"servicio", "hab", "estar ", ""} & set(S.STOP)


def near(d):
    return 0.1 * math.sqrt(1e-30 if d > 100 else 1 / (1.005 + 0.05 * math.exp(d / 1.5 - 2)))


def test_ranks(spark):
    rows = [([[3, 9, 40]],), ([[1], [4, 200]],), ([[16383], [16383]],), ([[2], [3], [9]],)]
    got = [r[0] for r in spark.createDataFrame(rows, "p array<array<int>>").select(search.text_rank(F.col("p"))).collect()]
    assert got[0] == pytest.approx(0.1 * (1 + 1 / 4 + 1 / 9) / 1.64493406685)
    assert got[1] == pytest.approx(1 - (1 - near(3)) * (1 - near(199)))
    assert got[2] == pytest.approx(1e-20)
    assert got[3] == pytest.approx(1 - (1 - near(1)) * (1 - near(7)) * (1 - near(6)))


def test_search(spark):
    rows = [(1, "Servicio de mantenimiento", "a"), (2, "SERVICIOS y sistemas", "b"), (3, None, None), (4, "el servicio de los sistemas informáticos", "c")]
    df = spark.createDataFrame(rows, "id long, descripcion string, entidad string").withColumn("fecha_publica", F.lit("2020-01-01").cast("timestamp"))
    find = lambda t: {r.id for r in search.search_records(df, t, text=("descripcion", "entidad")).collect()}
    assert find("los servicios") == {1, 2, 4}
    assert find("sistema de servicio") == {2, 4}
    assert find("de los") == set()
    assert find("  ") == {1, 2, 3, 4}
    assert search.lexemes(df.limit(0), "id", ("descripcion",)).count() == 0


def test_index_as_a_table(spark, tmp_path):
    df = spark.createDataFrame([(i, f"palabra{i % 7} servicios") for i in range(50)], "id long, t string")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS lexis LOCATION '{tmp_path}'")
    index = search.write_lexemes(search.lexemes(df, "id", ("t",)), "lexis.words", 4)
    asked = spark.createDataFrame([("servicio palabra3",), ("palabra9",)], "term string")
    assert {r.id for r in search.spanish_hits(index, asked).collect()} == {i for i in range(50) if i % 7 == 3}
    assert [r.pos for r in search.spanish_hits(index, asked, 2).orderBy("pos").collect()] == [1, 2]
    spark.sql("DROP DATABASE lexis CASCADE")

import zlib

import numpy as np
import pytest

from telar.llm import language as L
from telar.llm.queries import op11_language

#: Sentences of closely related languages.
REAL = {
    "es": "El perro corre por la calle y la niña mira el cielo mientras su madre prepara la comida en la cocina de la casa. Los años pasan muy rápido cuando hay trabajo y alegría. ¿Dónde están las llaves que dejé sobre la mesa ayer por la noche? No lo sé, pero creo que tu hermano las llevó al mercado.",
    "pt": "O cão corre pela rua e a menina olha para o céu enquanto a sua mãe prepara a comida na cozinha da casa. Os anos passam muito depressa quando há trabalho e alegria. Onde estão as chaves que deixei em cima da mesa ontem à noite? Não sei, mas acho que o teu irmão as levou ao mercado.",
    "de": "Der Hund läuft durch die Straße und das Mädchen schaut in den Himmel, während ihre Mutter in der Küche des Hauses das Essen kocht. Die Jahre vergehen schnell, wenn es Arbeit und Freude gibt. Wo sind die Schlüssel, die ich gestern Abend auf dem Tisch gelassen habe? Ich weiß es nicht.",
    "nl": "De hond loopt door de straat en het meisje kijkt naar de hemel terwijl haar moeder in de keuken van het huis het eten kookt. De jaren gaan snel voorbij als er werk en vreugde is. Waar zijn de sleutels die ik gisteravond op de tafel heb laten liggen? Ik weet het niet, maar ik denk dat jouw broer ze meenam.",
    "xq": "Щука брат цього зоо мрія їжак ґанок хвиля небо крига сонце дощ вітер зима літо осінь весна поле ліс",
}


def brute_counts(text):
    """Runs of one to four characters of a text, one by one."""
    plain = " " + "".join(c.lower()[0] if c.isalpha() else " " for c in text) + " "
    while "  " in plain:
        plain = plain.replace("  ", " ")
    out = np.zeros(1 << L.BITS, int)
    for n in range(1, L.LONGEST + 1):
        for i in range(len(plain) - n + 1):
            g = 0
            for c in plain[i : i + n]:
                g = (g * 0x100000001B3 + ord(c)) % 2**64
            out[(g + n) * 0x9E3779B97F4A7C15 % 2**64 >> 64 - L.BITS] += 1
    return out


def test_counts_by_brute_force(monkeypatch):
    for text in ("Ñandú, 12 ÉTÉ—été  x", "a", "ß ẞ İ\n\tз", REAL["es"]):
        assert (L.counts(L.characters(text)) == brute_counts(text)).all()
    monkeypatch.setattr(L, "_STEP", 7)  # long texts are counted in steps
    assert (L.counts(L.characters(REAL["nl"])) == brute_counts(REAL["nl"])).all()


def test_no_letter():
    for text in ("", " \n", "123 + 5.6", "😀 — !"):
        assert not len(L.characters(text))


def test_pair_machine():
    """The separating line with squared loss, against plain gradient steps on the same function."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 5)).astype(np.float32)
    y = np.where(x @ [1, -2, 0.5, 0, 0] + 0.3 * rng.normal(size=300) > 0, 1, -1)
    w = L.fit_pair(x, y, cost=1.0, rounds=500)
    c = np.where(y > 0, 300 / (2 * (y > 0).sum()), 300 / (2 * (y < 0).sum()))
    z, v = np.column_stack([x, np.ones(300)]).astype(float), np.zeros(6)
    for _ in range(20_000):
        slack = np.maximum(0, 1 - y * (z @ v))
        v -= 0.0003 * (v - 2 * z.T @ (c * y * slack))
    assert np.allclose(w, v, atol=0.02)


def test_related_languages():
    rng = np.random.default_rng(6)

    def text(lang):
        words = REAL[lang].split()
        return " ".join(words[i] for i in rng.integers(0, len(words), rng.integers(12, 30)))

    counted = [(lang, k, L.counts(L.characters(text(lang)))) for lang in REAL for k in range(60)]
    rows = [(lang, k, np.flatnonzero(n), n[n > 0]) for lang, k, n in counted]
    m = L.fit(rows)
    assert m.families.classes == ["germanic", "own:xq", "romance"]
    assert {f: c.classes for f, c in m.within.items()} == {"germanic": ["de", "nl"], "own:xq": ["xq"], "romance": ["es", "pt"]}
    fresh = [(lang, L.vector(L.counts(L.characters(text(lang))))) for lang in REAL for _ in range(40)]
    names, score = m(np.array([v for _, v in fresh]))
    assert np.mean([a == b for a, (b, _) in zip(names, fresh, strict=True)]) > 0.97
    assert ((score >= 0) & (score <= 1)).all()


@pytest.mark.parametrize(("name", "family"), [("es", "romance"), ("pt-BR", "romance"), ("DE_at", "germanic"), ("qqq", "own:qqq"), ("", "own:")])
def test_family(name, family):
    assert L.family(name) == family


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = op11_language(spark, sf).collect()
    assert len(got) == len(lang)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    held = [r for r in got if r.held_out]
    assert len(held) > 100
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held]) > 0.99


def test_learns_from_no_held_out_row(spark):
    rows = [(i, REAL["es"][i % 40 :], "es" if zlib.crc32(str(i).encode()) % 4 != 2 else "nl") for i in range(100)] + [(None, REAL["de"], "de"), (7, None, "fr"), (8, REAL["de"], None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {r[0] for r in L.sample(docs)} == {"es"}
    assert {(r.lang_pred, r.score) for r in L.report(docs).filter("text IS NOT NULL").collect()} == {("es", 1.0)}


def test_bound(spark):
    rows = [(i, f"{REAL['es']} {i}", "es") for i in range(2000)] + [(i, f"{REAL['de']} {i // 500}", "de") for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = L.sample(docs, per_language=100)
    assert 3 * 60 < sum(r[0] == "es" for r in got) < 3 * 160
    assert sum(r[0] == "de" for r in got) == 3 * 4


def test_odd_rows(spark, odd, none):
    got = L.report(odd).collect()
    assert len(got) == odd.count()
    assert all(r.lang_pred == "und" and r.score == 0 for r in got if r.doc_id in (2, 3, 6))
    assert not any(r.held_out for r in got if r.doc_id is None)
    assert {r.lang_pred for r in got if r.doc_id in (1, 4, 5, 7)} <= {"en", "es", "fr"}
    assert L.report(none).count() == 0
    unlearned = L.predicted(odd, L.fit([]))
    assert {(r.lang_pred, r.score) for r in unlearned.collect()} == {("und", 0.0)}
    assert set(unlearned.columns) == {*odd.columns, "lang_pred"}

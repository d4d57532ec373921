import hashlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from telar.llm import wfst

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)


def encode(text):
    return np.frombuffer(wfst.transducer(PATH).encode([text])[0], "<i4").tolist()


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=30), st.text(st.sampled_from("aeinrst  \n\tthT.,1é日▁"), max_size=40)))
def test_same_as_library(text):
    assert encode(text) == LIBRARY.encode(text)


@pytest.mark.parametrize("text", ["", " ", "   x", " " * 40, "\n", "a\n  b", "<s> </s> <0x0A> <unk>", "𝔘𝔫 \u0000", "x" * 100, "aaaa" * 9 + "é" * 30, "123 4567.8"])
def test_cases(text):
    ids = encode(text)
    assert ids == LIBRARY.encode(text)
    assert wfst.transducer(PATH).decode(np.array(ids, "<i4").tobytes()).decode() == text


def test_one_path_of_finite_weight():
    """Of all segmentations into pieces, one has weight zero: the shortest path."""
    t = wfst.transducer(PATH)

    def every(word, state=""):
        if not word:
            yield []
        for n in range(1, len(word) + 1):
            if word[:n] in t.ids and t.weight(state, word[:n]) < wfst.INF:
                yield from ([word[:n], *rest] for rest in every(word[n:], word[:n]))

    for word in ("▁thering", "▁interation", "unhappiness", "▁▁▁▁▁x"):
        (only,) = every(word)
        assert only == t.path(word)


def test_rows(spark, odd, none):
    got = wfst.report(odd, PATH).collect()
    assert len(got) == odd.count()
    texts = {hashlib.sha256((r.text or "").encode()).hexdigest() for r in odd.collect()}
    assert all(r.round_trip and r.decoded_sha256 in texts for r in got)
    assert {r.n_tokens for r in got if r.doc_id in (2, 3)} == {0}
    assert wfst.report(none, PATH).count() == 0
    ids = wfst.with_ids(odd, PATH, ids_col="key", check_col="score")
    assert ids.columns == odd.columns
    assert ids.filter("NOT score").count() == 0
    back = wfst.decoded(ids.withColumnRenamed("text", "was"), PATH, "key")
    assert back.filter("text <> coalesce(was, '')").count() == 0
    mark = spark.createDataFrame([(1, "a▁b")], "doc_id long, text string")
    assert not wfst.report(mark, PATH).first().round_trip


def test_other_models_are_refused(tmp_path):
    (tmp_path / "m.model").write_bytes(open(PATH, "rb").read().replace(b"\x0a\x08identity", b"\x0a\x08identitz") + b"\x12\x02\x18\x01")
    with pytest.raises(ValueError, match="BPE"):
        wfst.Transducer(str(tmp_path / "m.model"))


def test_documents_as_library(docs):
    """Whole texts, and words that mix pieces with characters that only the byte fallback reads."""
    texts = [r.text or "" for r in docs.select("text").collect()]
    texts += ["ab𝔘cd𝔫", "𝔘" * 30, "x𝔘 𝔫y", "the" * 20_000 + "𝔘"]
    assert [np.frombuffer(x, "<i4").tolist() for x in wfst.transducer(PATH).encode(texts)] == [LIBRARY.encode(t) for t in texts]

import pytest

#: Nulls, empty, repeated rows, ties, a very long text, and columns named as the operators' own.
LONG = "palabra larga. " * 40_000


@pytest.fixture(scope="session")
def odd(spark):
    rows = [(1, "The quick brown fox jumps over the lazy dog again and again", "en"), (2, "", "en"), (3, None, None), (None, "no id here", "en"), (None, None, None), (4, "uno dos tres", "es"), (4, "uno dos tres", "es"), (5, LONG, "es"), (6, "  \n\t ", None), (7, "naïve café\u0000x 日本 😀", "fr")]
    extra = ["score", "kind", "fp", "component_id", "key", "t", "k", "n_tokens", "text_", "__score", "__spans", "__kept"]
    return spark.createDataFrame([(*r, *["x"] * len(extra)) for r in rows], "doc_id long, text string, lang string, " + ", ".join(f"{e} string" for e in extra)).repartition(3)


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")

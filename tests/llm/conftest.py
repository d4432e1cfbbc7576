"""A table of awkward rows for every operator, with column names that operators use themselves."""

import pytest
from pyspark.sql import Row
from pyspark.sql import types as T

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    *[T.StructField(c, T.StringType()) for c in ("kept", "n_words", "size", "shard", "id", "key", "copies", "score", "cid")]])


def sentence(seed: int, n: int) -> str:
    return " ".join(f"{WORDS[(seed * 7 + k * k + k // 3) % len(WORDS)]}{(seed + k) % 13}" for k in range(n))


def doc(i, text, lang="en", source="s0"):
    return (i, text, lang, source, None if text is None else len(text), *["x"] * 9)


@pytest.fixture(scope="session")
def odd_docs(spark):
    long_text = " ".join(f"w{k % 977}x{k % 31}" for k in range(120_000))
    rows = [doc(1, sentence(1, 60)), doc(1, sentence(1, 60)), doc(2, sentence(1, 60)), doc(3, None), doc(4, ""),
            doc(5, " \t\n\x0b\x0c\r "), doc(6, sentence(2, 3)), doc(7, sentence(2, 3)), doc(8, long_text, None, None),
            doc(9, sentence(3, 80), "de", "s1"), doc(10, "# $ % line\n# $ % line\n# $ % line", "de", "s1"),
            doc(None, sentence(4, 40), "fr", "s2"), doc(11, "ÀÉ straße ｆｕｌｌ 漢字 　 x" * 5, None, "é"),
            doc(12, "-".join(["a"] * 50_000)), doc(13, sentence(1, 58) + " tail end")]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


def rows(df):
    return [Row(**r.asDict()) for r in df.collect()]

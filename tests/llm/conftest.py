import random

import pytest
from pyspark.sql import types as T

SMALL = "/root/testdata/sf0.001"

#: Columns that operators give, with other contents, to show that they are left alone.
CLASHING = ("kept", "size", "component_id", "n_words", "key", "id", "n_tokens", "lang_pred", "fp", "node")

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        *(T.StructField(c, T.StringType()) for c in CLASHING),
    ]
)


def row(doc_id, text, lang="en", source="s1"):
    return (doc_id, text, lang, source, None if text is None else len(text), *("x" for _ in CLASHING))


def odd_rows():
    """Nulls, blanks, repeats, ties, long texts, copies and near copies."""
    random.seed(5)
    vocabulary = ["".join(random.choices("abcdefghij", k=random.randint(2, 7))) for _ in range(300)]
    prose = lambda n: " ".join(random.choices(vocabulary, k=n))
    base = prose(300)
    near = base.split(" ")
    near[40] = near[200] = "changed"
    out = [
        row(1, None),
        row(2, ""),
        row(3, " \n\t \x0b"),
        row(4, "one"),
        row(5, "one two"),
        row(6, "ONE two"),
        row(7, base),
        row(8, " ".join(near)),
        row(9, base.upper(), None, None),
        row(10, prose(90) + "\n" + base, "fr", "s2"),
        row(11, "word " * 30_000, "de", "s2"),
        row(12, "é中😀 " + prose(70) + "\n\nline line\nline line\n", "de", None),
        row(13, "123 456 !!", None, "s3"),
        row(13, "123 456 !!", None, "s3"),
        row(14, "write to a.b+c@mail.example.com or 1.2.3.4, card 4111 1111 1111 1111, +1 (267) 555-7228"),
        row(14, "same id, other text"),
        row(15, "x" * 120_000, "en", "s4"),
        row(None, "no id at all " + prose(60)),
        row(None, None, None, None),
    ]
    out += [row(100 + i, prose(random.choice([20, 60, 150])), random.choice(["en", "fr"]), random.choice(["s1", "s2"])) for i in range(30)]
    return out


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def table(spark):
    return lambda name: spark.read.parquet(f"{SMALL}/{name}.parquet")

import random

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])


def make_rows():
    """Prose with copies, near copies, shared passages, junk, personal data, and every odd case."""
    r = random.Random(11)
    vocab = ["".join(r.choice("abcdeiortnsé") for _ in range(r.randint(2, 8))) for _ in range(400)]

    def prose(n):
        out = []
        for i in range(n):
            out.append(r.choice(vocab) + ("." if i % 11 == 10 else ""))
            out.append("\n" if i % 60 == 59 else " ")
        return "".join(out).strip() + "."
    passage = prose(30)
    texts = [prose(r.randint(60, 160)) for _ in range(30)]
    texts += [texts[3]] * 5 + [texts[4] + " end"] * 2
    texts += [prose(60) + " " + passage + " " + prose(60) for _ in range(6)]
    texts += ["Mail jo.doe@mail.example.org or 10.0.0.255, call +1 (555) 555-0199, card 4111 1111 1111 1111. " + prose(60)]
    texts += ["a " * 300, "na | na | na | na |\n" * 5 + prose(80), prose(70) + "\nAll rights reserved.", "  ", "", None,
              "one", "two words", "\x00\t tab\x0bvt\r\nx  y", "中文字符。" * 40, "é" * 120, "x" * 3000, prose(4000)]
    rows = [(i * 3 + 1, t, "en", "s", None if t is None else len(t)) for i, t in enumerate(texts)]
    return rows + [rows[0], rows[0], (None, "a null id " + prose(60), None, None, None), (None, None, None, None, None)]


@pytest.fixture(scope="session")
def rows():
    return make_rows()


@pytest.fixture(scope="session")
def docs(spark, rows):
    """Odd cases, repeated rows, and an extra column whose name clashes with results."""
    from pyspark.sql import functions as F
    return spark.createDataFrame(rows, DOCS).withColumn("score", F.lit(1)).repartition(5).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)

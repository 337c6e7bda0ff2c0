"""Tables of edge cases, as fixtures. Not a conftest: two modules of that name would hide one another."""

import pytest
from pyspark.sql import functions as F

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "one two three four five six seven eight nine ten " * 3000 + "\n" + " ".join(f"w{i}" for i in range(20000))
PROSE = " ".join(f"word{i} and" for i in range(60))


@pytest.fixture
def edge_rows():
    """Nulls in any column, empty and long texts, copies, repeated rows, shared ids."""
    texts = [
        (1, PROSE, "en", "src1"), (2, PROSE, "en", "src2"), (2, PROSE, "en", "src2"), (3, None, "en", "src1"), (4, "", "de", "src3"), (5, " \n\t ", None, None),
        (None, PROSE + " more", "en", "src1"), (None, None, None, None), (6, LONG, "fr", "src0"), (7, "Ünïcödé ﬀ \U0001f600 déjà vu " + PROSE, "fr", "other"), (1, "another text of the same id " + PROSE, "en", "src1"),
    ]
    return [(i, t, lang, source, None if t is None else len(t)) for i, t, lang, source in texts]


@pytest.fixture
def edge(spark, edge_rows):
    """With more columns, named like those that operators make."""
    docs = spark.createDataFrame(edge_rows, COLUMNS)
    clashes = "score label kept rank fp anchor item_id hash budget place domain epoch words found owner digest word n b row".split()
    return docs.select("*", *[F.lit(f"mine {c}").alias(c) for c in clashes])


@pytest.fixture
def nothing(spark):
    return spark.createDataFrame([], COLUMNS)


@pytest.fixture
def labels(spark):
    rows = [(i, i % 2, int(i % 3 == 0)) for i in (1, 2, 4, 6, 7)] + [(1, 1, 1), (None, 1, 0), (4, None, None), (99, 0, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")

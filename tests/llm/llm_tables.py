"""Small tables with every awkward case; their extra columns clash with names the operators use inside."""
import pytest

LONG = "wort " * 30_000
SOLID = "abcdefghij" * 12_000
TWICE = " ".join(f"word{i} and more" for i in range(60))
DOC_SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, id long, th long, fp string, "
              "tokens int, words string, region string, value int, language string, text_hash string")


def doc(i, text, lang="en", source="src1"):
    return (i, text, lang, source, None if text is None else len(text), 7, 7, "x", 1, "y", "z", 3, "q", "r")


EDGE_TEXTS = [(0, None), (1, ""), (2, " \t\n "), (3, "short one"), (4, SOLID), (5, LONG), (6, TWICE), (7, TWICE + " tail"),
              (7, TWICE + " tail"), (8, "Ünïcödé ▁ 日本 \U0001d518 " + TWICE), (None, TWICE), (9, "x"), (10, "a  b   c ")]


@pytest.fixture(scope="session")
def edge_docs(spark):
    rows = [doc(i, t) for i, t in EDGE_TEXTS]
    rows[3] = (*rows[3][:2], None, None, None, *rows[3][5:])
    return spark.createDataFrame(rows, DOC_SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns whose names operators use inside or return.
CLASHES = "n_words kept size row block u v key label score _row _words target copies text_ doc n".split()

SENTENCE = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen"


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls in any column, empty and blank texts, long ones, ties and repeated rows."""
    own = " ".join(f"w{i}" for i in range(40))
    long = " ".join(f"x{i % 997}y{i % 13}" for i in range(30_000))
    rows = [
        (1, SENTENCE, "en", "a"),
        (2, "Extra " + SENTENCE + " tail", "en", "a"),
        (3, None, "en", "b"),
        (4, "", "de", "b"),
        (5, " \t\n\x0b\f\r ", "de", None),
        (6, SENTENCE, None, "a"),
        (6, SENTENCE, None, "a"),
        (7, own, "fr", None),
        (7, own + " but this one differs", "fr", None),
        (None, SENTENCE + " null id", "en", "a"),
        (None, SENTENCE + " null id", "en", "a"),
        (None, None, None, None),
        (8, long, "en", "c"),
        (9, long + " end", "en", "c"),
        (10, "a b   café \U0001f600 <|endoftext|> \x1c \x85", "en", "d"),
        (-3, "short text", "en", "d"),
        (11, "Short TEXT", "en", "d"),
        (12, ("again and again and again " * 30).strip(), "en", "d"),
        (13, "x" * 5000, "en", "d"),
        (14, "line one\nline one\n\nline two\r\n$$$ ### <b>|</b>", "es", "a"),
    ]
    return [(*r, None if r[1] is None else len(r[1])) for r in rows]


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(edge_rows, DOCS)
    return df.withColumns({c: F.lit(f"own {c}") for c in CLASHES})


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def sample_docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")

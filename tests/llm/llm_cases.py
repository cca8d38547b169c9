"""Small tables with the cases every operator must stand: NULLs in any column,
empty and very long texts, ties, repeated rows, and columns with clashing names."""

import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "lorem ipsum dolor sit amet consectetur " * 20_000  # 780,000 characters

EDGE_ROWS = [
    (1, "The quick brown fox jumps over the lazy dog. It ran home.", "en", "src1", 57),
    (2, "The quick brown fox jumps over the lazy dog. It ran home.", "en", "src1", 57),
    (2, "The quick brown fox jumps over the lazy dog. It ran home.", "en", "src1", 57),  # repeated row
    (3, "The  quick brown\tfox jumps over the lazy\ndog. It ran home.", None, "src2", None),
    (4, "", "de", "src2", 0),
    (5, None, "de", None, None),
    (None, "A text without an id, alone in the table.", "en", "src3", 41),
    (None, None, None, None, None),
    (6, LONG, "la", "src0", len(LONG)),
    (7, LONG + "end", "la", "src0", len(LONG) + 3),
    (8, "é 12 \U0001f600 ß naïve ünïcödé tëxt wîth áccents", "fr", "src4", 40),
    (9, " \t\r\n ", "en", "other", 5),
    (10, "one", "en", "src1", 3),
    (-11, "two words", "en", "src1", 9),
]


@pytest.fixture(scope="session")
def edge_docs(spark):
    return spark.createDataFrame(EDGE_ROWS, DOC_SCHEMA)


@pytest.fixture(scope="session")
def clashing_docs(edge_docs):
    """The same rows with further columns named like outputs and internals."""
    from pyspark.sql import functions as F
    names = ["size", "Shard", "slot", "virtual_slot", "epoch", "score", "digest", "fp", "salt", "norm", "spans",
             "n_email", "key", "tokens", "domain", "label", "stats", "_mix_epochs", "_stay_id", "a.b", "component_id"]
    return edge_docs.select("*", *[F.lit(f"x{i}").alias(n) for i, n in enumerate(names)])


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


@pytest.fixture(scope="session")
def sf():
    import os
    path = "/root/testdata/sf0.001"
    if not os.path.exists(path):
        pytest.skip("driver test data not present")
    return path


def rows_of(df, *cols):
    """Rows as sorted tuples."""
    df = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((x is None, str(x)) for x in r))

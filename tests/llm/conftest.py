import pytest
from pyspark.sql import types as T


@pytest.fixture(scope="session")
def shipped(spark):
    from lineark.session import ship_package
    ship_package(spark)
    return spark


#: whole texts that every text operator must take: null, empty, blank, one word, marks and other scripts,
#: a repeated row, ties, and a very long text
EDGE_TEXTS = [None, "", "   ", "word", "Word", "a  b\n\nc \t d", "ÄÖ é́ ☃ 漢字  x ▁y", "x" * 5000, "la " * 20000, "<s> <unk> </s> <0x0A>"]


@pytest.fixture(scope="session")
def edge_docs(shipped):
    """documents with extra columns whose names clash with the operators' own."""
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("source", T.StringType()),
                           T.StructField("n_chars", T.LongType())] + [T.StructField(c, T.StringType()) for c in ("k", "t", "id", "label", "score", "n", "h")])
    rows = [(i, t, None if i == 3 else "s", None if i == 2 else len(t or ""), *"abcdefg") for i, t in enumerate(EDGE_TEXTS)]
    rows += [(4, "Word", "s", 4, *"abcdefg"), (None, "no id here", "s", 10, *"abcdefg"), (None, None, None, None, *"abcdefg")]
    return shipped.createDataFrame(rows, schema)

import pytest
from pyspark.sql import types as T

#: Columns whose names the operators use inside.
CLASHING = ["row", "id", "n", "token", "size", "words", "key", "kind", "copies", "need", "_row"]


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table from (doc_id, text[, source, lang]) with columns whose names clash."""
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("source", T.StringType()),
                           T.StructField("lang", T.StringType()), *[T.StructField(c, T.StringType()) for c in CLASHING]])

    def make(rows):
        full = [(*row, *[None] * (4 - len(row)), *["x"] * len(CLASHING)) for row in rows]
        return spark.createDataFrame(full, schema).repartition(3) if full else spark.createDataFrame([], schema)

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty, blank and very long texts, ties and repeated rows."""
    long = " ".join(f"word{k % 977} Other{k % 31}." for k in range(30_000))
    return [(1, None), (2, ""), (3, " \t\n"), (4, "One two three four five six."), (5, "one TWO three four five six."), (5, "one TWO three four five six."),
            (None, "one two three four five six."), (None, None), (6, "solo"), (7, "Solo"), (8, long), (9, long + " end"), (10, "\u0001 äß \U0001F600 x"),
            (11, "no relation to any other text of this table at all, it says")]

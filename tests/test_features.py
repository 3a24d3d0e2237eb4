"""Entries without words, text or publisher."""

from minewright.registry import load_all
from tests.oracle import compare, duck


def test_entries_without_words_have_the_features_of_the_sql(spark, tmp_path):
    rows = [(1, "Re.", "a"), (2, "", "a"), (3, None, "b"), (4, "LOUD NEWS today", None), (5, None, None), (6, "Plain words here", "c")]
    spark.createDataFrame(rows, "doc_id LONG, text STRING, source STRING").toPandas().to_parquet(f"{tmp_path}/documents.parquet")
    ok, message = compare(spark, duck(str(tmp_path)), load_all()["entry_features"], str(tmp_path))
    assert ok, message

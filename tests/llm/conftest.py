import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """Documents from {id: text} or [(id, text)], with the columns of the table."""

    def build(texts):
        rows = list(texts.items()) if isinstance(texts, dict) else texts
        return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], SCHEMA)

    return build


@pytest.fixture
def odd(spark, documents):
    """Null ids and texts, empty and blank texts, a repeated row, one very long word, a clashing column."""
    long = "x" * 50_000
    rows = [(1, None), (2, ""), (3, " \n\t"), (None, "a b c d e f g"), (4, "a b c d e f g"), (4, "a b c d e f g")]
    df = documents([*rows, (5, long), (6, "é à ü ñ 日本 👍 " * 30)])
    from pyspark.sql import functions as F

    return df.withColumn("_row", F.lit(7)).withColumn("score", F.lit("x")).withColumn("__text", F.lit(None).cast("int"))

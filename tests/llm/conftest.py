import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                       T.StructField("n_chars", T.LongType())])


@pytest.fixture
def make(spark):
    """Documents from (doc_id, text[, source]) rows, with extra columns of clashing names."""
    def build(rows, extra=()):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "a", len(r[1] or ""), *(7 for _ in extra))
                for r in rows]
        schema = T.StructType([*SCHEMA.fields, *(T.StructField(c, T.IntegerType()) for c in extra)])
        return spark.createDataFrame(full, schema)
    return build


@pytest.fixture(scope="session")
def odd_texts():
    """Null, empty, blank, tied, repeated, non-ASCII, special and very long texts."""
    words = "the river and a stone that was said to the wind over old hills".split()
    long = " ".join(words[(i * i + i // 7) % len(words)] for i in range(60_000))
    return [None, "", " \n\t ", "one", "one two", "one two three", "one two three", "ONE Two thRee",
            "É K x　y \x1c z 漢字 😀😀 don't I'll 12345 <|endoftext|>!!  ok\n\n\n  a",
            "A" * 5000, "line\nline\nother\nline\n\n\n", long, long]

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """Builds a documents table from (doc_id, text[, source]) tuples."""
    def build(rows, extra=False):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, SCHEMA)
        if extra:
            from pyspark.sql import functions as F
            for name in ("ids", "n_tokens", "hash", "length", "n", "size", "members", "fp", "key", "rid", "tokens",
                         "item_id", "score", "html", "host", "pos", "words", "keep_id", "component_id"):
                df = df.withColumn(name, F.lit("clash"))
        return df
    return build

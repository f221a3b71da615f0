import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) pairs, with the columns of the table
    and extra ones whose names the operators use inside."""
    def make(rows, extra=True):
        full = [(i, t, "en", "s", len(t or "")) for i, t in rows]
        df = spark.createDataFrame(full, DOCS)
        if extra:
            from pyspark.sql import functions as F
            for name in ("rep", "pos", "n", "score", "kept", "line", "t", "y", "part"):
                df = df.withColumn(name, F.lit("x"))
        return df
    return make


@pytest.fixture(scope="session")
def sample(spark):
    """Driver documents of the smallest scale as (doc_id, text)."""
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    return sorted((r["doc_id"], r["text"]) for r in rows)


EDGE = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one two"), (5, "one two"), (5, "one two"), (None, "null id text here"),
    (6, "a" * 300), (7, "word " * 30_000), (8, "é" * 150 + "\n" + "é" * 150), (9, "\n\n\n"),
]


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls, empty and very long texts, ties and repeated rows."""
    return list(EDGE)

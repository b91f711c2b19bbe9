import pytest
from llm_helpers import prose
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def docs_of(spark):
    """A frame like documents from texts, with columns that have the operators' own names."""
    def make(texts, langs=None, clash=True, first=0):
        rows = [(first + i, t, (langs or ["en"] * len(texts))[i], f"src{i % 3}" if i % 4 else None, len(t or "")) for i, t in enumerate(texts)]
        df = spark.createDataFrame(rows, DOCS)
        if clash:
            for name in ("score", "_id", "_text", "_w", "_node", "_gone", "_bad", "shard", "n_words", "_at", "_part", "size", "_label", "toxicity_score", "_body"):
                df = df.selectExpr("*", f"'x' AS {name}")
        return df
    return make


@pytest.fixture(scope="session")
def odd_texts():
    long = prose(1, 30_000)
    return [None, "", "   \n\t ", "a", "one two", "Ünï cödé 🙂 \u00a0 x", long, long, "same same same " * 40, "=" * 3000,
            "a\x00b\x1fc", "<|endoftext|> <s>", "line\nline\n\nline", prose(2, 300), prose(2, 300) + " tail"]

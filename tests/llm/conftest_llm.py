import pytest
import public_tokenizers
from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"
DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])
BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")

# Nulls, empty and white texts, repeated rows, one id with two texts, ties, odd characters, a long text.
ROWS = [
    (1, "one two three four five six"), (1, "one two three four five six"), (1, "another text of the same id"),
    (None, "one two three four five six"), (2, None), (None, None), (3, ""), (4, " \n\t "), (5, "İ K ſ   x y \x1c z"),
    (6, "ﬁ é É<|endoftext|>tail  <|endoftext|> ퟿ 🙂"), (7, "word " * 30_000), (8, "don't  we'll\r\n\r\n\tgo 123 45"),
    (9, "#*$%&|<> " * 60), (10, "a" * 5000),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with every awkward case, and columns whose names clash with results."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(ROWS, DOCS)
    for name in ("digest", "pos", "n_words", "shard", "slot", "size", "label", "node", "class_id", "verdict", "host", "_row"):
        df = df.withColumn(name, F.lit("kept?"))
    return df


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def plain(text):
    """Lower-case A-Z and the words of op4, op7 and op9, the plain way."""
    import re

    table = {c: c + 32 for c in range(65, 91)}
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(table))

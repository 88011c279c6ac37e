import pytest
from pyspark.sql import functions as F

EDGES = [
    (5, None), (1, ""), (2, " \t\n "), (3, "a"), (3, "a"), (None, "a  b\n"), (None, None),
    (9, "It's  a'll wörd,  x!! 漢字\x00 <|endoftext|> 123."), (10, "na" * 6000),
    (11, "long words " * 3000), (12, "A\tB"), (13, "A B"), (2**40, "It's the end.\r\n\r\n"),
]


@pytest.fixture
def edge_docs(spark):
    """Documents with NULLs, empty and long texts, repeated rows and columns of clashing names."""
    names = ["n", "kept", "score", "part", "digest", "label", "ids", "h", "fingerprint", "length"]
    frame = spark.createDataFrame(EDGES, "doc_id long, text string")
    return frame.select("*", *[F.lit("x").alias(name) for name in names])


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, score string")


@pytest.fixture(scope="session")
def small_docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


def found(df, *columns):
    key = lambda row: [(v is not None, v) for v in row]
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=key)

import duckdb
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])
#: Names that the operators use for columns of their own.
CLASHING = ("_row", "_words", "_w", "kept", "size", "start", "base", "added", "id", "label", "h", "fp", "items", "s", "_id", "_text")


def hard_rows():
    """Nulls in every column, empty and very long texts, ties and repeated rows."""
    prose = " ".join(f"word{i}" for i in range(80))
    return [
        (1, prose, "en", "a", len(prose)), (1, prose, "en", "a", len(prose)), (2, prose, None, "a", None), (None, prose, "en", None, 3),
        (None, None, None, None, None), (3, None, "en", "b", 0), (4, "", "en", "b", 0), (5, " \t\n\x0b\x0c\r", "en", "b", 6),
        (6, LONG, "en", None, len(LONG)), (7, "one", "en", "", 3), (8, "one two", "en", "b", 7), (-9, prose + " end", "en", "b", 9),
        (9, "é 漢字 𝄞 token: abcdef123", "en", "b", 20), (9, "another text of the same id", "en", "b", 20),
    ]


@pytest.fixture(scope="session")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


@pytest.fixture(scope="session")
def hard(spark):
    frame = spark.createDataFrame(hard_rows(), DOCUMENTS)
    return frame.withColumns({c: F.lit("mine") for c in CLASHING})


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCUMENTS)


@pytest.fixture(scope="session")
def duck(sf_dir):
    con = duckdb.connect()
    for t in "documents embeddings pages benchmark labels conversations".split():
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con

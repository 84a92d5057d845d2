import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
LONG = " ".join(f"wört{k % 977}x{k}" for k in range(9000))


@pytest.fixture(scope="session")
def plain(spark):
    """sf0.001 documents as {doc_id: text}."""
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


@pytest.fixture(scope="session")
def odd_rows(plain):
    """Rows that hold every awkward case: nulls, empty and blank texts, repeats, ties, a very long text."""
    a = plain[0]
    rows = [(k, t) for k, t in sorted(plain.items()) if k < 60]
    rows += [(1000, None), (1001, ""), (1002, " \n\t "), (1003, a), (1003, a), (1004, a + " tail"), (1005, LONG), (1006, LONG + " more"), (1007, "one"), (1008, "One two"), (1009, "é" * 150 + " x"), (1010, "é" * 150 + " y")]
    return rows


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    """The awkward rows with extra columns whose names clash with those that operators make."""
    rows = odd_rows + [(None, "no id at all, token = abcdefgh12345"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for name in ("version", "key", "n", "h", "term", "pos", "row", "path", "blob", "start", "end", "id", "component", "gram", "score"):
        df = df.withColumn(name, F.lit("clash"))
    return df.repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string")

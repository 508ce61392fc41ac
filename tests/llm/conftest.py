import pytest
from pyspark.sql import types as T


@pytest.fixture(scope="session")
def docs(spark):
    """A maker of document tables from (doc_id, text), with columns whose names the operators use themselves."""
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])

    def make(rows, parts=3):
        from pyspark.sql import functions as F

        return spark.createDataFrame(rows, schema).repartition(parts).withColumns(
            {c: F.lit(7) for c in ("id", "hash", "block", "kept", "_id", "n", "simhash", "b", "component_id", "removed", "pii", "w")}
        )

    return make


#: Texts with nulls, empty and long ones, ties and repeated rows.
EDGES = [
    (1, None), (2, ""), (3, " \t\n "), (None, "some words without an id"), (None, None), (4, "a"), (4, "a"), (4, "b"),
    (5, "x" * 70_000), (6, "one two three four five six seven " * 3_000), (6, "one two three four five six seven " * 3_000), (7, "é🙂 " * 40), (8, "\x00\x01 control"),
]


@pytest.fixture(scope="session")
def edges():
    return EDGES

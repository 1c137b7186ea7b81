"""Explicit schemas of every file the engine reads; nothing is inferred."""

from pyspark.sql import types as T


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


TOPICS_RAW = _strings("Id", "Title", "Body")
TOPICS_SIMPLE = _strings("query_id", "query")
TOPICS_MIXED = _strings("query_id", "query", "Id", "Title")
ANSWERS_RAW = _strings("Id", "Text")
ANSWERS_SIMPLE = _strings("doc_id", "doc")

PAIRS = T.StructType(
    _strings("query", "query_id", "doc", "doc_id").fields
    + [T.StructField("score", T.IntegerType()), T.StructField("split", T.StringType())]
)

RUN = T.StructType(
    [
        T.StructField("query_id", T.StringType()),
        T.StructField("q0", T.StringType()),
        T.StructField("doc_id", T.StringType()),
        T.StructField("rank", T.IntegerType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("tag", T.StringType()),
    ]
)

#: The run table: a run's rows with the result set that they belong to, whose columns name the folders.
RUNS = T.StructType(
    [
        *[f for f in RUN.fields if f.name != "tag"],
        T.StructField("system", T.StringType()),
        T.StructField("topic_set", T.IntegerType()),
        T.StructField("tag", T.StringType()),
    ]
)

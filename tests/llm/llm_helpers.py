"""Small tables with the awkward rows that every operator has to take."""

from pyspark.sql import types as T

LONG = "lorem ipsum dolor sit amet " * 8000

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
])


def documents(spark, rows, extra=()):
    """A table of documents from (doc_id, text); ``extra`` names clashing columns."""
    schema = T.StructType([*SCHEMA.fields, *(T.StructField(c, T.StringType()) for c in extra)])
    full = [(i, t, "en", "s", None if t is None else len(t), *("x" for _ in extra)) for i, t in rows]
    return spark.createDataFrame(full, schema)


AWKWARD = [
    (1, "the quick brown fox"), (1, "the quick brown fox"), (2, None), (3, ""), (4, " \t\n "),
    (None, "no id here"), (None, None), (5, LONG), (6, "one"), (7, "naïve café 日本語 😀"),
    (8, "a\x00b\x1cc"), (9, "x" * 20000), (10, "the quick brown fox"),
]


def collected(df):
    return [r.asDict() for r in df.collect()]


def by_id(df, key="doc_id"):
    return {r[key]: r for r in collected(df)}

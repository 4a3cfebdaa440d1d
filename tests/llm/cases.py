"""Rows that every operator must bear: nulls, empty and very long texts, repeats, odd columns."""

from __future__ import annotations

from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Names that the operators use for their own columns.
        T.StructField("id", T.StringType()),
        T.StructField("size", T.DoubleType()),
        T.StructField("rep.fp", T.StringType()),
    ]
)

LONG = "Plain words follow each other in a very long text. " * 20_000


def rows():
    texts = [
        (1, "The cat sat on the mat and looked at the dog.", "en", "a"),
        (2, "The cat sat on the mat and looked at the dog.", "en", "a"),
        (2, "The cat sat on the mat and looked at the dog.", "en", "a"),
        (3, None, None, None),
        (4, "", "en", "b"),
        (None, "Keine Angabe zur Nummer, aber ein Text.", "de", "b"),
        (None, None, None, None),
        (5, " \n\t ", None, "b"),
        (6, LONG, "en", "c"),
        (7, "*** ### 123 456", "de", None),
        (8, "\U0001f600 émoji Ünïcode İstanbul\x00 nul", "fr", "c"),
    ]
    return [(i, t, lang, s, None if t is None else len(t), "x", 1.5, None) for i, t, lang, s in texts]


def frame(spark, data=None):
    return spark.createDataFrame(rows() if data is None else data, SCHEMA)


def texts(spark, *values):
    """A table of the given texts under ids from 0."""
    return frame(spark, [(i, t, "en", "a", None, None, None, None) for i, t in enumerate(values)])


def empty(spark):
    return frame(spark, [])


def collected(df, *key):
    return {tuple(r[k] for k in key) if len(key) > 1 else r[key[0]]: r.asDict() for r in df.collect()}

"""Rows that every operator must take: nulls, empty and very long texts, ties, repeated rows, clashing columns."""

from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

SCHEMA = StructType([
    StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType()),
    StructField("source", StringType()), StructField("n_chars", LongType()),
    # names that operators use themselves
    StructField("size", StringType()), StructField("score", DoubleType()), StructField("language", StringType()),
    StructField("n_words", StringType()), StructField("weight", StringType()), StructField("class_id", StringType()),
    StructField("kept", StringType()), StructField("spans", StringType()), StructField("n_tokens", StringType()),
    StructField("_Quality", StringType()), StructField("QUALITY", StringType()), StructField("_row", StringType()),
    StructField("_ROWID", StringType()), StructField("Text_Node", StringType()), StructField("keep_id", StringType()),
    StructField("keep_node", StringType()), StructField("_MIX", StringType()), StructField("_mixr", StringType()),
    StructField("Mix", StringType()), StructField("rate", StringType()), StructField("e", StringType()),
    StructField("ids", StringType()), StructField("node", StringType()), StructField("first_id", StringType()),
])


def row(doc_id, text, lang="en", source="a"):
    return (doc_id, text, lang, source, None if text is None else len(text), "x", 1.5, "y", "z", "w", "c", "k", "s", "t",
            *"abcdefghijklmno")


LONG = " ".join(f"word{i % 977} the of and" for i in range(20_000))
TEXTS = ["", None, " \t\n", "a", "é", "手机 😀 text", "the of and to " * 40, "the of and to " * 40, LONG, LONG,
         "der die das und nicht " * 30, "x" * 5000, "1234 !! ## $$", "line one\nline one\nline two\n\n" * 5]


def edge_rows():
    rows = [row(i, t, "de" if t and t.startswith("der") else "en", "ab"[i % 2]) for i, t in enumerate(TEXTS)]
    rows += [row(None, "no id here", None, None), row(None, None, None, None), row(6, TEXTS[6]), row(6, TEXTS[6]),
             row(3_000_000_000, "big id", "en", None), row(-5, "negative id", None, "a")]
    return rows


def edge_frame(spark, n=4):
    return spark.createDataFrame(edge_rows(), SCHEMA).repartition(n)


def empty_frame(spark):
    return spark.createDataFrame([], SCHEMA)

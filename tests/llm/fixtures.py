"""Small tables with the awkward cases every operator must define."""

from pyspark.sql import types as T

# Names that the operators use inside are extra columns here, with other types.
CLASH = ["id", "fp", "node", "component", "part", "at", "n", "t", "l", "h", "size", "shard", "vec", "code", "rank", "words"]

DOC = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                    T.StructField("n_chars", T.LongType()), *[T.StructField(c, T.StringType()) for c in CLASH]])

EN = "the cat and the dog went with their friends over the hill when it was late in the evening and cold "
DE = "der hund und die katze gingen mit ihren freunden über den hügel als es spät am abend war und kalt "


def doc(doc_id, text, lang="en", source="a"):
    return (doc_id, text, lang, source, len(text or ""), *["x" for _ in CLASH])


def awkward():
    """Nulls in every column, empty and very long texts, ties, repeated rows and repeated ids."""
    long = " ".join(f"word{i % 977} the and {i}" for i in range(60_000))
    rows = [doc(i, EN + f"number {i}", "en", f"s{i % 3}") for i in range(0, 60)]
    rows += [doc(i, DE + f"nummer {i}", "de", "s1") for i in range(60, 100)]
    rows += [doc(100, None), doc(101, ""), doc(102, " \t\r\n\x0b\x0c "), doc(103, "1234 !!! 5678"), doc(104, long),
             doc(105, EN), doc(106, EN), doc(106, EN), doc(107, "one two"), doc(108, "Ünï çødé   \x00 😀 <|endoftext|>"),
             doc(None, EN + "no id"), doc(None, None), doc(109, EN + "x", None, None), (110, *[None] * (len(DOC) - 1)),
             (None, *[None] * (len(DOC) - 1))]
    return rows


def docs_df(spark, rows=None):
    return spark.createDataFrame(awkward() if rows is None else rows, DOC)


def empty(df):
    return df.sparkSession.createDataFrame([], df.schema)

"""Rows that every operator must take."""

from pyspark.sql import types as T

FOLDER = "/root/testdata/sf0.001"
DOC = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())]
)
LONG = " ".join(f"w{i % 9000}" for i in range(30_000))
#: Nulls, empty, blank and very long texts, ties, repeated rows, odd characters.
ODD = [
    (1, None, None, None, None), (2, "", "en", "a", 0), (3, " \t\n", "en", "a", 3), (4, "one", "en", None, 3),
    (5, LONG, "en", "b", len(LONG)), (6, LONG + " tail", "en", "b", 1), (6, LONG + " tail", "en", "b", 1),
    (None, "no id at all but some words to read here and there", "en", "a", 5), (8, "a b c d e f g h i j a b c d e f g h i j", "en", "c", 1),
    (9, "A b C d e f g h i j a b c d e f g h i j", "de", "c", 1), (10, "x\x85y z \U0001F600 <|endoftext|> don't\x00", "en", "c", 1),
    (11, "l1 is a line\nl1 is a line\n\nl1 is a line", "en", "c", 1), (-12, "Licensed under CC BY-NC 4.0.", "en", "c", 1),
]

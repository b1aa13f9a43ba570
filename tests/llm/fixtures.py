"""Small tables with every awkward case: nulls, empty and blank texts, repeated rows, clashing extra columns."""

from pyspark.sql import types as T

#: Names that operators use inside.
CLASHING = ["fp", "text_hash", "root", "lm_bits", "lm_kept", "cell", "extra_0", "secret_spans", "rank", "shingle", "length", "id"]
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()), *(T.StructField(c, T.StringType()) for c in CLASHING)])

LONG = " ".join(f"word{k % 997} and" for k in range(30_000))
TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog, isn't it?\nIt's 1234 of them!!", "en"),
    (2, None, "en"), (3, "", None), (4, " \n\t ", "de"), (5, "É école à São<|endoftext|> Paulo… 漢字   x", "fr"),
    (5, "É école à São<|endoftext|> Paulo… 漢字   x", "fr"), (None, "no id here but some words follow on", "en"), (None, None, None),
    (6, LONG, "en"), (7, "a", "en"), (8, "don't   stop\r\n\r\nwe'll GO'S 'tis <|endoftext|>", "en"),
]


def rows(texts=TEXTS):
    return [(i, t, lang, "s", len(t) if t is not None else None, *("x" for _ in CLASHING)) for i, t, lang in texts]


def documents(spark, texts=TEXTS):
    return spark.createDataFrame(rows(texts), SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)

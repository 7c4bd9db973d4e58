"""Hand-made documents with the edge cases every operator must take."""

from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType()), T.StructField("Score", T.StringType()),
                     T.StructField("secrets", T.StringType())])

TEXTS = [
    None, "", " ", "  two  spaces  ", "plain words only", "tab\tnew\nline\r\x0bx\x0cend", "▁ marked ▁▁ text▁",
    "Ünïcode straße İstanbul ΣΑΣ ① ½ 日本語 🙂 é", "<|endoftext|> </s> <s> <unk>", "a\x1cb c\x00d",
    "don't WE'LL o'clock 3.14 foo_bar x²", "word " * 3000, "x" * 5000, "same text twice", "same text twice",
]


def docs(spark, texts=TEXTS, langs=("en", None, "fr")):
    """Extra columns clash with output names; one id is null."""
    rows = [(i, t, langs[i % len(langs)], "s", len(t or ""), "clash", "clash") for i, t in enumerate(texts)]
    return spark.createDataFrame([*rows, (None, "no id here", "en", None, None, None, None)], DOCS)


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)

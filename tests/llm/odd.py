"""A small table with every oddity: nulls in each column, empty and long texts, repeated rows, clashing column names."""

LONG = " ".join(f"word{i % 977} and line {i}" for i in range(30_000))
TEXT = " ".join(f"term{i}" for i in range(60))
ROWS = [
    (1, TEXT, "en", "a", 1), (1, TEXT, "en", "a", 1), (2, TEXT, "en", "a", 1), (3, None, "en", "a", None), (4, "", None, "a", 0), (5, "   \n\n ", "fr", None, 5), (None, TEXT + " end", "en", "b", 2), (None, None, None, None, None),
    (6, LONG, "de", "b", 3), (7, "é ü <|endoftext|> <|im_end|> 漢字 😀", None, "b", 9), (8, "word " * 400, "es", "c", 7), (9, "12 34 !!", "es", "c", 8),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = ["page", "row", "fp", "content", "kept_text", "n_dropped", "lang_pred", "score", "length", "part", "anchors", "base", "h", "text_", "kind", "node", "component_id"]


def docs(spark, rows=ROWS, clashing=True):
    df = spark.createDataFrame(rows, SCHEMA)
    if clashing:
        from pyspark.sql import functions as F

        df = df.select("*", *[F.lit(f"own {c}").alias(c) for c in CLASHING])
    return df

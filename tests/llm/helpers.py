"""Small tables with everything an operator must bear."""

from pyspark.sql import functions as F

LONG = " ".join(f"w{i % 977}" for i in range(30_000))


def documents(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def awkward(spark):
    """Nulls in every column, empty and long texts, repeated rows, one id with two texts."""
    return documents(spark, [
        (None, "no id here but words", "en", "s", 5), (1, None, None, None, None), (2, "", "en", "s", 0),
        (3, " \t\n ", "en", "s", 4), (4, LONG, "en", "s", len(LONG)), (5, LONG + " end", "fr", None, 1),
        (6, "one", "fr", "t", 3), (6, "one", "fr", "t", 3), (7, "first text", "fr", "t", 3), (7, "second text", "de", "t", 3),
        (8, "!!! ... 123", None, "t", 3), (None, None, None, None, None),
    ])


def clashing(df):
    """More columns, named like those that operators make or use."""
    names = ("n_words", "name", "place", "size", "score", "bucket", "kept", "n", "host", "rule", "words", "target", "copies",
             "text_key", "least", "_id", "path", "digest", "bytes", "first", "at", "toxic", "n_hit", "label",
             "_own", "_found", "_host", "_rejected", "_chance", "_source", "_of", "_gone_id", "_gone_key", "_key", "_text", "_row",
             "source_size", "rate", "copy", "n_removed", "kept_text", "base_failed", "whole", "item_ids", "_split", "spans")
    return df.withColumns({n: F.lit("x") for n in names if n not in df.columns})

"""Documents that every operator must take, and frames made of them."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = "Some words of a very long text, again and again. " * 3000
ROWS = [
    (5, "the quick brown fox jumps over the lazy dog", "en", "b", 43),
    (3, "the quick brown fox jumps over the lazy dog", "en", None, 43),
    (9, "the quick brown fox jumps over the lazy dog.", None, "b", None),
    (None, "the quick brown fox jumps over the lazy dog", "en", "b", 43),
    (7, None, "de", "a", None),
    (8, "", None, "a", 0),
    (2, " \t\n", "fr", "a", 3),
    (4, "Ça va? <|endoftext|> don't  stop\n\nnow 12 日本語", "fr", "c", 40),
    (4, "Ça va? <|endoftext|> don't  stop\n\nnow 12 日本語", "fr", "c", 40),
    (6, LONG, "en", "c", len(LONG)),
    (1, "one", "en", "d", 3),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows=ROWS):
    return spark.createDataFrame(rows, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def clashing(spark, *names):
    """The documents with more columns, of the names given."""
    from pyspark.sql import functions as F

    return documents(spark).withColumns({n: F.lit("x") for n in names})


def rows_of(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)

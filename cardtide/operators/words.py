"""Word counts over a text column."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def word_count(df: DataFrame, column: str) -> DataFrame:
    """``word, n``: lower-cased words reduced to letters a-z and digits; empty ones are dropped.

    The text is cleaned once as a whole, not word by word; the words of a text are streamed out
    of the generator, so its length does not matter.
    """
    cleaned = F.regexp_replace(F.lower(F.col(column)), r"[^a-zA-Z0-9\s]", "")
    words = df.select(F.explode(F.split(cleaned, r"\s+")).alias("word")).where(F.col("word") != "")
    return words.groupBy("word").agg(F.count("*").alias("n"))

"""OP14-OP15 in row form: one row per sentence with its index, score and
token count (the array form used for selection lives in functions/compress).

A narrow Generate: each document's sentences stay in the task that read the
document; `inline_outer` (the array is never empty) avoids an inferred
`size > 0` filter that would copy the split below the projection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.compress import scored_sentences
from ..functions.text import split_sentences


def sentence_table(df: DataFrame, text_col: str, type_col: str, keys: list[str]) -> DataFrame:
    d = df.select(*keys, F.col(type_col).alias("content_type"), split_sentences(text_col).alias("_s"))
    d = d.withColumn("_sc", scored_sentences(F.col("_s"), F.col("content_type")))
    return d.select(*keys, "content_type", F.inline_outer("_sc")).select(
        *keys, "content_type", "idx", (-F.col("neg_score")).alias("score"), "tok",
        F.col("s").alias("sentence"),
    )

"""OP07: canonical token counts kept in a table, each text counted once for each model.

The store is a committed table (sources/manifest.py) of counts by (text_key, model);
text_key is the SHA-256 of the text.  A pass finds the keys that are not in it by
an anti join of narrow rows, counts only their texts and appends them; a pass that
finds none moves no text.  Counts are then joined to the rows that ask for them,
at the last version or an earlier one.  A text without a stored count (its counter
failed) has the estimate, len // 4.
"""

from __future__ import annotations

import uuid
from typing import Callable, Mapping, Optional

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import estimate_tokens
from ..session import checkpoint_dir
from ..sources.manifest import Commit, commit, read_committed, version

SCHEMA = "text_key string, model string, n bigint"
#: (text, model) -> number of tokens, null where there is no count
Counter = Callable[[Column, Column], Column]


def text_key(text: Column) -> Column:
    return F.sha2(F.encode(text, "UTF-8"), 256)


def model_family(model: Column) -> Column:
    """What stands before the first dash of a model's name."""
    return F.substring_index(model, "-", 1)


def by_family(counters: Mapping[str, Callable[[Column], Column]], default: Optional[Callable[[Column], Column]] = None) -> Counter:
    """A counter for each family of models; other models have the default's count or none."""

    def count(text: Column, model: Column) -> Column:
        # a counter gets null for other models' texts: a Python function is called for all rows, whatever CASE they are in
        found, other = [], F.lit(True)
        for family, counter in counters.items():
            own = model_family(model) == family
            found.append(counter(F.when(own, text)).cast("bigint"))
            other = other & ~own
        if default is not None:
            found.append(default(F.when(other, text)).cast("bigint"))
        return F.coalesce(*found, F.lit(None).cast("bigint"))

    return count


def tokenizer(fn: Callable[[list], list]) -> Callable[[Column], Column]:
    """A counter from a function of texts to counts, called on Arrow batches; a text it fails on has no count."""

    def one(text):
        try:
            return fn([text])[0]
        except Exception:  # noqa: BLE001 - no count is the defined result
            return None

    @F.pandas_udf("bigint")
    def run(texts: pd.Series) -> pd.Series:
        asked = texts[texts.notna()]
        try:
            found = list(fn(list(asked)))
        except Exception:  # noqa: BLE001 - asked one by one
            found = [one(t) for t in asked]
        return pd.Series(found, index=asked.index, dtype="Int64").reindex(texts.index)

    run = run.asNondeterministic()  # never copied into a filter: a text is asked once
    return lambda text: run(text)


def read_counts(spark, store: str, as_of: Optional[int] = None) -> DataFrame:
    return read_committed(spark, store, SCHEMA, ["model"], as_of=as_of)


def count_missing(df: DataFrame, text_col: str, store: str, counter: Counter, model_col: str = "model") -> Commit:
    """Count the texts of df that the store doesn't know for their model; rows is the number of texts counted.

    Null texts and null models are left out.  A text with many copies is counted
    once: copies are dropped before and after the shuffle.
    """
    spark = df.sparkSession
    rows = df.select(text_key(F.col(text_col)).alias("text_key"), F.col(model_col).alias("model"), F.col(text_col).alias("_text"))
    rows = rows.where("text_key is not null and model is not null")
    known = read_counts(spark, store).select("text_key", "model")
    missing = rows.select("text_key", "model").distinct().join(known, ["text_key", "model"], "left_anti")
    todo = rows
    if not known.isEmpty():
        checkpoint_dir(spark)
        missing = missing.checkpoint()
        if missing.isEmpty():
            return Commit(version(spark, store), 0)
        todo = rows.join(missing, ["text_key", "model"], "left_semi")
    texts = todo.groupBy("text_key", "model").agg(F.min("_text").alias("_text"))
    counts = texts.select("text_key", "model", counter(F.col("_text"), F.col("model")).alias("n"),
                          F.monotonically_increasing_id().alias("_row"))
    # a filter is never pushed below a row number: without it each text would be counted again for the filter
    counts = counts.where(F.col("n").isNotNull() & (F.col("_row") >= 0)).drop("_row")
    return commit(counts, store, ["model"], epoch=uuid.uuid4().hex)


def with_token_counts(df: DataFrame, text_col: str, store: str, out: str = "canonical_tokens", model_col: str = "model",
                      as_of: Optional[int] = None) -> DataFrame:
    """df with the stored count of its text, the estimate where the store has none.

    The join moves the rows of df, their texts only where the result's texts are read.
    """
    counts = read_counts(df.sparkSession, store, as_of).select(
        F.col("text_key").alias("_k"), F.col("model").alias("_m"), F.col("n").alias("_n")).dropDuplicates(["_k", "_m"])
    keyed = df.withColumns({"_text_key": text_key(F.col(text_col)), "_estimate": estimate_tokens(text_col)})
    found = keyed.join(counts, (keyed["_text_key"] == counts["_k"]) & (keyed[model_col] == counts["_m"]), "left")
    return found.withColumn(out, F.coalesce("_n", "_estimate")).drop("_k", "_m", "_n", "_text_key", "_estimate")

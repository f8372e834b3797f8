"""OP23-OP27: price resolution, cost, count-and-cost, compression stats and
the accept/reject benchmark rule, as narrow projections."""

from __future__ import annotations

from typing import Optional

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.numeric import compression_pct, estimate_cost, price_lookup, py_round
from ..functions.text import estimate_tokens, lit_


def resolve_price(df: DataFrame, model_col: str = "model", out: str = "price") -> DataFrame:
    """OP23: STRUCT<model_key, input_per_1k, output_per_1k> per row."""
    return df.withColumn(out, price_lookup(F.col(model_col)))


def _substrings(c: str, most: str) -> Column:
    """All substrings of column c of up to `most` (a column) characters, the empty one too, each once."""
    starts = F.sequence(F.lit(1), F.greatest(F.length(c), F.lit(1)))
    sizes = F.sequence(F.lit(0), F.least(F.length(c), F.col(most)))
    cut = F.transform(starts, lambda i: F.transform(sizes, lambda n: F.substring(F.col(c), i, n)))
    return F.array_distinct(F.flatten(cut))


def resolve_price_table(models: DataFrame, prices: DataFrame, model_col: str = "model", default: str = C.DEFAULT_PRICE_MODEL) -> DataFrame:
    """OP23 against a price table of any size: the distinct models with model_key and the table's other columns.

    prices: model_key, ordinal (the order of the list) and prices.  A model has the
    row of its own key; else the first row (by ordinal, then key) whose key is part
    of the model's name or has the name as a part; else the row of `default`, or
    nulls if there is none.  A null model has the default.

    Contained names are found by equality: the names' substrings, up to the length
    of the longest key, meet the keys, and the keys' substrings, up to that of the
    longest name and reduced to the first row of each, meet the names.  Lengths are
    subqueries of the one plan; nothing runs while it is built.
    """
    kept = [c for c in prices.columns if c not in ("model_key", "ordinal")]
    names = models.select(F.col(model_col).alias("_name")).distinct()
    row = F.struct(F.col("ordinal").alias("ordinal"), F.col("model_key").alias("model_key"), *kept)
    listed = prices.where("model_key is not null").groupBy("model_key").agg(F.min(row).alias("_row"))
    longest_key = listed.agg(F.max(F.length("model_key"))).scalar()
    longest_name = names.agg(F.max(F.length("_name"))).scalar()

    parts = names.where("_name is not null").withColumn("_most", F.coalesce(longest_key, F.lit(0)))
    parts = parts.select("_name", F.explode(_substrings("_name", "_most")).alias("_part"))
    holds = parts.join(listed, parts["_part"] == listed["model_key"]).select(
        "_name", F.when(F.col("_part") == F.col("_name"), 0).otherwise(1).alias("_rank"), "_row")
    pieces = listed.withColumn("_most", F.coalesce(longest_name, F.lit(0)))
    pieces = pieces.select("_row", F.explode(_substrings("model_key", "_most")).alias("_piece"))
    first = pieces.groupBy("_piece").agg(F.min("_row").alias("_row"))
    held = names.join(first, names["_name"] == first["_piece"]).select("_name", F.lit(1).alias("_rank"), "_row")
    found = holds.unionByName(held).groupBy(F.col("_name").alias("_of")).agg(F.min(F.struct("_rank", "_row")).alias("_best"))

    fallback = listed.where(F.col("model_key") == default).agg(F.first("_row")).scalar()
    out = names.join(found, names["_name"] == found["_of"], "left").select(
        F.col("_name").alias(model_col), F.coalesce("_best._row", fallback).alias("_row"))
    return out.select(model_col, F.coalesce("_row.model_key", F.lit(default)).alias("model_key"), *[F.col(f"_row.{c}") for c in kept])


def cost_analysis(
    df: DataFrame,
    model_col: str = "model",
    raw_tokens: str = "raw_tokens",
    optimized_tokens: str = "compressed_tokens",
) -> DataFrame:
    """Summary costs at the run model's input price (OP24, OP26)."""
    price = price_lookup(F.col(model_col))
    r, o = F.col(raw_tokens), F.col(optimized_tokens)
    cost_raw, cost_opt = estimate_cost(r, 0, price), estimate_cost(o, 0, price)
    return df.withColumns(
        {
            "price_model": price["model_key"],
            "cost_raw": cost_raw,
            "cost_optimized": cost_opt,
            "cost_saved": cost_raw - cost_opt,
            "compression_pct": compression_pct(o, r),
        }
    )


def count_and_cost(
    df: DataFrame,
    text_col: str,
    model_col: str = "model",
    is_input_col: Optional[str] = None,
    token_col: Optional[str] = None,
) -> DataFrame:
    """OP25: tokens and their cost as input or as output.

    `token_col` lets a precomputed canonical count (OP07) replace len//4.
    """
    price = price_lookup(F.col(model_col))
    tokens = F.col(token_col) if token_col else estimate_tokens(text_col)
    is_input = F.col(is_input_col) if is_input_col else F.lit(True)
    return df.withColumn("tokens", tokens).withColumn(
        "cost",
        F.when(is_input, estimate_cost(F.col("tokens"), 0, price)).otherwise(
            estimate_cost(0, F.col("tokens"), price)
        ),
    )


def benchmark(
    df: DataFrame,
    model_col: str = "model",
    raw_tokens: str = "raw_tokens",
    optimized_tokens: str = "compressed_tokens",
) -> DataFrame:
    """OP27: accuracy = round(o/r-ish, 3); optimized if >= 0.90 else baseline.

    Adds benchmark_accuracy_raw (unrounded), benchmark_accuracy,
    benchmark_strategy and benchmark_cost (the chosen strategy's cost).
    Without a token count nothing is accepted or rejected: all are null.
    """
    price = price_lookup(F.col(model_col))
    r, o = F.col(raw_tokens), F.col(optimized_tokens)
    loss = F.when(r > 0, 1.0 - (o / r)).when(r.isNotNull() & o.isNotNull(), F.lit(0.0))
    acc_raw = 1.0 - loss
    acc = py_round(acc_raw, 3)
    ok = acc >= lit_(C.ACCEPT_ACCURACY)
    return df.withColumns(
        {
            "benchmark_accuracy_raw": acc_raw,
            "benchmark_strategy": F.when(ok, "optimized").when(~ok, "baseline"),
            "benchmark_accuracy": F.when(ok, acc).when(~ok, F.lit(1.0)),
            "benchmark_cost": F.when(ok, estimate_cost(o, 0, price)).when(~ok, estimate_cost(r, 0, price)),
        }
    )

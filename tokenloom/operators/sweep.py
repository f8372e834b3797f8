"""OP33: a grid of configurations (optionally with a forced strategy) and models,
evaluated inside each row.

The grid is a driver-side list of literals, so nothing is joined or shuffled.
Sentences are split, scored and sorted once per document, and one fold over them
carries the budgets of all variants; only sizes come out of it, no text.
"""

from __future__ import annotations

from typing import NamedTuple, Optional, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.compress import (
    chunk_target,
    compress_extractive,
    compress_truncate,
    extract_sizes,
    hierarchical_merge,
    needs_recompress,
    pack_chunks,
    scored_sentences,
    tokens_of_extract,
)
from ..functions.detect import calculate_target, select_strategy
from ..functions.numeric import estimate_cost, price_lookup, py_round
from ..functions.text import estimate_tokens, split_sentences


class Variant(NamedTuple):
    """One point of the grid; forced: a strategy for every row, or None to route by size."""

    name: str
    cfg: C.OptimizerConfig = C.DEFAULT_CONFIG
    forced: Optional[str] = None


def sweep(df: DataFrame, variants: Sequence[Variant], models: Sequence[str] = (C.DEFAULT_MODEL,),
          text_col: str = "norm_text", keys: Sequence[str] = ("doc_id",)) -> DataFrame:
    """One row per (row of df, variant, model); is_best marks the row's cheapest
    variant of each model (ties: the first in the list).

    df has the text, raw_tokens and content_type; a null text gives null results.
    """
    text, tok, ctype = F.col(text_col), F.col("raw_tokens"), F.col("content_type")
    routed = [select_strategy(tok, v.cfg, v.forced) for v in variants]
    target = [calculate_target(tok, v.cfg.target_ratio, v.cfg.max_output_tokens) for v in variants]
    own = [*keys, "raw_tokens", "content_type", text_col]
    d = df.select(
        *own,
        *[s.alias(f"_strategy{i}") for i, s in enumerate(routed)],
        *[t.alias(f"_target{i}") for i, t in enumerate(target)],
    )
    whole = ("extractive", "abstractive")
    single = [i for i, v in enumerate(variants) if v.forced == "hierarchical"]
    scored = F.lit(False)
    for i in range(len(variants)):
        scored = scored | F.col(f"_strategy{i}").isin(*whole, "hierarchical")
    d = d.withColumns({
        "_sizes": F.when(scored, extract_sizes(
            scored_sentences(split_sentences(text), ctype), [F.col(f"_target{i}") for i in range(len(variants))])),
        **{f"_chunks{i}": pack_chunks(text, F.lit(variants[i].cfg.chunk_size)) for i in single},
    })
    d = d.withColumns({
        f"_merged{i}": F.when(
            F.size(f"_chunks{i}") > 1,
            hierarchical_merge(F.col(f"_chunks{i}"), chunk_target(F.col(f"_chunks{i}"), F.col(f"_target{i}")), ctype))
        for i in single
    }) if single else d

    def compressed_tokens(i: int) -> Column:
        strategy, budget = F.col(f"_strategy{i}"), F.col(f"_target{i}")
        extract = tokens_of_extract(F.col("_sizes"), i)
        if i in single:
            merged = F.col(f"_merged{i}")
            again = F.when(needs_recompress(merged, budget), compress_extractive(merged, budget, ctype)).otherwise(merged)
            return F.when(merged.isNull(), extract).otherwise(estimate_tokens(again))
        return (F.when(strategy == "none", tok)
                .when(strategy == "truncate", estimate_tokens(compress_truncate(text, budget)))
                .when(strategy.isin(*whole), extract))

    d = d.select(*own[:-1], *[F.col(f"_{c}{i}") for i in range(len(variants)) for c in ("strategy", "target")],
                 *[compressed_tokens(i).alias(f"_tokens{i}") for i in range(len(variants))])

    def accuracy(i: int) -> Column:
        return py_round(1.0 - F.when(tok > 0, 1.0 - F.col(f"_tokens{i}") / tok).otherwise(0.0), 3)

    d = d.select("*", *[accuracy(i).alias(f"_accuracy{i}") for i in range(len(variants))])
    per_model = []
    for model in models:
        price = price_lookup(F.lit(model))

        def point(i: int) -> Column:
            acc, n = F.col(f"_accuracy{i}"), F.col(f"_tokens{i}")
            ok = acc >= C.ACCEPT_ACCURACY
            return F.struct(
                F.when(ok, estimate_cost(n, 0, price)).when(~ok, estimate_cost(tok, 0, price)).alias("benchmark_cost"),
                F.lit(i).alias("ordinal"), F.lit(variants[i].name).alias("config_name"),
                F.col(f"_strategy{i}").alias("strategy"), F.col(f"_target{i}").alias("target_tokens"),
                n.alias("compressed_tokens"),
                F.when(ok, acc).when(~ok, 1.0).alias("benchmark_accuracy"),
                F.when(ok, "optimized").when(~ok, "baseline").alias("benchmark_strategy"),
            )

        per_model.append(F.struct(F.lit(model).alias("model"), F.array(*map(point, range(len(variants)))).alias("per")))
    d = d.select(*keys, F.inline_outer(F.array(*per_model))).withColumn("best", F.array_min("per")["ordinal"])
    return d.select(*keys, "model", "best", F.inline_outer("per")).select(
        *keys, "model", "config_name", "strategy", "target_tokens", "compressed_tokens",
        "benchmark_accuracy", "benchmark_strategy", "benchmark_cost", (F.col("ordinal") == F.col("best")).alias("is_best"),
    )

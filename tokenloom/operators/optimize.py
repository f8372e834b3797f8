"""Per-document pipeline operators: prepare (normalize / detect / route) and
optimize (compress + TokenStats).  Every step is a narrow projection over the
corpus -- no shuffle, no Python worker on the default path."""

from __future__ import annotations

from typing import Callable, Optional

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.compress import (
    chunk_target,
    compress_extractive,
    compress_truncate,
    hierarchical_merge,
    needs_recompress,
    pack_chunks,
)
from ..functions.detect import (
    calculate_target,
    known_content_type,
    select_strategy,
    signal_scores,
    signal_window,
    type_from_signals,
)
from ..functions.numeric import cost_saved_config, safe_ratio_loss
from ..functions.text import estimate_tokens, lit_, normalize_lines


def normalize(df: DataFrame, text_col: str = "raw_text", out: str = "norm_text") -> DataFrame:
    """OP05: line-strip / blank-line removal + chars_extracted / chars_normalized."""
    norm = normalize_lines(text_col)
    return df.withColumns(
        {"chars_extracted": F.length(F.col(text_col)).cast("bigint"), out: norm}
    ).withColumn("chars_normalized", F.length(F.col(out)).cast("bigint"))


def prepare(
    df: DataFrame,
    text_col: str = "norm_text",
    filename_col: Optional[str] = "filename",
    cfg: C.OptimizerConfig = C.DEFAULT_CONFIG,
    content_type=None,
    force_strategy=None,
) -> DataFrame:
    """OP06, OP08-OP12: tokens, content type, strategy and target budget.

    `content_type` / `force_strategy` may be a literal or a Column (per-row
    overrides); NULL means "detect" / "route by size".
    """
    fname = F.col(filename_col) if filename_col and filename_col in df.columns else None
    tokens = estimate_tokens(text_col)
    known = known_content_type(fname, content_type)
    # a column of its own: below a coalesce, Spark would lower the window again for each of its sixty tests
    df = df.withColumn("_window", signal_window(F.col(text_col)) if known is None else F.when(known.isNull(), signal_window(F.col(text_col))))
    by_signals = type_from_signals(signal_scores(F.col("_window")))
    return df.withColumns(
        {
            "raw_tokens": tokens,
            "content_type": by_signals if known is None else F.coalesce(known, by_signals),
            "strategy": select_strategy(tokens, cfg, force_strategy),
            "target_tokens": calculate_target(tokens, cfg.target_ratio, cfg.max_output_tokens),
        }
    ).drop("_window")


def _compressed_expr(text: Column, cfg: C.OptimizerConfig, hierarchical: bool = True) -> Column:
    """CASE over the routed strategy.  Spark evaluates only the taken branch,
    so the fold-based strategies cost nothing for rows that do not use them."""
    strategy, target, ctype = F.col("strategy"), F.col("target_tokens"), F.col("content_type")
    extract = compress_extractive(text, target, ctype)
    routed = (
        F.when(strategy == "none", text)
        .when(strategy == "truncate", compress_truncate(text, target))
        # no summariser attached -> the extractive fallback on the full text
        .when(strategy.isin("extractive", "abstractive"), extract)
    )
    if not hierarchical:
        return routed.otherwise(text)
    return (
        routed.when(
            strategy == "hierarchical",
            F.when(F.size(F.col("_chunks")) <= 1, extract)
            .when(
                needs_recompress(F.col("_merged"), target),
                compress_extractive(F.col("_merged"), target, ctype),
            )
            .otherwise(F.col("_merged")),
        )
        .otherwise(text)
    )


def optimize(
    df: DataFrame,
    text_col: str = "norm_text",
    cfg: C.OptimizerConfig = C.DEFAULT_CONFIG,
    summarizer: Optional[Callable] = None,
    chunk_size=None,
    allow_hierarchical: bool = True,
    cache_path: Optional[str] = None,
) -> DataFrame:
    """OP22 + OP26 (TokenStats): route each prepared row to its strategy.

    With a `summarizer` the abstractive / hierarchical rows go through
    `summarize.optimize_with_summarizer` (Arrow batches, narrow) or, with a
    `cache_path`, `summarize.optimize_with_cache` (chunks as rows, answers
    written before use).  `allow_hierarchical=False` (nothing forced) leaves the
    chunking columns out of the plan.
    """
    chunk_size = cfg.chunk_size if chunk_size is None else chunk_size
    text = F.col(text_col)
    if summarizer is not None:
        from .summarize import optimize_with_cache, optimize_with_summarizer

        if cache_path is not None:
            return optimize_with_cache(df, text_col, cfg, summarizer, chunk_size, cache_path)
        return optimize_with_summarizer(df, text_col, cfg, summarizer, chunk_size)
    if not allow_hierarchical:
        return token_stats(df.withColumn("compressed", _compressed_expr(text, cfg, False)), cfg)
    is_h = F.col("strategy") == "hierarchical"
    out = (
        df.withColumn("_chunks", F.when(is_h, pack_chunks(text, lit_(chunk_size))))
        .withColumn("_chunk_target", chunk_target(F.col("_chunks"), F.col("target_tokens")))
        .withColumn(
            "_merged",
            F.when(
                is_h & (F.size(F.col("_chunks")) > 1),
                hierarchical_merge(F.col("_chunks"), F.col("_chunk_target"), F.col("content_type")),
            ),
        )
        .withColumn("compressed", _compressed_expr(text, cfg))
        .drop("_chunks", "_chunk_target", "_merged")
    )
    return token_stats(out, cfg)


def token_stats(df: DataFrame, cfg: C.OptimizerConfig = C.DEFAULT_CONFIG) -> DataFrame:
    """compressed_chars / tokens, compression_ratio, cost_saved_input."""
    ctok = estimate_tokens("compressed")
    return df.withColumns(
        {
            "compressed_chars": F.length("compressed").cast("bigint"),
            "compressed_tokens": ctok,
            "compression_ratio": safe_ratio_loss(ctok, F.col("raw_tokens")),
            "cost_saved_input": cost_saved_config(F.col("raw_tokens"), ctok, cfg.input_cost_per_1k),
        }
    )

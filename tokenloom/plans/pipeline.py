"""The six-stage run (Intake, Parse, Normalize, Optimize, Cost Analysis,
Benchmark) as one lazy DataFrame over a whole corpus.

    corpus -> identity -> normalize -> prepare -> optimize -> cost -> benchmark

Every stage is a projection of the previous one, so Spark fuses them into
one scan-to-sink stage per partition: no shuffle and no Python worker unless
a summariser callable is attached.
"""

from __future__ import annotations

from typing import Callable, Optional

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..operators.metrics import benchmark, cost_analysis
from ..operators.optimize import normalize, optimize, prepare
from ..operators.runs import with_run_identity

DEFAULT_RUN_TS = "2026-01-01 00:00:00"

RUN_COLUMNS = (
    "run_id",
    "fingerprint",
    "doc_key",
    "file_path",
    "filename",
    "doc_type",
    "model",
    "file_size_bytes",
    "chars_extracted",
    "chars_normalized",
    "raw_tokens",
    "content_type",
    "strategy",
    "target_tokens",
    "compressed",
    "compressed_chars",
    "compressed_tokens",
    "compression_ratio",
    "cost_saved_input",
    "compression_pct",
    "cost_raw",
    "cost_optimized",
    "cost_saved",
    "benchmark_accuracy_raw",
    "benchmark_accuracy",
    "benchmark_strategy",
    "benchmark_cost",
)


def run_pipeline(
    corpus: DataFrame,
    model: str = C.DEFAULT_MODEL,
    cfg: C.OptimizerConfig = C.DEFAULT_CONFIG,
    run_ts: str = DEFAULT_RUN_TS,
    content_type=None,
    force_strategy=None,
    summarizer: Optional[Callable] = None,
    keep_text: bool = True,
    passthrough: tuple = (),
    summary_cache: Optional[str] = None,
) -> DataFrame:
    """One run row per corpus document (see RUN_COLUMNS); `passthrough`
    columns of the corpus are carried along unchanged.  With a summarizer the
    rows also have summary_status; summary_cache names its cache table."""
    df = corpus.withColumn("model", F.lit(model)) if "model" not in corpus.columns else corpus
    df = with_run_identity(df, F.col("model"), run_ts)
    df = normalize(df, "raw_text", "norm_text")
    df = prepare(df, "norm_text", "filename", cfg, content_type, force_strategy)
    df = optimize(df, "norm_text", cfg, summarizer, allow_hierarchical=force_strategy is not None,
                  cache_path=summary_cache)
    df = cost_analysis(df, "model", "raw_tokens", "compressed_tokens")
    df = benchmark(df, "model", "raw_tokens", "compressed_tokens")
    cols = list(RUN_COLUMNS) + (["norm_text"] if keep_text else []) + list(passthrough)
    if summarizer is not None:
        cols.append("summary_status")
    if not keep_text:
        cols.remove("compressed")
    return df.select(*cols)

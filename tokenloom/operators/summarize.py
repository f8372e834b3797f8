"""OP18-OP21: summarisation prompts and the pluggable summariser.

The summariser is a user-supplied callable

    fn(requests: pandas.DataFrame) -> pandas.Series   (str or None per row)

with request columns content_type, target_tokens, max_tokens, prompt, system.
It runs on Arrow batches, only for the rows that need it.  Where a batch raises,
it is halved and asked again until the failing requests stand alone, so one bad
request never costs its neighbours their answers; an error that hits every
request fails the job (`tolerant` goes on).  A request without an answer
falls back to the extractive strategy on its full text, and `summary_status`
says so: answered, partial (some of a document's requests) or fallback.

Two forms with equal results: `optimize_with_summarizer` is one narrow pass (no
shuffle, a document's chunk prompts in one call); `optimize_with_cache` makes
every chunk a row of its own, asks equal requests once and writes each answer to
the cache table before it is used, so a retry never asks again.
"""

from __future__ import annotations

from typing import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from ..functions.compress import compress_extractive, label_sections, pack_chunks
from ..functions.text import col_, estimate_tokens, lit_, prefix


def instruction_expr(content_type) -> Column:
    """Per-type instruction; the 7-row table is a fixed CASE, not a join."""
    ct = lit_(content_type)
    by = dict(C.TYPE_INSTRUCTIONS)
    expr = None
    for k, v in C.TYPE_INSTRUCTIONS:
        expr = F.when(ct == k, F.lit(v)) if expr is None else expr.when(ct == k, F.lit(v))
    return expr.otherwise(F.lit(by["unknown"]))


def prompt_expr(content, target_tokens, content_type, window: int | None = C.PROMPT_CONTENT_CHARS) -> Column:
    """The request text; window: characters of the content it carries (None: all)."""
    before, rest = C.PROMPT_TEMPLATE.split("{content_type}")
    mid1, rest = rest.split("{target_tokens}")
    mid2, rest = rest.split("{instruction}")
    mid3, after = rest.split("{content}")
    return F.concat(
        F.lit(before),
        lit_(content_type),
        F.lit(mid1),
        lit_(target_tokens).cast("string"),
        F.lit(mid2),
        instruction_expr(content_type),
        F.lit(mid3),
        col_(content) if window is None else prefix(col_(content), window),
        F.lit(after),
    )


def max_tokens_expr(target_tokens) -> Column:
    return F.least(lit_(target_tokens) + C.SUMMARY_TOKEN_HEADROOM, F.lit(C.SUMMARY_MAX_TOKENS))


def build_prompts(df: DataFrame, text_col: str = "norm_text", window: int | None = C.PROMPT_CONTENT_CHARS) -> DataFrame:
    """OP18: prompt, max output tokens and the characters that the window leaves out, per row."""
    t, ct = F.col("target_tokens"), F.col("content_type")
    dropped = F.lit(0) if window is None else F.greatest(F.length(text_col) - window, F.lit(0))
    return df.withColumns({
        "prompt": prompt_expr(F.col(text_col), t, ct, window),
        "max_tokens": max_tokens_expr(t),
        "prompt_dropped_chars": dropped.cast("bigint"),
    })


class SummarizerDown(RuntimeError):
    """The callable fails on every request, whatever it holds."""


#: requests that are asked alone before an error counts as one that hits all
PROBES = 8


def _call(fn: Callable, requests: pd.DataFrame) -> list:
    answers = list(fn(requests))
    if len(answers) != len(requests):
        raise ValueError("not one answer for each request")
    return [v.strip() if isinstance(v, str) else None for v in answers]


def _halved(fn: Callable, requests: pd.DataFrame) -> list:
    """One answer per request, None where the request alone fails."""
    if not len(requests):
        return []
    try:
        return _call(fn, requests)
    except Exception:  # noqa: BLE001 - isolated below
        if len(requests) == 1:
            return [None]
    half = len(requests) // 2
    return [v for part in (requests[:half], requests[half:]) for v in _halved(fn, part.reset_index(drop=True))]


def _ask(fn: Callable, requests: pd.DataFrame) -> list:
    """One answer (str or None) per request.

    A failing batch is halved until the bad requests stand alone.  Where PROBES
    requests from all over it fail alone with the same error, the error hits
    every request: it rises instead of being asked for 2 * n times.  A missing
    module always rises.
    """
    if not len(requests):
        return []
    try:
        return _call(fn, requests)
    except ImportError:
        raise
    except Exception as e:  # noqa: BLE001 - one error of all, or isolated below
        if len(requests) >= PROBES:
            same = 0
            for i in {k * (len(requests) - 1) // (PROBES - 1) for k in range(PROBES)}:
                try:
                    _call(fn, requests[i:i + 1].reset_index(drop=True))
                    break
                except Exception as alone:  # noqa: BLE001 - compared
                    same += type(alone) is type(e) and str(alone) == str(e)
            if same == PROBES:
                raise SummarizerDown(f"the summariser fails on every request: {e!r}") from e
    return _halved(fn, requests)


def tolerant(fn: Callable) -> Callable:
    """fn, but with no answers where a whole batch fails: a job goes on with the fallback while the model is down."""

    def ask(requests: pd.DataFrame) -> list:
        try:
            return _ask(fn, requests)
        except SummarizerDown:
            return [None] * len(requests)

    return ask


def summarizer_udf(fn: Callable):
    """Scalar Arrow UDF over STRUCT<content_type, target_tokens, max_tokens,
    prompt>.  Rows whose struct is NULL (no request) cost only a null in the
    batch; the callable sees one pandas frame with the real requests."""
    system = C.SUMMARY_SYSTEM_PROMPT

    @F.pandas_udf(T.StringType())
    def run(req: pd.DataFrame) -> pd.Series:
        out = pd.Series([None] * len(req), index=req.index, dtype="object")
        mask = req["prompt"].notna().to_numpy()
        out[mask] = pd.Series(_ask(fn, req[mask].reset_index(drop=True).assign(system=system)), dtype="object").to_numpy()
        return out

    # a model call is not deterministic; marking it so also stops Catalyst
    # from copying the call into pushed-down filters (it would run twice)
    return run.asNondeterministic()


def summarizer_many_udf(fn: Callable):
    """Like `summarizer_udf` for a document's list of chunk prompts:
    STRUCT<content_type, target_tokens, max_tokens, prompts ARRAY<STRING>>
    -> ARRAY<STRING> (NULL entries where the call failed)."""
    system = C.SUMMARY_SYSTEM_PROMPT

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def run(req: pd.DataFrame) -> pd.Series:
        flat = req[req["prompts"].notna()].explode("prompts").rename(columns={"prompts": "prompt"})
        asked = flat[["content_type", "target_tokens", "max_tokens", "prompt"]].reset_index(drop=True)
        answers = iter(_ask(fn, asked.assign(system=system)))
        return pd.Series([None if ps is None else [next(answers) for _ in ps] for ps in req["prompts"]],
                         index=req.index, dtype="object")

    return run.asNondeterministic()


def _request(cond: Column, text: Column, target: Column, ctype: Column, window: int | None) -> Column:
    return F.when(
        cond,
        F.struct(
            ctype.alias("content_type"),
            target.alias("target_tokens"),
            max_tokens_expr(target).alias("max_tokens"),
            prompt_expr(text, target, ctype, window).alias("prompt"),
        ),
    )


def _status(answered: Column, asked: Column) -> Column:
    return F.when(answered == 0, "fallback").when(answered < asked, "partial").otherwise("answered")


def optimize_with_summarizer(df: DataFrame, text_col: str, cfg: C.OptimizerConfig,
                             fn: Callable, chunk_size) -> DataFrame:
    """OP19 / OP21 / OP22 with a summariser, in one narrow pass.

    Every row flows through the same projections; the Arrow UDFs receive a
    request only for abstractive / hierarchical rows (NULL otherwise), so the
    upstream scan and normalization run once, and a document's chunks are
    summarised in one batched call -- no filter/union branches, no shuffle.
    A missing summary (None or a failed batch) falls back to extractive.
    """
    from .optimize import _compressed_expr, token_stats

    window = cfg.prompt_content_chars
    one, many = summarizer_udf(fn), summarizer_many_udf(fn)
    text, t, ct, strategy = F.col(text_col), F.col("target_tokens"), F.col("content_type"), F.col("strategy")
    is_h = strategy == "hierarchical"
    d = df.withColumn("_chunks", F.when(is_h, pack_chunks(text, lit_(chunk_size))))
    d = d.withColumn("_multi", is_h & (F.size("_chunks") > 1))
    d = d.withColumn("_ct", F.when(F.col("_multi"), F.floor(t / F.size("_chunks")).cast("bigint")))
    # one request per abstractive (or single-chunk hierarchical) document
    d = d.withColumn("_sum", one(_request((strategy == "abstractive") | (is_h & ~F.col("_multi")), text, t, ct, window)))
    # all chunk requests of a multi-chunk document in one call
    chunk_req = F.when(
        F.col("_multi"),
        F.struct(
            ct.alias("content_type"),
            F.col("_ct").alias("target_tokens"),
            max_tokens_expr(F.col("_ct")).alias("max_tokens"),
            F.transform("_chunks", lambda c: prompt_expr(c, F.col("_ct"), ct, window)).alias("prompts"),
        ),
    )
    d = d.withColumn("_parts", many(chunk_req))
    d = d.withColumn(
        "_merged",
        F.when(
            F.col("_multi"),
            label_sections(
                F.zip_with(
                    "_chunks", "_parts",
                    lambda c, s: F.coalesce(s, compress_extractive(c, F.col("_ct"), ct)),
                )
            ),
        ),
    )
    big = F.col("_multi") & (estimate_tokens(F.col("_merged")) > t * C.HIERARCHY_RECOMPRESS_FACTOR)
    d = d.withColumn("_big", big)
    d = d.withColumn("_sum2", one(_request(F.col("_big"), F.col("_merged"), t, ct, window)))
    summarized = (
        F.when(strategy == "abstractive", F.coalesce("_sum", compress_extractive(text, t, ct)))
        .when(is_h & ~F.col("_multi"), F.coalesce("_sum", compress_extractive(text, t, ct)))
        .when(F.col("_big"), F.coalesce("_sum2", compress_extractive(F.col("_merged"), t, ct)))
        .when(F.col("_multi"), F.col("_merged"))
    )
    d = d.withColumn("compressed", F.coalesce(summarized, _compressed_expr(text, cfg, False)))
    got = F.array_compact(F.concat(F.array("_sum", "_sum2"), F.coalesce("_parts", F.array())))
    asked = F.coalesce(F.size("_parts"), F.lit(1)) + F.coalesce(F.col("_big"), F.lit(False)).cast("int")
    d = d.withColumn("summary_status", F.when((strategy == "abstractive") | is_h, _status(F.size(got), asked)))
    d = d.drop("_chunks", "_multi", "_ct", "_sum", "_parts", "_merged", "_big", "_sum2")
    return token_stats(d, cfg)


def optimize_with_cache(df: DataFrame, text_col: str, cfg: C.OptimizerConfig, fn: Callable,
                        chunk_size, cache_path: str) -> DataFrame:
    """OP19 / OP21 / OP22 with a summariser and a cache table: the same results.

    A job is a distinct (strategy, type, budget, text) that needs summaries; its
    requests are rows (one per chunk), so a long document is spread over tasks
    and equal documents are asked once.  Jobs come back by their key, salted, since
    many rows may have one text; rows that need no summary take no part in that join.
    """
    from ..session import checkpoint_dir
    from .optimize import _compressed_expr, token_stats
    from .salting import attach
    from .summary_cache import cached_summaries

    text, t, ct, strategy = F.col(text_col), F.col("target_tokens"), F.col("content_type"), F.col("strategy")
    window = cfg.prompt_content_chars
    needed = F.coalesce(strategy.isin("abstractive", "hierarchical"), F.lit(False))
    key = F.sha2(F.concat_ws("\u0001", strategy, ct, t.cast("string"), text), 256)
    plain = df.where(~needed).withColumn("compressed", _compressed_expr(text, cfg, False))
    asking = df.where(needed).withColumn("_job", key)

    jobs = asking.select("_job", ct.alias("content_type"), t.alias("_budget"), text.alias("_text"),
                         F.when(strategy == "hierarchical", pack_chunks(text, lit_(chunk_size))).alias("_chunks"))
    multi = F.coalesce(F.size("_chunks") > 1, F.lit(False))
    requests = jobs.select(
        "_job", "content_type", "_budget", multi.alias("_multi"),
        F.when(multi, F.floor(F.col("_budget") / F.size("_chunks"))).otherwise(F.col("_budget")).cast("bigint").alias("target_tokens"),
        F.posexplode_outer(F.when(multi, F.col("_chunks")).otherwise(F.array("_text"))).alias("_no", "norm_text"),
    ).dropDuplicates(["_job", "_no"])

    def answered(rows: DataFrame) -> DataFrame:
        out = cached_summaries(rows, fn, cache_path, window=window)
        own = compress_extractive(F.col("norm_text"), F.col("target_tokens"), F.col("content_type"))
        return out.withColumn("_out", F.coalesce("summary", own))

    checkpoint_dir(df.sparkSession)
    pieces = F.transform(F.array_sort(F.collect_list(F.struct("_no", "_out"))), lambda p: p["_out"])
    merged = (
        answered(requests).groupBy("_job", "content_type", "_budget", "_multi")
        .agg(pieces.alias("_pieces"), F.count(F.lit(1)).alias("_asked"), F.count("summary").alias("_got"))
        .select("_job", "content_type", F.col("_budget").alias("target_tokens"), "_asked", "_got", "_multi",
                F.when(F.col("_multi"), label_sections(F.col("_pieces"))).otherwise(F.col("_pieces")[0]).alias("norm_text"))
        .checkpoint()
    )
    big = F.col("_multi") & (estimate_tokens("norm_text") > F.col("target_tokens") * C.HIERARCHY_RECOMPRESS_FACTOR)
    again = answered(merged.where(big)).select(
        "_job", F.col("_out").alias("compressed"),
        _status(F.col("_got") + F.col("summary").isNotNull().cast("int"), F.col("_asked") + 1).alias("summary_status"))
    done = merged.where(~big).select(
        "_job", F.col("norm_text").alias("compressed"), _status(F.col("_got"), F.col("_asked")).alias("summary_status"))
    own = [F.col(c) for c in df.columns if c != text_col]
    back = attach(asking, done.unionByName(again), "_job", own).drop("_job")
    plain = plain.withColumn("summary_status", F.lit(None).cast("string"))
    return token_stats(plain.unionByName(back), cfg)

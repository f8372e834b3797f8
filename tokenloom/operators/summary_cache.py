"""Idempotent summarisation: summaries are written before they are used.

Model calls are slow, paid and not deterministic, so a re-run (or a job
restarted after losing its driver) must not call the model again for a
request it already answered.  Requests are keyed by SHA-256 of
(model, system text, max tokens, prompt); each pass

    1. drops requests whose key is already in the cache table (anti join),
    2. summarises the misses (Arrow-batched, one narrow stage),
    3. appends the new (key, summary) rows to the cache table,
    4. joins the cache back to the requests.

The cache table lives in the cluster's shared folder (spark.checkpoint.dir by
default).  It grows with the corpus, so both joins are plain shuffle joins.
"""

from __future__ import annotations

import uuid
from typing import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..session import checkpoint_dir
from .summarize import max_tokens_expr, prompt_expr, summarizer_udf

CACHE_SCHEMA = "req_key STRING, summary STRING"


def request_key(prompt, max_tokens, model: str = C.DEFAULT_CONFIG.summarization_model):
    return F.sha2(
        F.concat_ws("\u0001", F.lit(model), F.lit(C.SUMMARY_SYSTEM_PROMPT),
                    F.col(max_tokens).cast("string"), F.col(prompt)),
        256,
    )


def _read_cache(spark, path: str) -> DataFrame:
    """The cache table; empty only where the path does not exist (any other failure rises)."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return spark.createDataFrame([], CACHE_SCHEMA)
    return spark.read.schema(CACHE_SCHEMA).parquet(path)


def cached_summaries(requests: DataFrame, fn: Callable, cache_path: str | None = None,
                     text_col: str = "norm_text", target_col: str = "target_tokens",
                     type_col: str = "content_type", window: int | None = C.PROMPT_CONTENT_CHARS) -> DataFrame:
    """requests + `summary` (NULL where the model gave nothing; such a request is asked again by the next pass).

    `requests` needs text, target and type columns; the prompt is built here.
    """
    spark = requests.sparkSession
    path = cache_path or f"{checkpoint_dir(spark).rstrip('/')}/summary-cache"
    req = requests.withColumn(
        "_prompt", prompt_expr(F.col(text_col), F.col(target_col), F.col(type_col), window)
    ).withColumn("_max_tokens", max_tokens_expr(F.col(target_col)))
    req = req.withColumn("_key", request_key("_prompt", "_max_tokens"))

    known = _read_cache(spark, path)
    todo = (
        req.select("_key", F.col(type_col).alias("content_type"), F.col(target_col).alias("target_tokens"),
                   "_max_tokens", "_prompt")
        .dropDuplicates(["_key"])
        .join(known.withColumnRenamed("req_key", "_key"), "_key", "left_anti")
    )
    call = summarizer_udf(fn)(
        F.struct(
            F.col("content_type"), F.col("target_tokens"),
            F.col("_max_tokens").alias("max_tokens"), F.col("_prompt").alias("prompt"),
        )
    )
    fresh = todo.select(F.col("_key").alias("req_key"), call.alias("summary")).filter(
        F.col("summary").isNotNull()
    )
    # one write per pass; a retried task rewrites only its own file, and the
    # anti join above keeps earlier passes' answers from being requested again
    fresh.write.mode("append").parquet(path)
    cache = _read_cache(spark, path).groupBy("req_key").agg(F.min("summary").alias("summary"))
    out = req.join(cache.withColumnRenamed("req_key", "_key"), "_key", "left")
    return out.drop("_prompt", "_max_tokens", "_key")


def new_cache_path(spark) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/summary-cache-{uuid.uuid4().hex}"

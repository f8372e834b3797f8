"""OP32: rows of equal content are computed once and share the result.

What decides a row's result is its key: its bytes and model, and the type that its
file name gives.  The corpus is dealt once by (key, salt), so that one content
with a third of all rows takes many tasks.  Each (key, salt) names one row, the rows
named for a key are reduced to one, only those rows are run, and their results
go back to all rows of the key by a join on (key, salt): a result is repeated for
the salts its rows have, at most `salts`.
"""

from __future__ import annotations

from typing import Callable, Optional, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .. import config as C
from ..functions.detect import type_from_filename
from ..plans.pipeline import run_pipeline
from .runs import fingerprint_expr

#: tasks over which the rows of one content may spread
SALTS = 64


def run_distinct(
    corpus: DataFrame,
    results: Sequence[str],
    carry: Sequence[str] = (),
    model: str = C.DEFAULT_MODEL,
    run: Callable[..., DataFrame] = run_pipeline,
    salts: int = SALTS,
    computed: Optional[Observation] = None,
    **options,
) -> DataFrame:
    """A row for each row of the corpus: doc_key, `carry` and chars_extracted of its
    own, `results` of the run of its content, copies (rows of that content) and
    representative (the doc_key that was run).

    results: columns of `run`, which is called with the corpus of representatives
    and `options`; computed counts the rows that it was given.  Both branches read
    the same exchange, so the corpus is scanned once, as long as doc_key, `carry`
    and chars_extracted are selected from the result.
    """
    name_type = type_from_filename(F.col("filename")) if "filename" in corpus.columns else F.lit(None).cast("string")
    own_model = F.col("model") if "model" in corpus.columns else F.lit(model)
    # one column for the key, so that the exchange below serves the aggregation and the join as it is
    content = F.struct(fingerprint_expr(F.col("content"), own_model).alias("fingerprint"), own_model.alias("model"),
                       name_type.alias("name_type"))
    tasks = int(corpus.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # neither column can be null: no filter is inferred that would tell the two uses of the exchange apart
    salt = F.coalesce(F.pmod(F.xxhash64("doc_key"), F.lit(salts)).cast("int"), F.lit(0))
    dealt = corpus.select("doc_key", *carry, "raw_text", content.alias("_key"), salt.alias("_salt")).repartition(tasks, "_key", "_salt")
    row = F.struct("doc_key", *carry, "raw_text")
    named = dealt.groupBy("_key", "_salt").agg(F.min(row).alias("_row"), F.count(F.lit(1)).alias("_n"))
    chosen = named.repartition(tasks, "_key").groupBy("_key").agg(
        F.min("_row").alias("_row"), F.sum("_n").alias("copies"), F.collect_list("_salt").alias("_salts"))
    inputs = chosen.select(
        F.col("_row.doc_key").alias("doc_key"), F.col("_row.raw_text").alias("raw_text"), "_key", "_key.*", "copies", "_salts",
        F.octet_length("_row.raw_text").cast("bigint").alias("file_size_bytes"),
        *[F.lit(None).cast("string").alias(c) for c in ("file_path", "filename", "doc_type")],
    )
    if computed is not None:
        inputs = inputs.observe(computed, F.count(F.lit(1)).alias("rows"))
    done = run(inputs, content_type=F.col("name_type"), keep_text=True,
               passthrough=("_key", "copies", "_salts"), **options)
    wanted = [c for c in results if c != "chars_extracted"]
    spread = done.select(F.col("_key").alias("_of"), F.explode("_salts").alias("_of_salt"), "copies",
                         F.col("doc_key").alias("representative"), *wanted)
    out = dealt.join(spread, (dealt["_key"] == spread["_of"]) & (dealt["_salt"] == spread["_of_salt"]))
    return out.select("doc_key", *carry, F.length("raw_text").cast("bigint").alias("chars_extracted"), *wanted, "copies",
                      "representative")

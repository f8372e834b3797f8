"""OP28-OP30, OP34: run identity, stage report, run summary and run comparison."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.text import preview


def fingerprint_expr(content: Column, model) -> Column:
    """SHA-256 hex of the file bytes followed by the model name's UTF-8."""
    m = model if isinstance(model, Column) else F.lit(model)
    return F.sha2(F.concat(content, F.encode(m, "UTF-8")), 256)


def run_id_expr(fingerprint: Column, run_ts: str) -> Column:
    """'yyyyMMdd_HHmm-' + first 6 hex.  The timestamp is a job parameter so a
    rerun of the same job gives the same ids (key joins on the full
    fingerprint: 24 bits collide within a few thousand documents)."""
    stamp = F.date_format(F.to_timestamp(F.lit(run_ts)), C.RUN_TS_FORMAT)
    return F.concat(stamp, F.lit("-"), F.substring(fingerprint, 1, C.RUN_HASH_HEX))


def with_run_identity(df: DataFrame, model, run_ts: str, content_col: str = "content") -> DataFrame:
    """A fingerprint that the rows bring along is taken as it is."""
    fp = F.col("fingerprint") if "fingerprint" in df.columns else fingerprint_expr(F.col(content_col), model)
    return df.withColumns({"fingerprint": fp, "run_id": run_id_expr(fp, run_ts)})


# fixed values: the metrics each stage reports
STAGE_METRICS = (
    # (stage_no, stage_name, metric, numeric column or None, text column or None)
    (1, "Intake", "file_size_bytes", "file_size_bytes", None),
    (2, "Parse", "chars_extracted", "chars_extracted", None),
    (3, "Normalize", "chars_normalized", "chars_normalized", None),
    (4, "Optimize", "raw_tokens", "raw_tokens", None),
    (4, "Optimize", "optimized_tokens", "compressed_tokens", None),
    (4, "Optimize", "compression_pct", "compression_pct", None),
    (4, "Optimize", "strategy", None, "strategy"),
    (5, "Cost Analysis", "cost_raw", "cost_raw", None),
    (5, "Cost Analysis", "cost_optimized", "cost_optimized", None),
    (5, "Cost Analysis", "cost_saved", "cost_saved", None),
    (6, "Benchmark", "accuracy", "benchmark_accuracy", None),
    (6, "Benchmark", "strategy", None, "benchmark_strategy"),
)

# metrics that are not DOUBLE
METRIC_TYPES = {
    "file_size_bytes": "bigint", "chars_extracted": "bigint", "chars_normalized": "bigint",
    "raw_tokens": "bigint", "optimized_tokens": "bigint", "strategy": "string",
}


def stage_field(name: str) -> str:
    """Field of a stage in `stage_results`: its name in lower case, joined by underscores."""
    return name.lower().replace(" ", "_")


def stage_report(runs: DataFrame, keys: Sequence[str] = ("run_id", "fingerprint", "doc_key", "model")) -> DataFrame:
    """OP29: 12 metric rows per document run (a narrow Generate, no shuffle)."""
    entries = []
    for no, stage, metric, num, txt in STAGE_METRICS:
        entries.append(
            F.struct(
                F.lit(no).alias("stage_no"),
                F.lit(stage).alias("stage_name"),
                F.lit(metric).alias("metric"),
                (F.col(num).cast("double") if num else F.lit(None).cast("double")).alias("value"),
                (F.col(txt) if txt else F.lit(None).cast("string")).alias("value_text"),
            )
        )
    return runs.select(*keys, F.inline_outer(F.array(*entries)))


def run_summary(runs: DataFrame) -> DataFrame:
    """OP30: the nested run result (summary STRUCT, one typed STRUCT per stage, preview)."""
    summary = F.struct(
        F.col("raw_tokens").alias("raw_tokens"),
        F.col("compressed_tokens").alias("optimized_tokens"),
        F.col("compression_pct").alias("compression_pct"),
        F.col("cost_raw").alias("cost_raw"),
        F.col("cost_optimized").alias("cost_optimized"),
        F.col("cost_saved").alias("cost_saved"),
        F.col("benchmark_accuracy").alias("benchmark_accuracy"),
        F.col("benchmark_strategy").alias("benchmark_strategy"),
    )
    def stage(name: str) -> Column:
        own = [(m, num or txt) for _, of, m, num, txt in STAGE_METRICS if of == name]
        return F.struct(
            F.lit(name).alias("stage_name"),
            # stages are fused into one Spark stage: no per-stage timer
            F.lit(None).cast("double").alias("duration_ms"),
            F.struct(*[F.col(c).cast(METRIC_TYPES.get(m, "double")).alias(m) for m, c in own]).alias("metrics"),
        )

    stages = F.struct(*[stage(name).alias(stage_field(name)) for name in C.STAGE_NAMES])
    return runs.select(
        "run_id",
        "fingerprint",
        "doc_key",
        "file_path",
        "doc_type",
        "model",
        stages.alias("stage_results"),
        summary.alias("summary"),
        F.col("content_type"),
        preview("compressed", C.PREVIEW_CHARS).alias("compressed_preview"),
    )


def compare_runs(a: DataFrame, b: DataFrame, keys: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """OP34: full outer join of two run outputs; per-field null-safe equality.

    Returns one row per key with `status` in (same, changed, only_a, only_b)
    and the list of changed fields.
    """
    aa = a.select(*keys, *[F.col(f).alias(f"a_{f}") for f in fields], F.lit(True).alias("_in_a"))
    bb = b.select(*keys, *[F.col(f).alias(f"b_{f}") for f in fields], F.lit(True).alias("_in_b"))
    j = aa.join(bb, list(keys), "full_outer")
    diffs = F.filter(
        F.array(*[F.when(~F.col(f"a_{f}").eqNullSafe(F.col(f"b_{f}")), F.lit(f)) for f in fields]),
        lambda x: x.isNotNull(),
    )
    status = (
        F.when(F.col("_in_b").isNull(), "only_a")
        .when(F.col("_in_a").isNull(), "only_b")
        .when(F.size(diffs) == 0, "same")
        .otherwise("changed")
    )
    return j.select(
        *keys,
        status.alias("status"),
        F.array_join(diffs, ",").alias("changed_fields"),
        *[F.col(f"a_{f}") for f in fields],
        *[F.col(f"b_{f}") for f in fields],
    )

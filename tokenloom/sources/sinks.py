"""OP04: run artifacts, a committed table (manifest.py) of one record per document run.

Records are partitioned by job, run minute and model.  A rerun of a job replaces
its own records once all new ones are written; other jobs of the same minute and
model keep theirs, and a job that dies half-way changes nothing a reader sees.
"""

from __future__ import annotations

from typing import Optional

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..operators.runs import METRIC_TYPES, STAGE_METRICS, run_summary, stage_field
from .manifest import commit, read_committed

PARTS = ("job", "run_minute", "model")


def artifact_records(runs: DataFrame, job: str) -> DataFrame:
    return run_summary(runs).withColumn("run_minute", F.split(F.col("run_id"), "-").getItem(0)).withColumn("job", F.lit(job))


def write_artifacts(runs: DataFrame, path: str, job: str, fmt: str = "json") -> DataFrame:
    """Write run results; returns the written frame (for chaining / tests).

    job: names what was run (source and configuration); the same job at the
    same run time replaces its earlier records, and only those.
    """
    out = artifact_records(runs, job)
    commit(out, path, PARTS, fmt=fmt)
    return out


def artifact_schema() -> str:
    """The schema of stored records, partition columns included (no inference pass over the files)."""
    def stage(name: str) -> str:
        own = ", ".join(f"{m}: {METRIC_TYPES.get(m, 'double')}" for _, of, m, _, _ in STAGE_METRICS if of == name)
        return f"{stage_field(name)}: struct<stage_name: string, duration_ms: double, metrics: struct<{own}>>"

    return (
        "run_id string, fingerprint string, doc_key string, file_path string, doc_type string, "
        f"stage_results struct<{', '.join(stage(n) for n in C.STAGE_NAMES)}>, "
        "summary struct<raw_tokens: bigint, optimized_tokens: bigint, compression_pct: double, cost_raw: double, "
        "cost_optimized: double, cost_saved: double, benchmark_accuracy: double, benchmark_strategy: string>, "
        "content_type string, compressed_preview string, job string, run_minute string, model string"
    )


def read_artifacts(spark, path: str, fmt: str = "json", schema=None, as_of: Optional[int] = None) -> DataFrame:
    """Stored records of every job, now or as of an earlier commit; filters on job, run_minute and model prune partitions."""
    return read_committed(spark, path, schema or artifact_schema(), PARTS, fmt, as_of)

"""OP34: do two stored sets of run artifacts agree?  Checksums first, rows only where they differ.

A set is one job's records in an artifact table.  Its checksums, one row for each
(model, bucket of the key), don't depend on the order or the partitioning of the
records: a count, the sum and the exclusive or of the records' hashes.  They are
kept in a committed table beside the records, so two sets that agree are told by
reading a few small rows.  Where they differ, the records of those models and
buckets are read, `exceptAll` leaves those without an equal on the other side, and
only these are joined and compared field by field.
"""

from __future__ import annotations

from typing import NamedTuple, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.manifest import commit, entries, read_committed
from ..sources.sinks import read_artifacts
from .runs import compare_runs

BUCKETS = 64
KEYS = ("doc_key", "model")
#: what two runs of equal rules have in common; run ids carry the time of the run
FIELDS = ("fingerprint", "doc_type", "content_type", "summary", "stage_results", "compressed_preview")
CHECKSUMS = ("job string, run_minute string, model string, bucket int, seq bigint, rows bigint, hash_sum decimal(38,0), hash_xor bigint")


def bucket_of(key: Column, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def checksums(records: DataFrame, by: Sequence[str], keys: Sequence[str] = KEYS, fields: Sequence[str] = FIELDS,
              buckets: int = BUCKETS) -> DataFrame:
    """rows, hash_sum and hash_xor of the records for each (by, bucket), whatever their order."""
    h = F.xxhash64(*keys, *fields)
    rows = records.select(*by, bucket_of(F.col(keys[0]), buckets).alias("bucket"), h.alias("_h"))
    return rows.groupBy(*by, "bucket").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.col("_h").cast("decimal(38,0)")).alias("hash_sum"),
        F.bit_xor(F.xxhash64(F.col("_h"), F.lit(1))).alias("hash_xor"))


def _records_seq(spark: SparkSession, root: str, job: str) -> int:
    """The last commit that changed the job's records."""
    return max((e["seq"] for e in entries(spark, root) if e["part"].split("\u0001")[0] == job), default=0)


def store_checksums(spark: SparkSession, root: str, job: str, fmt: str = "json") -> None:
    """Checksum the job's present records and keep the result beside them."""
    seq = _records_seq(spark, root, job)
    own = read_artifacts(spark, root, fmt).where(F.col("job") == job)
    sums = checksums(own, ("job", "run_minute", "model"))
    commit(sums.withColumn("seq", F.lit(seq).cast("bigint")), f"{root.rstrip('/')}/checksums", ("job", "run_minute", "model"))


def read_checksums(spark: SparkSession, root: str, job: str, fmt: str = "json") -> DataFrame:
    """The job's checksums over all run minutes; they are made first where the records have changed since."""
    path, seq = f"{root.rstrip('/')}/checksums", _records_seq(spark, root, job)
    stored = read_committed(spark, path, CHECKSUMS, ("job", "run_minute", "model")).where(F.col("job") == job)
    if seq and (stored.agg(F.max("seq")).first()[0] or 0) < seq:
        store_checksums(spark, root, job, fmt)
        stored = read_committed(spark, path, CHECKSUMS, ("job", "run_minute", "model")).where(F.col("job") == job)
    return stored.groupBy("model", "bucket").agg(
        F.sum("rows").alias("rows"), F.sum("hash_sum").alias("hash_sum"), F.bit_xor("hash_xor").alias("hash_xor"))


class Differences(NamedTuple):
    """same: the sets agree; parts: the (model, bucket) pairs that differ; rows: compare_runs of the records that differ."""

    same: bool
    parts: list
    rows: DataFrame


def compare_artifacts(spark: SparkSession, root_a: str, job_a: str, root_b: str, job_b: str,
                      fields: Sequence[str] = FIELDS, fmt: str = "json") -> Differences:
    """Compare two stored jobs.  rows has a row for each key whose records differ or that one side lacks."""
    a, b = read_checksums(spark, root_a, job_a, fmt), read_checksums(spark, root_b, job_b, fmt)
    sides = a.join(b, (a["model"].eqNullSafe(b["model"])) & (a["bucket"] == b["bucket"]), "full_outer")
    differs = F.lit(False)
    for c in ("rows", "hash_sum", "hash_xor"):
        differs = differs | ~a[c].eqNullSafe(b[c])
    # a row for each model and bucket at most
    parts = [tuple(r) for r in sides.where(differs).select(
        F.coalesce(a["model"], b["model"]).alias("model"), F.coalesce(a["bucket"], b["bucket"]).alias("bucket")).collect()]

    def records(root: str, job: str) -> DataFrame:
        own = read_artifacts(spark, root, fmt).where(F.col("job") == job)
        wanted = F.lit(False)
        for model in {m for m, _ in parts}:
            buckets = [n for m, n in parts if m == model]
            wanted = wanted | (F.col("model").eqNullSafe(F.lit(model)) & bucket_of(F.col(KEYS[0])).isin(buckets))
        return own.where(wanted).select(*KEYS, *fields)

    left, right = records(root_a, job_a), records(root_b, job_b)
    return Differences(not parts, parts, compare_runs(left.exceptAll(right), right.exceptAll(left), KEYS, fields))

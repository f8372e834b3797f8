"""OP31: corpus reports from integer partial sums that jobs leave behind.

A job adds up its runs once for each (model, dimensions) and keeps the sums in a
committed table.  Sums of many jobs, batches and stream epochs are added again,
so a report over all of them reads a few rows a job, runs nothing twice and
equals the report over all runs at once: only integers are added, and prices
come last.
"""

from __future__ import annotations

from itertools import combinations
from typing import Optional, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import estimate_cost, price_lookup
from ..session import checkpoint_dir
from ..sources.manifest import Commit, commit, read_committed

DIMS = ("doc_type", "content_type", "strategy")
SUMS = ("documents", "raw_tokens", "optimized_tokens", "chosen_tokens", "accepted")


def partial_sums(runs: DataFrame, dims: Sequence[str] = DIMS) -> DataFrame:
    """The sums of the runs for each model and combination of dimensions."""
    accepted = F.col("benchmark_strategy") == "optimized"
    chosen = F.when(accepted, F.col("compressed_tokens")).otherwise(F.col("raw_tokens"))
    return runs.groupBy("model", *dims).agg(
        F.count(F.lit(1)).alias("documents"),
        F.sum("raw_tokens").alias("raw_tokens"),
        F.sum("compressed_tokens").alias("optimized_tokens"),
        F.sum(chosen).alias("chosen_tokens"),
        F.sum(F.when(accepted, 1).otherwise(0)).alias("accepted"),
    )


def store_sums(runs: DataFrame, root: str, job: str, batch: str = "", dims: Sequence[str] = DIMS) -> Commit:
    """Keep the sums of one batch of a job; the same batch again replaces its earlier sums."""
    return commit(partial_sums(runs, dims).withColumn("job", F.lit(job)), root, ("job",), epoch=f"{job}/{batch}")


def read_sums(spark: SparkSession, root: str, dims: Sequence[str] = DIMS, as_of: Optional[int] = None) -> DataFrame:
    """The sums of all batches of all jobs, with the column job."""
    schema = ", ".join([f"{c} string" for c in ("model", *dims, "job")] + [f"{c} bigint" for c in SUMS])
    return read_committed(spark, root, schema, ("job",), as_of=as_of)


def _costs(price: Column) -> dict[str, Column]:
    return {f"cost_{name}": estimate_cost(F.col(f"{name}_tokens"), 0, price) for name in ("raw", "optimized", "chosen")}


def _field(name: str):
    return lambda struct: struct[name]


def report(sums: DataFrame, dims: Sequence[str] = DIMS) -> DataFrame:
    """Every level of the cube over dims, for each model and over all models.

    level: the grouping id over (model, *dims); a set bit is a dimension that is
    summed up.  Costs are priced for each model; those over all models are the
    models' costs added in the order of their names.
    """
    merged = sums.groupBy("model", *dims).agg(*[F.sum(c).alias(c) for c in SUMS])
    sets = [["model", *some] for n in range(len(dims) + 1) for some in combinations(dims, n)]
    each = merged.groupingSets(sets, "model", *dims).agg(
        *[F.sum(c).alias(f"_{c}") for c in SUMS], F.grouping_id().alias("level"))
    each = each.select("model", *dims, "level", *[F.col(f"_{c}").alias(c) for c in SUMS])
    each = each.withColumns(_costs(price_lookup(F.col("model"))))
    costs = [f"cost_{name}" for name in ("raw", "optimized", "chosen")]
    parts = F.array_sort(F.collect_list(F.struct("model", *costs)))  # a row for each model
    added = each.groupBy(*dims, "level").agg(*[F.sum(c).alias(c) for c in SUMS], parts.alias("_parts"))
    total = added.select(
        F.lit(None).cast("string").alias("model"), *dims, (F.col("level") + (1 << len(dims))).alias("level"), *SUMS,
        *[F.aggregate(F.transform("_parts", _field(c)), F.lit(0.0), lambda acc, p: acc + p).alias(c) for c in costs])
    return each.unionByName(total)


def corpus_rollup(runs: DataFrame, dims: Sequence[str]) -> DataFrame:
    """The report's levels along the rollup of (model, *dims), as one job over runs.

    The sums are kept by a reliable checkpoint (a row for each model and combination
    of dimensions), so the runs are evaluated once.
    """
    checkpoint_dir(runs.sparkSession)
    levels = [(1 << (len(dims) - n)) - 1 for n in range(len(dims) + 1)] + [(1 << (len(dims) + 1)) - 1]
    out = report(partial_sums(runs, dims).checkpoint(), dims)
    return out.where(F.col("level").isin(levels)).withColumnRenamed("level", "grouping_level")

"""Tables that are committed: data first, then one manifest entry that makes it visible.

    root/data/commit=<id>/<partition columns>/...   what a job wrote, one folder for each commit
    root/manifest/...                               entries (part, epoch, commit, rows, seq)

A commit writes its own new folder and appends its entries only when that write
has succeeded, so a job that dies half-way leaves nothing a reader follows.  An
entry replaces earlier ones of the same (part, epoch); nothing is deleted, so a
reader may also ask for the table as it was at an earlier seq.  Entries are a few
per commit; what a job wrote is never listed or collected.
"""

from __future__ import annotations

import uuid
from typing import Iterable, NamedTuple, Optional, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

SEPARATOR, NULL = "\u0001", "\u0000"
ENTRY = "part string, epoch string, commit string, rows bigint, seq bigint"


class Commit(NamedTuple):
    """seq: the version of the table from which on the commit is visible; rows: what it wrote."""

    seq: int
    rows: int


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def _part(columns: Sequence[str]) -> Column:
    """The partition values of a row as one string."""
    return F.concat_ws(SEPARATOR, *[F.coalesce(F.col(c).cast("string"), F.lit(NULL)) for c in columns])


def _all_entries(spark: SparkSession, root: str) -> list:
    path = f"{root.rstrip('/')}/manifest"
    return spark.read.schema(ENTRY).json(path).collect() if _exists(spark, path) else []


def version(spark: SparkSession, root: str) -> int:
    """The seq of the last commit, 0 before the first."""
    return max((e["seq"] for e in _all_entries(spark, root)), default=0)


def entries(spark: SparkSession, root: str, as_of: Optional[int] = None) -> list:
    """The entries that count: the last of each (part, epoch), up to the version `as_of`."""
    last: dict[tuple, tuple] = {}
    for e in _all_entries(spark, root):
        key, rank = (e["part"], e["epoch"]), (e["seq"], e["commit"])
        if (as_of is None or e["seq"] <= as_of) and (key not in last or rank > last[key][0]):
            last[key] = (rank, e)
    return [e for _, e in last.values()]


def commit(df: DataFrame, root: str, parts: Sequence[str], epoch: str = "", fmt: str = "parquet") -> Commit:
    """Write df, partitioned by the columns `parts`, and make it visible at once.

    It replaces what earlier commits of the same epoch hold in the parts that
    df has rows of, and leaves their other parts as they are.
    """
    spark, root, own = df.sparkSession, root.rstrip("/"), uuid.uuid4().hex
    seen = Observation(f"commit-{own}")
    counted = df.observe(seen, F.collect_set(_part(parts)).alias("parts"), F.count(F.lit(1)).alias("rows"))
    writer = counted.write.partitionBy(*parts) if parts else counted.write
    if fmt == "json":
        writer = writer.option("ignoreNullFields", "false")  # a stable record shape
    writer.format(fmt).save(f"{root}/data/commit={own}")
    rows, seq = seen.get["rows"], version(spark, root) + 1
    found = [(p, epoch, own, rows, seq) for p in sorted(seen.get["parts"])]
    if found:
        spark.createDataFrame(found, ENTRY).coalesce(1).write.mode("append").json(f"{root}/manifest")
    return Commit(seq if found else seq - 1, rows)


def read_committed(spark: SparkSession, root: str, schema: str, parts: Sequence[str], fmt: str = "parquet",
                   as_of: Optional[int] = None, epochs: Optional[Iterable[str]] = None) -> DataFrame:
    """The rows of all entries that count; filters on `parts` prune folders.  schema: DDL, `parts` included."""
    found = entries(spark, root, as_of)
    if epochs is not None:
        found = [e for e in found if e["epoch"] in set(epochs)]
    if not found:
        return spark.createDataFrame([], schema)
    base = f"{root.rstrip('/')}/data"
    folders = sorted({f"{base}/commit={e['commit']}" for e in found})
    rows = spark.read.format(fmt).option("basePath", base).schema(f"{schema}, commit string").load(folders)
    visible = F.concat_ws(SEPARATOR, "commit", _part(parts)) if parts else F.col("commit")
    names = [f"{e['commit']}{SEPARATOR}{e['part']}" if parts else e["commit"] for e in found]
    return rows.where(visible.isin(names)).drop("commit")

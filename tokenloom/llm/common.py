"""Small helpers that the operators share."""

from __future__ import annotations

import pickle
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: characters that a Python task holds at a time (a longer text is a block of its own)
BLOCK_CHARS = 4_000_000
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z; every other character stays."""
    return F.translate(c, UPPER, UPPER.lower())


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder, from spark.checkpoint.dir.

    A folder of our own is set only for a local master without that setting
    (tests); a cluster without a shared folder is an error.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        return d
    sc = spark.sparkContext
    if not sc.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    # a running session refuses the setting, so its context remembers the folder
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="llm-shared-"))
    return sc.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """df, its lineage cut by a reliable checkpoint in the shared folder."""
    sc = df.sparkSession.sparkContext
    d = shared_dir(df.sparkSession)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return df.checkpoint()


def shared(spark: SparkSession, value) -> Broadcast:
    """A broadcast of any object, its class by value: workers need no copy of this package.  Tasks read it with `opened`."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def opened(b: Broadcast):
    """The object of `shared`, unpickled once in each Python worker."""
    if not hasattr(b, "opened_value"):
        b.opened_value = pickle.loads(b.value)
    return b.opened_value


def without(columns: list[str], names) -> list[str]:
    """The columns that have none of the names, in any case (Spark's column names ignore case)."""
    taken = {n.lower() for n in names}
    return [c for c in columns if c.lower() not in taken]


def new_folder(spark: SparkSession, what: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_dir(spark).rstrip('/')}/{what}-{uuid.uuid4().hex}"


def blocks(batches: Iterator[pa.RecordBatch], chars: int = BLOCK_CHARS) -> Iterator[tuple[list, list[str]]]:
    """ids and texts, so many rows at a time that their characters stay within `chars` (one text at least)."""
    ids, texts, size = [], [], 0
    for batch in batches:
        for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if texts and size + len(t) > chars:
                yield ids, texts
                ids, texts, size = [], [], 0
            ids.append(i)
            texts.append(t)
            size += len(t)
    if texts:
        yield ids, texts

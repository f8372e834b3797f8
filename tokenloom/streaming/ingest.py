"""Incremental ingestion with Structured Streaming.

The per-document operators are narrow, so the whole run pipeline applies to
a streaming `binaryFile` source unchanged.  Each micro-batch is committed by
`foreachBatch` under its job, its checkpoint's id and its epoch
(sources/manifest.py), and the checkpoint records processed files, so a
restarted query (or a lost executor) neither skips nor duplicates documents, and
a query that starts anew with another checkpoint leaves earlier epochs in place.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..plans.pipeline import DEFAULT_RUN_TS, run_pipeline
from ..sources.files import decode_text
from ..sources.manifest import commit, read_committed

PARTS = ("job", "model")
CORPUS_SCHEMA = ("doc_key string, file_path string, filename string, doc_type string, file_size_bytes bigint, "
                 "content binary, raw_text string")
BINARY_FILE_SCHEMA = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"


def stream_files(spark: SparkSession, path: str, glob: str | None = None,
                 max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    df = r.load(path)
    df = df.select(
        F.col("path").alias("doc_key"),
        F.col("path").alias("file_path"),
        F.regexp_extract("path", r"[^/]+$", 0).alias("filename"),
        F.lit(C.DEFAULT_DOC_TYPE).alias("doc_type"),
        F.col("length").alias("file_size_bytes"),
        F.col("content"),
    )
    return decode_text(df, "content", "raw_text").drop("chars_extracted")


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark keeps in a query's checkpoint: the same after a restart, another for a new checkpoint."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0])["id"]


def start_ingest(spark: SparkSession, src: str, out: str, checkpoint: str,
                 model: str = C.DEFAULT_MODEL, run_ts: str = DEFAULT_RUN_TS,
                 fmt: str = "parquet", trigger_once: bool = True, glob: str | None = None, job: str = "ingest"):
    """Start the streaming run; returns the StreamingQuery.  Read the result with `read_ingested`."""
    runs = run_pipeline(stream_files(spark, src, glob), model=model, run_ts=run_ts, keep_text=False)

    def sink(batch: DataFrame, epoch_id: int) -> None:
        # a replayed epoch replaces its own rows and no other's
        epoch = f"{job}/{_stream_id(spark, checkpoint)}/{epoch_id}"
        commit(batch.withColumn("job", F.lit(job)), out, PARTS, epoch, fmt)

    w = runs.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if trigger_once else w.trigger(processingTime="30 seconds")
    return w.start()


def read_ingested(spark: SparkSession, out: str, fmt: str = "parquet", as_of: int | None = None) -> DataFrame:
    """The runs of all committed epochs, of every job and checkpoint."""
    corpus = spark.createDataFrame([], CORPUS_SCHEMA)
    fields = run_pipeline(corpus, keep_text=False).schema.fields
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields) + ", job string"
    return read_committed(spark, out, schema, PARTS, fmt, as_of)

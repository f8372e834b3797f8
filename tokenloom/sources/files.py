"""OP01 / OP02: documents from files, and UTF-8 decoding that drops invalid
bytes (Python's errors='ignore')."""

from __future__ import annotations

from typing import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C

# One byte of an ill-formed sequence, in the view of the bytes as ISO-8859-1 characters.  A lead byte is ill-formed
# where its sequence is not complete behind it, a continuation byte where no lead byte before it reaches it.  Sequences
# can't overlap, so looking at most three bytes around is exact, and no loop of the pattern runs over the text.
_CONT = r"[\x80-\xBF]"
_LEADS = (  # lead byte, its first continuation byte, further ones
    (r"[\xC2-\xDF]", _CONT, 0),
    (r"\xE0", r"[\xA0-\xBF]", 1),
    (r"[\xE1-\xEC\xEE\xEF]", _CONT, 1),
    (r"\xED", r"[\x80-\x9F]", 1),
    (r"\xF0", r"[\x90-\xBF]", 2),
    (r"[\xF1-\xF3]", _CONT, 2),
    (r"\xF4", r"[\x80-\x8F]", 2),
)


def _ill_formed() -> str:
    bad = [r"[\xC0\xC1\xF5-\xFF]"]
    reached = []
    for lead, second, more in _LEADS:
        bad.append(f"{lead}(?!{second}{_CONT * more})")
        for k in range(more + 1):  # the byte is the k-th behind the second one; the rest of the sequence stands ahead
            reached.append(f"{lead}{second}{_CONT * k}(?={_CONT * (more - k)})")
    return "|".join(bad) + f"|{_CONT}(?<!{'|'.join(reached)})"


ILL_FORMED = _ill_formed()


def decode_expr(content: Column) -> Column:
    """The text of a BINARY column without the bytes of ill-formed UTF-8 sequences, as errors='ignore' gives it.

    Valid UTF-8 is a plain cast.  Other bytes are read as ISO-8859-1, one
    character a byte, cleaned by one regular expression and encoded again.
    """
    text = content.cast("string")
    clean = F.regexp_replace(F.decode(content, "ISO-8859-1"), ILL_FORMED, "")
    return F.when(F.is_valid_utf8(text), text).otherwise(F.encode(clean, "ISO-8859-1").cast("string"))


def decode_text(df: DataFrame, content_col: str = "content", out: str = "raw_text") -> DataFrame:
    """OP02 (Parse): the decoded text and its length, in the JVM."""
    return df.withColumn(out, decode_expr(F.col(content_col))).withColumn("chars_extracted", F.length(out))


def _missing(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """The paths (or patterns) that name nothing."""
    conf = spark._jsc.hadoopConfiguration()
    gone = []
    for p in paths:
        where = spark._jvm.org.apache.hadoop.fs.Path(p)
        found = where.getFileSystem(conf).globStatus(where)
        if found is None or len(found) == 0:
            gone.append(p)
    return gone


def _scan(spark: SparkSession, paths: Sequence[str], glob: str | None, recursive: bool) -> DataFrame:
    gone = _missing(spark, paths)
    if gone:
        raise FileNotFoundError(f"no such file: {', '.join(gone)}")
    r = spark.read.format("binaryFile")
    if glob:
        r = r.option("pathGlobFilter", glob)
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    return r.load(list(paths))


def _empty_files(scan: DataFrame) -> DataFrame:
    """path of the files without a byte, which Spark's scans leave out; its index knows them (as all paths, it lies on the driver)."""
    # the index gives escaped URIs, the scan plain paths
    plain = [unquote(p).replace("file:///", "file:/", 1) for p in scan.inputFiles()]
    known = scan.sparkSession.createDataFrame([(p,) for p in plain], "path string")
    return known.join(scan.select("path"), "path", "left_anti")


def list_files(spark: SparkSession, paths: str | Sequence[str], glob: str | None = None, recursive: bool = True) -> DataFrame:
    """path, size and modified of each file; no content is read.  All missing paths are named in one error."""
    scan = _scan(spark, [paths] if isinstance(paths, str) else list(paths), glob, recursive)
    empty = _empty_files(scan).select("path", F.lit(0).cast("bigint").alias("size"), F.lit(None).cast("timestamp").alias("modified"))
    return scan.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified")).unionByName(empty)


#: a larger file does not fit a row of the binary file source
MAX_FILE_BYTES = 1 << 30


def read_files(
    spark: SparkSession,
    paths: str | Sequence[str],
    glob: str | None = None,
    recursive: bool = True,
    doc_type: str = C.DEFAULT_DOC_TYPE,
    max_bytes: int = MAX_FILE_BYTES,
    name_pattern: str = r"([^/]+)$",
) -> DataFrame:
    """OP01 (Intake) + OP02: one row per file in the corpus shape.

    Missing paths raise, all of them in one error.  Each file is one row, read
    whole; Spark packs the listed files into tasks by their sizes, largest
    first, up to spark.sql.files.maxPartitionBytes a task, so no shuffle is
    needed to balance them.  Files above max_bytes are not opened: `reject_files`
    lists them.  name_pattern: what of a path is the file's name (first group).
    """
    scan = _scan(spark, [paths] if isinstance(paths, str) else list(paths), glob, recursive)
    empty = _empty_files(scan).select("path", F.lit(0).cast("bigint").alias("length"), F.lit(b"").alias("content"))
    df = scan.where(F.col("length") <= max_bytes).select("path", "length", "content").unionByName(empty)
    df = df.select(
        F.col("path").alias("doc_key"),
        F.col("path").alias("file_path"),
        F.regexp_extract("path", name_pattern, 1).alias("filename"),
        F.lit(doc_type).alias("doc_type"),
        F.col("length").alias("file_size_bytes"),
        F.col("content"),
    )
    return decode_text(df, "content", "raw_text").drop("chars_extracted")


def reject_files(listing: DataFrame, wanted: DataFrame | None = None, max_bytes: int = MAX_FILE_BYTES) -> DataFrame:
    """path and reject_reason: files too large for a row, and wanted paths that the listing lacks.

    listing: see `list_files`; wanted: a table with a column path, of any size.
    """
    large = listing.where(F.col("size") > max_bytes).select("path", F.lit("too_large").alias("reject_reason"))
    if wanted is None:
        return large
    asked = wanted.select("path").where("path is not null").distinct()
    missing = asked.join(listing.select("path"), "path", "left_anti").select("path", F.lit("missing").alias("reject_reason"))
    return large.join(asked, "path", "left_semi").unionByName(missing)


def wanted_files(corpus: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows of `read_files` whose path the table `wanted` names."""
    asked = wanted.select(F.col("path").alias("_path")).distinct()
    return corpus.join(asked, corpus["file_path"] == asked["_path"], "left_semi")

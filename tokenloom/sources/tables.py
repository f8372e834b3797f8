"""OP03: corpora from parquet tables, in the common corpus shape

    doc_key STRING, file_path STRING, filename STRING, doc_type STRING,
    file_size_bytes BIGINT, content BINARY, raw_text STRING

The ready sources return only rows with a text; `split_rejects` gives the others
with their reason.  A null role or text of a turn counts as empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import config as C
from ..operators.numbering import numbered
from ..session import checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame, min_partitions: int | None = None, keys: list[str] | None = None) -> DataFrame:
    """Spread a scan that came back as too few partitions over the cores.

    Small single-row-group files yield one scan task, which would serialise
    all per-document work.  Only then is a repartition added (round-robin,
    or by a unique key when given: deterministic, so a plan that uses the
    same spread corpus twice shares one exchange); a large scan already has
    enough splits and is left as it is (no shuffle).

    For bare scans only: asking a frame with a shuffle for its partitions would
    run that shuffle while the query is built.
    """
    spark = df.sparkSession
    want = min_partitions or spark.sparkContext.defaultParallelism
    have = df.rdd.getNumPartitions()
    if have >= want:
        return df
    return df.repartition(want, *keys) if keys else df.repartition(want)


def split_rejects(corpus: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows that can run, rejects): a row without text is a reject and never
    enters a run or a report.  Rejects have doc_key, file_path and reject_reason."""
    null = F.col("raw_text").isNull()
    rejects = corpus.where(null).select("doc_key", "file_path", F.lit("null_text").alias("reject_reason"))
    return corpus.where(~null), rejects


def table_corpus(df: DataFrame, key, path, filename, text, doc_type: str) -> DataFrame:
    """Any table as a corpus; null texts are kept, see split_rejects."""
    content = F.encode(text, "UTF-8")
    return df.select(
        key.cast("string").alias("doc_key"),
        path.alias("file_path"),
        filename.cast("string").alias("filename"),
        F.lit(doc_type).alias("doc_type"),
        F.octet_length(text).cast("bigint").alias("file_size_bytes"),
        content.alias("content"),
        text.alias("raw_text"),
    )


def documents_corpus(
    spark: SparkSession, sf_dir: str, doc_type: str = C.DEFAULT_DOC_TYPE, with_content=True,
    spread_keys: list[str] | None = None, spread_scan: bool = True,
) -> DataFrame:
    """`documents.text`; no file name, so the type comes from the signals.

    The scan is spread (when needed) before the corpus columns are derived,
    so a shuffle carries the text once, not the text and its bytes.
    """
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    d = spread(d, keys=spread_keys) if spread_scan else d
    out = table_corpus(
        d,
        F.col("doc_id"),
        F.concat(F.lit("documents/"), F.col("doc_id").cast("string")),
        F.lit(None).cast("string"),
        F.col("text"),
        doc_type,
    )
    out = split_rejects(out)[0]
    return out if with_content else out.drop("content")


def pages_corpus(spark: SparkSession, sf_dir: str, doc_type: str = "web_page") -> DataFrame:
    """`pages.html` with the url as file name (the name rules apply to it)."""
    p = spread(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return split_rejects(table_corpus(p, F.col("page_id"), F.col("url"), F.col("url"), F.col("html"), doc_type))[0]


#: a conversation beyond one of these is assembled from pieces, and becomes several rows of about this many characters
LONG_TURNS, LONG_CHARS = 10_000, 16_000_000
#: turns that one piece takes
PIECE_TURNS = 500


def _line() -> Column:
    return F.concat(F.coalesce("role", F.lit("")), F.lit(": "), F.coalesce("text", F.lit("")))


def _joined(rows: DataFrame, by: list[str], order: list[str], text: str) -> DataFrame:
    """One row for each `by`: the texts in order, a line each, and n_turns.  A group is one transcript or a bounded part of one."""
    parts = F.array_sort(F.collect_list(F.struct(*order, F.col(text).alias("_t"))))
    return rows.groupBy(*by).agg(F.array_join(F.transform(parts, lambda p: p["_t"]), "\n").alias("text"), F.sum("n_turns").alias("n_turns"))


def transcript_text(conversations: DataFrame, long_turns: int = LONG_TURNS, long_chars: int = LONG_CHARS,
                    piece_turns: int = PIECE_TURNS) -> DataFrame:
    """conv_id, part, text, n_turns: the transcript, 'role: text' lines in the order of turn, role and text.

    A conversation is one row with part 0.  One of more than long_turns turns or
    long_chars characters never comes together in one task: its turns are
    numbered by ranges, every piece_turns of them are joined, and its pieces are
    joined to rows (part 0, 1, ...) of which each begins within long_chars
    characters of the one before.  The parts, joined by a line end, are the
    transcript.
    """
    turns = conversations.select("conv_id", "turn", "role", "text")
    chars = F.length(_line()) + 1
    long = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"), F.sum(chars).alias("c")).where(
        (F.col("n") > long_turns) | (F.col("c") > long_chars)).select(F.col("conv_id").alias("_long"))
    checkpoint_dir(turns.sparkSession)
    long = long.checkpoint()  # read twice or more; a row for each long conversation
    is_long = turns["conv_id"].eqNullSafe(long["_long"])
    rest = turns.join(long, is_long, "left_anti") if not long.isEmpty() else turns
    rest = rest.select("conv_id", "turn", "role", "text", _line().alias("line"), F.lit(1).alias("n_turns"))
    whole = _joined(rest, ["conv_id"], ["turn", "role", "text"], "line").withColumn("part", F.lit(0).cast("bigint"))
    columns = ["conv_id", "part", "text", "n_turns"]
    if long.isEmpty():
        return whole.select(*columns)
    rows = numbered(turns.join(long, is_long, "left_semi"), "conv_id", ["turn", "role", "text"])
    rows = rows.select("conv_id", "idx", _line().alias("line"), F.lit(1).alias("n_turns"),
                       F.expr(f"idx div {piece_turns}").alias("piece"))
    pieces = _joined(rows, ["conv_id", "piece"], ["idx"], "line").withColumnRenamed("text", "line")
    pieces = pieces.checkpoint()
    before = Window.partitionBy("conv_id").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    sizes = pieces.select("conv_id", "piece", (F.length("line") + 1).alias("size"))  # no text: a row for each piece
    starts = sizes.select(F.col("conv_id").alias("_c"), F.col("piece").alias("_p"),
                          F.floor(F.coalesce(F.sum("size").over(before), F.lit(0)) / long_chars).alias("part"))
    placed = pieces.join(starts, pieces["conv_id"].eqNullSafe(starts["_c"]) & (pieces["piece"] == starts["_p"]))
    return whole.select(*columns).unionByName(_joined(placed, ["conv_id", "part"], ["piece"], "line").select(*columns))


def conversations_corpus(spark: SparkSession, sf_dir: str, doc_type: str = "transcript", **limits) -> DataFrame:
    """The transcripts; the rows of a long one have keys `conv_id#part` from its second part on."""
    t = transcript_text(table(spark, sf_dir, "conversations"), **limits)
    key = F.concat(F.col("conv_id").cast("string"), F.when(F.col("part") > 0, F.concat(F.lit("#"), F.col("part").cast("string"))).otherwise(""))
    corpus = table_corpus(
        t,
        key,
        F.concat(F.lit("conversations/"), key),
        F.lit(None).cast("string"),
        F.col("text"),
        doc_type,
    )
    return split_rejects(corpus)[0]

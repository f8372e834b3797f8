"""Transcripts of short and long conversations against plain string joins."""

from pyspark.sql import functions as F

from tokenloom.operators.numbering import numbered
from tokenloom.sources.tables import conversations_corpus, transcript_text


def plain(rows):
    """conv_id -> transcript."""
    out = {}
    for c, t, r, x in sorted(rows, key=lambda v: ((v[1] is not None, v[1] or 0), (v[2] is not None, v[2] or ""), (v[3] is not None, v[3] or ""))):
        out.setdefault(c, []).append(f"{r or ''}: {x or ''}")
    return {c: "\n".join(lines) for c, lines in out.items()}


def joined(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: r.part):
        out.setdefault(r.conv_id, []).append(r.text)
    return {c: "\n".join(p) for c, p in out.items()}


SCHEMA = "conv_id long, turn long, role string, text string"


def test_numbers_within_groups(spark):
    rows = [(g, k % 40, f"v{k}") for k in range(300) for g in (None, "a", "b" if k % 9 else "c")]
    df = spark.createDataFrame(rows, "g string, k long, v string").repartition(6)
    got = {}
    for r in numbered(df, "g", ["k", "v"]).collect():
        got.setdefault(r.g, []).append((r.idx, r.k, r.v))
    for g, found in got.items():
        own = sorted((k, v) for a, k, v in rows if a == g)
        assert [(k, v) for _, k, v in sorted(found)] == own and [i for i, *_ in sorted(found)] == list(range(len(own)))
    assert numbered(df.limit(0), "g", ["k"]).count() == 0


def test_ties_nulls_and_all_limits(spark):
    rows = [(1, k, "user" if k % 2 else "assistant", f"text {k}\nline") for k in range(23)] + [(2, 0, "user", "hi")]
    rows += [(3, 5, None, None), (3, 5, "user", None), (3, None, "user", "x"), (3, 5, "user", None), (3, None, None, "é" * 50)]
    rows += [(None, k, "user", f"no id {k}") for k in range(9)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    for long_turns, long_chars, piece_turns in ((100, 10**6, 10), (4, 10**6, 3), (100, 60, 2), (1, 1, 1), (0, 45, 4)):
        out = transcript_text(df, long_turns, long_chars, piece_turns)
        assert joined(out) == plain(rows), (long_turns, long_chars, piece_turns)
        assert sum(r.n_turns for r in out.collect()) == len(rows)
    assert transcript_text(df.limit(0)).count() == 0
    assert [r.part for r in transcript_text(df).select("part").distinct().collect()] == [0]


def test_one_long_conversation_lies_in_many_bounded_tasks(spark):
    n = 300_000
    df = spark.range(0, n, 1, 8).select(F.when(F.col("id") < n - 50, F.lit(7)).otherwise(F.col("id")).alias("conv_id"), F.reverse(F.col("id").cast("string")).alias("r"),
                                        (n - F.col("id")).alias("turn"), F.lit("user").alias("role"), F.concat(F.lit("t"), F.col("id").cast("string")).alias("text"))
    out = transcript_text(df, long_chars=500_000).cache()
    parts = sorted(out.where("conv_id = 7").collect(), key=lambda r: r.part)
    assert len(parts) > 6 and max(len(r.text) for r in parts) < 520_000
    want = "\n".join(f"user: t{i}" for i in range(n - 51, -1, -1))
    assert "\n".join(r.text for r in parts) == want
    assert out.where("conv_id <> 7").count() == 50 and sum(r.n_turns for r in out.collect()) == n
    tasks = out.where("conv_id = 7").groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) > 2


def test_keys_of_parts(spark, tmp_path):
    rows = [(1, k, "user", "x" * 30) for k in range(10)] + [(2, 0, "user", "y")]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    keys = sorted(r.doc_key for r in conversations_corpus(spark, str(tmp_path), long_turns=5, long_chars=100, piece_turns=2).collect())
    assert keys == ["1", "1#1", "1#2", "2"]

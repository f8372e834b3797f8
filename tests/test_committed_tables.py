"""Committed tables: half-written jobs, reruns, versions; the token store on top; streams that start anew."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tokenloom.operators.token_store import by_family, count_missing, read_counts, tokenizer, with_token_counts
from tokenloom.plans.pipeline import run_pipeline
from tokenloom.sources.manifest import commit, entries, read_committed, version
from tokenloom.sources.sinks import read_artifacts, write_artifacts
from tokenloom.sources.tables import documents_corpus

SCHEMA = "k long, v string, job string, minute string"


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "table")


def rows(spark, *values):
    return spark.createDataFrame(values, SCHEMA)


def shown(spark, root, **kw):
    return sorted((r.k, r.v, r.job, r.minute) for r in read_committed(spark, root, SCHEMA, ("job", "minute"), **kw).collect())


def test_a_commit_replaces_its_own_parts_only(spark, root):
    parts = ("job", "minute")
    assert shown(spark, root) == [] and version(spark, root) == 0
    one = commit(rows(spark, (1, "a", "x", "m1"), (2, "b", "x", "m2"), (3, "c", "y/ü=", None)), root, parts)
    two = commit(rows(spark, (4, "d", "x", "m2"), (5, "e", "y/ü=", "m1")), root, parts)
    assert (one, two) == ((1, 3), (2, 2))
    assert shown(spark, root) == [(1, "a", "x", "m1"), (3, "c", "y/ü=", None), (4, "d", "x", "m2"), (5, "e", "y/ü=", "m1")]
    assert shown(spark, root, as_of=1) == [(1, "a", "x", "m1"), (2, "b", "x", "m2"), (3, "c", "y/ü=", None)]
    assert shown(spark, root, as_of=0) == []
    empty = commit(rows(spark, (1, "a", "x", "m1")).limit(0), root, parts)
    assert empty == (2, 0) and len(shown(spark, root)) == 4
    third = commit(rows(spark, (9, "z", "x", "m1")), root, parts, epoch="later")
    assert third.seq == 3 and len(shown(spark, root)) == 5 and shown(spark, root, epochs=["later"]) == [(9, "z", "x", "m1")]


def test_a_job_that_dies_is_invisible(spark, root):
    commit(rows(spark, (1, "a", "x", "m")), root, ("job", "minute"))

    def fail_late(batches):
        for n, batch in enumerate(batches):
            yield batch
            if n >= 0 and batch.num_rows and batch.column(0)[0].as_py() >= 500:
                raise RuntimeError("lost")

    many = spark.range(0, 1000, 1, 4).select(F.col("id").alias("k"), F.lit("new").alias("v"), F.lit("x").alias("job"), F.lit("m").alias("minute"))
    with pytest.raises(Exception):
        commit(many.mapInArrow(fail_late, SCHEMA), root, ("job", "minute"))
    assert len(os.listdir(f"{root}/data")) == 2  # the folder of the dead job is there
    assert shown(spark, root) == [(1, "a", "x", "m")]
    assert commit(rows(spark, (2, "b", "x", "m")), root, ("job", "minute")) == (2, 1)
    assert shown(spark, root) == [(2, "b", "x", "m")]


def test_unpartitioned_and_json(spark, root):
    df = spark.createDataFrame([(1, None), (2, "b")], "k long, v string")
    commit(df, root, (), fmt="json")
    commit(df, root, (), fmt="json")
    got = read_committed(spark, root, "k long, v string", (), "json")
    assert sorted((r.k, r.v) for r in got.collect()) == [(1, None), (2, "b")]


def test_artifacts_as_of_an_earlier_commit(spark, sf, root):
    corpus = documents_corpus(spark, sf)
    write_artifacts(run_pipeline(corpus), root, "one")
    write_artifacts(run_pipeline(corpus.limit(5)), root, "one")
    assert read_artifacts(spark, root).count() == 5
    assert read_artifacts(spark, root, as_of=1).count() == corpus.count()
    assert read_artifacts(spark, root).where("job = 'other'").count() == 0


def test_tokens_are_counted_once(spark, root):
    asked = spark.sparkContext.accumulator(0)

    def words(texts):
        if any("bad" in t for t in texts):
            raise ValueError("refused")
        asked.add(len(texts))
        return [len(t.split()) for t in texts]

    counter = by_family({"gpt": tokenizer(words)})
    texts = [("a b c", "gpt-4o"), ("a b c", "gpt-4o"), ("a b c", "gpt-4"), ("a b c", "claude-3"), ("x" * 40, None), (None, "gpt-4o"),
             ("bad text of twenty-f", "gpt-4o"), ("", "gpt-4o")]
    df = spark.createDataFrame([(k, *t) for k, t in enumerate(texts)], "k long, text string, model string").repartition(3)
    first = count_missing(df, "text", root, counter)
    assert first.rows == 3 and asked.value == 3  # "a b c" for two models, the empty text; the bad one and claude have no count
    got = {r.k: r.canonical_tokens for r in with_token_counts(df, "text", root).collect()}
    assert got == {0: 3, 1: 3, 2: 3, 3: 1, 4: 10, 5: None, 6: 5, 7: 0}
    again = count_missing(df.where("k < 4 or k = 7"), "text", root, by_family({"gpt": tokenizer(words)}))
    assert again == (first.seq, 0) and asked.value == 3  # nothing is missing, nothing is asked
    more = count_missing(df.unionByName(spark.createDataFrame([(9, "d e", "gpt-4o")], df.schema)).where("k <> 6"), "text", root, counter)
    assert (more.seq, more.rows, asked.value) == (first.seq + 1, 1, 4)
    assert read_counts(spark, root).count() == 4 and read_counts(spark, root, as_of=first.seq).count() == 3
    old = with_token_counts(spark.createDataFrame([(9, "d e", "gpt-4o")], df.schema), "text", root, as_of=first.seq)
    assert old.first().canonical_tokens == 0  # the estimate: the count is younger than that version
    assert {e["part"] for e in entries(spark, root)} == {"gpt-4o", "gpt-4"}


def test_a_store_filled_twice_at_once_still_joins_once(spark, root):
    df = spark.createDataFrame([(1, "a b", "gpt-4o")], "k long, text string, model string")
    counts = df.select(F.sha2("text", 256).alias("text_key"), "model", F.lit(2).cast("bigint").alias("n"))
    commit(counts, root, ["model"], epoch="one")
    commit(counts, root, ["model"], epoch="two")
    assert [r.canonical_tokens for r in with_token_counts(df, "text", root).collect()] == [2]


def test_a_real_tokenizer_counts_through_the_store(spark, root):
    tokenizers = pytest.importorskip("public_tokenizers")
    import base64

    import tiktoken

    path = tokenizers.path("byte_bpe_50k.tiktoken")
    pattern = tokenizers.PATTERN

    def load():
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def count(texts):
        return [len(t) for t in load().encode_ordinary_batch(texts)]

    texts = ["Hello there, general!", "", "ünï çødé 🎉", "a" * 50]
    df = spark.createDataFrame([(t, "gpt-4o") for t in texts], "text string, model string")
    count_missing(df, "text", root, by_family({}, default=tokenizer(count)))
    got = {r.text: r.canonical_tokens for r in with_token_counts(df, "text", root).collect()}
    assert got == {t: len(load().encode_ordinary(t)) for t in texts}


def test_a_stream_that_starts_anew_loses_nothing(spark):
    from tokenloom.streaming.ingest import read_ingested, start_ingest

    d = tempfile.mkdtemp(prefix="tl-stream-")
    src, out = os.path.join(d, "in"), os.path.join(d, "out")
    os.makedirs(src)

    def write(names):
        for n in names:
            with open(os.path.join(src, n), "w") as f:
                f.write(f"Document {n}. " * 60)

    def run(source, checkpoint):
        start_ingest(spark, source, out, os.path.join(d, checkpoint)).awaitTermination(120)
        return sorted(os.path.basename(r.file_path) for r in read_ingested(spark, out).collect())

    assert read_ingested(spark, out).count() == 0
    write(["a.txt", "b.txt"])
    assert run(src, "one") == ["a.txt", "b.txt"]
    write(["c.txt"])
    assert run(src, "one") == ["a.txt", "b.txt", "c.txt"]  # the same checkpoint goes on
    other = os.path.join(d, "other")
    os.makedirs(other)
    with open(os.path.join(other, "z.txt"), "w") as f:
        f.write("More text. " * 50)
    assert run(other, "two") == ["a.txt", "b.txt", "c.txt", "z.txt"]  # its epoch 0 replaces no other epoch 0
    assert read_ingested(spark, out, as_of=1).count() == 2


def test_a_counter_is_called_once_a_text(spark, root):
    calls = spark.sparkContext.accumulator(0)

    @F.udf("bigint")
    def words(text):
        if text is not None:
            calls.add(1)
            return len(text.split())

    texts = spark.createDataFrame([(f"a text of {k}", "m-1") for k in range(20)], "t string, model string")
    assert count_missing(texts, "t", root, by_family({"m": words})).rows == 20
    assert calls.value == 20  # not once more for the filter


def test_counts_are_joined_without_the_texts(spark, root):
    texts = spark.createDataFrame([("abcd efgh ijkl", "m-1"), ("some other text", None), (None, "m-1")], "t string, model string")
    count_missing(texts, "t", root, by_family({"m": lambda t: F.length(t)}))
    out = with_token_counts(texts, "t", root).select("model", "canonical_tokens")
    assert {tuple(r) for r in out.collect()} == {("m-1", 14), (None, 3), ("m-1", None)}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    above = plan[:plan.index("Join")]
    assert "length(t#" not in above  # estimated below the join

"""Columns with clashing names, equal rows, and workers that lack the package."""

import os
import pathlib
import subprocess
import sys

import pytest

pytest.importorskip("public_tokenizers")

from tokenloom.llm import quality_rules, url_rules, weak_quality  # noqa: E402

ROOT = pathlib.Path(__file__).resolve().parents[2]
TEXT = " ".join(f"word{k} of" for k in range(120))


def test_quality_rules_keep_other_columns_whatever_their_names(spark):
    names = ["doc_id", "text", "__text", "__words", "__h", "h", "row", "result", "pairs", "SCORE", "N_words", "Kept"]
    df = spark.createDataFrame([(k, TEXT + str(k), *names[2:]) for k in range(4)], names)
    out = quality_rules.quality_rules(df, df.select("doc_id").limit(2))
    assert out.columns == [*names[:-3], *quality_rules.RESULTS]
    for r in out.collect():
        assert all(r[c] == c for c in names[2:-3]) and r["n_words"] == 240
    both = quality_rules.judged(df, None).select("row.*").collect()
    assert [tuple(r)[2:] for r in both] == [tuple(names[2:])] * 4


def test_all_trusted_rows_count(spark):
    df = spark.createDataFrame([(k, "a b c" if k % 2 else "x y z") for k in range(400)], "doc_id long, text string")
    half = quality_rules.gram_weights(df, df.where("doc_id % 2 = 1").select("doc_id"))
    twice = quality_rules.gram_weights(df, df.where("doc_id % 2 = 1").select("doc_id").unionByName(df.where("doc_id = 1").select("doc_id")))
    assert half == twice and max(half) > 0 > min(half)
    few = quality_rules.gram_weights(df, df.where("doc_id = 1").select("doc_id"))
    assert few != half  # the share of the prior falls with the rows that count


def test_url_rules_keep_other_columns_whatever_their_names(spark):
    names = ["page_id", "url", "Host", "RULE", "__hit", "__url", "row", "own_url", "k"]
    df = spark.createDataFrame([(k, "http://a.org/es/1", *names[2:]) for k in range(3)], names)
    out = url_rules.url_rules(df, url_rules.rules_table(spark))
    assert out.columns == ["page_id", "url", "__hit", "__url", "row", "own_url", "k", "host", "path", "rule", "verdict"]
    assert all((r["__hit"], r["row"], r["k"], r["rule"]) == ("__hit", "row", "k", "org/") for r in out.collect())


def test_the_quality_stage_keeps_every_column(spark, tmp_path):
    import corpus_pipeline

    labels = spark.createDataFrame([(k, 1, 0) for k in range(3)], "doc_id long, quality long, toxic long")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    schema = "doc_id long, text string, score string, kept string, n_words int, Row string, n_chars int"
    df = spark.createDataFrame([(k, TEXT, "mine", "yes", -1, "r", 7) for k in range(3)] + [(9, "short", "mine", "no", -1, "r", 7)], schema)
    out = corpus_pipeline.quality(spark, df, str(tmp_path))
    assert out.schema == df.schema
    assert sorted(map(tuple, out.collect())) == [(k, TEXT, "mine", "yes", -1, "r", 7) for k in range(3)]
    for stage in (corpus_pipeline.near_duplicates, corpus_pipeline.repeated_passages):
        assert stage(spark, df, str(tmp_path)).columns == df.columns


def test_quality_classifier_does_not_depend_on_row_order(spark):
    rows = [(k % 20, TEXT[: 40 + 7 * k] + " $$$ ### " * (k % 5)) for k in range(80)]
    one = {tuple(r) for r in weak_quality.weak_quality(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    other = {tuple(r) for r in weak_quality.weak_quality(spark.createDataFrame(rows[::-1], "doc_id long, text string").repartition(5)).collect()}
    assert one == other


SCRIPT = """
import sys
sys.path[:0] = [{root!r}]
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4").getOrCreate()
def missing(_):
    import importlib.util
    yield importlib.util.find_spec("tokenloom") is None
assert all(spark.sparkContext.parallelize([1], 1).mapPartitions(missing).collect())
import corpus_pipeline
from tokenloom.llm import queries
sf = "/root/testdata/sf0.001"
for name, query in queries.QUERIES.items():
    assert query(spark, sf).count(), name
assert corpus_pipeline.run(spark, sf).count()
print("all ran")
"""


def test_workers_need_no_copy_of_the_package(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", SCRIPT.format(root=str(ROOT))], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    assert "all ran" in done.stdout, done.stderr[-3000:]


def test_jaccard_join_takes_ids_of_any_type(spark):
    from tokenloom.llm import jaccard_join

    texts = [TEXT, TEXT, TEXT.replace("word60", "other"), "a b c", None, "# !"]
    for ids, kind in ((["b", "a", "c", "d", "e", "f"], "string"), ([2, 1, 3, 4, 5, 6], "int"), ([2.5, 1.5, 3.5, 4.5, 5.5, None], "double")):
        df = spark.createDataFrame(list(zip(ids, texts)), f"doc_id {kind}, text string")
        out = jaccard_join.jaccard_join(df)
        assert out.schema["group_id"].dataType.simpleString() == kind
        got = {r.doc_id: (r.class_id, r.group_id, r.n_links) for r in out.collect()}
        first, second = ids[1], ids[2]
        assert got[ids[0]] == got[first] == (first, first, 2) and got[second] == (second, first, 2)
        assert got[ids[3]] == (ids[3], ids[3], 0) and got[ids[4]] == (ids[4], ids[4], 0)

"""Stored artifact sets by checksums; one fold for many budgets."""

import random

from pyspark.sql import functions as F

from tokenloom import config as C
from tokenloom.functions.compress import compress_extractive, extract_sizes, scored_sentences, tokens_of_extract
from tokenloom.functions.text import estimate_tokens, split_sentences
from tokenloom.operators.compare import FIELDS, KEYS, checksums, compare_artifacts, read_checksums, store_checksums
from tokenloom.plans.pipeline import run_pipeline
from tokenloom.sources.sinks import read_artifacts, write_artifacts
from tokenloom.sources.tables import documents_corpus


def test_checksums_depend_on_records_only(spark):
    df = spark.createDataFrame([(str(k % 50), f"m{k % 3}", k // 7, None if k % 5 else "x") for k in range(400)], "doc_key string, model string, n long, v string")
    def sums(d):
        return sorted(map(tuple, checksums(d, ("model",), ("doc_key",), ("n", "v"), 8).collect()), key=repr)
    one = sums(df.repartition(7))
    assert one == sums(df.orderBy(F.desc("n")).coalesce(1)) and len(one) == 24
    assert one != sums(df.limit(399)) and one != sums(df.unionByName(df.limit(1)))
    assert one != sums(df.withColumn("v", F.when(F.col("n") == 3, "y").otherwise(F.col("v"))))
    # two records that change in opposite ways don't cancel out
    assert sums(df.where("n < 2").unionByName(df.where("n < 2"))) != sums(df.where("n < 2"))


def test_equal_sets_read_checksums_only(spark, sf, tmp_path):
    root, other = str(tmp_path / "a"), str(tmp_path / "b")
    corpus = documents_corpus(spark, sf)
    write_artifacts(run_pipeline(corpus), root, "one")
    write_artifacts(run_pipeline(corpus.repartition(5), run_ts="2027-05-05 05:05:00"), other, "two")
    store_checksums(spark, root, "one")
    store_checksums(spark, other, "two")
    found = compare_artifacts(spark, root, "one", other, "two")
    assert found.same and found.parts == [] and found.rows.count() == 0
    plan = found.rows._jdf.queryExecution().optimizedPlan().toString()
    assert "Scan" not in plan and "Relation" not in plan.replace("LocalRelation", "")  # no record is read


def test_differences_are_found_and_only_they(spark, sf, tmp_path):
    root = str(tmp_path / "a")
    corpus = documents_corpus(spark, sf)
    n = corpus.count()
    keys = sorted(r.doc_key for r in corpus.select("doc_key").collect())
    changed, gone, extra = keys[3], keys[5], "new"
    second = corpus.where(F.col("doc_key") != gone).withColumn(
        "raw_text", F.when(F.col("doc_key") == changed, F.concat("raw_text", F.lit(" more"))).otherwise(F.col("raw_text")))
    second = second.withColumn("content", F.encode("raw_text", "UTF-8"))
    second = second.unionByName(second.limit(1).withColumn("doc_key", F.lit(extra)))
    write_artifacts(run_pipeline(corpus), root, "one")
    write_artifacts(run_pipeline(second), root, "two")
    found = compare_artifacts(spark, root, "one", root, "two")
    assert not found.same and 0 < len(found.parts) <= 3
    rows = {r.doc_key: r for r in found.rows.collect()}
    assert {k: r.status for k, r in rows.items()} == {changed: "changed", gone: "only_a", extra: "only_b"}
    assert "fingerprint" in rows[changed].changed_fields.split(",") and "doc_type" not in rows[changed].changed_fields
    # the job is written again, equal now: its checksums follow
    write_artifacts(run_pipeline(corpus), root, "two")
    assert compare_artifacts(spark, root, "one", root, "two").same
    assert read_checksums(spark, root, "two").agg(F.sum("rows")).first()[0] == n
    direct = checksums(read_artifacts(spark, root).where("job = 'two'"), ("model",), KEYS, FIELDS)
    assert sorted(map(tuple, direct.select("model", "bucket", "rows", "hash_sum", "hash_xor").collect())) == sorted(
        map(tuple, read_checksums(spark, root, "two").select("model", "bucket", "rows", "hash_sum", "hash_xor").collect()))


def test_jobs_without_records(spark, tmp_path, sf):
    root = str(tmp_path / "a")
    write_artifacts(run_pipeline(documents_corpus(spark, sf).limit(4)), root, "one")
    assert compare_artifacts(spark, root, "none", root, "nothing").same
    found = compare_artifacts(spark, root, "one", root, "none")
    assert {r.status for r in found.rows.collect()} == {"only_a"} and found.rows.count() == 4


def test_one_fold_equals_an_extract_for_each_budget(spark):
    rng = random.Random(3)
    words = ["must", "key", "asap", "um", "yes", "A", "decide", "thanks", "x" * 30, "ünï", "🎉"]

    def text():
        return "".join(rng.choice(words) + rng.choice([" ", ". ", "! ", "?\n", ".", ". . "]) for _ in range(rng.randint(0, 120)))

    budgets = [0, 1, 7, 40, 300, 10_000]
    rows = [(text(), rng.choice(["document", "email", "transcript", "chat"])) for _ in range(60)] + [("", "email"), (None, "email")]
    df = spark.createDataFrame(rows, "t string, ct string")
    fold = extract_sizes(scored_sentences(split_sentences("t"), F.col("ct")), [F.lit(b) for b in budgets])
    df = df.withColumn("f", fold).select(
        *[tokens_of_extract(F.col("f"), i).alias(f"a{i}") for i in range(len(budgets))],
        *[estimate_tokens(compress_extractive("t", b, F.col("ct"))).alias(f"b{i}") for i, b in enumerate(budgets)])
    for r in df.collect():
        assert [r[f"a{i}"] for i in range(len(budgets))] == [r[f"b{i}"] for i in range(len(budgets))]
    assert len(C.EXTRACT_JOINER) > 0

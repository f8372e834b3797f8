"""Equal content is run once: counts of computed rows, results as without reuse, one scan, one hot content."""

from pyspark.sql import Observation
from pyspark.sql import functions as F

from tokenloom import config as C
from tokenloom.operators.reuse import run_distinct
from tokenloom.plans import queries as Q
from tokenloom.plans.pipeline import run_pipeline

RESULTS = ["fingerprint", "content_type", "strategy", "compressed_tokens", "cost_saved", "benchmark_strategy", "compressed"]


def corpus(spark, rows, model=None):
    """(doc_key, filename, raw_text) rows in the corpus shape."""
    df = spark.createDataFrame(rows, "doc_key string, filename string, raw_text string")
    df = df.select("doc_key", F.concat(F.lit("p/"), "doc_key").alias("file_path"), "filename", F.lit("document").alias("doc_type"),
                   F.octet_length("raw_text").cast("bigint").alias("file_size_bytes"), F.encode("raw_text", "UTF-8").alias("content"), "raw_text")
    return df if model is None else df.withColumn("model", model)


def long_text(k):
    return f"Text {k} starts here. " + " ".join(f"Sentence {i} of {k} says a thing." for i in range(80))


ROWS = [*[(f"d{k}", None, long_text(k % 7)) for k in range(60)], ("a", "a.py", long_text(1)), ("b", "b.txt", long_text(1)),
        ("c", "c.py", long_text(1)), ("e", None, ""), ("f", None, ""), ("g", "", "one")]


def test_results_are_those_of_running_every_row(spark):
    df = corpus(spark, ROWS).repartition(5)
    seen = Observation("computed")
    out = run_distinct(df, RESULTS, carry=("file_path", "filename"), computed=seen)
    got = {r["doc_key"]: r for r in out.collect()}
    want = {r["doc_key"]: r for r in run_pipeline(df).collect()}
    assert set(got) == set(want) and len(got) == len(ROWS)
    keys = {}
    for k, r in want.items():
        assert all(got[k][c] == r[c] for c in RESULTS) and got[k]["file_path"] == r["file_path"]
        assert got[k]["chars_extracted"] == len(dict((a, c) for a, _, c in ROWS)[k])
        name_type = "code" if k in "ac" else "document" if k == "b" else None
        keys.setdefault((r["fingerprint"], name_type), []).append(k)
    for same in keys.values():
        assert {got[k]["copies"] for k in same} == {len(same)} and {got[k]["representative"] for k in same} == {min(same)}
    assert seen.get["rows"] == len(keys) == 11  # seven texts, two name types of one of them, the empty one, "one"


def test_options_models_and_salts(spark):
    model = F.when(F.col("doc_key") < "d3", "gpt-4o").otherwise("claude-3-haiku")
    df = corpus(spark, ROWS, model).repartition(3)
    cfg = C.DEFAULT_CONFIG.with_(target_ratio=0.5)
    want = {r["doc_key"]: (r["model"], r["compressed_tokens"], r["cost_saved"]) for r in run_pipeline(df, cfg=cfg).collect()}
    for salts in (1, 3, 64):
        out = run_distinct(df, ["model", "compressed_tokens", "cost_saved"], salts=salts, cfg=cfg).collect()
        assert {r["doc_key"]: (r["model"], r["compressed_tokens"], r["cost_saved"]) for r in out} == want


def test_one_hot_content_takes_many_tasks(spark):
    df = spark.range(0, 30000, 1, 6).select(
        F.col("id").cast("string").alias("doc_key"), F.lit(None).cast("string").alias("filename"),
        F.when(F.col("id") % 3 > 0, F.lit("the same text for most rows")).otherwise(F.concat(F.lit("own "), F.col("id").cast("string"))).alias("raw_text"))
    df = df.withColumn("content", F.encode("raw_text", "UTF-8"))
    seen = Observation("computed")
    out = run_distinct(df, ["compressed_tokens"], computed=seen)
    spread = out.where("copies > 1").groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in spread) == 20000 and len(spread) > 4
    assert seen.get["rows"] == 10001
    assert run_distinct(df.limit(0), ["compressed_tokens"]).count() == 0


def test_the_query_scans_once(spark, sf):
    df = Q.distinct_content(spark, sf)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("FileScan") == 1 and plan.count("ReusedExchange") == 1

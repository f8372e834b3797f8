"""Partial sums of jobs: merged reports equal reports over all runs; reruns replace; levels and prices."""

import itertools

from pyspark.sql import functions as F

from tokenloom import config as C
from tokenloom.operators.rollup import DIMS, corpus_rollup, partial_sums, read_sums, report, store_sums

COLUMNS = "model string, doc_type string, content_type string, strategy string, raw_tokens bigint, compressed_tokens bigint, benchmark_strategy string"


def runs(n, start=0):
    models = ("gpt-4o", "claude-3-haiku", "gpt-4o-mini")
    return [(models[k % 3], ("a", None)[k % 2], f"c{k % 4}", ("none", "truncate")[k % 5 > 2], 10 * k, 7 * k, "optimized" if k % 3 else "baseline")
            for k in range(start, start + n)]


def plain(rows):
    """The report by loops: (model, dims, level) -> (documents, raw, optimized, chosen, accepted, costs)."""
    price = {k: a for k, a, _ in C.MODEL_PRICES}
    out = {}
    for keep in itertools.product((0, 1), repeat=3):
        level = sum((1 - b) << (2 - i) for i, b in enumerate(keep))
        groups = {}
        for m, *dims, r, o, s in rows:
            key = tuple(d if b else None for d, b in zip(dims, keep))
            g = groups.setdefault(key, {}).setdefault(m, [0] * 5)
            for i, v in enumerate((1, r, o, o if s == "optimized" else r, s == "optimized")):
                g[i] += v
        for key, models in groups.items():
            costs = {m: [(g[i] / 1000) * price[m] + 0.0 for i in (1, 2, 3)] for m, g in models.items()}
            for m, g in models.items():
                out[(m, *key, level)] = (*g, *costs[m])
            total = [sum(g[i] for g in models.values()) for i in range(5)]
            added = [0.0] * 3
            for m in sorted(models):
                added = [a + c for a, c in zip(added, costs[m])]
            out[(None, *key, level + 8)] = (*total, *added)
    return out


def rows_of(df):
    got = {tuple(r)[:5]: tuple(r)[5:] for r in df.collect()}
    assert len(got) == df.count()
    return got


def test_merged_report_equals_the_whole(spark, tmp_path):
    root = str(tmp_path)
    parts = {("one", "a"): runs(40), ("one", "b"): runs(30, 40), ("two", ""): runs(25, 70)}
    for (job, batch), rows in parts.items():
        store_sums(spark.createDataFrame(rows, COLUMNS), root, job, batch)
    everything = sum(parts.values(), [])
    assert rows_of(report(read_sums(spark, root))) == plain(everything)
    whole = report(partial_sums(spark.createDataFrame(everything, COLUMNS).repartition(7)))
    assert rows_of(whole) == plain(everything)
    store_sums(spark.createDataFrame(runs(5), COLUMNS), root, "one", "a")  # the batch again: replaced
    assert rows_of(report(read_sums(spark, root))) == plain(runs(5) + parts[("one", "b")] + parts[("two", "")])
    assert rows_of(report(read_sums(spark, root, as_of=3))) == plain(everything)
    assert rows_of(report(read_sums(spark, root).where("job = 'two'"))) == plain(parts[("two", "")])


def test_levels_of_a_rollup(spark):
    df = spark.createDataFrame(runs(50), COLUMNS)
    got = corpus_rollup(df, ["strategy", "doc_type"])
    direct = df.rollup("model", "strategy", "doc_type").agg(F.grouping_id().alias("grouping_level"), F.sum("raw_tokens").alias("raw_tokens"))
    key = ["model", "strategy", "doc_type", "grouping_level", "raw_tokens"]
    assert sorted(map(repr, got.select(*key).collect())) == sorted(map(repr, direct.select(*key).collect()))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
    assert corpus_rollup(df.limit(0), ["strategy"]).count() == 0 and report(partial_sums(df.limit(0)), DIMS).count() == 0

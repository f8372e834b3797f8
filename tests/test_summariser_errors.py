"""Errors of a summariser, copies of one text, and workers that lack the package."""

import os
import pathlib
import subprocess
import sys

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tokenloom.operators.salting import attach
from tokenloom.operators.summarize import SummarizerDown, _ask, tolerant


def requests(n):
    return pd.DataFrame({"prompt": [f"p{k}" for k in range(n)]})


def test_single_bad_requests_stand_alone():
    calls = []

    def picky(req):
        calls.append(len(req))
        if req["prompt"].isin(["p3", "p90"]).any():
            raise ValueError("refused")
        return " " + req["prompt"] + " "

    got = _ask(picky, requests(100))
    assert got == [None if k in (3, 90) else f"p{k}" for k in range(100)] and sum(calls) < 900
    assert _ask(picky, requests(4)) == ["p0", "p1", "p2", None] and _ask(picky, requests(0)) == []
    assert _ask(lambda r: [1] * len(r), requests(2)) == [None, None]


def test_an_error_of_every_request_rises_at_once():
    calls = []

    def down(req):
        calls.append(len(req))
        raise ConnectionError("no route")

    with pytest.raises(SummarizerDown, match="no route"):
        _ask(down, requests(1000))
    assert len(calls) <= 9
    assert tolerant(down)(requests(1000)) == [None] * 1000
    assert _ask(down, requests(3)) == [None] * 3  # too few to tell

    def missing(req):
        raise ModuleNotFoundError("no client")

    with pytest.raises(ModuleNotFoundError):
        _ask(missing, requests(1))
    with pytest.raises(SummarizerDown):
        _ask(lambda r: [], requests(50))


def test_copies_of_one_key_spread_over_tasks(spark):
    rows = spark.range(0, 9000, 1, 4).select(F.col("id"), F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id").cast("string"))).alias("k"))
    results = rows.select("k").distinct().where("k <> 'k3'").withColumn("v", F.length("k"))
    out = attach(rows, results, "k", [F.col("id")])
    assert sorted(map(tuple, out.select("id", "k", "v").collect())) == sorted((r.id, r.k, None if r.k == "k3" else len(r.k)) for r in rows.collect())
    tasks = out.where("k = 'hot'").groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) > 3 and max(t["count"] for t in tasks) < 6000


SCRIPT = """
import sys
sys.path[:0] = [{root!r}]
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4").getOrCreate()
def missing(_):
    import importlib.util
    yield importlib.util.find_spec("tokenloom") is None
assert all(spark.sparkContext.parallelize([1], 1).mapPartitions(missing).collect())
from tokenloom.plans.queries import QUERIES
for name in ("abstractive_callable", "hierarchical_callable", "canonical_counts"):
    assert QUERIES[name](spark, "/root/testdata/sf0.001").count(), name
print("all ran")
"""


def test_workers_need_no_copy_of_the_package(tmp_path):
    root = pathlib.Path(__file__).resolve().parents[1]
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", SCRIPT.format(root=str(root))], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert "all ran" in done.stdout, done.stderr[-3000:]


def test_the_queries_callable_is_cheap_for_single_requests():
    import time

    from tokenloom.plans.queries import LEAD_CHARS, _lead_summaries

    def by_series(requests):
        if (requests["prompt"].str.len() % 5 == 0).any():
            raise ValueError("request refused")
        return requests["prompt"].str.split("Content:\n", n=1).str[1].str[:LEAD_CHARS]

    asked = pd.DataFrame({"prompt": [f"Type\nContent:\n{'ab c' * k}Content:\n" for k in range(400)]})
    assert _ask(_lead_summaries, asked) == _ask(by_series, asked)
    took = []
    for fn in (_lead_summaries, by_series):
        start = time.process_time()
        _ask(fn, asked)
        took.append(time.process_time() - start)
    assert took[0] < 0.6 * took[1]

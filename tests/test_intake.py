"""Files: missing and too large ones, tables of wanted paths, tasks by size, names."""

import os

import pytest
from pyspark.sql import functions as F

from tokenloom import config as C
from tokenloom.functions.detect import signal_window
from tokenloom.sources.files import list_files, read_files, reject_files, wanted_files


@pytest.fixture
def folder(tmp_path):
    for i in range(60):
        d = tmp_path / f"part={i % 3}"
        d.mkdir(exist_ok=True)
        (d / f"f{i}.txt").write_bytes(b"x" * (1000 if i else 90_000) + bytes([0xFF]))
    (tmp_path / "part=0" / "empty.txt").write_bytes(b"")
    (tmp_path / "part=0" / "em+ %pty é.txt").write_bytes(b"")
    (tmp_path / "part=0" / "notes.md").write_bytes("é".encode())
    return str(tmp_path)


def test_listing_reads_no_content(spark, folder):
    listing = list_files(spark, folder, glob="*.txt")
    assert listing.count() == 62 and listing.agg(F.sum("size")).first()[0] == 59 * 1001 + 90_001
    plan = listing._jdf.queryExecution().sparkPlan().toString()
    assert "FileScan binaryFile" in plan and "content#" not in plan and "content:" not in plan


def test_all_missing_paths_are_named(spark, folder):
    with pytest.raises(FileNotFoundError, match=r"nowhere.*not-\*"):
        read_files(spark, [folder, f"{folder}/nowhere", f"{folder}/not-*"])
    assert read_files(spark, [f"{folder}/part=0", f"{folder}/part=1/f1*.txt"]).count() > 20


def test_too_large_and_wanted_files(spark, folder):
    listing = list_files(spark, folder)
    corpus = read_files(spark, folder, max_bytes=2000)
    assert corpus.count() == 62 and corpus.where("file_size_bytes > 2000").count() == 0
    assert [(os.path.basename(r.path), r.reject_reason) for r in reject_files(listing, max_bytes=2000).collect()] == [("f0.txt", "too_large")]
    some = [r.path for r in listing.collect() if r.path.endswith(("f0.txt", "f7.txt", "empty.txt"))]
    wanted = spark.createDataFrame([(p,) for p in some + some[:1] + ["file:/no/such", None]], "path string")
    got = wanted_files(read_files(spark, folder, max_bytes=2000), wanted).collect()
    assert sorted((r.filename, r.file_size_bytes, r.raw_text) for r in got) == [("empty.txt", 0, ""), ("f7.txt", 1001, "x" * 1000)]
    rejects = {os.path.basename(r.path): r.reject_reason for r in reject_files(listing, wanted, max_bytes=2000).collect()}
    assert rejects == {"f0.txt": "too_large", "such": "missing"}


def test_files_are_packed_into_tasks_by_size(spark, folder):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        tasks = read_files(spark, folder).where("file_size_bytes > 0").groupBy(F.spark_partition_id().alias("p")).agg(F.sum("file_size_bytes").alias("b"), F.count(F.lit(1)).alias("n")).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert sum(t.n for t in tasks) == 61
    assert all(t.b <= 20000 or t.n == 1 for t in tasks) and len(tasks) <= 8  # the large file alone, the others together


def test_names_from_paths(spark, folder):
    names = {r.filename for r in read_files(spark, folder, glob="f1*.txt", name_pattern=r"part=(\d+)/").select("filename").collect()}
    assert names == {"0", "1", "2"}


def test_window_with_capital_sigma(spark):
    cut = C.SIGNAL_WINDOW_CHARS
    texts = ["A" * (cut - 1) + "Σ" + "B" * 50, "A" * (cut - 1) + "Σ" + "." * 100 + "B", "A" * (cut - 1) + "Σ." + " B", "Σ" * 3000, "İ" * 2500, "Ab" * 4, "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r.w for r in df.select(signal_window("t").alias("w")).collect()]
    assert got == [None if t is None else t.lower()[:cut] for t in texts]

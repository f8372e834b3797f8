import __spark_entry__ as E


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "benchmark_strategy" in df.columns


def test_every_query_has_oracle_and_runs(spark, sf):
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    for name, fn in qs.items():
        df = fn(spark, sf)
        df.write.format("noop").mode("overwrite").save()  # whole query, no row cap

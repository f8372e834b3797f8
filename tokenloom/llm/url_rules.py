"""URL filters (operator 8), Spark expressions only: a sort-merge range join.

Host labels are reversed, so that a rule for a host and all its subdomains is
the key interval [com.example. , com.example/ ).  A rule's path is compared as
an equal prefix: each url is probed once for every path length that some rule
has.  Rules and probes are sorted together by (path, key); a sweep keeps the
stack of open intervals.  Intervals nest, so the stack's top after an event is
the last interval opened at the depth that remains.

The sweep runs in range partitions: each gives its last event to those after
it (one row a partition), so one hot host is spread over as many partitions as
its urls need.  Urls are judged once each, then joined back to their rows.

Defined results: null url or one without `://` has empty host and path and no
rule; rules without a host are ignored; repeated rules for one host and path
count once, `block` before `allow`; of fitting rules the longest text (host +
path) wins, ties by text; extra columns of the pages pass through
(columns named host, path, rule or verdict, in any case, are replaced by the results).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import ascii_lower, checkpointed, without


def host_and_path(url):
    """(host, path) of a url column: after the first ://, up to / ? # and ? #."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest.substr(F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return ascii_lower(host), path


def _reversed(host):
    return F.array_join(F.reverse(F.split(host, r"\.")), ".")


def rule_events(rules: DataFrame) -> DataFrame:
    """p, k, top: from key k on (path p), the innermost open rule (null: none)."""
    r = (
        rules.select(ascii_lower(F.col("host")).alias("host"), F.coalesce("path", F.lit("")).alias("p"), "verdict")
        .where("host <> '' and verdict is not null")
        .groupBy("host", "p")
        .agg(F.max("verdict").alias("verdict"))  # block > allow
        .select(
            "p",
            _reversed(F.col("host")).alias("rk"),
            F.struct(F.concat("host", "p").alias("rule"), "verdict").alias("own"),
        )
    )
    ends = r.select("p", F.inline(F.array(
        F.struct(F.concat("rk", F.lit(".")).alias("k"), F.lit(1).alias("step"), F.col("own").alias("own")),
        F.struct(F.concat("rk", F.lit("/")).alias("k"), F.lit(-1).alias("step"), F.lit(None).cast("struct<rule:string,verdict:string>").alias("own")),
    )))
    order = Window.partitionBy("p").orderBy("k")
    depth = ends.withColumn("depth", F.sum("step").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    # the stack: for each depth, the interval opened last
    top = F.last("own", ignorenulls=True).over(Window.partitionBy("p", "depth").orderBy("k").rowsBetween(Window.unboundedPreceding, 0))
    return depth.select("p", "k", F.when(F.col("depth") > 0, top).alias("top"))


def url_rules(pages: DataFrame, rules: DataFrame, default: str = "allow", url: str = "url") -> DataFrame:
    """The pages with host, path, rule (null: none fits) and verdict."""
    spark = pages.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    urls = pages.select(F.col(url).alias("__url")).where("__url is not null").distinct()
    h, p = host_and_path(F.col("__url"))
    events = rule_events(rules)
    lengths = sorted(x[0] for x in events.select(F.length("p")).distinct().collect())  # one small number per path length
    probes = (
        urls.select("__url", h.alias("h"), p.alias("path"))
        .where("h <> ''")
        .select(
            "__url",
            F.concat(_reversed(F.col("h")), F.lit(".")).alias("k"),
            "path",
            F.explode(F.array(*[F.lit(n) for n in lengths]) if lengths else F.lit(None).cast("array<int>")).alias("n"),
        )
        .where("length(path) >= n")
        .select(F.expr("substring(path, 1, n)").alias("p"), "k", F.lit(1).alias("kind"), "__url",
                F.lit(None).cast("struct<top:struct<rule:string,verdict:string>>").alias("state"))
    )
    marks = events.select("p", "k", F.lit(0).alias("kind"), F.lit(None).cast("string").alias("__url"), F.struct("top").alias("state"))
    keys = ["p", "k", "kind", "__url"]
    swept = checkpointed(
        probes.unionByName(marks).repartitionByRange(parts, *keys).withColumn("part", F.spark_partition_id())
    )
    last = swept.groupBy("part").agg(F.max(F.when(F.col("kind") == 0, F.struct("p", "k", "state"))).alias("m"))
    before = last.select(  # one row for each partition
        "part", F.last("m.state", ignorenulls=True).over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)).alias("open")
    )
    sweep = Window.partitionBy("part").orderBy(*keys).rowsBetween(Window.unboundedPreceding, 0)
    found = (
        swept.withColumn("state", F.last("state", ignorenulls=True).over(sweep))
        .where("kind = 1")
        .join(F.broadcast(before), "part")
        .select("__url", F.coalesce("state", "open")["top"].alias("top"))
        .where("top is not null")
        .groupBy("__url")
        .agg(F.max(F.struct(F.length("top.rule").alias("n"), F.col("top.rule").alias("rule"), F.col("top.verdict").alias("verdict"))).alias("__hit"))
    )
    rows = pages.select(F.struct(*pages.columns).alias("row"), F.col(url).alias("own_url"))
    out = rows.join(found, rows["own_url"] == found["__url"], "left")
    host, path = host_and_path(F.col("own_url"))
    return out.select(
        *[F.col(f"row.`{c}`") for c in without(pages.columns, ("host", "path", "rule", "verdict"))],
        host.alias("host"),
        path.alias("path"),
        F.col("__hit.rule").alias("rule"),
        F.coalesce("__hit.verdict", F.lit(default)).alias("verdict"),
    )


#: host, path, verdict of the registered query's rules
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)


def rules_table(spark: SparkSession, rules=RULES) -> DataFrame:
    """The rules as a table of literals."""
    rows = F.array(*[F.struct(F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(v).alias("verdict")) for h, p, v in rules])
    return spark.range(1).select(F.inline(rows))

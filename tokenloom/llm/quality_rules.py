"""Quality rules (operator 5), Spark expressions only.

Base rules on word, symbol, line and repetition counts of the whole text, then
a hashed n-gram log-likelihood ratio: words and word pairs are hashed into
BUCKETS bins; the raw multinomial counts the bins over every document, the
target multinomial over trusted documents.  A document's score is the sum of
log(target / raw) over its n-grams, divided by their number; it is kept when
the score reaches THRESHOLD.  Nothing is random.

Raw counts cover all documents.  Target counts cover the documents whose id is
trusted, up to `trusted_rows` ids (first by hash of the id above that), since the
ids are broadcast.  What reaches the driver is one row for each bin.

Defined results: a null text has no words; an empty or short text (n_words
below MIN_WORDS) fails the base rules; with no trusted rows every ratio is 0;
repeated ids are judged row by row; extra columns of the documents pass through,
whatever their names, but those named like a result (in any case) are replaced
by it; `judged` keeps these too, since it returns row and results as two structs.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import without

BUCKETS = 16384
#: trusted ids that are broadcast at most, 8 MB
TRUSTED_ROWS = 500_000
MIN_WORDS = 50
THRESHOLD = -0.2
SMOOTHING = 0.5
SPACE = r"[\x20\x09-\x0D]"
SPACES = " \t\n\x0b\x0c\r"
MARKS = r"[#*$%&|<>]"
RESULTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score")


def _let(value: Column, use) -> Column:
    """use(value), with value computed once."""
    return F.transform(F.array(value), use)[0]


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE + "+"), "")


def _bin(h: Column) -> Column:
    return h.bitwiseAND(F.lit(BUCKETS - 1))


def _from(xs: Column, first: int, last_cut: int) -> Column:
    """xs from its first-th element, without so many at the end."""
    return F.slice(xs, F.lit(first), F.greatest(F.size(xs) - (first - 1) - last_cut, F.lit(0)))


def _repeated_at(tri: Column, again: Column) -> Column:
    """Places of the windows whose hash is in `again`."""
    placed = F.zip_with(tri, F.sequence(F.lit(0), F.size(tri) - 1), lambda h, i: F.when(F.array_contains(again, h), i))
    return F.filter(placed, lambda i: i.isNotNull())


def _repeated_at_sorted(tri: Column) -> Column:
    """The same by sorting, for texts with many repeated windows."""
    placed = F.array_sort(F.zip_with(tri, F.sequence(F.lit(0), F.size(tri) - 1), lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    pad = F.array(F.lit(None).cast("struct<h:bigint,i:int>"))

    def repeated(s: Column) -> Column:
        same = lambda x, y: F.coalesce(x["h"] == y["h"], F.lit(False))
        both = F.zip_with(
            F.zip_with(s, F.concat(pad, _from(s, 1, 1)), lambda x, b: F.struct(x["h"].alias("h"), x["i"].alias("i"), same(x, b).alias("r"))),
            F.concat(_from(s, 2, 0), pad),
            lambda x, a: F.when(x["r"] | same(x, a), x["i"]),
        )
        return F.filter(both, lambda i: i.isNotNull())

    return _let(placed, repeated)


def _repeat_words(tri: Column) -> Column:
    """Words inside three-word windows whose hash occurs more than once; tri: the windows' hashes."""
    none = F.array().cast("array<bigint>")
    again = F.when(
        F.size(F.array_distinct(tri)) < F.size(tri),
        _let(F.sort_array(tri), lambda s: F.array_distinct(F.filter(
            F.zip_with(_from(s, 1, 1), _from(s, 2, 0), lambda x, y: F.when(x == y, x)), lambda x: x.isNotNull()))),
    ).otherwise(none)

    def count(again: Column) -> Column:
        at = F.when(F.size(again) <= 64, _repeated_at(tri, again)).otherwise(_repeated_at_sorted(tri))
        return F.when(F.size(again) > 0, F.size(F.array_distinct(F.flatten(F.transform(at, lambda i: F.array(i, i + 1, i + 2)))))).otherwise(0)

    return _let(again, count).cast("long")


def gram_weights(docs: DataFrame, trusted: DataFrame | None, trusted_rows: int = TRUSTED_ROWS) -> list[float]:
    """log(target / raw) of each bin.  trusted: table with doc_id, or None; at most trusted_rows ids of it count."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text"))
    flag = F.lit(False)
    if trusted is not None:
        ids = trusted.where("doc_id is not null").select(F.col("doc_id").alias("__id")).distinct()
        ids = ids.orderBy(F.xxhash64("__id"), "__id").limit(trusted_rows)
        rows = rows.join(F.broadcast(ids), rows["doc_id"] == F.col("__id"), "left")
        flag = F.col("__id").isNotNull()
    words = rows.select(flag.alias("trusted"), _words(F.col("text")).alias("w"))
    pairs = words.select("trusted", F.explode(F.arrays_zip(F.col("w").alias("a"), _from(F.col("w"), 2, 0).alias("b"))).alias("g"))
    one, two = _bin(F.xxhash64("g.a")), _bin(F.xxhash64(F.xxhash64("g.a"), F.xxhash64("g.b")))
    bins = (
        pairs.select("trusted", F.explode(F.when(F.col("g.b").isNotNull(), F.array(one, two)).otherwise(F.array(one))).alias("bin"))
        .groupBy("bin")
        .agg(F.count(F.lit(1)).alias("raw"), F.sum(F.col("trusted").cast("long")).alias("target"))
        .collect()
    )
    raw, target = [0] * BUCKETS, [0] * BUCKETS
    for b in bins:
        raw[b["bin"]], target[b["bin"]] = b["raw"], b["target"]
    all_raw, all_target = sum(raw), sum(target)
    if not all_target:
        return [0.0] * BUCKETS
    extra = SMOOTHING * BUCKETS
    return [
        math.log((t + SMOOTHING) / (all_target + extra)) - math.log((r + SMOOTHING) / (all_raw + extra))
        for t, r in zip(target, raw)
    ]


def judged(docs: DataFrame, trusted: DataFrame | None, threshold: float = THRESHOLD, trusted_rows: int = TRUSTED_ROWS) -> DataFrame:
    """row (struct of all columns of the document) and result (struct of RESULTS)."""
    weights = gram_weights(docs, trusted, trusted_rows)
    w = F.split(F.lit(",".join(map(repr, weights))), ",").cast("array<double>")
    text = F.col("text")
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.coalesce(text, F.lit("")).alias("text"))
    rows = rows.select("*", _words(text).alias("words"), F.filter(F.split(text, "\n"), lambda x: F.ltrim(F.translate(x, "\t\x0b\x0c\r", "    ")) != "").alias("lines"))
    words = F.col("words")
    rows = rows.select(
        "row",
        F.size(words).cast("long").alias("n_words"),
        F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit(MARKS)).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.transform(F.arrays_zip(_from(words, 1, 2), _from(words, 2, 1), _from(words, 3, 0)), lambda x: F.xxhash64(x)).alias("tri"),
        F.transform(words, lambda x: F.xxhash64(x)).alias("h"),
    )
    h = F.col("h")
    ones = F.aggregate(h, F.lit(0.0), lambda acc, x: acc + w[_bin(x)])
    twos = F.aggregate("pairs", F.lit(0.0), lambda acc, x: acc + w[x])
    rows = rows.select("*", F.zip_with(_from(h, 1, 1), _from(h, 2, 0), lambda x, y: _bin(F.xxhash64(x, y))).alias("pairs"))
    grams = F.size(h) + F.size("pairs")
    rows = rows.select(
        "row", "n_words", "word_chars", "n_symbols", "n_dup_lines",
        _repeat_words(F.col("tri")).alias("n_repeat_words"),
        F.when(grams > 0, (ones + twos) / grams).otherwise(0.0).alias("score"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    rows = rows.select("*", failed.alias("base_failed")).select(
        "*", (~F.col("base_failed") & (F.col("score") >= threshold)).alias("kept"))
    return rows.select("row", F.struct(*RESULTS).alias("result"))


def quality_rules(docs: DataFrame, trusted: DataFrame | None, threshold: float = THRESHOLD, trusted_rows: int = TRUSTED_ROWS) -> DataFrame:
    """The documents with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept and score."""
    own = without(docs.columns, RESULTS)
    return judged(docs, trusted, threshold, trusted_rows).select(*[F.col(f"row.`{c}`") for c in own], "result.*")


def trusted_ids(labels: DataFrame) -> DataFrame:
    return labels.where("quality = 1 and toxic = 0").select("doc_id")

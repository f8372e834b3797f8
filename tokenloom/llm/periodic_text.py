"""Periodic run detection in documents: stretches of words that repeat with one period, and texts without the repeats.

Word numbers are compressed by Re-Pair; the repetitions across each nonterminal's
boundary are computed once, moved to all places it derives, and merged into
maximal intervals (word_runs.py).  A document without a repeated half of the
least length can't hold a run and is passed over.

Documents don't meet: there is no shuffle, and a task holds a block of texts
(one text at least).  Defined cases: a null or blank text has no words and no
run; equal rows and null ids are judged row by row; other columns are not read,
so their names can't clash; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import blocks
from .word_runs import periodic_runs

SPACE = "[\\x20\\x09-\\x0D]+"
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run holds after its first period, joined by one space."""
    if not runs:
        return b" ".join(words)
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period:start + length] = False
    return b" ".join([words[i] for i in np.flatnonzero(keep)])


def _block(texts: list[str], least: int) -> tuple[list[int], list[list[tuple[int, int, int]]], list[bytes]]:
    words = [t.encode().split() for t in texts]  # bytes are split at exactly the six white space characters
    known: dict[bytes, int] = {}
    bounds = np.cumsum([0] + [len(w) for w in words])
    numbers = np.fromiter((known.setdefault(x, len(known)) for w in words for x in w), np.int64, bounds[-1])
    start, end, period = periodic_runs(numbers, bounds, least)
    own = np.searchsorted(start, bounds)
    found = []
    for d in range(len(texts)):
        part = slice(own[d], own[d + 1])
        found.append(list(zip((start[part] - bounds[d]).tolist(), (end - start)[part].tolist(), period[part].tolist())))
    return [len(w) for w in words], found, [collapsed(w, r) for w, r in zip(words, found)]


def periodic_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 12) -> DataFrame:
    """id, n_words, runs (by start, then period; start is a word's number from 0) and collapsed, the text without repeats.

    A run is a stretch with smallest period q of length max(least, 2 * q) or more
    that no neighbouring word extends keeping q.
    """
    fields = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = None

        def seen():
            nonlocal kind
            for batch in batches:
                kind = batch.schema.field(0).type
                yield batch

        runs = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for ids, texts in blocks(seen()):
            sizes, found, kept = _block(texts, least)
            found = [[{"start": s, "length": n, "period": q} for s, n, q in r] for r in found]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, kind), pa.array(sizes, pa.int64()), pa.array(found, runs), pa.array([k.decode() for k in kept], pa.string())],
                ["id", "n_words", "runs", "collapsed"])

    kind = fields.schema["id"].dataType.simpleString()
    out = fields.mapInArrow(judge, f"id {kind}, n_words bigint, runs {RUNS}, collapsed string")
    return out.withColumnRenamed("id", id_col)


def planted(text: Column, key: Column) -> Column:
    """The text with a periodic end where the key is divisible by ten: from word a on, words repeat with period p.

    a = g % n and p = 1 + (n - a) div (3 + g % 8), with g = key div 10 and n words.
    """
    words = F.filter(F.split(text, SPACE), lambda w: w != "")

    def end(w: Column) -> Column:
        n, g = F.size(w), F.floor(key / 10)
        a = (g % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        unit = F.slice(w, a + 1, p)
        times = F.ceil((n - a) / p).cast("int")
        return F.array_join(F.slice(F.concat(F.slice(w, F.lit(1), a), F.flatten(F.array_repeat(unit, times))), F.lit(1), n), " ")

    bound = F.element_at(F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, end(w)).otherwise("")), 1)
    return F.when(key % 10 == 0, bound).otherwise(text)


def runs_hash(runs: Column) -> Column:
    """sha256 of a line `start,length,period` for each run."""
    return F.sha2(F.array_join(F.transform(runs, lambda r: F.concat(
        r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))), ""), 256)


def longest(runs: Column) -> Column:
    """The run of greatest length (ties: smallest start, then period), null where there is none."""
    best = F.array_max(F.transform(runs, lambda r: F.struct(r["length"].alias("n"), (-r["start"]).alias("s"), (-r["period"]).alias("q"))))
    return F.when(best.isNotNull(), F.struct((-best["s"]).alias("start"), best["n"].alias("length"), (-best["q"]).alias("period")))

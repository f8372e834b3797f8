"""Periodic runs against brute force over all periods."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

pytest.importorskip("public_tokenizers")

from pyspark.sql import functions as F  # noqa: E402

from tokenloom.llm import periodic_text as P  # noqa: E402
from tokenloom.llm import queries, word_runs  # noqa: E402


def brute(w, least=12):
    """(start, length, period) of all runs, by start, then period."""
    found = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(least, 2 * q):
                found.setdefault((i, j + q - i), q)
            i = max(j, i + 1) if j > i else i + 1
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def shapes(rng):
    """A word sequence with repeats of many kinds."""
    letters = rng.choice([1, 2, 2, 3, 5, 30])
    w = [rng.randrange(letters) for _ in range(rng.randint(0, 80))]
    if w and rng.random() < 0.5:
        a, p = rng.randrange(len(w)), rng.randint(1, 9)
        unit = w[a:a + p]
        w = w[:a] + [unit[k % len(unit)] for k in range(rng.randint(0, 80))] + w[a + p:]
    return w * rng.choice([1, 1, 1, 2, 3])


@pytest.mark.parametrize("least", [12, 8, 5, 4, 3, 2])
def test_runs_of_many_documents(least):
    rng = random.Random(least)
    for _ in range(150):
        docs = [shapes(rng) for _ in range(rng.randint(1, 5))]
        bounds = np.cumsum([0] + [len(d) for d in docs])
        start, end, period = word_runs.periodic_runs(np.array(sum(docs, []), np.int64), bounds, least)
        want = [(s + int(bounds[d]), s + int(bounds[d]) + n, q) for d, w in enumerate(docs) for s, n, q in brute(w, least)]
        assert list(zip(start.tolist(), end.tolist(), period.tolist())) == want, docs


def test_pairs_are_compared_in_pieces(monkeypatch):
    monkeypatch.setattr(word_runs, "PAIRS", 7)
    w = [1, 2, 3] * 30 + [9] + [4, 5] * 20
    start, end, period = word_runs.periodic_runs(np.array(w), np.array([0, len(w)]))
    assert list(zip(start.tolist(), (end - start).tolist(), period.tolist())) == brute(w)


def test_grammar_derives_the_words():
    rng = random.Random(5)
    for _ in range(100):
        w = shapes(rng) or [0]
        derived, rest = word_runs.grammar(np.array(w), np.zeros(len(w), np.int64))
        by_name = {}
        for name, s, b, e in derived.T.tolist():
            by_name.setdefault(name, set()).add((tuple(w[s:e]), b - s))
            assert s < b < e
        assert all(len(x) == 1 for x in by_name.values())  # a nonterminal stands for one word sequence, cut at one place
        pieces = sorted(rest[1:].T.tolist())
        assert [i for s, e in pieces for i in range(s, e)] == list(range(len(w)))


def test_a_run_through_a_nonterminal_is_moved_to_all_its_places():
    unit = list(range(7)) * 4  # a run of 28 words with period 7
    w = []
    for k in range(9):
        w += [100 + k, *unit, 200 + k]
    start, end, period = word_runs.periodic_runs(np.array(w), np.array([0, len(w)]))
    assert period.tolist() == [7] * 9 and start.tolist() == [30 * k + 1 for k in range(9)] and set((end - start).tolist()) == {28}


TEXTS = [None, "", " \t\n\x0b\x0c\r ", "one", "a b " * 30, "a b " * 12, "x " * 11, "x " * 12, "un like " * 40, "p q r s t u " * 300 + "end",
         " ".join(random.Random(1).choice("abcdefg") for _ in range(900)), "a b " * 30]


def test_texts_and_odd_rows(spark):
    rows = [(i if i != 9 else None, t, 5, "mine", "c") for i, t in enumerate(TEXTS)]
    df = spark.createDataFrame(rows, "doc_id long, text string, id long, runs string, collapsed string").repartition(4)
    out = P.periodic_text(df)
    assert out.columns == ["doc_id", "n_words", "runs", "collapsed"]
    want = []
    for i, t, *_ in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        runs = brute(w)
        gone = {k for s, n, q in runs for k in range(s + q, s + n)}
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        want.append((i, len(w), [(s, n, q) for s, n, q in runs], kept))
    shown = [(r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in out.collect()]
    assert sorted(shown, key=repr) == sorted(want, key=repr)
    assert P.periodic_text(df.limit(0)).count() == 0
    named = P.periodic_text(df.select(F.col("doc_id").cast("string").alias("k"), F.col("text").alias("t")), "k", "t")
    assert sorted((r["k"] or "", r["collapsed"]) for r in named.collect()) == sorted((str(i) if i is not None else "", c) for i, _, _, c in want)


def test_a_text_longer_than_a_block(spark, monkeypatch):
    from tokenloom.llm import common

    monkeypatch.setattr(common.blocks, "__defaults__", (50,))
    test_texts_and_odd_rows(spark)


def test_the_query_over_its_table(spark):
    sf = "/root/testdata/sf0.001"
    got = {r["doc_id"]: tuple(r)[1:] for r in queries.op12_periodic_runs(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", d["text"] or "")
        if len(w) > 3000:
            continue  # brute force takes the square of the words
        h = zlib.crc32(str(d["doc_id"]).encode())
        if h % 10 == 0 and w:
            a = h // 10 % len(w)
            p = 1 + (len(w) - a) // (3 + h // 10 % 8)
            w = [w[k] if k < a else w[a + (k - a) % p] for k in range(len(w))]
        runs = brute(w)
        gone = {k for s, n, q in runs for k in range(s + q, s + n)}
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        digests = ("".join(f"{s},{n},{q}\n" for s, n, q in runs), " ".join(x for k, x in enumerate(w) if k not in gone))
        want = (len(runs), *best, 1000 * best[1] // best[2] if runs else None, *[hashlib.sha256(x.encode()).hexdigest() for x in digests])
        assert got[d["doc_id"]] == want, d["doc_id"]

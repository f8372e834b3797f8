import random
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tokenloom.functions.compress import compress_extractive, compress_truncate, pack_chunks
from tokenloom.functions.text import estimate_tokens, normalize_lines, py_strip, rfind, split_sentences

WS_CHARS = " \t\r\n\x0b\x0c\x1c\x1f\x85\xa0 　"
ALPHA = "ab. ?!#KEYé" + WS_CHARS


def _eval(spark, values, fn, schema="t string"):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(fn(F.col("t"))).collect()]


def test_normalize_literals(spark):
    pairs = {"  a \n\n\t b  \r\n c\u3000\n": "a\nb\nc", "x": "x", "": "", " \n\t\n ": "", "a  b\n": "a  b", "\x1ca\x1f\n\xa0b\x85": "a\nb",
             "a \x0b\x0c\n\n \n c": "a\nc", "no newline  here ": "no newline  here"}
    assert _eval(spark, list(pairs), normalize_lines) == list(pairs.values())


def test_normalize_is_linear_on_padding(spark):
    text = "a" + " " * 1_000_000 + "b" + " " * 1_000_000 + "\n" + " " * 1_000_000
    start = time.time()
    assert _eval(spark, [text], normalize_lines) == ["a" + " " * 1_000_000 + "b"]
    assert time.time() - start < 20  # far below the hours of a quadratic form


def test_expressions_keep_their_frames(spark):
    a = spark.createDataFrame([(1, "x" * 40)], "k int, text string")
    b = spark.createDataFrame([(1, "y" * 400)], "k int, text string")
    j = a.join(b, a["k"] == b["k"])
    assert tuple(j.select(estimate_tokens(a["text"]).alias("p"), estimate_tokens(b["text"]).alias("q")).first()) == (10, 100)


def test_normalize_idempotent(spark):
    texts = ["  a \n\n\t b  \r\n c　\n", "x", "", "\n\n"]
    once = _eval(spark, texts, normalize_lines)
    assert _eval(spark, once, normalize_lines) == once


def test_strip_unicode_and_separators(spark):
    texts = ["\x1c  hi  ", "﻿bom ", "a\r"]
    assert _eval(spark, texts, py_strip) == [t.strip() for t in texts]


def test_rfind(spark):
    texts = ["a. b. c", "none", ". ", "xx. y. "]
    got = _eval(spark, texts, lambda c: rfind(c, ". "))
    assert got == [t.rfind(". ") for t in texts]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet=ALPHA, max_size=60), min_size=1, max_size=10))
def test_split_sentences(spark, texts):
    import re

    got = _eval(spark, texts, split_sentences)
    assert got == [re.split(r"(?<=[.!?])\s+", t) for t in texts]


MARK = "\n\n[... content truncated ...]"


def test_truncate_literals(spark):
    cases = [
        ("short", 10, "short"),
        ("", 0, ""),
        ("x" * 100, 5, "x" * 20 + MARK),
        ("aaaa bbbb cccc dd. eeee ffff", 5, "aaaa bbbb cccc dd." + MARK),  # a sentence end past 80 %
        ("aa. bbbb cccc dddd eeee ffff", 5, "aa. bbbb cccc dddd e" + MARK),  # one before it does not count
        ("aaaa bbbb cccc d\n\neeee ffff", 5, "aaaa bbbb cccc d" + MARK),  # a paragraph end past 70 %
        ("a\n\nbbbb cccc dddd eeee ffff", 5, "a\n\nbbbb cccc dddd ee" + MARK),
    ]
    df = spark.createDataFrame([c[:2] for c in cases], "t string, k long")
    got = {(r.t, r.k): r.o for r in df.select("t", "k", compress_truncate(F.col("t"), F.col("k")).alias("o")).collect()}
    for t, k, want in cases:
        assert got[t, k] == want, (t, k)


def test_extractive_skip_and_continue(spark):
    # the long second sentence does not fit; a later short one still does
    text = "First one here. " + "Long " * 30 + "sentence here. Tiny end."
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(compress_extractive(F.col("t"), F.lit(6), F.lit("document"))).first()[0] == "First one here. [...] Tiny end."


@pytest.mark.parametrize("ctype", ["transcript", "document", "email", "web_page"])
def test_extractive_properties(spark, ctype):
    random.seed(11)
    vocab = ["We agreed.", "Please send by Friday.", "um, okay?", "KEY POINT.", "# Title.",
             "thanks, regards.", "A fairly ordinary sentence about nothing much.", "Short!",
             "You know what?", "It is important that we must act."]
    texts = [" ".join(random.choice(vocab) for _ in range(random.randint(1, 40))) for _ in range(40)]
    df = spark.createDataFrame([(t, k) for t in texts for k in (0, 5, 20)], "t string, k long")
    for r in df.select("t", "k", compress_extractive(F.col("t"), F.col("k"), F.lit(ctype)).alias("o")).collect():
        chosen, at = r.o.split(" [...] ") if r.o else [], 0
        assert sum(len(s) // 4 for s in chosen) <= r.k  # the budget holds
        for s in chosen:  # an ordered subset of the sentences
            at = r.t.index(s, at) + len(s)


def test_pack_chunks_properties(spark):
    random.seed(3)
    paras = ["p" * random.randint(0, 900) for _ in range(200)]
    texts = ["\n\n".join(paras[i:i + random.randint(1, 12)]) for i in range(0, 190, 7)] + ["", "solo"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", pack_chunks(F.col("t"), F.lit(100)).alias("c")).collect():
        assert "\n\n".join(r.c) == r.t
        tokens = [[len(p) // 4 for p in c.split("\n\n")] for c in r.c]
        assert all(sum(c) <= 100 or len(c) == 1 for c in tokens)
        assert all(sum(a) + b[0] > 100 for a, b in zip(tokens, tokens[1:]))  # nothing more would have fitted


def test_whitespace_class_is_python_isspace(spark):
    from tokenloom.functions.text import WS_CLASS

    chars = [chr(i) for i in range(0x10000) if not 0xD800 <= i < 0xE000]
    df = spark.createDataFrame([(c,) for c in chars], "c string")
    got = {r.c for r in df.filter(F.col("c").rlike("^" + WS_CLASS + "$")).collect()}
    assert got == {c for c in chars if c.isspace()}


def test_junk_shapes_stay_exact(spark):
    """Thousands of 0-token sentences / empty paragraphs (linear paths)."""
    tiny = "a. " * 6000 + "A real sentence that is long enough. " * 20
    blank = "\n\n" * 6000 + "word " * 900 + "\n\n" + ("p" * 50 + "\n\n") * 3000
    df = spark.createDataFrame([(tiny, blank)], "a string, b string")
    r = df.select(compress_extractive(F.col("a"), F.lit(120), F.lit("document")).alias("x"),
                  pack_chunks(F.col("b"), F.lit(100)).alias("c")).first()
    chosen = r.x.split(" [...] ")
    assert chosen.count("a.") == 6000 and sum(len(x) // 4 for x in chosen) <= 120
    assert "\n\n".join(r.c) == blank


def test_sentences_are_split_and_scored_once(spark):
    df = spark.createDataFrame([("One. Two two two two two. Three is three. x",), (None,), ("",)], "t string")
    out = df.select(compress_extractive(F.col("t"), F.lit(9), F.lit("document")).alias("x"))
    plan = out._jdf.queryExecution().analyzed().toString()
    assert plan.count("split(") == 1 and plan.count("lower(") == 1
    assert [r.x for r in out.collect()] == ["One. [...] Two two two two two. [...] Three is three. [...] x", None, ""]


def test_visible_characters_are_left_before_any_lookbehind(spark):
    from tokenloom.functions.text import RUN_START, SENTENCE_SPLIT

    assert RUN_START.startswith("(?![!-~])") and SENTENCE_SPLIT.startswith("(?![!-~])")
    texts = ["".join(random.Random(k).choices(ALPHA + " é~!", k=40)) for k in range(300)]
    assert _eval(spark, texts, py_strip) == [t.strip() for t in texts]
    assert _eval(spark, texts, normalize_lines) == ["\n".join(p.strip() for p in t.split("\n") if p.strip()) for t in texts]

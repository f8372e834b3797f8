"""Compression strategies as Column expressions (no Python per row).

* truncate    -- substring + reverse/locate for rfind
* extractive  -- split into sentences, score with `transform`, order with
                 `array_sort`, greedy skip-and-continue selection with an
                 `aggregate` fold (not a running-sum window: a sentence that
                 does not fit is skipped and later, shorter ones may still fit)
* chunks      -- greedy paragraph packing with an `aggregate` fold
* hierarchical (fallback summariser) -- per-chunk extractive inside the row
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config as C
from .text import (
    col_,
    contains_any,
    estimate_tokens,
    lit_,
    prefix,
    py_isupper,
    py_strip,
    rfind,
    split_paragraphs,
    split_sentences,
)


def compress_truncate(content, target_tokens) -> Column:
    """Cut at 4*target chars; back up to a paragraph (>70%) or sentence
    (>80%) end; strip; append the truncation marker."""
    text = col_(content)
    tc = lit_(target_tokens) * C.CHARS_PER_TOKEN
    t = prefix(text, tc)
    last_para = rfind(t, "\n\n")
    last_sent = F.greatest(rfind(t, ". "), rfind(t, "! "), rfind(t, "? "))
    cut = (
        F.when(last_para > tc * 0.7, prefix(t, last_para))
        .when(last_sent > tc * 0.8, prefix(t, last_sent + 1))
        .otherwise(t)
    )
    return F.when(F.length(text) <= tc, text).otherwise(
        F.concat(py_strip(cut), F.lit(C.TRUNCATION_MARKER))
    )


def sentence_score(s: Column, i: Column, n: Column, content_type, low: Column | None = None) -> Column:
    """Position + length + content-type keyword score of sentence i of n.

    `low` is the lowered sentence when already computed (inside a lambda an
    expression is re-evaluated at every use, so callers pass it in)."""
    ln = F.length(s)
    low = F.lower(s) if low is None else low
    position = F.when(i < 3, 3 - i).otherwise(0) + F.when(i >= n - 2, 1).otherwise(0)
    length_pen = F.when(ln < 20, -2).when(ln > 200, -1).otherwise(0)

    def pts(cond, v):
        return F.when(cond, v).otherwise(0)

    ctype = lit_(content_type)
    by_type = (
        F.when(
            ctype == "transcript",
            pts(contains_any(low, C.TRANSCRIPT_BOOST_WORDS), 3)
            + pts(F.instr(s, "?") > 0, 1)
            + pts(contains_any(low, C.TRANSCRIPT_FILLER_WORDS), -2),
        )
        .when(
            ctype == "document",
            pts(py_isupper(s) | s.startswith("#"), 2)
            + pts(contains_any(low, C.DOCUMENT_BOOST_WORDS), 2),
        )
        .when(
            ctype == "email",
            pts(contains_any(low, C.EMAIL_BOOST_WORDS), 2)
            + pts(contains_any(low, C.EMAIL_DAMP_WORDS), -1),
        )
        .otherwise(0)
    )
    return position + length_pen + by_type


def scored_sentences(sentences: Column, content_type) -> Column:
    """ARRAY<STRUCT<neg_score INT, idx INT, tok BIGINT, s STRING>> in order.

    Lambdas here only read their own variables: anything from outside a
    lambda body is re-evaluated per element, so the distance-from-end is
    zipped in beforehand instead of reading size(sentences) inside.
    """
    pairs = let(sentences, lambda given: F.zip_with(
        given, F.sequence(F.size(given) - 1, F.lit(0), F.lit(-1)),
        lambda s, r: F.struct(s.alias("s"), r.alias("r"), F.lower(s).alias("low")),
    ))
    return F.transform(
        pairs,
        lambda x, i: F.struct(
            (-sentence_score(x["s"], i, i + x["r"] + 1, content_type, x["low"])).alias("neg_score"),
            i.alias("idx"),
            estimate_tokens(x["s"]).alias("tok"),
            x["s"].alias("s"),
        ),
    )


def select_within_budget(scored: Column, target_tokens) -> Column:
    """Greedy by (-score, idx), skip-and-continue.  Returns the picked
    sentences as STRUCT<idx, s> in original order.

    scored: all sentences by idx, from 0.  A sentence of 0 tokens always fits
    (the running total never exceeds the budget), whatever its rank, so those
    are taken outside the fold.  The fold then appends at most `budget` times,
    and appends numbers: Spark copies its state at every step.
    """
    init = F.struct(
        F.lit(0).cast("bigint").alias("used"),
        lit_(target_tokens).cast("bigint").alias("budget"),
        F.array().cast("array<int>").alias("picked"),
    )

    def step(acc, x):
        fits = acc["used"] + x["tok"] <= acc["budget"]
        taken = F.struct(
            (acc["used"] + x["tok"]).alias("used"),
            acc["budget"].alias("budget"),
            F.array_append(acc["picked"], x["idx"]).alias("picked"),
        )
        return F.when(fits, taken).otherwise(acc)

    def pick(given):
        free = F.transform(F.filter(given, lambda x: x["tok"] == 0), lambda x: x["idx"])
        ordered = F.array_sort(F.filter(given, lambda x: x["tok"] > 0))
        picked = F.array_sort(F.concat(F.aggregate(ordered, init, step)["picked"], free))
        return F.transform(picked, lambda i: F.struct(i.alias("idx"), F.get(given, i)["s"].alias("s")))

    return let(scored, pick)  # the sentences are split and scored once


def extract_scored(scored: Column, target_tokens) -> Column:
    """The picked sentences' text, from sentences that are already scored."""
    return F.array_join(F.transform(select_within_budget(scored, target_tokens), lambda x: x["s"]), C.EXTRACT_JOINER)


def extract_sizes(scored: Column, budgets: list[Column]) -> Column:
    """The sizes of the extracts for all budgets, by one pass over the sentences in the order they are tried.

    A STRUCT of used tokens, characters and sentences for each budget; no text
    is built.  The budgets are plain columns: a lambda evaluates them for every
    sentence.
    """
    ordered = F.transform(F.array_sort(scored), lambda x: F.struct(
        x["tok"].alias("tok"), F.length(x["s"]).cast("bigint").alias("chars")))
    zero = F.lit(0).cast("bigint")
    start = F.struct(*[zero.alias(f"{c}{i}") for i in range(len(budgets)) for c in ("used", "chars", "n")])

    def step(acc, x):
        out = []
        for i, budget in enumerate(budgets):
            fits = acc[f"used{i}"] + x["tok"] <= budget
            for c, more in (("used", x["tok"]), ("chars", x["chars"]), ("n", F.lit(1).cast("bigint"))):
                out.append((acc[f"{c}{i}"] + F.when(fits, more).otherwise(0)).alias(f"{c}{i}"))
        return F.struct(*out)

    return F.aggregate(ordered, start, step)


def tokens_of_extract(fold: Column, i: int) -> Column:
    """Tokens of the i-th budget's extract, joiners included, from the fold's result."""
    joiners = F.greatest(fold[f"n{i}"] - 1, F.lit(0)) * len(C.EXTRACT_JOINER)
    return F.floor((fold[f"chars{i}"] + joiners) / C.CHARS_PER_TOKEN).cast("bigint")


def compress_extractive(content, target_tokens, content_type) -> Column:
    return extract_scored(scored_sentences(split_sentences(col_(content)), content_type), target_tokens)


def let(value: Column, body) -> Column:
    """Evaluate `value` once and bind it for `body` (a one-element transform):
    inside a lambda, an outer expression would be re-evaluated at each use."""
    return F.element_at(F.transform(F.array(value), body), 1)


def pack_chunks(content, chunk_size) -> Column:
    """Greedy packing of '\\n\\n' paragraphs into <= chunk_size-token chunks.

    A chunk closes when adding the next paragraph would exceed chunk_size
    tokens and the chunk is non-empty; the first paragraph always opens
    chunk 0, so an oversized paragraph stands alone.  The fold keeps only
    scalars and the list of chunk starts (appended once per chunk), so many
    empty paragraphs cost linear time; chunk texts are sliced at the end.
    """

    def build(paras: Column) -> Column:
        init = F.struct(
            lit_(chunk_size).cast("bigint").alias("limit"),
            F.lit(0).cast("bigint").alias("cur"),
            F.lit(0).alias("i"),
            F.array().cast("array<int>").alias("starts"),
        )

        def step(acc, p):
            tok = estimate_tokens(p)
            close = (acc["cur"] + tok > acc["limit"]) & (acc["i"] > 0)
            return F.when(
                close,
                F.struct(acc["limit"].alias("limit"), tok.alias("cur"), (acc["i"] + 1).alias("i"),
                         F.array_append(acc["starts"], acc["i"]).alias("starts")),
            ).otherwise(
                F.struct(acc["limit"].alias("limit"), (acc["cur"] + tok).alias("cur"),
                         (acc["i"] + 1).alias("i"), acc["starts"].alias("starts"))
            )

        starts = F.aggregate(paras, init, step)["starts"]
        bounds = F.concat(F.array(F.lit(0)), starts, F.array(F.size(paras)))
        return let(
            bounds,
            lambda b: F.transform(
                F.slice(b, 1, F.size(b) - 1),
                lambda lo, k: F.array_join(
                    F.slice(paras, lo + 1, F.element_at(b, k + 2) - lo), "\n\n"
                ),
            ),
        )

    return let(split_paragraphs(col_(content)), build)


def label_sections(summaries: Column) -> Column:
    """'[Section i]\\n' + summary, i from 1, joined with blank lines."""
    return F.array_join(
        F.transform(
            summaries,
            lambda s, i: F.concat(F.lit("[Section "), (i + 1).cast("string"), F.lit("]\n"), s),
        ),
        "\n\n",
    )


def chunk_target(chunks: Column, target_tokens) -> Column:
    return F.floor(lit_(target_tokens) / F.size(chunks)).cast("bigint")


def hierarchical_merge(chunks: Column, chunk_budget: Column, content_type) -> Column:
    """Summarise every chunk at `chunk_budget` (= target // n, computed as a
    column beforehand) with the fallback (extractive) summariser and label
    the pieces; no re-compression here."""
    return label_sections(
        F.transform(chunks, lambda c: compress_extractive(c, chunk_budget, content_type))
    )


def needs_recompress(merged: Column, target_tokens) -> Column:
    return estimate_tokens(merged) > lit_(target_tokens) * C.HIERARCHY_RECOMPRESS_FACTOR

"""Content-type detection, strategy routing and budgets as Column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config as C
from .text import col_, contains_any, count_contains, lit_, prefix


def java_pattern(pattern: str) -> str:
    """A pattern of Python's dialect for Java: Unicode digits and word characters, a dot that excludes only a line feed."""
    return pattern.replace(r"\d", r"\p{Nd}").replace(r"\w", r"[\p{L}\p{N}_]").replace(".*", r"[^\n]*")


def type_from_filename(filename) -> Column:
    """First-match substring rules on the lowered file name; NULL if none."""
    fn = F.lower(col_(filename))
    return (
        F.when(fn.isNull() | (fn == ""), F.lit(None).cast("string"))
        .when(contains_any(fn, C.CODE_NAME_MARKERS), F.lit("code"))
        .when(contains_any(fn, C.DOCUMENT_NAME_MARKERS), F.lit("document"))
        .when(contains_any(fn, C.TRANSCRIPT_NAME_MARKERS), F.lit("transcript"))
    )


def signal_window(text) -> Column:
    """content.lower()[:2000].

    Lowering never shortens a string, and a character's lower case depends on
    those around it for the capital sigma alone, so the first 2000 characters
    are enough unless they hold one.
    """
    c = col_(text)
    head = prefix(c, C.SIGNAL_WINDOW_CHARS)
    return prefix(F.when(F.instr(head, "\u03a3") > 0, F.lower(c)).otherwise(F.lower(head)), C.SIGNAL_WINDOW_CHARS)


def _b(cond: Column) -> Column:
    return F.when(cond, 1).otherwise(0)


def _literals(pattern: str) -> list[str] | None:
    """The substrings that a pattern of plain alternatives looks for; `um+` is found where `um` is.  Else None."""
    parts = pattern.split("|")
    if not all(re.fullmatch(r"[a-z ,]+(\\\?)?\+?", p) for p in parts):
        return None
    return [p.removesuffix("+").replace("\\?", "?") for p in parts]


def count_matches(window: Column, patterns) -> Column:
    """How many of the patterns are found; plain ones by substring tests, which are faster."""
    out = None
    for p in patterns:
        words = _literals(p)
        t = _b(contains_any(window, words) if words else window.rlike(java_pattern(p)))
        out = t if out is None else out + t
    return out


def signal_scores(window: Column) -> Column:
    """STRUCT of the five signal counts over the lowered 2000-char window."""
    w = window
    transcript = count_matches(w, C.TRANSCRIPT_PATTERNS)
    chat = count_matches(w, C.CHAT_PATTERNS)
    return F.struct(
        transcript.alias("transcript"),
        count_contains(w, C.EMAIL_SIGNALS).alias("email"),
        count_contains(w, C.WEB_SIGNALS).alias("web_page"),
        count_contains(w, C.CODE_SIGNALS).alias("code"),
        chat.alias("chat"),
    )


def type_from_signals(scores: Column) -> Column:
    return (
        F.when(scores["transcript"] >= C.TRANSCRIPT_SIGNAL_MIN, F.lit("transcript"))
        .when(scores["email"] >= C.EMAIL_SIGNAL_MIN, F.lit("email"))
        .when(scores["web_page"] >= C.WEB_SIGNAL_MIN, F.lit("web_page"))
        .when(scores["code"] >= C.CODE_SIGNAL_MIN, F.lit("code"))
        .when(scores["chat"] >= C.CHAT_SIGNAL_MIN, F.lit("chat"))
        .otherwise(F.lit("document"))
    )


def known_content_type(filename=None, override=None) -> Column | None:
    """The type that is decided without the text: the override, else the file name's; None where neither is given."""
    parts = [lit_(override)] if override is not None else []
    if filename is not None:
        parts.append(type_from_filename(filename))
    return F.coalesce(*parts) if parts else None


def detect_content_type(text, filename=None, override=None) -> Column:
    """override, else filename rule, else signal thresholds, else 'document'."""
    known = known_content_type(filename, override)
    by_signals = type_from_signals(signal_scores(signal_window(text)))
    return by_signals if known is None else F.coalesce(known, by_signals)


def select_strategy(tokens, cfg: C.OptimizerConfig = C.DEFAULT_CONFIG, forced=None,
                    thresholds: tuple | None = None) -> Column:
    """Inclusive token bounds; `hierarchical` only when forced; null without a count.

    `thresholds` may carry Columns (config sweeps) instead of cfg values.
    """
    t = col_(tokens)
    lo, mid, hi = thresholds or (
        cfg.no_compress_threshold,
        cfg.truncate_threshold,
        cfg.extractive_threshold,
    )
    auto = (
        F.when(t <= lit_(lo), F.lit("none"))
        .when(t <= lit_(mid), F.lit("truncate"))
        .when(t <= lit_(hi), F.lit("extractive"))
        .when(t.isNotNull(), F.lit("abstractive"))
    )
    return auto if forced is None else F.coalesce(lit_(forced), auto)


def calculate_target(tokens, target_ratio=0.3, max_output_tokens=2000) -> Column:
    """min(int(tokens * ratio), max_output) with a DOUBLE product truncated."""
    prod = (col_(tokens) * lit_(target_ratio).cast("double")).cast("bigint")
    return F.least(prod, lit_(max_output_tokens).cast("bigint"))


"""Column expressions for text handling.

All of these build Catalyst expressions from ``pyspark.sql.functions``; none
runs Python per row.  Regex patterns are Java regexes chosen to reproduce
Python ``str`` semantics (Unicode whitespace, code-point lengths).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import CHARS_PER_TOKEN

# Python's str.isspace() set (also what `\s` and str.strip() use for str):
# ASCII whitespace, the separators 0x1C-0x1F, NEL, NBSP and the Unicode space
# / line / paragraph separators.  Java's Character.isWhitespace covers all of
# them except the no-break spaces and NEL, which are added; one predicate
# call per character instead of a chain of ranges (about a third faster).
# Visible ASCII, most of any text, is told by one range test before that.
WS_CLASS = r"[[^!-~]&&[\p{javaWhitespace}\x{85}\x{A0}\x{2007}\x{202F}]]"
# no match begins at visible ASCII: those places are left before any lookbehind
NOT_VISIBLE = "(?![!-~])"
RUN_START = NOT_VISIBLE + "(?<!" + WS_CLASS + ")"
SENTENCE_SPLIT = NOT_VISIBLE + r"(?<=[.!?])" + WS_CLASS + "+"


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lit_(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def py_strip(c) -> Column:
    """str.strip(): remove leading/trailing Unicode whitespace."""
    # a run is entered at its start only and never given back: linear on padding
    return F.regexp_replace(col_(c), NOT_VISIBLE + "(?:^" + WS_CLASS + "++|" + RUN_START + WS_CLASS + r"++\z)", "")


def normalize_lines(c) -> Column:
    """Split on '\\n', strip every line, drop blank lines, re-join with '\\n'.

    Done as two regex rewrites instead of split/transform/join: trim the ends,
    then collapse every whitespace run that contains a newline to one newline.
    A run without a newline is inside a line and stays as it is.
    """
    trimmed = py_strip(c)
    return F.regexp_replace(trimmed, RUN_START + r"(?:(?!\n)" + WS_CLASS + r")*+\n" + WS_CLASS + "*+", "\n")


def idiv(a, b) -> Column:
    """Integer floor division of non-negative values, BIGINT result."""
    return F.floor(lit_(a) / lit_(b)).cast("bigint")


def estimate_tokens(c) -> Column:
    """len(text) // 4 in code points."""
    return idiv(F.length(col_(c)), CHARS_PER_TOKEN)


def rfind(text: Column, needle: str) -> Column:
    """Python str.rfind: 0-based index of the last occurrence, -1 if none."""
    rev = needle[::-1]
    pos = F.locate(rev, F.reverse(text))
    return F.when(pos == 0, F.lit(-1)).otherwise(F.length(text) - pos + 1 - len(needle))


def prefix(text: Column, n) -> Column:
    """text[:n] for n >= 0."""
    return text.substr(F.lit(1), lit_(n))


def split_sentences(c) -> Column:
    """re.split(r'(?<=[.!?])\\s+', text) as ARRAY<STRING> (trailing '' kept)."""
    return F.split(col_(c), SENTENCE_SPLIT, -1)


def split_paragraphs(c) -> Column:
    """text.split('\\n\\n')."""
    return F.split(col_(c), "\n\n", -1)


def contains_any(c: Column, words) -> Column:
    out = None
    for w in words:
        t = F.contains(c, F.lit(w))  # faster than instr, which walks characters
        out = t if out is None else (out | t)
    return out


def count_contains(c: Column, words) -> Column:
    out = None
    for w in words:
        t = F.when(F.contains(c, F.lit(w)), 1).otherwise(0)
        out = t if out is None else out + t
    return out


def py_isupper(c: Column) -> Column:
    """str.isupper(): some uppercase character and no lower/titlecase one."""
    # the lowercase test usually fails first, so the second regex rarely runs
    return ~c.rlike(r"[\p{IsLowercase}\p{Lt}]") & c.rlike(r"\p{IsUppercase}")


def preview(c, n: int) -> Column:
    """c[:n] + '...' if longer than n, else c."""
    c = col_(c)
    return F.when(F.length(c) > n, F.concat(prefix(c, n), F.lit("..."))).otherwise(c)

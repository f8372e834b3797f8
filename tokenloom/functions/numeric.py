"""Prices, costs, ratios and Python-exact rounding as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config as C
from .text import col_, lit_

_SPLITTER = 134217729.0  # 2**27 + 1, Dekker split


def _two_product_err(x: Column, c: float) -> tuple[Column, Column]:
    """p = fl(x*c) and the exact error x*c - p (c must have <= 26 bits)."""
    p = x * F.lit(c)
    t = x * F.lit(_SPLITTER)
    x_hi = t - (t - x)
    x_lo = x - x_hi
    err = (x_hi * F.lit(c) - p) + x_lo * F.lit(c)
    return p, err


def py_round(x, ndigits: int) -> Column:
    """Python's round(float, n): half-even on the exact binary value.

    Spark's round/bround work on the shortest decimal string and differ from
    Python when e.g. 99.35 is really 99.34999...; this version forms x*10^n as
    an exact double-double, rounds that to an integer and divides back
    (one correctly rounded division, as Python does).
    """
    x = col_(x).cast("double")
    scale = float(10**ndigits)
    hi, lo = _two_product_err(x, scale)
    fl = F.floor(hi).cast("double")
    frac = hi - fl
    odd = F.abs(fl % 2.0) == 1.0
    # frac is exact; lo only matters on an exact half (|lo| < ulp(hi)/2)
    up = (frac > 0.5) | ((frac == 0.5) & ((lo > 0) | ((lo == 0) & odd)))
    k = F.when(up, fl + 1.0).otherwise(fl)
    return F.when(x.isNull(), F.lit(None).cast("double")).otherwise(k / F.lit(scale))


def price_lookup(model, prices=C.MODEL_PRICES, default=C.DEFAULT_PRICE_MODEL) -> Column:
    """Resolve a model name to STRUCT<model_key, input_per_1k, output_per_1k>.

    Exact key first; else the first key (in table order) that is a substring
    of the name or contains it; else the default key.  The price list is a
    fixed handful of rows, so the lookup is a CASE expression: no join and
    no shuffle however large the corpus is.
    """
    m = col_(model)
    by_key = {k: (a, b) for k, a, b in prices}

    def row(k):
        a, b = by_key[k]
        return F.struct(
            F.lit(k).alias("model_key"),
            F.lit(float(a)).alias("input_per_1k"),
            F.lit(float(b)).alias("output_per_1k"),
        )

    expr = None
    for k, _, _ in prices:
        cond = m == k
        expr = F.when(cond, row(k)) if expr is None else expr.when(cond, row(k))
    for k, _, _ in prices:
        cond = (F.instr(m, k) > 0) | (F.instr(F.lit(k), m) > 0)
        expr = expr.when(cond, row(k))
    return expr.otherwise(row(default))


def estimate_cost(input_tokens, output_tokens, price: Column) -> Column:
    """(in/1000)*p_in + (out/1000)*p_out, evaluated in that order."""
    return (lit_(input_tokens) / 1000.0) * price["input_per_1k"] + (
        lit_(output_tokens) / 1000.0
    ) * price["output_per_1k"]


def safe_ratio_loss(optimized, raw) -> Column:
    """1 - o/r, 0 when r == 0 (ANSI division would raise)."""
    o, r = lit_(optimized), lit_(raw)
    return F.when(r > 0, 1.0 - (o / r)).otherwise(F.lit(0.0))


def compression_pct(optimized, raw) -> Column:
    o, r = lit_(optimized), lit_(raw)
    return F.when(r > 0, py_round((1.0 - (o / r)) * 100.0, 1)).otherwise(F.lit(0.0))


def cost_saved_config(original_tokens, compressed_tokens, input_cost_per_1k) -> Column:
    """TokenStats.cost_saved: always at the config's input price."""
    return ((lit_(original_tokens) - lit_(compressed_tokens)) / 1000.0) * lit_(input_cost_per_1k)

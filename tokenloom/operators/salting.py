"""Joining results to rows of which one key may hold a third."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALTS = 64


def attach(rows: DataFrame, results: DataFrame, key: str, spread_by: Sequence[Column], salts: int = SALTS) -> DataFrame:
    """rows left-joined with results (one row for each `key`), the rows of a key over up to `salts` tasks.

    A result is repeated for the salts that rows of its key have, no more.
    spread_by: what tells rows of one key apart; only their hash is used.
    """
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int"))
    wanted = salted.select(key, "_salt").distinct()  # at most `salts` rows of a key
    return salted.join(results.join(wanted, key), [key, "_salt"], "left").drop("_salt")

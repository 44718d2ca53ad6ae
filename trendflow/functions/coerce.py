"""Null-on-failure coercions.

Spark 4 runs with ANSI on, so a plain ``cast`` raises on bad text. Every
coercion of untrusted input goes through ``try_cast``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def try_long(c: Column | str) -> Column:
    """Text or number to bigint; decimals are truncated, junk becomes null.

    The direct cast comes first so integers above 2^53 stay exact; only
    text that is not an integer goes through double (both levels are
    ``try_cast``: ``'Infinity'`` would raise otherwise).
    """
    c = as_col(c)
    return F.coalesce(
        c.try_cast("bigint"),
        c.try_cast("double").try_cast("bigint"),
    )


def try_bool(c: Column | str) -> Column:
    return as_col(c).try_cast("boolean")


def try_text(c: Column | str) -> Column:
    return as_col(c).try_cast("string")


def normalise_region(c: Column | str) -> Column:
    return F.lower(F.trim(as_col(c)))

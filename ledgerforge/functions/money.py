"""Amounts as people type them: one parser instead of many that disagree."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MOST = 10**12


def parse_money(c: Column) -> Column:
    """decimal(18,4) of a typed amount; null for junk and for 1e12 and more.

    Grouping is recognised first: ``1.234`` and ``1,234`` are 1234, ``1.234,56`` and ``1,234.56`` are 1234.56,
    ``12,5`` and ``12.5`` are 12.5. ``%``, ``Rp`` and ``IDR`` are dropped.
    """
    s = F.regexp_replace(F.upper(c), r"\s|%|IDR|RP\.?", "")
    plain = (
        F.when(s.rlike(r"^-?\d{1,3}(\.\d{3})+(,\d+)?$"), F.translate(F.translate(s, ".", ""), ",", "."))
        .when(s.rlike(r"^-?\d{1,3}(,\d{3})+(\.\d+)?$"), F.translate(s, ",", ""))
        .when(s.rlike(r"^-?\d+,\d+$"), F.translate(s, ",", "."))
        .when(s.rlike(r"^-?\d+(\.\d+)?$"), s)
    )
    v = plain.try_cast("decimal(30,4)")
    return F.when(F.abs(v) < MOST, v).cast("decimal(18,4)")


def format_id(c: Column) -> Column:
    """An amount as ``1.234,56``."""
    return F.translate(F.format_number(c, 2), ",.", ".,")


def near(a: Column, b: Column, least: float, share: float) -> Column:
    """Whether a is b within the greater of an absolute and a relative tolerance of b."""
    return F.abs(a - b) <= F.greatest(F.lit(least).cast("decimal(18,4)"), F.abs(b) * F.lit(share).cast("decimal(6,4)"))

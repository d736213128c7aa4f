"""Status tags: a list inside, joined by | outside. A tag is added, never written over another."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def add_tag(status: Column, tag: str | Column, when: Column) -> Column:
    """``status`` with a tag at its end where ``when`` holds and it isn't there yet."""
    t = tag if isinstance(tag, Column) else F.lit(tag)
    tags = F.split(F.coalesce(status, F.lit("")), r"\|")
    return F.when(when & ~F.array_contains(tags, t), F.concat_ws("|", F.nullif(status, F.lit("")), t)).otherwise(status)


def confidence(c: Column) -> Column:
    """high, medium, low or none of free text in two languages."""
    s = F.lower(F.trim(c))
    return F.when(s.isin("high", "tinggi"), "high").when(s.isin("medium", "sedang"), "medium").when(s.isin("low", "rendah"), "low").otherwise("none")


def backoff_seconds(attempt: Column, base: int = 5) -> Column:
    """Seconds before a retry: base times two to the attempt less one."""
    return (F.lit(base) * F.pow(F.lit(2), attempt - 1)).cast("bigint")

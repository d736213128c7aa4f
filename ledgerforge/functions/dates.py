"""Dates as people type them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Month names by number, Indonesian and English, by their first three letters.
MONTHS = {
    "JAN": 1, "FEB": 2, "MAR": 3, "APR": 4, "MEI": 5, "MAY": 5, "JUN": 6, "JUL": 7,
    "AGU": 8, "AUG": 8, "SEP": 9, "OKT": 10, "OCT": 10, "NOV": 11, "DES": 12, "DEC": 12,
}


def _date(y: Column, m: Column, d: Column) -> Column:
    year = F.when(F.length(y) == 2, F.concat(F.lit("20"), y)).otherwise(y)
    return F.concat_ws("-", year, F.lpad(m, 2, "0"), F.lpad(d, 2, "0")).try_cast("date")


def parse_date(c: Column) -> Column:
    """The date of ``d.m.yy``, ``d/m/yyyy``, ``yyyy-mm-dd``, ``d mon yyyy``; null if it is none. Years of two digits are 20yy."""
    s = F.upper(F.trim(c))
    dmy, ymd, mon = r"^(\d{1,2})[./-](\d{1,2})[./-](\d{4}|\d{2})$", r"^(\d{4})-(\d{1,2})-(\d{1,2})$", r"^(\d{1,2})[ /-]([A-Z]{3})[A-Z]*[ /-](\d{4}|\d{2})$"
    g = lambda p, i: F.regexp_extract(s, p, i)
    month = F.lit(None).cast("string")
    for name, n in MONTHS.items():
        month = F.when(g(mon, 2) == name, str(n)).otherwise(month)
    return F.when(s.rlike(dmy), _date(g(dmy, 3), g(dmy, 2), g(dmy, 1))).when(s.rlike(ymd), _date(g(ymd, 1), g(ymd, 2), g(ymd, 3))).when(s.rlike(mon), _date(g(mon, 3), month, g(mon, 1)))


def normal_date(c: Column) -> Column:
    """A typed date as ``dd/mm/yyyy``, with the time dropped; null if it is none."""
    return F.date_format(parse_date(F.regexp_replace(c, r"\s+\d{1,2}:.*$", "")), "dd/MM/yyyy")

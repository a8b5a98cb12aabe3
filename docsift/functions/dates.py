"""Dates as printed, to ISO: shape by shape, in a fixed order of precedence."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docsift.functions import vocab
from docsift.functions.text import clean_text

_MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")
#: (pattern, places of year, month and day in it; day 0 is the first of the month). Month names may be whole or of three letters.
SHAPES = (
    (r"^(\d{4})-(\d{1,2})-(\d{1,2})$", 1, 2, 3),
    (r"^(\d{1,2})/(\d{1,2})/(\d{4})$", 3, 1, 2),
    (r"^(\d{1,2})/(\d{1,2})/(\d{2})$", 3, 1, 2),
    (r"^(\d{1,2})-(\d{1,2})-(\d{4})$", 3, 1, 2),
    (r"^(\d{1,2})\s+([A-Za-z]+)\s+(\d{4})$", 3, 2, 1),
    (r"^([A-Za-z]+)\s+(\d{1,2}),\s+(\d{4})$", 3, 1, 2),
    (r"^([A-Za-z]+)\s+(\d{1,2})\s+(\d{4})$", 3, 1, 2),
    (r"^(\d{4})/(\d{1,2})/(\d{1,2})$", 1, 2, 3),
    (r"^(\d{4})(1[0-2]|0[1-9]|[1-9])(3[01]|[12]\d|0[1-9]|[1-9])$", 1, 2, 3),
    (r"^(\d{1,2})-([A-Za-z]+)-(\d{4})$", 3, 2, 1),
    (r"^([A-Za-z]+)\s+(\d{4})$", 2, 1, 0),
    (r"^(\d{1,2})/(\d{4})$", 2, 1, 0),
    (r"^(\d{4})-(\d{1,2})$", 1, 2, 0),
)


def _month(c: Column) -> Column:
    named = F.coalesce(*[F.when(c.isin(m, m[:3]), F.lit(str(k))) for k, m in enumerate(_MONTHS, 1)])
    return F.when(c.rlike(r"^\d+$"), c).otherwise(named)


def _year(c: Column) -> Column:
    two = F.length(c) == 2
    return F.when(two & (c.try_cast("int") >= 69), F.concat(F.lit("19"), c)).when(two, F.concat(F.lit("20"), c)).otherwise(c)


def _bound(value: Column, use) -> Column:
    """use(value) with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), lambda v: use(v)), F.lit(0))


def _parts(text: Column) -> Column:
    """struct(y, m, d) of the shape that fits; shapes exclude one another."""
    pick = []
    for pattern, *places in SHAPES:
        values = [F.regexp_extract(text, pattern, k) if k else F.lit("1") for k in places]
        pick.append(F.when(text.rlike(pattern), F.struct(*[v.alias(n) for v, n in zip(values, "ymd")])))
    return F.coalesce(*pick)


def _iso(text: Column) -> Column:
    joined = lambda p: F.concat_ws("-", _year(p["y"]), _bound(F.lower(p["m"]), _month), p["d"])
    parsed = lambda p: F.date_format(F.try_to_timestamp(joined(p), F.lit("yyyy-M-d")), "yyyy-MM-dd")
    return _bound(_parts(text), lambda p: F.when(p.isNotNull() & _bound(F.lower(p["m"]), _month).isNotNull(), parsed(p)))


def _unlabelled(text: Column) -> Column:
    plain = F.regexp_replace(F.trim(F.regexp_replace(text, vocab.DATE_LABEL, "")), r"[.,;]+$", "")
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), text).otherwise(plain)


def normalise_iso_date(c: Column) -> Column:
    """ISO date of a printed date, else empty. A text of ISO shape that is no date is empty."""
    return F.coalesce(_bound(clean_text(c), lambda t: _bound(_unlabelled(t), _iso)), F.lit(""))


def extract_dates(text: Column) -> Column:
    """struct(effective, updated): the first labelled date of each kind in the head of a text."""
    head = F.substring(F.coalesce(text, F.lit("")), 1, 12000)
    return F.struct(normalise_iso_date(F.regexp_extract(head, vocab.EFFECTIVE_DATE, 1)).alias("effective"), normalise_iso_date(F.regexp_extract(head, vocab.UPDATED_DATE, 1)).alias("updated"))

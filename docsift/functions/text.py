"""Text, number and enumeration normalisers: Column -> Column, without Python on executors."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from docsift.functions import vocab

#: White space of all scripts, with the separators U+001C to U+001F.
WS = r"[\s\x1c-\x1f\x{85}\p{Z}]+"


def lit_array(values: Iterable[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def contains_any(c: Column, words: Sequence[str]) -> Column:
    """Whether any word is a substring; one pattern with quoted words."""
    return c.rlike("|".join(rf"\Q{w}\E" for w in words))


def first_of(c: Column, words: Sequence[str]) -> Column:
    """The first word of the list, in list order, that is a substring; null if none is."""
    return F.coalesce(*[F.when(F.contains(c, F.lit(w)), F.lit(w)) for w in words])


def strip(c: Column) -> Column:
    return F.regexp_replace(c, rf"^{WS}|{WS}$", "")


def clean_text(c: Column, collapse: bool = True) -> Column:
    """Null and placeholders to empty, odd spaces folded, invisible characters gone, ends trimmed."""
    text = F.translate(F.coalesce(c.cast("string"), F.lit("")), vocab.SPACES + vocab.ZERO_WIDTH, " " * len(vocab.SPACES))
    text = F.trim(F.regexp_replace(text, WS, " ")) if collapse else strip(text)
    return F.when(F.lower(text).isin(*vocab.PLACEHOLDERS), F.lit("")).otherwise(text)


def format_confidence(c: Column) -> Column:
    """Clamped to 0..1 with two decimals; anything that is no number is 0."""
    x = F.coalesce(c.try_cast("double"), F.lit(0.0))
    x = F.when(F.isnan(x), F.lit(0.0)).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), x)))
    return F.format_string("%.2f", F.bround(x, 2))


def format_int(c: Column) -> Column:
    """A plain integer as text, empty where it is none."""
    text = strip(F.coalesce(c.cast("string"), F.lit("")))
    digits = F.regexp_extract(text, r"^([+-]?\d+)$", 1)
    return F.coalesce(F.when(digits != "", digits.try_cast("decimal(38,0)").cast("string")), F.lit(""))


def format_bool_yn(c: Column) -> Column:
    upper = F.upper(strip(F.coalesce(c.cast("string"), F.lit(""))))
    return F.when(upper.isin("Y", "YES", "TRUE", "1"), F.lit("Y")).otherwise(F.lit("N"))


def split_pipe(c: Column) -> Column:
    return F.filter(F.transform(F.split(c, r"\|"), lambda p: F.trim(p)), lambda p: p != "")


def normalise_multi_enum(c: Column, allowed: Sequence[str]) -> Column:
    """Members of a pipe list that are allowed, in order, each once."""
    known = lit_array(allowed)
    return F.array_join(F.array_distinct(F.filter(split_pipe(clean_text(c)), lambda p: F.array_contains(known, p))), "|")


def in_enum(c: Column, allowed: Sequence[str], default: str) -> Column:
    return F.when(c.isin(*allowed), c).otherwise(F.lit(default))


def sha256_hex(c: Column) -> Column:
    return F.sha2(c, 256)


def utc_now_iso() -> Column:
    return F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def split_list(c: Column) -> Column:
    """A list cell: by pipes if it has one, else by commas."""
    text = clean_text(c)
    parts = F.when(F.contains(text, F.lit("|")), F.split(text, r"\|")).otherwise(F.split(text, ","))
    return F.filter(F.transform(parts, lambda p: F.trim(p)), lambda p: p != "")


def trim_label(c: Column, limit: int = 40) -> Column:
    text = F.replace(clean_text(c), F.lit("'"), F.lit(""))
    return F.when(F.length(text) <= limit, text).otherwise(F.concat(F.substring(text, 1, limit - 3), F.lit("...")))


def percent_decode(c: Column) -> Column:
    """Percent escapes decoded, plus signs kept; a text with a bad escape stays as it is."""
    return F.coalesce(F.try_url_decode(F.replace(c, F.lit("+"), F.lit("%2B"))), c)


def any_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def title_key(c: Column) -> Column:
    """Comparison key of a title: noise, punctuation and stop words out; empty under two words."""
    text = F.lower(clean_text(c))
    for pattern in vocab.TITLE_NOISE:
        text = F.regexp_replace(text, f"(?i){pattern}", " ")
    words = F.filter(F.split(F.regexp_replace(text, r"[^a-z0-9\s]+", " "), r"\s+"), lambda w: (w != "") & ~w.isin(*vocab.TITLE_STOPWORDS))
    return F.when(F.size(words) < 2, F.lit("")).otherwise(F.array_join(words, " "))

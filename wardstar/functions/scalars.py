"""Column expressions shared by loading, cleaning, reports and documents."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F

NUMBER_TEXT = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
LEADING_DATE = r"^\s*([0-9]{4}-[0-9]{1,2}-[0-9]{1,2})([T ].*)?$"


def is_blank(c: Column) -> Column:
    """Null or empty text."""
    return F.coalesce(c, F.lit("")) == ""


def blank_to(c: Column, default: Column | str) -> Column:
    other = default if isinstance(default, Column) else F.lit(default)
    return F.when(is_blank(c), other).otherwise(c)


def any_of(text: Column, words: Sequence[str]) -> Column:
    """True when any literal word occurs in the text."""
    found = F.lit(False)
    for word in words:
        found = found | F.contains(text, F.lit(word))
    return found


def bucket(key: Column, salt: str, n: int) -> Column:
    """A repeatable choice in 0..n-1 from an md5 of ``salt:key``."""
    digest = F.md5(F.concat(F.lit(salt + ":"), key.cast("string")))
    return F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint"), F.lit(n))


def pick(options: Sequence[str], key: Column, salt: str) -> Column:
    """One of ``options``, chosen by :func:`bucket`."""
    values = F.array(*[F.lit(o) for o in options])
    return F.element_at(values, (bucket(key, salt, len(options)) + 1).cast("int"))


def lookup(mapping: Mapping[str, str], key: Column, default: Column) -> Column:
    """Value by key, else ``default``."""
    entries = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(F.try_element_at(entries, F.coalesce(key, F.lit(""))), default)


def safe_double(c: Column) -> Column:
    """Number from text, null for anything else (also for NaN and infinities)."""
    text = c.cast("string")
    value = F.when(text.rlike(NUMBER_TEXT), F.trim(text)).try_cast("double")
    infinite = F.abs(value) == float("inf")
    return F.when(~infinite, value)


def money(c: Column) -> Column:
    """Two-place decimal; null when it does not fit ten digits."""
    return c.try_cast("decimal(10,2)")


def date_of(c: Column) -> Column:
    """Calendar date of date or timestamp text as written, null when unparseable.

    The written date is kept, so neither the session zone nor an offset in the
    text moves an event to another day.
    """
    text = c.cast("string")
    parsed = F.try_to_timestamp(text)
    written = F.nullif(F.regexp_extract(text, LEADING_DATE, 1), F.lit("")).try_cast("date")
    return F.when(parsed.isNotNull(), F.coalesce(written, F.to_date(parsed)))


def plain_id(c: Column, is_text: bool = True) -> Column:
    """A key as text: null is ``0``, numbers lose leading zeros and fractions.

    Whole-number columns (``is_text=False``) are printed as they are, which stays
    exact beyond 2^53.
    """
    if not is_text:
        return F.coalesce(c.cast("string"), F.lit("0"))
    text = c.cast("string")
    whole = text.try_cast("double").try_cast("bigint").cast("string")
    return F.coalesce(whole, text, F.lit("0"))


def strip_leading_zeros(digits: Column) -> Column:
    """``007`` is ``7`` and ``000`` is ``0``."""
    return F.regexp_replace(digits, "^0+([0-9])", "$1")


def percent(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, F.round(part * F.lit(100.0) / whole, 1))

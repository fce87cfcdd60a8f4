"""Masks, price texts and keyword terms."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The visible prefix and the mask of a telephone number.
PHONE_PREFIX = 4
PHONE_MASK = "*******"


def mask_phone(tel: Column) -> Column:
    """First four characters and the mask; null stays null."""
    return F.concat(F.substring(tel, 1, PHONE_PREFIX), F.lit(PHONE_MASK))


def price(text: Column) -> Column:
    """Price text as double; null when it is no number."""
    return text.try_cast("double")


def tokens(text: Column) -> Column:
    """Lower-case terms of a text: each Han character, and runs of other letters and digits."""
    term = r"\p{IsHan}|[\p{L}\p{M}\p{N}&&[^\p{IsHan}]]+"
    return F.regexp_extract_all(F.lower(text), F.lit(term), 0)


def matches_all(text: Column, keyword: str | None) -> Column:
    """True when every term of ``keyword`` is a term of ``text``.

    A keyword without terms matches nothing.
    """
    wanted = tokens(F.lit(keyword or ""))
    found = (F.size(wanted) > 0) & (F.size(F.array_except(wanted, tokens(text))) == 0)
    return F.coalesce(found, F.lit(False))

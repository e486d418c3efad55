"""Text keys and small text derivations."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def is_blank(text: Column) -> Column:
    return F.coalesce(F.trim(text), F.lit("")) == ""


def blank_to_null(text: Column) -> Column:
    return F.nullif(F.trim(text), F.lit(""))


def match_key(text: Column) -> Column:
    """Case-insensitive comparison key; a plain string, so joins on it can hash."""
    return F.lower(F.trim(text))


def accent_free_key(text: Column) -> Column:
    """Key that ignores case and accents, whatever the letters: compared under the collation, it
    still joins and groups by hash."""
    return F.collate(match_key(text), "UNICODE_CI_AI")


def full_name(first: Column, last: Column) -> Column:
    return F.concat(first, F.lit(" "), last)


def city_of(address: Column) -> Column:
    """What follows the last comma; the whole text when there is none."""
    return F.trim(F.substring_index(F.coalesce(address, F.lit("")), ",", -1))


def money_text(amount: Column) -> Column:
    return F.format_number(amount, 2)


def show(value: Column) -> Column:
    """A value inside a message; a missing one reads as NULL instead of erasing the message."""
    return F.coalesce(value.cast("string"), F.lit("NULL"))

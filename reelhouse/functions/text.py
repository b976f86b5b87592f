"""Text clean-up columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def strip_one_prefix(col: Column, prefix: str = "T", ignore_case: bool = False) -> Column:
    """Remove one leading ``prefix``: 'TTitanic' gives 'Titanic'."""
    head = F.substring(col, 1, len(prefix))
    found = F.lower(head) == prefix.lower() if ignore_case else head == prefix
    return F.when(found, F.substr(col, F.lit(len(prefix) + 1))).otherwise(col)


def strip_all_prefix(col: Column, char: str = "T") -> Column:
    """Remove every leading ``char``: 'TTitanic' gives 'itanic'."""
    return F.ltrim(col, F.lit(char))


def title_key(col: Column) -> Column:
    """Title or name reduced: lower case first, then keep only a-z and 0-9."""
    return F.regexp_replace(F.lower(col), "[^a-z0-9]", "")


def match_key(col: Column) -> Column:
    """The reduced title for joins; NULL, which never matches, if nothing is left of it."""
    return F.nullif(title_key(col), F.lit(""))


def collated(col: Column, collation: str = "UNICODE_CI_AI") -> Column:
    """Text that compares without regard to case and accents; for keys that should match that way."""
    return F.collate(col, collation)


def split_name_first_last(col: Column) -> tuple[Column, Column]:
    """First and last space-separated token; a single token gives both."""
    return F.substring_index(col, " ", 1), F.substring_index(col, " ", -1)


def parse_name_initial(col: Column) -> tuple[Column, Column, Column]:
    """(first, initial, last) of a full name; one token leaves the last name NULL."""
    tokens = F.split(F.regexp_replace(col, r"^\s+|\s+$", ""), r"\s+")
    n = F.size(tokens)
    first = F.get(tokens, F.lit(0))
    initial = F.when(n >= 3, F.get(tokens, F.lit(1)))
    last = F.when(n >= 2, F.get(tokens, n - 1))
    return first, initial, last


def period_label(year: Column, month: Column) -> Column:
    """'YYYY-MM' from integer year and month."""
    return F.concat(year.cast("string"), F.lit("-"), F.lpad(month.cast("string"), 2, "0"))


def client_caption(first: Column, last: Column) -> Column:
    """'First Last', NULL when either part is NULL."""
    return F.concat(first, F.lit(" "), last)

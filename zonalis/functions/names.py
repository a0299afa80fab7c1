"""Expressions on road names: one text with separators, or a list of texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_BLANKS = " \t\n\r\x0b\x0c"


def _tidy(c: Column) -> Column:
    return F.lower(F.btrim(c, F.lit(_BLANKS)))


def names_from_text(c: Column) -> Column:
    """The names in a text separated by ``,`` or ``;``, trimmed and in lower case."""
    return F.coalesce(F.transform(F.split(c, "[,;]"), _tidy), F.array().cast("array<string>"))


def names_from_list(c: Column) -> Column:
    return F.coalesce(F.transform(c, _tidy), F.array().cast("array<string>"))


def joined_names(c: Column) -> Column:
    """One text for a list of names; empty without names."""
    return F.coalesce(F.array_join(c, ", "), F.lit(""))

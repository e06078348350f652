"""Substring tests on condition text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def contains_text(column: str | Column, text: str, literal: bool = False) -> Column:
    """Case-sensitive test: does ``column`` contain ``text``?

    ``%`` and ``_`` in ``text`` act as LIKE wildcards unless ``literal``; a backslash is
    a plain character. Text that comes from data, not from a user, is literal.
    """
    column = F.col(column) if isinstance(column, str) else column
    return column.contains(text) if literal else column.like("%" + text.replace("\\", "\\\\") + "%")


def matches(column: str | Column, condition: str, literal: bool = False) -> Column:
    """Case-insensitive test: does ``column`` mention ``condition``? Null stays null."""
    column = F.col(column) if isinstance(column, str) else column
    return contains_text(F.lower(column), condition.lower(), literal)

"""Text clean-up for join keys and identifiers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def strip_text(column: Column) -> Column:
    """Trim only; inner runs of blanks stay. Used by the warehouse staging view."""
    return F.trim(column)


def normalise_text(column: Column) -> Column:
    """Trim and fold every run of white space into one blank. Used for key look-ups."""
    return F.trim(F.regexp_replace(column, r"\s+", " "))


def clean_identifier(column: Column) -> Column:
    """Upper-case and strip an id that a person typed."""
    return F.upper(F.trim(column))


def numbered_id(prefix: str, number: Column) -> Column:
    """``RT001`` style ids; longer numbers simply grow."""
    return F.format_string(f"{prefix}%03d", number)

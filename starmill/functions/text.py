"""Text and category clean-up."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F


def recode(value: Column, labels: Mapping[str, str]) -> Column:
    """Replace exact, case-sensitive matches; everything else, NULL included, stays.

    One CASE WHEN: meant for a handful of labels.  A large mapping belongs in a
    lookup relation (see ``operators.lookups``).
    """
    branch = F
    for seen, wanted in labels.items():
        branch = branch.when(value == seen, F.lit(wanted))
    return value if branch is F else branch.otherwise(value)


def without_characters(value: Column, characters: str) -> Column:
    """Delete every occurrence of the given characters (no regular expression needed)."""
    for character in characters:
        value = F.replace(value, F.lit(character), F.lit(""))
    return value


def without_pattern(value: Column, pattern: str) -> Column:
    """Delete every match of a regular expression."""
    return F.regexp_replace(value, pattern, "")


def folded(value: Column) -> Column:
    """Trimmed lower case; blank text becomes ``''`` and NULL stays NULL."""
    return F.lower(F.trim(value))


def is_present(value: Column) -> Column:
    """1 for text with at least one character, 0 for empty text and NULL."""
    return F.coalesce((F.length(value) > 0).cast("int"), F.lit(0))

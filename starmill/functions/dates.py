"""Dates, times and the labels derived from them."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from starmill import fixed_values as fixed


def to_day(text: Column, layout: str) -> Column:
    return F.try_to_date(text, layout)


def to_moment(text: Column, *layouts: str) -> Column:
    """The first layout that parses wins; NULL when none does.

    A failed parse costs far more than a good one (it raises inside the JVM), so the
    layout whose length and first separator the text has is tried before the others.
    """
    parsed = [F.try_to_timestamp(text, F.lit(layout)) for layout in layouts]
    choice = F
    for layout, attempt in zip(layouts, parsed):
        others = [p for p in parsed if p is not attempt]
        choice = choice.when(_has_shape(text, layout), F.coalesce(attempt, *others))
    return choice.otherwise(F.coalesce(*parsed))


def _has_shape(text: Column, layout: str) -> Column:
    position, separator = next((i, c) for i, c in enumerate(layout) if not c.isalpha())
    return (F.length(text) == len(layout)) & (F.substring(text, position + 1, 1) == separator)


def date_key(day: Column) -> Column:
    """yyyymmdd as an integer, by arithmetic rather than by formatting and parsing text."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def month_name(day: Column) -> Column:
    return F.date_format(day, fixed.MONTH_NAME_LAYOUT)


def weekend_flag(day_name: Column) -> Column:
    """Decided by the published name, not recomputed from the date; NULL counts as 0."""
    return F.coalesce(day_name.isin(*fixed.WEEKEND_DAYS).cast("int"), F.lit(0))


def period_label(prefix: str, number: Column, year: Column) -> Column:
    """``Q3-2025`` or ``Week31-2025``; NULL when a part is missing."""
    return F.concat(F.lit(prefix), number.cast("string"), F.lit("-"), year.cast("string"))


def agreement(day: Column, day_name: Column, quarter: Column, week: Column) -> Column:
    """How many of a calendar row's three claims (0 to 3) hold for its date."""
    claims = (
        F.initcap(day_name) == F.date_format(day, fixed.DAY_NAME_LAYOUT),
        quarter == F.quarter(day),
        F.abs(week) == F.weekofyear(day),
    )
    first, second, third = (F.coalesce(claim.cast("int"), F.lit(0)) for claim in claims)
    return first + second + third

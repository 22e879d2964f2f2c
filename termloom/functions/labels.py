"""Mapping of raw integer labels to the three sentiments."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The sentiments in metric order and in report order.
SENTIMENTS = ["negative", "neutral", "positive"]
REPORT_ORDER = ["positive", "neutral", "negative"]


def _named(label: Column, negative: list[int], neutral: int, positive: list[int], unknown: str) -> Column:
    named = F.when(label.isin(negative), "negative").when(label == neutral, "neutral")
    if unknown == "positive":
        return named.otherwise("positive")
    if unknown == "null":
        return named.when(label.isin(positive), "positive")
    raise ValueError(f"unknown must be 'positive' or 'null', not {unknown!r}")


def five_class(label: Column, unknown: str = "positive") -> Column:
    """0, 1 negative; 2 neutral; 3, 4 positive.

    Any other value, null included, is positive unless ``unknown="null"``, which
    keeps it null so that rows without a usable label can be dropped.
    """
    return _named(label, [0, 1], 2, [3, 4], unknown)


def three_class(label: Column, unknown: str = "positive") -> Column:
    """0 negative; 1 neutral; 2 positive; other values as in ``five_class``."""
    return _named(label, [0], 1, [2], unknown)

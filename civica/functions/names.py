"""Normalising place names before they are matched with a lookup."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from civica.fixed_values import NOT_WORD_OR_SPACE


def normalize_name(name: Column, tight: bool = False) -> Column:
    """Lower-case a name and blank out everything but ASCII letters and digits.

    Word characters are ASCII, so an accented letter becomes a space. The underscore is
    the one word character that is neither letter nor digit; it vanishes. ``tight`` is
    the older form: punctuation is removed without leaving a space, and underscores stay.
    """
    lowered = F.lower(name)
    if tight:
        return F.regexp_replace(lowered, NOT_WORD_OR_SPACE, "")
    spaced = F.regexp_replace(lowered, NOT_WORD_OR_SPACE, " ")
    return F.replace(spaced, F.lit("_"), F.lit(""))

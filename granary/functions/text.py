"""Text classification and joining rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, functions as F


def class_by_prefix(column: Column, classes: Mapping[str, str], default: str) -> Column:
    """Class of the first matching prefix; NULL and unknown text fall to ``default``."""
    cases = [(F.substring(column, 1, len(p)) == p, name) for p, name in classes.items()]
    first, *rest = cases
    chain = reduce(lambda c, case: c.when(case[0], F.lit(case[1])), rest, F.when(first[0], F.lit(first[1])))
    return chain.otherwise(F.lit(default))


def class_by_phrase(column: Column, classes: Sequence[tuple[str, str]], default: str) -> Column:
    """Class of the first phrase found anywhere in the text; NULL falls to ``default``."""
    first, *rest = [(F.position(F.lit(p), column) > 0, name) for p, name in classes]
    chain = reduce(lambda c, case: c.when(case[0], F.lit(case[1])), rest, F.when(first[0], F.lit(first[1])))
    return chain.otherwise(F.lit(default))


def joined(*parts: Column) -> Column:
    """Concatenation that is NULL when any part is NULL."""
    return F.concat(*parts)


def joined_present(*parts: Column) -> Column:
    """Concatenation of the parts that are not NULL."""
    return F.concat_ws("", *parts)


def renamed_phrases(column: Column, phrases: Mapping[str, str]) -> Column:
    """Replace every long phrase by its short name."""
    return reduce(lambda c, pair: F.replace(c, F.lit(pair[0]), F.lit(pair[1])), phrases.items(), column)


def blank_if(column: Column, values: Sequence[str]) -> Column:
    """Empty text where the value is one of ``values``."""
    return F.when(column.isin(*values), F.lit("")).otherwise(column)

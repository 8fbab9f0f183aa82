"""Rule lists compiled to CASE expressions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_match(rules: Iterable[tuple[Column, object]], otherwise: object = None) -> Column:
    """Value of the first rule whose condition holds."""
    out = F
    for condition, value in rules:
        out = out.when(condition, value)
    return out if otherwise is None else out.otherwise(otherwise)


def band(c: Column, bounds: Sequence[tuple[object, str]], descending: bool = False) -> Column:
    """Label of the first bound that holds the value; a None bound takes the rest. NULL stays NULL."""
    rules = []
    for bound, label in bounds:
        if bound is None:
            rules.append((c.isNotNull(), F.lit(label)))
        else:
            rules.append((c >= bound if descending else c <= bound, F.lit(label)))
    return first_match(rules)


def code_map(c: Column, mapping: Mapping) -> Column:
    """Dictionary lookup; unknown values give NULL."""
    return first_match([(c == F.lit(k), F.lit(v)) for k, v in mapping.items()])


def yes_count(columns: Sequence[str], yes: str = "Yes") -> Column:
    """How many of the columns hold the value; NULL counts as no."""
    return reduce(add, [F.coalesce((F.col(c) == yes).cast("int"), F.lit(0)) for c in columns])

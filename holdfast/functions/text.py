"""Names and label text."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_WORD_START = re.compile(r"(?<=[a-z0-9])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])")

def snake_case(name: str) -> str:
    """CamelCase to snake_case; a run of capitals counts as one word."""
    return _WORD_START.sub("_", name).lower().strip()


def title_words(c: Column) -> Column:
    """Capital at the start of every run of letters, lower case after it."""
    runs = F.regexp_extract_all(c, F.lit("[A-Za-z]+|[^A-Za-z]+"), F.lit(0))
    return F.array_join(F.transform(runs, lambda run: F.initcap(run)), "")


def signed_text(c: Column, digits: int = 1, unit: str = "%") -> Column:
    return F.format_string(f"%+.{digits}f{unit.replace('%', '%%')}", c)


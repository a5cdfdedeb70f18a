"""Comparisons written as text, such as ``"== 0"`` or ``"<= 5"``."""

from __future__ import annotations

import operator
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_COMPARE = {
    "==": operator.eq,
    "!=": operator.ne,
    "<=": operator.le,
    ">=": operator.ge,
    "<": operator.lt,
    ">": operator.gt,
}
_TEXT = re.compile(r"(?P<sign>[=!<>]=|[<>])\s*(?P<bound>-?[0-9]+)")


def threshold(text: str) -> tuple[str, int]:
    """Split ``"<= 5"`` into its sign and its whole-number bound."""
    found = _TEXT.fullmatch(text.strip())
    if found is None:
        raise ValueError(f"not a comparison with a whole number: {text!r} (write for example '== 0')")
    return found["sign"], int(found["bound"])


def meets(observed: int, text: str) -> bool:
    sign, bound = threshold(text)
    return _COMPARE[sign](observed, bound)


def meets_column(observed: Column, text: str) -> Column:
    """The same test on a column; a NULL observation never passes."""
    sign, bound = threshold(text)
    return F.coalesce(_COMPARE[sign](observed, F.lit(bound)), F.lit(False))

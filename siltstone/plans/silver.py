"""The conformed table as one plan, without any table being written."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame

from ..contracts import Domain
from ..operators.conform import cast, normalize
from ..operators.identity import add_trip_id, copy_key, dealt, keep_latest
from ..operators.metrics import derive
from ..operators.rules import split, tag


def conform(raw: DataFrame | Sequence[DataFrame], domain: Domain) -> DataFrame:
    """Contract columns and types. Months with different source schemas meet only here."""
    parts = [raw] if isinstance(raw, DataFrame) else list(raw)
    typed = [cast(normalize(part, domain.fields), domain.fields) for part in parts]
    return reduce(DataFrame.unionByName, typed)


def prepare(
    raw: DataFrame | Sequence[DataFrame], domain: Domain, rows: int | None = None, gather: Sequence[str] = ()
) -> DataFrame:
    """Conformed rows, one per id and month, with their derived columns.

    Derived columns and the id are functions of the others, so they are added after the copies are gone: no
    exchange of this layer carries them. Copies are sought within a
    load month, which makes any split of the months into runs give the same tables. ``rows``, where their number
    is known, has them dealt by their key among tasks that sort them in memory. Rows that arrive dealt by a column of
    the key are not exchanged again. ``gather`` brings the remaining rows together by these columns.
    """
    typed = conform(raw, domain)
    key = copy_key(typed, domain.natural_key)
    if rows is not None and key:
        typed = dealt(typed, rows, *key)
    if key:
        kept = keep_latest(typed, (*key, "load_month"), tie_break=domain.tie_break)
    else:
        kept = keep_latest(add_trip_id(typed, domain.natural_key), tie_break=domain.tie_break)
    if gather:
        kept = kept.hint("rebalance", *gather)
    return derive(add_trip_id(kept, domain.natural_key) if key else kept)


def tagged_trips(
    raw: DataFrame | Sequence[DataFrame], domain: Domain, rows: int | None = None, gather: Sequence[str] = ()
) -> DataFrame:
    return tag(prepare(raw, domain, rows, gather), domain.rules)


def build_trips(
    raw: DataFrame | Sequence[DataFrame], domain: Domain
) -> tuple[DataFrame, DataFrame]:
    """Accepted and quarantined rows."""
    return split(prepare(raw, domain), domain.rules)

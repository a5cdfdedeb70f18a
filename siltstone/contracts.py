"""Plain data that describes a domain to the operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

LINEAGE = ("_ingested_at", "_source_file", "_batch_id")


@dataclass(frozen=True)
class Field:
    """One column of the conformed table and the source spellings that feed it."""

    name: str
    type: str
    sources: tuple[str, ...]
    money: bool = False


def whole(name: str, *sources: str) -> Field:
    return Field(name, "int", sources or (name,))


def long(name: str, *sources: str) -> Field:
    return Field(name, "bigint", sources or (name,))


def real(name: str, *sources: str) -> Field:
    return Field(name, "double", sources or (name,))


def text(name: str, *sources: str) -> Field:
    return Field(name, "string", sources or (name,))


def moment(name: str, *sources: str) -> Field:
    return Field(name, "timestamp", sources or (name,))


def money(name: str, *sources: str) -> Field:
    return Field(name, "decimal(10,2)", sources or (name,), money=True)


LINEAGE_FIELDS = (
    text("load_month"),
    moment("_ingested_at"),
    text("_source_file"),
    text("_batch_id"),
)


@dataclass(frozen=True)
class Rule:
    """A row is accepted when every rule's expression is strictly TRUE."""

    name: str
    expression: str


@dataclass(frozen=True)
class Expectation:
    """A query for one number and the comparison that number has to meet.

    Where the number is a count of the rows that meet ``predicate``, the job that writes the rows can count them.
    """

    name: str
    query: str
    expect: str
    severity: str = "fail"
    predicate: str | None = None

    def __post_init__(self) -> None:
        object.__setattr__(self, "query", " ".join(self.query.split()))

    @classmethod
    def of_rows(cls, name: str, predicate: str, expect: str, severity: str = "fail") -> Expectation:
        """Of the number of rows for which ``predicate`` is TRUE."""
        plain = predicate.replace("{", "{{").replace("}", "}}")
        return cls(name, f"SELECT count(*) FROM {{table}} WHERE {plain}", expect, severity, predicate)


@dataclass(frozen=True)
class Codes:
    """A closed list of codes that becomes a dimension of its own."""

    key: str
    columns: str
    rows: tuple[tuple, ...]
    unknown: tuple

    @property
    def listed(self) -> list[int]:
        return [row[0] for row in self.rows]


@dataclass(frozen=True)
class Domain:
    fields: tuple[Field, ...]
    natural_key: tuple[str, ...]
    rules: tuple[Rule, ...]
    vendors: Codes
    rate_codes: Codes
    payment_types: Codes
    airport_pattern: str
    tie_break: tuple[str, ...] = ()
    expectations: Mapping[str, Sequence[Expectation]] = field(default_factory=dict)

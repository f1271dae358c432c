"""Plain descriptions of keys, rules and checks; small, and held on the driver."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame

Tables = dict[str, DataFrame]


@dataclass(frozen=True)
class ForeignKey:
    """``child.columns`` refer to ``parent.keys``; both may be composite."""

    child: str
    columns: tuple[str, ...]
    parent: str
    keys: tuple[str, ...] = ("id",)

    @classmethod
    def of(cls, child: str, columns: str, parent: str, keys: str = "id") -> ForeignKey:
        """Comma-separated short form."""
        split = lambda text: tuple(part.strip() for part in text.split(","))
        return cls(child, split(columns), parent, split(keys))

    @property
    def pairs(self) -> list[tuple[str, str]]:
        return list(zip(self.columns, self.keys, strict=True))


@dataclass(frozen=True)
class AnonymizationRule:
    """What to do with a column whose name matches ``pattern``."""

    name: str
    pattern: str
    strategy: str  # surrogate, hash, tokenize, nullify, preserve
    kind: str | None = None  # surrogate type
    options: dict = field(default_factory=dict)


@dataclass(frozen=True)
class RowCheck:
    """A count of failing rows; all checks of one table share one aggregation."""

    check: str
    rule: str
    failing: Column
    severity: str = "WARNING"
    column: str | None = None
    message: str = "%d records failed"
    ref_table: str | None = None


@dataclass(frozen=True)
class BusinessRule:
    """``condition`` is a Spark SQL predicate; a row fails unless it is true."""

    name: str
    table: str
    condition: str
    severity: str = "WARNING"
    description: str = ""


@dataclass(frozen=True)
class RequiredFields:
    name: str
    table: str
    fields: tuple[str, ...]
    severity: str = "ERROR"


@dataclass(frozen=True)
class SchemaRule:
    """Types, columns that must not be null, and bounds of values of a table."""

    table: str
    types: dict[str, str] = field(default_factory=dict)
    filled: tuple[str, ...] = ()
    bounds: dict[str, tuple[object, object]] = field(default_factory=dict)


@dataclass(frozen=True)
class RelationRule:
    """What holds between the rows of two tables along a key.

    With ``compare`` (child column, parent column) these agree on joined rows; else
    every parent has at least ``minimum`` children.
    """

    name: str
    key: ForeignKey
    compare: tuple[tuple[str, str], ...] = ()
    minimum: int = 1
    severity: str = "WARNING"


@dataclass(frozen=True)
class StoreRule:
    """Tables of several stores agree: on the keys they have, or with ``tolerance`` on how many rows.

    ``columns`` gives the key column of each table.  With ``values`` the first two tables also agree on these columns.
    """

    name: str
    columns: dict[str, str]
    tolerance: float | None = None
    values: tuple[str, ...] = ()
    severity: str = "WARNING"

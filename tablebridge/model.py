"""Exceptions and the definitions a caller writes: tables, keys, migrations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field


class BridgeError(Exception):
    """Base of every error raised on purpose by this package."""


class SourceError(BridgeError):
    """A source or target cannot be reached."""


class ReflectionError(BridgeError):
    """Catalogue metadata is missing or inconsistent."""


class QueryError(BridgeError):
    """A scan or query request is not valid."""


class BulkWriteError(BridgeError):
    """Rows could not be written."""


class DdlError(BridgeError):
    """A structure change cannot be applied to the existing rows."""


class UnsupportedError(BridgeError):
    """The target has no form for this value or type."""


@dataclass(frozen=True)
class TableRef:
    schema: str
    name: str

    def __str__(self) -> str:
        return f"{self.schema}.{self.name}"


@dataclass(frozen=True)
class Identity:
    """Generated numbers: ``always`` refuses supplied values, ``by_default`` keeps them."""

    mode: str = "by_default"
    start: int = 1
    increment: int = 1

    def __post_init__(self) -> None:
        if self.mode not in ("always", "by_default"):
            raise DdlError(f"unknown identity mode {self.mode!r}")
        if self.increment == 0:
            raise DdlError("identity increment must not be zero")


@dataclass(frozen=True)
class SequenceDef:
    start: int = 1
    increment: int = 1
    min_value: int = 1
    max_value: int = 2**63 - 1
    cycle: bool = False

    def __post_init__(self) -> None:
        if self.increment == 0:
            raise DdlError("sequence increment must not be zero")
        if not self.min_value <= self.start <= self.max_value:
            raise DdlError("sequence start lies outside its bounds")


@dataclass(frozen=True)
class ColumnDef:
    """One column; ``data_type`` is Spark DDL, ``default`` a SQL expression."""

    name: str
    data_type: str
    nullable: bool = True
    default: str | None = None
    identity: Identity | None = None


@dataclass(frozen=True)
class PrimaryKey:
    columns: Sequence[str]
    name: str = "primary_key"


@dataclass(frozen=True)
class UniqueKey:
    name: str
    columns: Sequence[str]


@dataclass(frozen=True)
class CheckRule:
    """``expression`` is the bare condition, without a CHECK frame."""

    name: str
    expression: str


@dataclass(frozen=True)
class NotNull:
    columns: Sequence[str]
    name: str = "not_null"


@dataclass(frozen=True)
class EnumDomain:
    name: str
    column: str
    labels: Sequence[str]


@dataclass(frozen=True)
class Exclusion:
    """No two rows with equal ``eq_columns`` may have overlapping [lower, upper)."""

    name: str
    eq_columns: Sequence[str]
    lower: str
    upper: str


NO_ACTION, RESTRICT, CASCADE = "NO ACTION", "RESTRICT", "CASCADE"
SET_NULL, SET_DEFAULT = "SET NULL", "SET DEFAULT"
REFERENTIAL_ACTIONS = (NO_ACTION, RESTRICT, CASCADE, SET_NULL, SET_DEFAULT)


@dataclass(frozen=True)
class ForeignKey:
    name: str
    columns: Sequence[str]
    referenced_table: str
    referenced_columns: Sequence[str]
    on_delete: str = NO_ACTION
    on_update: str = NO_ACTION

    def __post_init__(self) -> None:
        if len(self.columns) != len(self.referenced_columns) or not self.columns:
            raise DdlError(f"foreign key {self.name}: the column lists must pair up")
        for action in (self.on_delete, self.on_update):
            if action not in REFERENTIAL_ACTIONS:
                raise DdlError(f"foreign key {self.name}: unknown action {action!r}")


Constraint = PrimaryKey | UniqueKey | CheckRule | ForeignKey | NotNull | EnumDomain | Exclusion


@dataclass(frozen=True)
class TableDef:
    name: str
    columns: Sequence[ColumnDef]
    primary_key: PrimaryKey | None = None


@dataclass(frozen=True)
class AddColumn:
    column: ColumnDef


@dataclass(frozen=True)
class DropColumn:
    name: str


@dataclass(frozen=True)
class AlterColumnType:
    name: str
    data_type: str


@dataclass(frozen=True)
class AddConstraint:
    constraint: Constraint
    tables: Mapping[str, object] = field(default_factory=dict)


Alteration = AddColumn | DropColumn | AlterColumnType | AddConstraint

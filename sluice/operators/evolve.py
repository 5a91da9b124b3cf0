"""Schema comparison and contracts between incoming rows and a target table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import naming
from ..functions.types import Column, columns_of, widened
from .transforms import align

ADD, WIDEN, OVERRIDE, REMOVE, RELAX = "add", "widen", "override", "remove", "relax"
CONTRACTS = ("evolve", "freeze", "discard_row", "discard_value")


class ContractError(ValueError):
    """Incoming rows break a frozen schema."""


@dataclass(frozen=True)
class Change:
    kind: str
    name: str
    old: Column | None
    new: Column | None


def _same(a: Column, b: Column) -> bool:
    return (a.kind, a.precision, a.scale, a.max_length) == (b.kind, b.precision, b.scale, b.max_length)


def compare(
    incoming: T.StructType, target: T.StructType, keys: tuple[str, ...] = (), overrides: dict[str, Column] | None = None
) -> list[Change]:
    """What has to change in ``target`` to take ``incoming``; names are compared in any case."""
    there = {c.name.lower(): c for c in columns_of(target)}
    wanted = {k.lower(): v for k, v in (overrides or {}).items()}
    key_names = {k.lower() for k in keys}
    changes = []
    for c in columns_of(incoming):
        low = c.name.lower()
        old = there.get(low)
        forced = wanted.get(low)
        if old is None:
            new = forced or c
            changes.append(Change(ADD, c.name, None, Column(c.name, new.kind, True, new.precision, new.scale, new.max_length, new.element)))
            continue
        if c.nullable and not old.nullable and low not in key_names and low not in naming.BOOKKEEPING:
            changes.append(Change(RELAX, old.name, old, Column(old.name, old.kind, True, old.precision, old.scale, old.max_length)))
        if forced is not None:
            meets = widened(forced, old) if forced.kind == old.kind else forced
            if not _same(meets, old):
                changes.append(Change(OVERRIDE, old.name, old, meets))
            continue
        if old.kind == "json" or (c.kind == old.kind and c.kind not in ("decimal", "string")):
            continue
        new = widened(c, old)
        if not _same(new, old):
            changes.append(Change(WIDEN, old.name, old, new))
    have = {f.name.lower() for f in incoming.fields}
    for low, old in there.items():
        if low not in have and low not in naming.BOOKKEEPING:
            changes.append(Change(REMOVE, old.name, old, None))
    return changes


def evolved(target: T.StructType, changes: list[Change], contract: str = "evolve") -> T.StructType:
    """The target's schema after the changes that the contract allows; removed columns stay and take nulls."""
    allowed = {"evolve": {ADD, WIDEN, OVERRIDE, REMOVE, RELAX}, "freeze": set(), "discard_row": {REMOVE, RELAX}, "discard_value": {ADD, REMOVE, RELAX}}
    by_name: dict[str, list[Change]] = {}
    for c in changes:
        if c.kind in allowed[contract] or (contract == "freeze" and c.kind == ADD and c.name.lower() == naming.LOADED_AT):
            by_name.setdefault(c.name, []).append(c)
    fields = []
    for f in target.fields:
        mine = by_name.pop(f.name, [])
        nullable = f.nullable or any(c.kind in (REMOVE, RELAX) for c in mine)
        new = next((c.new for c in mine if c.kind in (WIDEN, OVERRIDE)), None)
        fields.append(Column(new.name, new.kind, nullable, new.precision, new.scale, new.max_length).field() if new else T.StructField(f.name, f.dataType, nullable, f.metadata))
    fields += [c.new.field() for mine in by_name.values() for c in mine if c.kind == ADD]
    return T.StructType(fields)


def apply_contract(
    incoming: DataFrame, target: T.StructType, contract: str = "evolve", keys: tuple[str, ...] = (), overrides=None
) -> tuple[DataFrame, T.StructType]:
    """Rows that the contract lets in, in the shape of the target's schema, and that schema.

    evolve: all changes are made. freeze: any change but a new load timestamp
    is an error. discard_row: rows with a value in a new or differently typed
    column are dropped. discard_value: new columns come in; a differently typed
    column is null for the whole load.
    """
    if contract not in CONTRACTS:
        raise ValueError(f"unknown contract: {contract}")
    changes = compare(incoming.schema, target, keys, overrides)
    strict = [c for c in changes if not (c.kind == ADD and c.name.lower() == naming.LOADED_AT)]
    if contract == "freeze" and strict:
        raise ContractError("; ".join(f"{c.kind} {c.name}" for c in strict))
    schema = evolved(target, changes, contract)
    lower = {c.lower(): c for c in incoming.columns}
    if contract == "discard_row":
        for c in changes:
            if c.kind in (ADD, WIDEN, OVERRIDE):
                incoming = incoming.filter(F.col(f"`{lower[c.name.lower()]}`").isNull())
    if contract == "discard_value":
        kinds = {f.name: f.dataType for f in target.fields}
        gone = {lower[c.name.lower()]: F.lit(None).cast(kinds[c.name]) for c in changes if c.kind in (WIDEN, OVERRIDE)}
        incoming = incoming.withColumns(gone) if gone else incoming
    return align(incoming, schema), schema


def widen_target(target: DataFrame, schema: T.StructType) -> DataFrame:
    """The target's rows in the evolved schema."""
    return align(target, schema)


def union_evolved(target: DataFrame, incoming: DataFrame, contract: str = "evolve", keys: tuple[str, ...] = ()) -> DataFrame:
    """Target and admitted rows together, in the evolved schema."""
    rows, schema = apply_contract(incoming, target.schema, contract, keys)
    return widen_target(target, schema).unionByName(rows)


def changes_as_rows(spark: SparkSession, changes: list[Change]) -> DataFrame:
    """Changes as a table: ``change, name, old_kind, new_kind``."""
    rows = [(c.kind, c.name, c.old.kind if c.old else None, c.new.kind if c.new else None) for c in changes]
    return spark.createDataFrame(rows, "change string, name string, old_kind string, new_kind string")


def ddl(table: str, changes: list[Change], supports_alter_type: bool = False) -> tuple[list[str], list[str]]:
    """Statements that make the changes on a catalog table, and warnings for those it cannot make in place."""
    statements, warnings = [], []
    added = [c for c in changes if c.kind == ADD]
    if added:
        statements.append(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(f'`{c.name}` {c.new.spark_type.simpleString()}' for c in added)})")
    for c in changes:
        if c.kind in (WIDEN, OVERRIDE):
            if supports_alter_type:
                statements.append(f"ALTER TABLE {table} ALTER COLUMN `{c.name}` TYPE {c.new.spark_type.simpleString()}")
            else:
                warnings.append(f"{c.name}: {c.old.kind} to {c.new.kind} needs a rewrite of {table}")
        elif c.kind in (REMOVE, RELAX) and not c.old.nullable:
            if supports_alter_type:
                statements.append(f"ALTER TABLE {table} ALTER COLUMN `{c.name}` DROP NOT NULL")
            else:
                warnings.append(f"{c.name}: becomes nullable with the next rewrite of {table}")
    return statements, warnings


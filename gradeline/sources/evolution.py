"""What a batch with another schema means for a stored table: add, widen, rename, or refuse.

Types form a lattice. Two types have a common one if every value of both is exact in it and Spark's
Parquet reader takes files of either as that type, so widening a table does not write its files again.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql.types import (
    ArrayType, ByteType, DataType, DateType, DecimalType, DoubleType, FloatType, IntegerType, LongType, MapType, NullType,
    ShortType, StructField, StructType, TimestampNTZType,
)

KEEP, ADD, WIDEN, RENAME, REFUSE = "keep", "add", "widen", "rename", "refuse"

#: Whole numbers from narrow to wide, with the digits a decimal needs to hold them.
WHOLE = {ByteType: 3, ShortType: 5, IntegerType: 10, LongType: 20}
#: Digits of Spark's widest decimal.
MAX_DIGITS = 38


class SchemaRefused(ValueError):
    """The batch does not fit the table; the message names every column that does not."""


@dataclass(frozen=True)
class Change:
    """What happens to one column: ``column`` is its name afterwards, ``before`` the stored one."""

    kind: str
    column: str
    kind_after: DataType | None
    before: str | None = None
    reason: str | None = None


def common_type(left: DataType, right: DataType) -> DataType | None:
    """The narrowest type that holds both exactly, or None."""
    if left == right or isinstance(right, NullType):
        return left
    if isinstance(left, NullType):
        return right
    kinds = {type(left), type(right)}
    whole = list(WHOLE)
    if kinds <= set(whole):
        return max(left, right, key=lambda t: whole.index(type(t)))
    if kinds <= {ByteType, ShortType, IntegerType, FloatType, DoubleType}:
        return DoubleType()
    if DecimalType in kinds and kinds <= {DecimalType, *whole}:
        return _common_decimal(_as_decimal(left), _as_decimal(right))
    if kinds == {DateType, TimestampNTZType}:
        return TimestampNTZType()
    if kinds == {StructType}:
        return _common_struct(left, right)
    if kinds == {ArrayType}:
        element = common_type(left.elementType, right.elementType)
        return element and ArrayType(element, left.containsNull or right.containsNull)
    if kinds == {MapType} and left.keyType == right.keyType:
        value = common_type(left.valueType, right.valueType)
        return value and MapType(left.keyType, value, left.valueContainsNull or right.valueContainsNull)
    return None


def _as_decimal(kind: DataType) -> DecimalType:
    return kind if isinstance(kind, DecimalType) else DecimalType(WHOLE[type(kind)], 0)


def _common_decimal(left: DecimalType, right: DecimalType) -> DecimalType | None:
    scale = max(left.scale, right.scale)
    digits = max(left.precision - left.scale, right.precision - right.scale) + scale
    return DecimalType(digits, scale) if digits <= MAX_DIGITS else None


def _common_struct(left: StructType, right: StructType) -> StructType | None:
    """Fields of the left one in its order, then those that only the right one has; all may be NULL."""
    theirs = {f.name.lower(): f for f in right}
    if len(theirs) < len(right.fields) or len({f.name.lower() for f in left}) < len(left.fields):
        return None
    fields = []
    for field in left:
        other = theirs.pop(field.name.lower(), None)
        kind = common_type(field.dataType, other.dataType) if other else field.dataType
        if kind is None:
            return None
        fields.append(StructField(field.name, kind, True))
    return StructType(fields + [StructField(f.name, f.dataType, True) for f in theirs.values()])


def plan_schema(stored: StructType, incoming: StructType, renames: Mapping[str, str] | None = None) -> list[Change]:
    """One change per column of the table as it will be, in stored order, added ones last, refused ones among them.

    Names are compared without case, as Spark does. ``renames`` leads from stored names to new ones and is never
    guessed: a name that only the batch has is a new column. Stored columns that the batch lacks stay, NULL in its rows.
    A column of NULLs without a type fits any stored one; as a new column it is refused.
    """
    renames = {old.lower(): new for old, new in (renames or {}).items()}
    names = [f.name.lower() for f in stored]
    batch: dict[str, StructField] = {}
    changes, refused = [], []
    for field in incoming:
        if field.name.lower() in batch:
            refused.append(Change(REFUSE, field.name, None, None, "the batch has it twice"))
        batch[field.name.lower()] = field
    for old, new in renames.items():
        if old not in names:
            refused.append(Change(REFUSE, new, None, old, f"there is no {old} to rename"))
        elif new.lower() in names and new.lower() != old or [n.lower() for n in renames.values()].count(new.lower()) > 1:
            refused.append(Change(REFUSE, new, None, old, "the name is taken"))
        elif old in batch and new.lower() != old:
            refused.append(Change(REFUSE, new, None, old, f"the batch still has {old}"))
    for field in stored:
        name = renames.get(field.name.lower(), field.name)
        other = batch.pop(name.lower(), None)
        kind = common_type(field.dataType, other.dataType) if other else field.dataType
        if kind is None:
            reason = f"{field.dataType.simpleString()} and {other.dataType.simpleString()} have no common type"
            changes.append(Change(REFUSE, name, field.dataType, field.name, reason))
        elif name != field.name:
            changes.append(Change(RENAME, name, kind, field.name))
        else:
            changes.append(Change(KEEP if kind == field.dataType else WIDEN, name, kind, field.name))
    for field in batch.values():
        untyped = isinstance(field.dataType, NullType)
        changes.append(Change(REFUSE, field.name, None, None, "it has no type yet") if untyped else Change(ADD, field.name, field.dataType))
    return changes + refused


def schema_after(changes: list[Change]) -> StructType:
    """The table's schema once the changes are made; raises ``SchemaRefused`` if one of them is refused."""
    refused = [f"{c.column}: {c.reason}" for c in changes if c.kind == REFUSE]
    if refused:
        raise SchemaRefused("; ".join(refused))
    return StructType([StructField(c.column, c.kind_after, True) for c in changes])

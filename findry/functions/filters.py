"""Metadata filters: ``{key: value}`` or ``{key: {operator: operand}}``, all ANDed.

A filter compiles to one boolean column over the JSON metadata.  Comparison is by
JSON type, the way Python compares the decoded values: text never equals a number,
``true`` and ``false`` count as 1 and 0, and a missing key reads as null.  Ranges
over unlike types match nothing.  Malformed JSON reads as having no keys.

``promoted`` names keys the table also stores as a real column; those compile to
plain comparisons, which Parquet scans can use to skip data.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from findry.schema import check_name

OPERATORS = ("$eq", "$ne", "$in", "$nin", "$gt", "$gte", "$lt", "$lte")
_RANGE = {
    "$gt": lambda a, b: a > b,
    "$gte": lambda a, b: a >= b,
    "$lt": lambda a, b: a < b,
    "$lte": lambda a, b: a <= b,
}
_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
            T.DecimalType)
_INT64 = 2 ** 63


class _JsonValue:
    """One key of a parsed JSON document, read by type."""

    def __init__(self, parsed: Column, key: str):
        self.parsed = parsed
        self.path = f"$.{key}"
        self.kind = F.schema_of_variant(self._get("variant"))

    def _get(self, as_type: str) -> Column:
        return F.try_variant_get(self.parsed, self.path, as_type)

    def is_null(self) -> Column:
        return F.coalesce(self.kind, F.lit("VOID")) == "VOID"

    def text(self) -> Column:
        return F.when(self.kind == "STRING", self._get("string"))

    def number(self, exact: bool) -> Column:
        """The value as a number, or null if it is none."""
        flag = F.when(self.kind == "BOOLEAN", self._get("boolean").cast("int"))
        if exact:
            whole = F.when(self.kind == "BIGINT", self._get("bigint"))
            return F.coalesce(whole, flag.cast("bigint"))
        real = F.when(self.kind.startswith("DECIMAL") | self.kind.isin("BIGINT", "DOUBLE", "FLOAT"),
                      self._get("double"))
        return F.coalesce(real, flag.cast("double"))


def promoted_value(metadata: Column, key: str, kind: str = "string") -> Column:
    """A metadata key as a column of its own; null where its value is of another kind."""
    value = _JsonValue(F.try_parse_json(metadata), check_name(key))
    if kind == "string":
        return value.text()
    if kind in ("bigint", "long", "int"):
        return F.when(value.kind == "BIGINT", value.number(exact=True)).cast(kind)
    if kind == "double":
        return F.when(value.kind != "BOOLEAN", value.number(exact=False))
    if kind == "boolean":
        return F.when(value.kind == "BOOLEAN", value.number(exact=True).cast("boolean"))
    raise ValueError(f"a promoted key is a string, bigint, double or boolean, not {kind!r}")


class _PlainValue:
    """A key that is stored as a column of its own."""

    def __init__(self, column: str, data_type: T.DataType):
        self.column, self.type = F.col(column), data_type

    def is_null(self) -> Column:
        return self.column.isNull()

    def text(self) -> Column | None:
        return self.column if isinstance(self.type, T.StringType) else None

    def number(self, exact: bool) -> Column | None:
        if isinstance(self.type, T.BooleanType):
            return self.column.cast("bigint" if exact else "double")
        whole = isinstance(self.type, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
        if exact and not whole or not isinstance(self.type, _NUMERIC):
            return None
        return self.column


def _compare(value, operand, test) -> Column:
    """``test(value, operand)`` where the types allow it, else false (never null)."""
    if isinstance(operand, str):
        return _settled(value, [(value.text(), operand)], test)
    if isinstance(operand, (bool, int)) and -_INT64 <= operand < _INT64:
        # Whole numbers compare exactly; other numbers as doubles.
        return _settled(value, [(value.number(exact=True), int(operand)),
                                (value.number(exact=False), float(operand))], test)
    return _settled(value, [(value.number(exact=False), float(operand))], test)


def _settled(value, readings, test) -> Column:
    """The test on the first reading that is not null; false if there is none."""
    readings = [(reading, operand) for reading, operand in readings if reading is not None]
    if not readings:
        return F.lit(False)
    if isinstance(value, _PlainValue):
        # Kept free of coalesce so that the scan can use it.
        reading, operand = readings[0]
        return ~value.is_null() & test(reading, operand)
    return F.coalesce(*[test(reading, operand) for reading, operand in readings], F.lit(False))


def _scalar(key, operand):
    if operand is not None and not isinstance(operand, (str, bool, int, float)):
        raise ValueError(f"filter on {key!r}: {operand!r} is not a string, number, boolean or None")
    return operand


def _equals(value, operand) -> Column:
    if operand is None:
        return value.is_null()
    return _compare(value, operand, lambda a, b: a == b)


def _any_of(value, operands) -> Column:
    texts = [o for o in operands if isinstance(o, str)]
    numbers = [o for o in operands if isinstance(o, (bool, int, float))]
    whole = [int(o) for o in numbers if float(o).is_integer() and -_INT64 <= o < _INT64]
    parts = []
    if texts:
        parts.append(_settled(value, [(value.text(), texts)], Column.isin))
    if numbers:
        readings = [(value.number(exact=False), [float(o) for o in numbers])]
        if isinstance(value, _JsonValue) or len(whole) == len(numbers):
            readings.insert(0, (value.number(exact=True), whole))
        parts.append(_settled(value, readings, Column.isin))
    if None in operands:
        parts.append(value.is_null())
    return reduce(lambda a, b: a | b, parts) if parts else F.lit(False)


def _members(key, operand):
    if not isinstance(operand, (list, tuple, set, frozenset)):
        raise ValueError(f"filter on {key!r}: $in and $nin take a list")
    return [_scalar(key, o) for o in operand]


def _clause(key, value, op, operand) -> Column:
    if op not in OPERATORS:
        raise ValueError(f"filter on {key!r}: {op!r} is none of {', '.join(OPERATORS)}")
    if op == "$in":
        return _any_of(value, _members(key, operand))
    if op == "$nin":
        return ~_any_of(value, _members(key, operand))
    operand = _scalar(key, operand)
    if op == "$eq":
        return _equals(value, operand)
    if op == "$ne":
        return ~_equals(value, operand)
    if operand is None:
        return F.lit(False)
    return _compare(value, operand, _RANGE[op])


def _clauses(value, key, condition) -> list[Column]:
    if not isinstance(condition, Mapping):
        condition = {"$eq": condition}
    return [_clause(key, value, op, operand) for op, operand in condition.items()]


def predicate(flt: Mapping | None, metadata: str = "metadata",
              promoted: Mapping[str, tuple[str, T.DataType]] | None = None) -> Column | None:
    """The filter as one condition that is never null, or None if it has no clause.

    Raises on anything it cannot honour.  The metadata is parsed once a row, however many
    keys and operators look at it.
    """
    promoted = promoted or {}
    flt = {check_name(key): condition for key, condition in (flt or {}).items()
           if not (isinstance(condition, Mapping) and not condition)}
    plain = {key: c for key, c in flt.items() if key in promoted}
    parsed = {key: c for key, c in flt.items() if key not in promoted}
    parts = [part for key, c in plain.items() for part in _clauses(_PlainValue(*promoted[key]), key, c)]
    if parsed:
        parts.append(F.exists(
            F.array(F.try_parse_json(F.col(metadata))),
            lambda document: reduce(lambda a, b: a & b, [
                part for key, c in parsed.items()
                for part in _clauses(_JsonValue(document, key), key, c)])))
    return reduce(lambda a, b: a & b, parts) if parts else None


def keep(table, flt: Mapping | None, metadata: str = "metadata",
         promoted_keys: Mapping[str, str] | None = None):
    """The rows of a table that satisfy a filter."""
    promoted = {key: (column, table.schema[column].dataType)
                for key, column in (promoted_keys or {}).items()}
    condition = predicate(flt, metadata, promoted)
    return table if condition is None else table.filter(condition)

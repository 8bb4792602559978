"""Row filters built as Column trees.

A filter spec arrives either as the legacy text form (``cond; cond; ...``, all
AND-ed) or as the JSON v2 document::

    {"version": 2,
     "groups": [{"conditions": [{"column", "operator", "value", "value2"}...],
                 "intraLogic": "AND" | "OR"}, ...],
     "interLogic": ["AND" | "OR", ...]}

The v2 form is compiled straight into a ``Column`` -- no SQL text is generated,
so values never need quoting and cannot inject SQL.  Between groups the usual
SQL precedence holds (AND binds tighter than OR).  Literals take the type of
the column they are compared with, so ``'007'`` against a number is ``7`` and
``'2024-01-10'`` against a timestamp is midnight of that day.

NULL rule: a change stream keeps rows whose predicate is unknown (``unknown=
'keep'``); a backfill scan drops them (``unknown='drop'``).
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

COMPARISONS = ("=", "!=", "<>", ">", "<", ">=", "<=")
OTHER_OPERATORS = ("BETWEEN", "LIKE", "ILIKE", "IN", "IS NULL", "IS NOT NULL")

# Operators offered per column kind (fixed values of the filter editor).
OPERATORS_BY_KIND = {
    "boolean": ["=", "!=", "IS NULL", "IS NOT NULL"],
    "string": ["=", "!=", "LIKE", "ILIKE", "IN", "IS NULL", "IS NOT NULL"],
    "number": ["=", "!=", ">", "<", ">=", "<=", "IN", "IS NULL", "IS NOT NULL"],
    "date": ["=", "!=", ">", "<", ">=", "<=", "BETWEEN", "IS NULL", "IS NOT NULL"],
}

MAX_BACKFILL_CONDITIONS = 5


class FilterError(ValueError):
    """A filter spec that cannot be compiled against the table's schema."""


def column_kind(data_type: T.DataType) -> str:
    if isinstance(data_type, T.BooleanType):
        return "boolean"
    if isinstance(data_type, T.NumericType):
        return "number"
    if isinstance(data_type, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return "date"
    return "string"


def _field_type(schema: T.StructType | None, column: str) -> T.DataType | None:
    if schema is None:
        return None
    for f in schema.fields:
        if f.name.lower() == column.lower():
            return f.dataType
    raise FilterError(f"unknown column {column!r}")


def typed_literal(value: str, data_type: T.DataType | None) -> Column:
    """The literal ``value`` as the column's type (``try_cast``: a value that
    does not parse compares as NULL)."""
    lit = F.lit(value)
    if data_type is None or isinstance(data_type, T.StringType):
        return lit
    return lit.try_cast(data_type)


def validate_operator(column: str, operator: str, schema: T.StructType | None) -> None:
    """reject an operator the column's kind does not offer."""
    if schema is None:
        return
    kind = column_kind(_field_type(schema, column))
    if operator.upper().strip() not in OPERATORS_BY_KIND[kind] and operator.strip() != "<>":
        raise FilterError(f"operator {operator!r} is not allowed on {kind} column {column!r}")


def condition(
    column: str,
    operator: str,
    value: str | None = "",
    value2: str | None = "",
    schema: T.StructType | None = None,
    like_contains: bool = True,
) -> Column | None:
    """One condition; ``None`` when the condition is dropped (empty value for an
    operator that needs one)."""
    if not column:
        return None
    op = operator.upper().strip()
    data_type = _field_type(schema, column)
    c = F.col(column)
    if op == "IS NULL":
        return c.isNull()
    if op == "IS NOT NULL":
        return c.isNotNull()
    if not value:
        return None
    if op == "BETWEEN":
        if not value2:
            raise FilterError(f"BETWEEN on {column!r} needs two values")
        return c.between(typed_literal(value, data_type), typed_literal(value2, data_type))
    if op in ("LIKE", "ILIKE"):
        pattern = f"%{value}%" if like_contains else value
        return c.ilike(pattern) if op == "ILIKE" else c.like(pattern)
    if op == "IN":
        items = [v.strip() for v in value.split(",") if v.strip()]
        if not items:
            return None
        return c.isin(*[typed_literal(v, data_type) for v in items])
    lit = typed_literal(value, data_type)
    if op == "=":
        return c == lit
    if op in ("!=", "<>"):
        return c != lit
    if op == ">":
        return c > lit
    if op == "<":
        return c < lit
    if op == ">=":
        return c >= lit
    if op == "<=":
        return c <= lit
    raise FilterError(f"unsupported operator {operator!r}")


def _and_all(parts: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, parts)


def _or_all(parts: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, parts)


def v2_predicate(spec: Mapping, schema: T.StructType | None = None, validate: bool = False) -> Column | None:
    """compile a v2 filter document; ``None`` when nothing remains.  With
    ``validate`` every operator is checked against its column's kind (F10)."""
    group_preds = []
    inter = [str(x).upper() for x in (spec.get("interLogic") or [])]
    for group in spec.get("groups") or []:
        parts = []
        for cond in group.get("conditions") or []:
            if validate and cond.get("column"):
                validate_operator(cond["column"], cond.get("operator", ""), schema)
            p = condition(
                cond.get("column", ""), cond.get("operator", ""), cond.get("value", ""), cond.get("value2", ""), schema
            )
            if p is not None:
                parts.append(p)
        if not parts:
            continue
        intra = (group.get("intraLogic") or "AND").upper()
        group_preds.append(_or_all(parts) if intra == "OR" else _and_all(parts))
    if not group_preds:
        return None
    # The connective before the j-th surviving group is interLogic[j-1]
    # (AND when missing).  SQL precedence: split at OR, AND inside each run,
    # OR across runs.
    runs, current = [], [group_preds[0]]
    for j, pred in enumerate(group_preds[1:], start=1):
        logic = inter[j - 1] if j - 1 < len(inter) else "AND"
        if logic == "OR":
            runs.append(current)
            current = [pred]
        else:
            current.append(pred)
    runs.append(current)
    return _or_all([_and_all(r) for r in runs])


def legacy_predicate(text: str) -> Column | None:
    """``;``-separated SQL conditions, all AND-ed."""
    parts = [p.strip() for p in text.split(";") if p.strip()]
    if not parts:
        return None
    return _and_all([F.expr(p) for p in parts])


def parse_filter(spec, schema: T.StructType | None = None, validate: bool = False) -> Column | None:
    """Compile a stored filter (v2 JSON text or dict, or legacy text)."""
    if spec is None or spec == "":
        return None
    if isinstance(spec, Mapping):
        return v2_predicate(spec, schema, validate)
    try:
        parsed = json.loads(spec)
    except (TypeError, ValueError):
        parsed = None
    if isinstance(parsed, dict) and parsed.get("version") == 2:
        return v2_predicate(parsed, schema, validate)
    return legacy_predicate(spec)


def apply_filter(df: DataFrame, spec, unknown: str = "keep", validate: bool = False) -> DataFrame:
    """Filter ``df`` by a stored spec.

    ``unknown='keep'`` (change stream): rows are removed only where the
    predicate is FALSE.  ``unknown='drop'`` (backfill): ordinary WHERE.
    ``validate`` rejects operators the column's kind does not offer."""
    pred = parse_filter(spec, df.schema, validate)
    if pred is None:
        return df
    if unknown == "keep":
        return df.filter(F.coalesce(pred, F.lit(True)))
    if unknown == "drop":
        return df.filter(pred)
    raise ValueError("unknown must be 'keep' or 'drop'")


def backfill_predicate(
    filters: Sequence[Mapping], schema: T.StructType | None = None, max_conditions: int | None = None
) -> Column | None:
    """backfill conditions, AND-ed; more than ``max_conditions`` (default:
    no limit; the filter editor allows ``MAX_BACKFILL_CONDITIONS``) is an error.
    LIKE/ILIKE take the value as the whole pattern here (no implicit ``%``
    around it)."""
    if max_conditions is not None and len(filters) > max_conditions:
        raise FilterError(f"at most {max_conditions} backfill filters are allowed")
    parts = []
    for f in filters:
        p = condition(f["column"], f["operator"], f.get("value", ""), f.get("value2", ""), schema, like_contains=False)
        if p is not None:
            parts.append(p)
    return _and_all(parts) if parts else None

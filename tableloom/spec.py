"""Parsing of text attributes and the errors raised for a bad specification."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, types as T

METADATA_PREFIXES = ("delta__", "scd_")
CHANGE_COLUMNS = ("_change_type", "_commit_version", "_commit_timestamp")
CREATED, MODIFIED = "delta__created_datetime", "delta__modified_datetime"
SOURCE_PATH, CORRUPT = "delta__raw_folderpath", "delta__corrupt_record"
DQ_DETAILS, QUARANTINE_REASON = "delta__dq_failure_details", "delta__quarantine_reason"


class SpecError(ValueError):
    """A step, check or run specification that cannot be carried out."""


class NoDataFound(Exception):
    """A stage ended without rows; the run closes as processed with zero rows."""


def names(value: str | Iterable[str] | None, sep: str = ",") -> list[str]:
    """``"a, b"`` or ``["a", "b"]`` to a list without blanks."""
    if value is None:
        return []
    parts = value.split(sep) if isinstance(value, str) else value
    return [p.strip() for p in parts if p and p.strip()]


def flag(value: object, default: bool = False) -> bool:
    """Read a boolean that may arrive as text."""
    if value is None or value == "":
        return default
    return value if isinstance(value, bool) else str(value).strip().lower() in ("true", "1", "yes")


def text(step: Mapping, key: str, default: str | None = None) -> str:
    """A required text attribute, or ``default`` when one is given."""
    value = step.get(key)
    if value is None or not str(value).strip():
        if default is None:
            raise SpecError(f"{step.get('Category', 'step')}: '{key}' must be given")
        return default
    return str(value)


def choice(value: str, allowed: Iterable[str], what: str) -> str:
    """Lower-case ``value`` and check it against ``allowed``."""
    low, allowed = value.strip().lower(), list(allowed)
    if low not in allowed:
        raise SpecError(f"{what} '{value}' is not one of {', '.join(allowed)}")
    return low


def check_columns(df: DataFrame, columns: Iterable[str], what: str) -> None:
    """Raise unless every column exists; names compare without case."""
    have = {c.lower() for c in df.columns}
    missing = [c for c in columns if c.lower() not in have]
    if missing:
        raise SpecError(f"{what}: columns not found: {', '.join(missing)}")


def text_columns(df: DataFrame, wanted: str | None, what: str) -> list[str]:
    """Expand ``*`` to all string columns, else check the listed ones."""
    if wanted is not None and wanted.strip() == "*":
        return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    columns = names(wanted)
    check_columns(df, columns, what)
    return columns


def type_of(df: DataFrame, column: str) -> T.DataType:
    """Data type of a column whose name may differ in case."""
    for field in df.schema.fields:
        if field.name.lower() == column.lower():
            return field.dataType
    raise SpecError(f"column not found: {column}")


def is_metadata(column: str) -> bool:
    return column.lower().startswith(METADATA_PREFIXES)

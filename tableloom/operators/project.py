"""Column-level steps: rename, derive, select, filter, cast, hash, mask.

Every function takes a frame and typed arguments and returns a lazy frame that
is one projection or one filter, so Catalyst folds chains of them into a single
codegen stage on top of the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tableloom.spec import SpecError, check_columns, is_metadata, names

CASTABLE = ("string", "int", "long", "float", "double", "boolean", "binary", "date", "timestamp")


def rename_columns(df: DataFrame, old: list[str], new: list[str]) -> DataFrame:
    """Rename pairwise and all at once; unequal lists are an error."""
    check_columns(df, old, "columns_to_rename")
    if len(old) != len(new):
        raise SpecError(f"columns_to_rename: {len(old)} old names but {len(new)} new names")
    return df.withColumnsRenamed(dict(zip(old, new)))


def derive_column(df: DataFrame, column: str, expression: str) -> DataFrame:
    return df.withColumn(column, F.expr(expression))


def remove_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    check_columns(df, columns, "remove_columns")
    return df.drop(*columns)


def select_columns(df: DataFrame, columns: list[str], keep_metadata: bool = True) -> DataFrame:
    """Keep ``columns``, and the bookkeeping columns unless told otherwise."""
    check_columns(df, columns, "select_columns")
    chosen = {c.lower() for c in columns}
    extra = [c for c in df.columns if keep_metadata and is_metadata(c) and c.lower() not in chosen]
    return df.select(*columns, *extra)


def filter_rows(df: DataFrame, predicate: str) -> DataFrame:
    return df.filter(F.expr(predicate))


def conditional_column(
    df: DataFrame, column: str, conditions: list[str], values: list[str], default: str | None = None
) -> DataFrame:
    """First condition that holds decides the (text) value."""
    if not conditions or len(conditions) != len(values):
        raise SpecError(f"conditional_column: {len(conditions)} conditions but {len(values)} values")
    chain = F
    for condition, value in zip(conditions, values):
        chain = chain.when(F.expr(condition), F.lit(value))
    return df.withColumn(column, chain.otherwise(F.lit(default)))


def change_types(df: DataFrame, columns: list[str], new_type: str) -> DataFrame:
    """Cast ``columns``; under ANSI mode a value that cannot be cast fails the job."""
    check_columns(df, columns, "change_data_types")
    kind = new_type.strip().lower()
    if kind not in CASTABLE and not kind.startswith("decimal"):
        raise SpecError(f"change_data_types: '{new_type}' is not one of {', '.join(CASTABLE)}, decimal(p,s)")
    cast = {"date": F.to_date, "timestamp": F.to_timestamp}.get(kind, lambda c: c.cast(kind))
    return df.withColumns({c: cast(F.col(f"`{c}`")) for c in columns})


def add_row_hash(
    df: DataFrame, columns: list[str] | None = None, output: str = "row_hash", algorithm: str = "xxhash64"
) -> DataFrame:
    """Change-detection hash over ``columns`` (default: all of them)."""
    columns = columns or df.columns
    check_columns(df, columns, "add_row_hash")
    if algorithm == "xxhash64":
        value = F.xxhash64(*[F.col(f"`{c}`") for c in columns])
    elif algorithm == "sha256":
        parts = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("NULL")) for c in columns]
        value = F.sha2(F.concat_ws("|", *parts), 256)
    else:
        raise SpecError(f"add_row_hash: unknown algorithm '{algorithm}'")
    return df.withColumn(output, value)


def mask_columns(
    df: DataFrame, columns: list[str], upper: str = "X", lower: str = "X", digit: str = "X", other: str | None = None
) -> DataFrame:
    """Replace letters and digits; other characters stay unless ``other`` is given."""
    check_columns(df, columns, "mask_sensitive_data")
    marks = [F.lit(m) for m in (upper, lower, digit, other)]
    return df.withColumns({c: F.mask(F.col(f"`{c}`"), *marks) for c in columns})


def order_columns(df: DataFrame) -> DataFrame:
    """Data columns first, then history columns, then bookkeeping columns."""
    rank = lambda c: 2 if c.lower().startswith("delta__") else 1 if c.lower().startswith("scd_") else 0
    return df.select(*[f"`{c}`" for c in sorted(df.columns, key=rank)])


def sort_rows(df: DataFrame, columns: list[str], directions: list[str] | None = None) -> DataFrame:
    """Global sort: Spark range-partitions by sampled bounds, so no single task sorts it all."""
    check_columns(df, columns, "sort_data")
    return df.orderBy(*ordering(columns, directions, default="asc"))


def ordering(columns: list[str], directions: str | list[str] | None, default: str) -> list:
    """Sort columns with their directions; missing directions take ``default``."""
    given = [d.lower() for d in names(directions)]
    if bad := [d for d in given if d not in ("asc", "desc")]:
        raise SpecError(f"sort direction must be asc or desc, not {', '.join(bad)}")
    given += [default] * (len(columns) - len(given))
    return [F.col(f"`{c}`").asc() if d == "asc" else F.col(f"`{c}`").desc() for c, d in zip(columns, given)]

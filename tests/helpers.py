"""Small helpers that test modules import by name."""

from __future__ import annotations


def as_set(df, *columns):
    return {tuple(r) for r in (df.select(*columns) if columns else df).collect()}

"""Registered queries; importing the modules fills the registry."""

from __future__ import annotations

from tableloom.workloads import checks, control, folds, matching, merging, recipes, registry, runs, shape, typed


def all_queries() -> dict[str, registry.Query]:
    return dict(registry.QUERIES)


def all_sql() -> dict[str, str]:
    return dict(registry.SQL)


__all__ = ["all_queries", "all_sql", "checks", "control", "folds", "matching", "merging", "recipes", "runs", "shape", "typed"]

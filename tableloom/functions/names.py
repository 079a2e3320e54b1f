"""Column-name cleansing."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, functions as F

from tableloom.spec import CREATED, MODIFIED, SpecError, flag, names, text_columns


def cleanse_name(name: str, rules: dict) -> str:
    """Trim, exact replace, regex replace, underscore, case; bookkeeping names stay."""
    if name.lower().startswith("delta__"):
        return name
    if flag(rules.get("trim")):
        name = name.strip()
    find, put = names(rules.get("exact_find")), names(rules.get("exact_replace"))
    if find and put:
        if len(put) not in (1, len(find)):
            raise SpecError(f"exact_replace: {len(put)} replacements for {len(find)} texts")
        for old, new in zip(find, put * len(find) if len(put) == 1 else put):
            name = name.replace(old, new)
    if rules.get("regex_find"):
        name = _regex(name, rules["regex_find"], rules.get("regex_replace") or "")
    if flag(rules.get("replace_non_alphanumeric_with_underscore")):
        name = re.sub(r"_+", "_", re.sub(r"[^0-9A-Za-z]", "_", name))
    case = {"lower": str.lower, "upper": str.upper, "title": str.title}.get((rules.get("apply_case") or "").lower())
    return case(name) if case else name


def _regex(name: str, find: str, put: str) -> str:
    """An invalid expression leaves the name alone."""
    try:
        return re.sub(find, put, name)
    except re.error:
        return name


def cleanse_names(columns: list[str], rules: dict) -> list[str]:
    """New names in the order given; two columns may not end up with one name."""
    made = [cleanse_name(c, rules) for c in columns]
    low = [m.lower() for m in made]
    if clash := sorted({m for m in made if low.count(m.lower()) > 1}):
        raise SpecError(f"column names collide after cleansing: {', '.join(clash)}")
    return made


def cleanse_columns(df: DataFrame, rules: dict) -> DataFrame:
    return df.toDF(*cleanse_names(df.columns, rules))


def add_timestamps(df: DataFrame, now=None) -> DataFrame:
    """Creation and modification time of the batch; an existing creation time stays."""
    now = F.current_timestamp() if now is None else now
    new = {MODIFIED: now} if CREATED in df.columns else {CREATED: now, MODIFIED: now}
    return df.withColumns(new)


def clean_strings(df: DataFrame, trim: str | None = None, blank_to_null: str | None = None) -> DataFrame:
    """Trim text columns and turn blank text into null, in one projection."""
    known = set(text_columns(df, "*", "data_cleansing"))
    trimmed = [c for c in text_columns(df, trim, "trim") if c in known] if trim else []
    blanked = [c for c in text_columns(df, blank_to_null, "blank") if c in known] if blank_to_null else []
    out = {c: F.trim(F.col(f"`{c}`")) for c in trimmed}
    for c in blanked:
        value = out.get(c, F.col(f"`{c}`"))
        out[c] = F.when(F.trim(value) == "", F.lit(None)).otherwise(value)
    return df.withColumns(out) if out else df

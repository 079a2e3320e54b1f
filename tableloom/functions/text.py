"""Text expressions: functions, normalization, splitting, joining, redaction."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tableloom.spec import SpecError, check_columns, choice, text_columns

STRING_FUNCTIONS: dict[str, Callable[[Column], Column]] = {
    name: getattr(F, name)
    for name in ("upper", "lower", "trim", "ltrim", "rtrim", "reverse", "length", "initcap", "soundex")
}

# Accented letters and what they become, position by position.
ACCENTED = "àáâãäåèéêëìíîïòóôõöùúûüýÿñçÀÁÂÃÄÅÈÉÊËÌÍÎÏÒÓÔÕÖÙÚÛÜÑÇ"
UNACCENTED = "aaaaaaeeeeiiiiooooouuuuyyncAAAAAAEEEEIIIIOOOOOUUUUNC"

# What each clean-up removes.
NORMALIZERS: dict[str, Callable[[Column], Column]] = {
    "lowercase": F.lower,
    "uppercase": F.upper,
    "trim": F.trim,
    "collapse_whitespace": lambda c: F.regexp_replace(c, r"\s+", " "),
    "remove_punctuation": lambda c: F.regexp_replace(c, r"[^\w\s]", ""),
    "remove_digits": lambda c: F.regexp_replace(c, r"\d", ""),
    "remove_special_chars": lambda c: F.regexp_replace(c, r"[^a-zA-Z0-9\s]", ""),
    "ascii_only": lambda c: F.regexp_replace(c, r"[^\x00-\x7F]", ""),
    "strip_accents": lambda c: F.translate(c, ACCENTED, UNACCENTED),
}

# Secrets, in the order they are masked.
SECRETS = (
    (r"(?i)(Bearer|Basic)\s+[A-Za-z0-9\-._~+/]+=*", "$1 [REDACTED]"),
    (r"(?i)(UID|PWD|Password|Access_Token)\s*=\s*[^;\s]+", "$1=[REDACTED]"),
    (r"(?i)(password|pwd|secret|token|key|sig|api_key|apikey|client_secret)\s*=\s*[^;&\s]+", "$1=[REDACTED]"),
    (r"(?i)([?&])(sig|sv|se|sp|spr|srt|ss)=([^&\s]+)", "$1$2=[REDACTED]"),
    (r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}", "[JWT REDACTED]"),
)


def apply_string_function(df: DataFrame, columns: str, function: str, output: str) -> DataFrame:
    """One function over one, several or all (``*``) text columns."""
    chosen = text_columns(df, columns, "string_functions")
    fn = STRING_FUNCTIONS[choice(function, STRING_FUNCTIONS, "function")]
    target = (lambda c: output) if len(chosen) == 1 else (lambda c: f"{output}_{c}")
    return df.withColumns({target(c): fn(F.col(f"`{c}`")) for c in chosen}) if chosen else df


def normalized(value: Column, operations: list[str]) -> Column:
    """Apply the named clean-ups in order."""
    return reduce(lambda c, op: NORMALIZERS[choice(op, NORMALIZERS, "operation")](c), operations, value)


def normalize_columns(df: DataFrame, columns: str, operations: list[str], output: str | None = None) -> DataFrame:
    chosen = text_columns(df, columns, "normalize_text")
    target = output if output and len(chosen) == 1 else None
    return df.withColumns({target or c: normalized(F.col(f"`{c}`"), operations) for c in chosen}) if chosen else df


def split_column(
    df: DataFrame, column: str, delimiter: str, outputs: list[str], max_splits: int = -1, drop_original: bool = False
) -> DataFrame:
    """Split on a regular expression; parts a row does not have are null."""
    check_columns(df, [column], "split_column")
    parts = F.split(F.col(f"`{column}`"), delimiter, max_splits + 1 if max_splits > 0 else -1)
    out = df.withColumns({name: F.get(parts, F.lit(i)) for i, name in enumerate(outputs)})
    return out.drop(column) if drop_original and column not in outputs else out


def concat_columns(
    df: DataFrame, columns: list[str], output: str, separator: str = "", nulls: str = "skip", drop_original: bool = False
) -> DataFrame:
    """Join columns as text; nulls are skipped, read as empty, or make the result null."""
    check_columns(df, columns, "concat_columns")
    parts = [F.col(f"`{c}`").cast("string") for c in columns]
    mode = choice(nulls, ("skip", "empty", "keep"), "null_handling")
    if mode == "keep":
        value = F.when(reduce(lambda a, b: a | b, [p.isNull() for p in parts]), F.lit(None)).otherwise(
            F.concat_ws(separator, *parts)
        )
    else:
        value = F.concat_ws(separator, *[F.coalesce(p, F.lit("")) for p in parts] if mode == "empty" else parts)
    out = df.withColumn(output, value)
    return out.drop(*[c for c in columns if c != output]) if drop_original else out


def redact_secrets(value: Column, max_length: int = 4000) -> Column:
    """Mask credentials, then shorten to ``max_length`` and say how long the text was."""
    if max_length < 0:
        raise SpecError("max_length must not be negative")
    clean = reduce(lambda c, rule: F.regexp_replace(c, *map(F.lit, rule)), SECRETS, value)
    note = F.concat(F.lit(" ... [truncated, "), F.length(value).cast("string"), F.lit(" chars total]"))
    room = F.lit(max_length) - F.length(note)
    short = F.when(room <= 0, F.substring(note, 1, max_length)).otherwise(
        F.concat(F.substring(clean, F.lit(1), room), note)
    )
    return F.when(F.length(clean) <= max_length, clean).otherwise(short)


def similarity(left: Column, right: Column) -> Column:
    """1 - edit distance / longer length; null when both texts are empty."""
    return 1 - F.try_divide(F.levenshtein(left, right), F.greatest(F.length(left), F.length(right)))

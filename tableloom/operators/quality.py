"""Quality checks in a single pass.

Row checks become boolean columns of the batch; a row's quarantine reasons and
marks are built from these flags in place, without row ids or joins back.
Facts a row cannot know alone are prepared beforehand: duplicate key groups and
missing reference values are small pre-aggregated tables joined on, baseline
statistics are one-row subqueries. All counts of all checks come from one
aggregate over the flagged batch.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Observation, functions as F

from tableloom.functions.patterns import pattern
from tableloom.operators.keys import any_null, duplicate_keys, mark_by_keys
from tableloom.operators.quantiles import exact_quantiles
from tableloom.session import once, settle
from tableloom.spec import CORRUPT, DQ_DETAILS, QUARANTINE_REASON, SpecError, check_columns, choice, flag, names, text

ACTIONS = ("warn", "mark", "quarantine", "fail")

# Check names as they appear in results.
DISPLAY = {
    "validate_condition": "Validate Condition",
    "duplicates_on_pks": "Duplicate Primary Keys",
    "validate_referential_integrity": "Referential Integrity",
    "validate_pattern": "Pattern Validation",
    "validate_batch_size": "Batch Size Validation",
    "validate_not_null": "Not Null Validation",
    "validate_unique": "Uniqueness Validation",
    "validate_range": "Range Validation",
    "validate_freshness": "Freshness Validation",
    "validate_completeness": "Completeness Validation",
    "validate_anomaly": "Anomaly Detection",
    "file_corruption": "File Corruption",
}
# Texts and units of the built-in checks.
CORRUPT_REASON = "File Corruption check failed: row data does not conform to input schema in metadata."
CORRUPT_FOUND = ("There are ", " rows from the input file in the Bronze files did not match the provided schema.")
NO_TIMESTAMPS = "No timestamp values found in column '{}' - cannot validate freshness"
COMPLETENESS_FOUND = ("{} - completeness ", "% below threshold {:.0f}%")
NOTHING_TO_COMPLETE = "No records to validate completeness"
BATCH_LEVEL = "{} (batch-level metric; falling back to warn)"
NO_BASELINE = "Skipping anomaly detection: baseline table not accessible or column '{}' not found."
FEW_RECORDS = ("Skipping anomaly detection: baseline table has ", " records, minimum required is {}.")
NO_SPREAD = "Skipping anomaly detection: standard deviation is zero or null for column '{}'."
ANOMALIES_FOUND = ("{} - ", " anomalous value(s) detected")
UNIT_SECONDS = {"minute": 60, "hour": 3600, "day": 86400, "week": 7 * 86400, "month": 30 * 86400}

REPORT_DDL = (
    "step int, outcome string, category string, message string, column_name string, "
    "quarantined string, rows_impacted bigint, rows_quarantined bigint"
)


class QualityFailure(Exception):
    """Checks with action ``fail`` found violations; ``results`` holds every record."""

    def __init__(self, results: list[dict]):
        self.results = results
        failed = [r["message"] for r in results if r["outcome"] == "Failure"]
        super().__init__(f"{len(failed)} quality checks failed: {'; '.join(failed)}")


@dataclass
class Check:
    """One result line: how rows fail, how violations are counted, what to say."""

    category: str
    action: str
    message: str
    column: str | None = None
    fails: Column | None = None  # row flag, used for reasons and marks
    count: Column | None = None  # aggregate; default is the number of flagged rows
    skip: Column | None = None  # text when the check could not be made
    note: Column | None = None  # message when violated, default ``message``
    passed: Column | None = None  # message when not violated, default ``message``


@dataclass
class QualityOutcome:
    """Lazy frames of a quality run; ``results`` runs the one counting job."""

    clean: DataFrame
    quarantined: DataFrame
    report: DataFrame
    flagged: DataFrame = field(repr=False)
    watch: Observation | None = field(default=None, repr=False)

    def sizes(self) -> tuple[int, int]:
        """Clean and quarantined rows of a materialized run, counted while it was written."""
        if self.watch is None:
            return self.clean.count(), self.quarantined.count()
        got = self.watch.get
        return got["rows"] - got["held"], got["held"]

    def results(self) -> list[dict]:
        return [r.asDict() for r in self.report.orderBy("step").collect()]

    def stop_on_failure(self) -> list[dict]:
        records = self.results()
        if any(r["outcome"] == "Failure" for r in records):
            raise QualityFailure(records)
        return records


@dataclass
class _Build:
    df: DataFrame
    lookup: Callable[[str], DataFrame]
    baseline: DataFrame | None
    now: Column
    step: int = 0

    def col(self, name: str) -> Column:
        return F.col(f"`{name}`")


def _labelled(message: str, column: str, columns: list[str]) -> str:
    return f"{message} ({column})" if len(columns) > 1 else message


def _condition(b: _Build, step: dict, action: str, message: str) -> list[Check]:
    broken = F.expr(f"NOT ({text(step, 'condition')})")
    return [Check("validate_condition", action, message, fails=F.coalesce(broken, F.lit(False)))]


def _batch_size(b: _Build, step: dict, action: str, message: str) -> list[Check]:
    short = F.greatest(F.lit(int(text(step, "min_rows"))) - F.count(F.lit(1)), F.lit(0))
    return [Check("validate_batch_size", action, message, count=short)]


def _referential(b: _Build, step: dict, action: str, message: str) -> list[Check]:
    mine, theirs = text(step, "current_table_column_name").strip(), text(step, "reference_table_column_name").strip()
    check_columns(b.df, [mine], "validate_referential_integrity")
    known = b.lookup(text(step, "reference_table_name")).select(F.col(f"`{theirs}`").alias("__known")).distinct()
    used = b.df.select(b.col(mine).alias("__used")).distinct()
    missing = used.join(known, F.col("__used") == F.col("__known"), "left_anti")
    tag = f"__missing_{b.step}"
    facts = missing.filter("__used IS NOT NULL").select(F.col("__used").alias(mine), F.lit(True).alias(tag))
    b.df = b.df.join(facts, mine, "left").select("*")
    lost = F.max(missing.agg(F.count(F.lit(1))).scalar())
    fails = F.coalesce(F.col(tag), F.lit(False))
    return [Check("validate_referential_integrity", action, message, fails=fails, count=F.coalesce(lost, F.lit(0)))]


def _not_null(b: _Build, step: dict, action: str, message: str) -> list[Check]:
    columns = names(text(step, "column_name"))
    check_columns(b.df, columns, "validate_not_null")
    return [
        Check("validate_not_null", action, _labelled(message, c, columns), c, fails=b.col(c).isNull()) for c in columns
    ]


def _unique(b: _Build, step: dict, action: str, message: str) -> list[Check]:
    columns = names(text(step, "column_name"))
    check_columns(b.df, columns, "validate_unique")
    tag = f"__copies_{b.step}"
    b.df = mark_by_keys(b.df, columns, duplicate_keys(b.df, columns, tag))
    return [Check("validate_unique", action, message, fails=F.col(tag).isNotNull())]


def _range(b: _Build, step: dict, action: str, message: str) -> list[Check]:
    columns = names(text(step, "column_name"))
    check_columns(b.df, columns, "validate_range")
    low, high = step.get("min_value"), step.get("max_value")
    bounds = [(v, op) for v, op in ((low, "<"), (high, ">")) if v not in (None, "")]
    out = []
    for c in columns:
        outside = F.lit(False)
        for value, op in bounds:
            literal = F.lit(str(value)).cast(b.df.schema[c].dataType)
            outside = outside | (b.col(c) < literal if op == "<" else b.col(c) > literal)
        fails = F.coalesce(outside, F.lit(False))
        out.append(Check("validate_range", action, _labelled(message, c, columns), c, fails=fails))
    return out if bounds else []


def _pattern(b: _Build, step: dict, action: str, message: str) -> list[Check]:
    columns = names(text(step, "column_name"))
    check_columns(b.df, columns, "validate_pattern")
    regex, null_ok = pattern(text(step, "pattern_type")), flag(step.get("allow_null"), True)
    out = []
    for c in columns:
        wrong = F.coalesce(~b.col(c).cast("string").rlike(regex), F.lit(not null_ok))
        out.append(Check("validate_pattern", action, _labelled(message, c, columns), c, fails=wrong))
    return out


def _freshness(b: _Build, step: dict, action: str, message: str) -> list[Check]:
    column = text(step, "column_name").strip()
    check_columns(b.df, [column], "validate_freshness")
    unit = choice(text(step, "unit_of_measure", "hour"), UNIT_SECONDS, "unit_of_measure")
    given = step.get("max_age")
    limit = 86400.0 if given in (None, "") else float(given) * UNIT_SECONDS[unit]
    newest = F.max(b.col(column)).cast("timestamp")
    age = (F.unix_micros(b.now) - F.unix_micros(newest)) / F.lit(1e6)
    stale = F.coalesce((age > limit).cast("int"), F.lit(0))
    none = NO_TIMESTAMPS.format(column)
    note, act = _batch_level(message, action)
    passed = F.when(newest.isNull(), F.lit(none)).otherwise(F.lit(message))
    return [Check("validate_freshness", act, message, count=stale, note=F.lit(note), passed=passed)]


def _completeness(b: _Build, step: dict, action: str, message: str) -> list[Check]:
    columns = names(text(step, "column_name"))
    check_columns(b.df, columns, "validate_completeness")
    least = float(step.get("min_completeness_percent") or 95)
    out = []
    for c in columns:
        label = _labelled(message, c, columns)
        note, act = _batch_level(label, action)
        share = F.try_divide(F.count(b.col(c)), F.count(F.lit(1))) * 100
        below = F.coalesce((share < least).cast("int"), F.lit(0))
        said = F.concat(
            F.lit(COMPLETENESS_FOUND[0].format(note)), F.format_string("%.0f", share), F.lit(COMPLETENESS_FOUND[1].format(least))
        )
        empty = F.when(F.count(F.lit(1)) == 0, F.lit(NOTHING_TO_COMPLETE)).otherwise(F.lit(label))
        out.append(Check("validate_completeness", act, label, c, count=below, note=said, passed=empty))
    return out


def _batch_level(message: str, action: str) -> tuple[str, str]:
    """Checks on the batch as a whole cannot mark or quarantine rows."""
    if action in ("mark", "quarantine"):
        return BATCH_LEVEL.format(message), "warn"
    return message, action


def _anomaly(b: _Build, step: dict, action: str, message: str) -> list[Check]:
    columns = names(text(step, "column_name"))
    check_columns(b.df, columns, "validate_anomaly")
    method = choice(text(step, "method", "z_score"), ("z_score", "iqr"), "method")
    limit = float(step.get("threshold") or (3 if method == "z_score" else 1.5))
    least = int(step.get("minimum_baseline_records") or 30)
    out = []
    for c in columns:
        label, value = _labelled(message, c, columns), b.col(c).cast("double")
        if b.baseline is None or c not in b.baseline.columns:
            gone = NO_BASELINE.format(c)
            out.append(Check("validate_anomaly", action, label, c, fails=F.lit(False), skip=F.lit(gone)))
            continue
        history = b.baseline.select(F.col(f"`{c}`").cast("double").alias("v")).filter("v IS NOT NULL")
        tag = f"__stats_{b.step}_{c}"
        if method == "z_score":
            stats = history.agg(F.count("v").alias("n"), F.avg("v").alias("mid"), F.stddev_samp("v").alias("spread"))
            mid, spread = F.col(f"{tag}.mid"), F.col(f"{tag}.spread")
            odd = F.try_divide(F.abs(value - mid), spread) > limit
            useless = F.coalesce(spread, F.lit(0.0)) == 0
        else:
            if flag(step.get("exact_quantiles")):
                stats = exact_quantiles(history, "v", [0.25, 0.75])
            else:
                stats = history.agg(
                    F.count("v").alias("n"), F.percentile_approx("v", [0.25, 0.75], F.lit(10000)).alias("q")
                )
            q1, q3 = F.get(F.col(f"{tag}.q"), F.lit(0)), F.get(F.col(f"{tag}.q"), F.lit(1))
            odd = (value < q1 - limit * (q3 - q1)) | (value > q3 + limit * (q3 - q1))
            useless = F.lit(False)
        b.df = b.df.withColumn(tag, stats.select(F.struct("*")).scalar())
        size = F.col(f"{tag}.n")
        few = F.concat(
            F.lit(FEW_RECORDS[0]), size.cast("string"),
            F.lit(FEW_RECORDS[1].format(least)),
        )
        flat = NO_SPREAD.format(c)
        usable = (size >= least) & ~useless
        fails = F.coalesce(usable & odd, F.lit(False))
        skip = F.when(F.max(size) < least, F.max(few)).when(F.bool_and(useless), F.lit(flat))
        found = F.concat(F.lit(ANOMALIES_FOUND[0].format(label)), F.count_if(fails).cast("string"), F.lit(ANOMALIES_FOUND[1]))
        out.append(Check("validate_anomaly", action, label, c, fails=fails, skip=skip, note=found))
    return out


CHECKS: dict[str, Callable[[_Build, dict, str, str], list[Check]]] = {
    "validate_condition": _condition,
    "validate_pattern": _pattern,
    "validate_batch_size": _batch_size,
    "validate_referential_integrity": _referential,
    "validate_anomaly": _anomaly,
    "validate_not_null": _not_null,
    "validate_unique": _unique,
    "validate_range": _range,
    "validate_freshness": _freshness,
    "validate_completeness": _completeness,
}


def run_quality(
    df: DataFrame,
    steps: list[dict],
    keys: list[str] | None = None,
    if_duplicate_keys: str = "fail",
    lookup: Callable[[str], DataFrame] | None = None,
    baseline: DataFrame | None = None,
    now: Column | None = None,
    materialize: bool = False,
) -> QualityOutcome:
    """Corrupt rows, then duplicate keys, then all checks on the same remaining rows.

    ``materialize`` writes the flagged batch to the shared folder once, so that
    the report, the clean rows and the quarantined rows do not each recompute it.
    """
    df = once(df.drop(DQ_DETAILS, QUARANTINE_REASON), "batch")
    checks: list[Check] = []
    gates: list[int] = []
    if CORRUPT in df.columns:
        gates.append(len(checks))
        checks.append(Check("file_corruption", "quarantine", CORRUPT_REASON, fails=F.col(f"`{CORRUPT}`").isNotNull()))
    if keys:
        action = choice(if_duplicate_keys, ACTIONS, "if_duplicate_primary_keys")
        sound = df.filter(~checks[0].fails) if gates else df
        groups = duplicate_keys(sound, keys, "__pk_copies")
        df = mark_by_keys(df, keys, groups)
        fails = F.col("__pk_copies").isNotNull() & ~any_null(keys)
        if gates:
            fails = fails & ~checks[0].fails
        if action == "quarantine":
            gates.append(len(checks))
        found = F.coalesce(F.max(groups.agg(F.count(F.lit(1))).scalar()), F.lit(0))
        message = f"Duplicate primary keys ({', '.join(keys)})"
        checks.append(Check("duplicates_on_pks", action, message, fails=fails, count=found))
    for i, gate in enumerate(checks):
        df = df.withColumn(f"__f{i}", gate.fails)
    gated = [F.col(f"__f{i}") for i in gates]
    held = gated[0] if len(gated) == 1 else gated[0] | gated[1] if gated else F.lit(False)
    first = len(checks)
    passing = df.filter(~held) if gates else df
    build = _Build(passing, lookup or _no_lookup, baseline, now if now is not None else F.current_timestamp())
    for build.step, step in enumerate(steps):
        category = choice(text(step, "Category"), CHECKS, "quality check")
        action = choice(text(step, "if_not_compliant", "warn"), ACTIONS, "if_not_compliant")
        checks += CHECKS[category](build, step, action, text(step, "message"))
    flagged = build.df.withColumns(
        {f"__f{i}": c.fails for i, c in enumerate(checks) if i >= first and c.fails is not None}
    )
    if gates:
        flagged = flagged.unionByName(df.filter(held), allowMissingColumns=True)
    watch = None
    if materialize:
        watch, held_back = Observation(), F.count_if(F.size(_failed(checks, "quarantine")) > 0)
        flagged = settle(flagged, "quality", watch, F.count(F.lit(1)).alias("rows"), held_back.alias("held"))
    return replace(_split(flagged, checks, held, df.columns), watch=watch)


def _no_lookup(name: str) -> DataFrame:
    raise SpecError(f"no table resolver was given, so '{name}' cannot be read")


def _failed(checks: list[Check], action: str) -> Column:
    """Messages of the checks with ``action`` that the row fails, in step order."""
    hit = [
        F.when(F.col(f"__f{i}"), F.lit(c.message))
        for i, c in enumerate(checks)
        if c.action == action and c.fails is not None
    ]
    return F.array_compact(F.array(*hit)) if hit else F.array().cast("array<string>")


def _split(flagged: DataFrame, checks: list[Check], held: Column, columns: list[str]) -> QualityOutcome:
    data = [c for c in columns if not c.startswith("__") and c != CORRUPT]
    reasons, marks = _failed(checks, "quarantine"), _failed(checks, "mark")
    rows = [F.col(f"`{c}`") for c in data]
    clean = flagged.filter(F.size(reasons) == 0)
    if any(c.action == "mark" and c.fails is not None for c in checks):
        joined = F.array_join(F.array_sort(F.array_distinct(marks)), "; ")
        clean = clean.select(*rows, F.when(F.size(marks) > 0, joined).alias(DQ_DETAILS))
    else:
        clean = clean.select(*rows)
    corrupt = [F.col(f"`{CORRUPT}`")] if CORRUPT in columns else []
    bad = flagged.filter(F.size(reasons) > 0)
    bad = bad.select(*rows, *corrupt, F.array_join(reasons, "; ").alias(QUARANTINE_REASON))
    return QualityOutcome(clean, bad, _report(flagged, checks, held), flagged)


#: Columns of the report.
REPORT = (
    "step int, outcome string, category string, message string, column_name string, quarantined string, "
    "rows_impacted bigint, rows_quarantined bigint"
)


def _report(flagged: DataFrame, checks: list[Check], held: Column) -> DataFrame:
    """One row per check, from one aggregate over the flagged batch."""
    aggs, lines = [], []
    live = flagged.withColumn("__held", F.coalesce(held, F.lit(False)))
    gates, rest = {}, {}
    for i, c in enumerate(checks):
        place = gates if c.category in ("file_corruption", "duplicates_on_pks") else rest
        place[f"n{i}"] = c.count if c.count is not None else F.count_if(F.col(f"__f{i}"))
        for part in ("note", "passed", "skip"):
            value = getattr(c, part)
            place[f"{part}{i}"] = F.lit(None).cast("string") if value is None else value
    ungated = not gates
    aggs = [v.alias(k) for k, v in rest.items()]
    tail = live.filter(~F.col("__held")) if not ungated else live
    one = tail.agg(*aggs) if aggs else tail.sparkSession.range(1).select(F.lit(1).alias("__none"))
    if gates:
        head = live.agg(*[v.alias(k) for k, v in gates.items()]).select(F.struct("*")).scalar()
        one = one.withColumn("__head", head).withColumns({k: F.col(f"__head.{k}") for k in gates})
    for i, c in enumerate(checks):
        lines.append(_line(i, c))
    if not lines:
        return one.sparkSession.createDataFrame([], REPORT)
    return one.select(F.inline(F.array(*lines)))


def _line(i: int, c: Check) -> Column:
    n, broken = F.col(f"n{i}").cast("bigint"), F.col(f"n{i}") > 0
    skip, corrupt = F.col(f"skip{i}"), c.category == "file_corruption"
    bad = "Failure" if c.action == "fail" else "Warning"
    outcome = F.when(skip.isNotNull(), F.lit("Skipped")).when(broken, F.lit(bad)).otherwise(F.lit("Pass"))
    message = F.coalesce(
        skip,
        F.when(broken, F.coalesce(F.col(f"note{i}"), F.lit(c.message))).otherwise(
            F.coalesce(F.col(f"passed{i}"), F.lit(c.message))
        ),
    )
    if corrupt:
        outcome = F.lit("Warning")
        message = F.concat(
            F.lit(CORRUPT_FOUND[0]), n.cast("string"), F.lit(CORRUPT_FOUND[1]),
        )
    hit = broken & skip.isNull()
    held = c.action == "quarantine"
    said = {"quarantine": "Yes", "warn": "No", "mark": "No"}.get(c.action)
    none = F.lit(None)
    return F.struct(
        F.lit(i + 1).alias("step"),
        outcome.alias("outcome"),
        F.lit(DISPLAY[c.category]).alias("category"),
        message.alias("message"),
        F.lit(c.column).cast("string").alias("column_name"),
        F.when(hit, F.lit(said)).cast("string").alias("quarantined"),
        (none if held else F.when(hit, n)).cast("bigint").alias("rows_impacted"),
        (F.when(hit, n) if held else none).cast("bigint").alias("rows_quarantined"),
    )


def row_score(df: DataFrame, rules: dict[str, float], output: str = "dq_score") -> DataFrame:
    """Weighted sum of the SQL conditions a row violates."""
    total = F.lit(0.0)
    for condition, weight in rules.items():
        total = total + F.when(F.expr(f"NOT ({condition})"), F.lit(float(weight))).otherwise(F.lit(0.0))
    return df.withColumn(output, total)

from __future__ import annotations

from datetime import datetime

import pytest
from helpers import as_set
from pyspark.sql import functions as F

from tableloom.operators.quality import QualityFailure, run_quality
from tableloom.spec import CORRUPT, DQ_DETAILS, QUARANTINE_REASON, SpecError


def check(category, action="warn", message="m", **attributes):
    return {"Category": category, "if_not_compliant": action, "message": message, **attributes}


@pytest.fixture
def rows(frame):
    return frame("id int, k int, v double, t string", [
        (1, 1, 5.0, "a"), (2, 1, None, "b1"), (3, 2, -3.0, None), (4, None, 50.0, "c"), (5, None, 7.0, "d"),
    ])


def by_category(outcome):
    return {r["category"]: r for r in outcome.results()}


def test_clean_and_quarantined_make_up_the_input(rows):
    out = run_quality(rows, [check("validate_range", "quarantine", column_name="v", min_value="0", max_value="10")])
    assert as_set(out.clean, "id") == {(1,), (2,), (5,)}
    assert as_set(out.quarantined, "id") == {(3,), (4,)}


def test_reasons_join_in_step_order_and_quarantined_rows_are_not_marked(rows):
    out = run_quality(rows, [
        check("validate_not_null", "mark", "marked", column_name="t"), check("validate_condition", "quarantine", "zz", condition="v >= 0"),
        check("validate_range", "quarantine", "aa", column_name="v", min_value="0"), check("validate_pattern", "mark", "letters", column_name="t", pattern_type="alpha_only"),
    ])
    assert as_set(out.quarantined, "id", QUARANTINE_REASON) == {(3, "zz; aa")}
    assert as_set(out.clean, "id", DQ_DETAILS) == {(1, None), (2, "letters"), (4, None), (5, None)}


def test_null_condition_passes(rows):
    out = run_quality(rows, [check("validate_condition", "fail", condition="v < 100")])
    assert by_category(out)["Validate Condition"]["outcome"] == "Pass"


def test_duplicate_keys_count_groups_and_null_keys_stay(rows):
    out = run_quality(rows, [], ["k"], "quarantine")
    record = out.results()[0]
    assert (record["rows_quarantined"], record["quarantined"]) == (2, "Yes")
    assert as_set(out.quarantined, "id") == {(1,), (2,)}


def test_duplicate_keys_fail_by_default(rows):
    with pytest.raises(QualityFailure) as err:
        run_quality(rows, [], ["k"]).stop_on_failure()
    assert err.value.results[0]["outcome"] == "Failure"


def test_unique_counts_rows_with_nulls_as_equal(rows):
    out = run_quality(rows, [check("validate_unique", column_name="k")])
    assert out.results()[0]["rows_impacted"] == 4


def test_referential_integrity_counts_values_and_spares_null_rows(rows, frame):
    known = frame("x int", [(2,)])
    out = run_quality(rows, [check("validate_referential_integrity", "quarantine", current_table_column_name="k", reference_table_name="t", reference_table_column_name="x")],
                      lookup=lambda name: known)
    assert out.results()[0]["rows_quarantined"] == 2  # the value 1, and null counted once
    assert as_set(out.quarantined, "id") == {(1,), (2,)}


def test_corrupt_rows_leave_first(frame):
    df = frame(f"id int, {CORRUPT} string", [(1, None), (1, "bad"), (2, None)])
    out = run_quality(df, [check("validate_not_null", column_name="id")], ["id"])
    assert as_set(out.clean) == {(1,), (2,)}
    assert as_set(out.quarantined, "id", CORRUPT) == {(1, "bad")}
    assert [r["outcome"] for r in out.results()] == ["Warning", "Pass", "Pass"]


@pytest.mark.parametrize("age,unit,want", [("2", "day", "Pass"), ("1", "hour", "Warning"), (None, "hour", "Pass")])
def test_freshness(frame, age, unit, want):
    df = frame("t timestamp", [(datetime(2024, 1, 1),), (None,)])
    now = F.lit("2024-01-01 12:00:00").cast("timestamp")
    step = check("validate_freshness", "quarantine", column_name="t", unit_of_measure=unit, **({"max_age": age} if age else {}))
    record = run_quality(df, [step], now=now).results()[0]
    assert record["outcome"] == want
    assert ("falling back" in record["message"]) == (want == "Warning")


def test_freshness_without_values_passes(frame):
    record = run_quality(frame("t timestamp", [(None,)]), [check("validate_freshness", column_name="t")]).results()[0]
    assert record["outcome"] == "Pass" and record["message"].startswith("No timestamp values")


def test_completeness_and_batch_size_on_an_empty_batch(frame):
    steps = [check("validate_completeness", "fail", column_name="a"), check("validate_batch_size", "fail", min_rows="3")]
    out = by_category(run_quality(frame("a int", []), steps))
    assert out["Completeness Validation"]["message"] == "No records to validate completeness"
    assert out["Batch Size Validation"]["rows_impacted"] == 3


def test_anomaly_skips_thin_flat_and_missing_baselines(frame):
    batch, step = frame("v double", [(1e9,)]), check("validate_anomaly", "fail", column_name="v")
    outcomes = []
    for base in (None, frame("v double", [(1.0,)]), frame("v double", [(1.0,)] * 40)):
        outcomes.append(run_quality(batch, [step], baseline=base).results()[0]["outcome"])
    assert outcomes == ["Skipped"] * 3
    varied = frame("v double", [(float(i),) for i in range(40)])
    record = run_quality(batch, [step], baseline=varied).results()[0]
    assert record["outcome"] == "Failure" and record["message"] == "m - 1 anomalous value(s) detected"


def test_pattern_reads_allow_null_as_text(frame):
    df = frame("t string", [("a",), (None,)])
    step = lambda allow: check("validate_pattern", column_name="t", pattern_type="alpha_only", allow_null=allow)
    assert run_quality(df, [step("true")]).results()[0]["outcome"] == "Pass"
    assert run_quality(df, [step("false")]).results()[0]["rows_impacted"] == 1


def test_materialized_outcome_is_the_same(rows):
    steps = [check("validate_range", "quarantine", column_name="v", min_value="0"), check("validate_not_null", "mark", column_name="t")]
    a, b = run_quality(rows, steps, ["id"]), run_quality(rows, steps, ["id"], materialize=True)
    assert a.results() == b.results()
    assert as_set(a.clean) == as_set(b.clean) and as_set(a.quarantined) == as_set(b.quarantined)


def test_unknown_check_or_action_raises(rows):
    with pytest.raises(SpecError):
        run_quality(rows, [check("validate_mood")])
    with pytest.raises(SpecError):
        run_quality(rows, [check("validate_not_null", "shrug", column_name="v")])

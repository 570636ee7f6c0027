"""Checks declared as data on any table, and the ledger of runs."""

import datetime

import pytest
from rows import as_set

from ludometry.operators.checks import ACCEPTED, IN_RANGE, NOT_NEGATIVE, NOT_NULL, UNIQUE, Check, check, copies, violating, violations
from ludometry.plans import ledger
from ludometry.plans.lake import Lake

ROWS = [
    ("a", 1, 0.5, "x"), ("a", 1, 0.5, "x"), ("b", -1, None, "y"), (None, None, 1.5, None), (None, None, -0.5, "z"), ("c", 2, 1.0, "x"),
]
CHECKS = [
    check(UNIQUE, "k"), check(UNIQUE, "k", "n"), check(NOT_NULL, "k"), check(NOT_NEGATIVE, "n"),
    check(IN_RANGE, "r", low=0, high=1), check(IN_RANGE, "n", high=1), check(ACCEPTED, "v", values=("x", "y")),
]


@pytest.fixture
def rows(spark):
    return spark.createDataFrame(ROWS, "k string, n int, r double, v string")


def test_counts_and_rows_come_from_the_same_checks(rows):
    counts = {r.check_name: (r.violations, r.passed) for r in violations(rows, CHECKS).collect()}
    assert counts == {
        "k_unique": (1, False), "k_n_unique": (1, False), "k_not_null": (2, False), "n_not_negative": (1, False),
        "r_in_range": (2, False), "n_in_range": (1, False), "v_accepted": (1, False),
    }
    found = sorted((r.k or "", r.r or 0.0, ",".join(r.broken)) for r in violating(rows, CHECKS).collect())
    assert found == [
        ("", -0.5, "k_not_null,r_in_range,v_accepted"), ("", 1.5, "k_not_null,r_in_range"),
        ("a", 0.5, "k_n_unique,k_unique"), ("a", 0.5, "k_n_unique,k_unique"), ("b", 0.0, "n_not_negative"), ("c", 1.0, "n_in_range"),
    ]
    assert as_set(copies(rows, CHECKS[0]), "k", "copies") == {("a", 2)}


def test_checks_without_a_key_and_without_rows(rows):
    some = [check(NOT_NULL, "k"), check(NOT_NULL, "v")]
    assert as_set(violations(rows, some), "check_name", "violations") == {("k_not_null", 2), ("v_not_null", 1)}
    for checks in (CHECKS, some):
        assert all(r.violations == 0 and r.passed for r in violations(rows.filter("false"), checks).collect())
        assert violating(rows.filter("false"), checks).count() == 0
    assert violating(rows, [check(UNIQUE, "k")]).count() == 2


def test_checks_that_cannot_be():
    with pytest.raises(ValueError):
        Check(("a",), "other")
    with pytest.raises(ValueError):
        check(NOT_NULL, "a", "b")


def test_layers_are_summed_or_replaced(spark, tmp_path):
    lake = Lake(str(tmp_path))
    assert ledger.layer_totals(spark, lake).count() == 0
    for day, (events, maps) in enumerate([(5, 3), (0, 4), (7, 2)], 1):
        at = datetime.datetime(2024, 1, day, tzinfo=datetime.UTC)
        ledger.record(spark, lake, "bronze", {"new_events": events, "maps": maps}, at)
    assert as_set(ledger.layer_totals(spark, lake), "layer", "row_count") == {("bronze_events", 12), ("bronze_maps", 2)}
    assert ledger.runs(spark, lake).count() == 6
    with pytest.raises(KeyError):
        ledger.record(spark, lake, "bronze", {"other": 1})

from __future__ import annotations

import pytest

from ridgeway.operators.columns import (
    assign_roles,
    drop_columns,
    drop_matching,
    matching_columns,
    random_subset,
)
from ridgeway.plans import census


def test_drop_ignores_absent_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert drop_columns(df, ["b", "nope"]).columns == ["a", "c"]


@pytest.mark.parametrize(
    "name, dropped",
    [
        ("pwgtp1", True),
        ("PWGTP80", True),
        ("wgtp12", True),
        ("PWGTP", False),
        ("WGTP", False),
        ("FAGEP", True),
        ("ffincp", True),
        ("FFULP", True),
        ("FINCP", False),
        ("FULP", False),
        ("FOD1P", False),
        ("FIBEROP", False),
        ("FPARC", False),
        ("FP", False),
        ("AGEP", False),
    ],
)
def test_census_patterns_match_whole_names_in_any_case(name, dropped):
    assert any(matching_columns([name], p) for p in census.DROPPED_PATTERNS) is dropped


def test_patterns_agree_with_spark(spark):
    names = ["pwgtp1", "PWGTP", "wgtp3", "FAGEP", "FINCP", "FOD1P", "FFULP", "NP", "FS", "AGEP"]
    df = spark.createDataFrame([tuple(range(len(names)))], names)
    for pattern in census.DROPPED_PATTERNS:
        expected = df.select(df.colRegex(f"`{pattern}`")).columns
        assert matching_columns(names, pattern) == expected


def test_drop_matching_keeps_protected_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], "x1 int, x2 int, y int")
    assert drop_matching(df, ["X.+"], keep=["x2"]).columns == ["x2", "y"]


def test_remaining_columns_are_categorical():
    spec = assign_roles(["k", "y", "n", "o", "c", "leak", "d"], "y", ["n"], ["o"], ["leak"], ["k"])
    assert spec.categoricals == ("c", "d")
    assert "leak" not in spec.features


def test_roles_reject_missing_and_doubled_columns():
    with pytest.raises(ValueError, match="missing"):
        assign_roles(["y"], "y", ["n"], [])
    with pytest.raises(ValueError, match="more than one role"):
        assign_roles(["y", "n"], "y", ["n"], ["n"])
    with pytest.raises(ValueError, match="more than one role"):
        assign_roles(["y", "n"], "y", ["n", "y"], [])


def test_random_subset_depends_on_seed_only():
    columns = [f"c{i}" for i in range(30)]
    chosen = random_subset(columns, 10, seed=3)
    assert chosen == random_subset(list(reversed(columns)), 10, seed=3)
    assert len(set(chosen)) == 10
    assert chosen != random_subset(columns, 10, seed=4)
    assert sorted(random_subset(columns, 99)) == sorted(columns)

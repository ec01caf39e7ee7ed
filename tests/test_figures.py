"""Known counts of the test tables at sf0.01."""

from collections import Counter

import pytest

from rolehabit.registry import QUERIES

SF_DIR = "/root/testdata/sf0.01"


def rows(spark, name):
    return QUERIES[name](spark, SF_DIR).collect()


def test_branches(spark):
    assert {r.branch: r.calls for r in rows(spark, "identity_router")} == {
        "AssumedRole": 6949,
        "IAMUser": 1046,
        "Root": 995,
    }


@pytest.mark.parametrize("name", ["baseline_expiry_replay", "baseline_sessions"])
def test_ninety_days_of_orders(spark, name):
    assert len(rows(spark, name)) == 13_920


def test_groups_of_a_week(spark):
    sizes = Counter(r.n_new for r in rows(spark, "role_new_action_sets"))
    assert sizes == {1: 972, 2: 805, 3: 466, 4: 199, 5: 74, 6: 14, 7: 4}


def test_hour_across_midnight(spark):
    assert len(rows(spark, "hourly_activity")) == 16

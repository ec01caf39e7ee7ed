"""Routing, cleaning and the join to the inventory."""

from datetime import datetime, timezone

from rolehabit.operators import activity
from tests.samples import CALL, plan_of, role, roles

AT = datetime(2024, 1, 1, tzinfo=timezone.utc)


def frame(spark, *rows):
    calls = [(AT, source, name, who, kind) for source, name, who, kind in rows]
    return activity.at_tick(spark.createDataFrame(calls, CALL), AT)


def test_router_drops_other_types(spark):
    kinds = ["AssumedRole", "Root", "IAMUser", "AWSService", None]
    calls = frame(spark, *[("s", "n", "p", kind) for kind in kinds])
    routed = {(r.branch, r.identity_type) for r in activity.routed(calls).collect()}
    assert routed == {(kind, kind) for kind in kinds[:3]}


def test_distinct_and_cleaning(spark):
    calls = frame(
        spark,
        ("s", "n", "p", "AssumedRole"),
        ("s", "n", "p", "AssumedRole"),
        ("s", 'n"', "p", "AssumedRole"),
        ("s", "n", None, "Root"),
        ("s", "n", "", "Root"),
        ("s,t", "n", "p", "AssumedRole"),
    )
    rows = sorted(tuple(r)[1:] for r in activity.distinct_calls(calls).collect())
    assert rows == [
        ("s", "n", "", "Root"),
        ("s", "n", "p", "AssumedRole"),
        ("s,t", "n", "p", "AssumedRole"),
    ]


def test_only_known_roles_are_learned(spark):
    calls = frame(
        spark,
        ("s", "a", "R1", "AssumedRole"),
        ("s", "a", "R1", "AssumedRole"),
        ("s", "b", "ghost", "AssumedRole"),
        ("s", "c", None, "AssumedRole"),
        ("s", "d", "R1", "Root"),
        (None, "e", "R1", "AssumedRole"),
    )
    inventory = roles(spark, role("R1"), role(""))
    actions = activity.role_actions(calls)
    known = activity.of_known_roles(actions, inventory).collect()
    assert sorted(r.action for r in known) == [":e", "s:a"]
    unknown = activity.unknown_principals(actions, inventory).collect()
    assert [(r.role_id, r.action) for r in unknown] == [("ghost", "s:b")]


def test_account_must_match_where_known(spark):
    calls = frame(spark, ("s", "a", "R1", "AssumedRole"))
    inventory = roles(spark, role("R1", account="1"))
    for account, expected in (("1", 1), ("2", 0)):
        actions = activity.role_actions(calls.selectExpr("*", f"'{account}' AS account"))
        assert activity.of_known_roles(actions, inventory).count() == expected


def test_repeats_go_before_the_shuffle(spark):
    calls = frame(spark, ("s", "a", "R1", "AssumedRole"))
    plan = plan_of(activity.distinct_calls(calls)).split("== Physical Plan ==")[1]
    final, partial = plan.split("Exchange hashpartitioning(")
    assert "HashAggregate" in final and "HashAggregate" in partial
    keys = partial.split(")")[0]
    assert all(name in keys for name in activity.ACTIVITY)

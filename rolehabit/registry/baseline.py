"""The baseline: lookups, merge, expiry, replay, and the snapshot store."""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from rolehabit.functions.moments import epoch_of, moment, seconds_of
from rolehabit.operators import novelty
from rolehabit.plans import replay as history
from rolehabit.plans.tick import roles_in_scope
from rolehabit.registry.base import (
    DAILY,
    WEEKLY,
    fx_accounts,
    fx_calls,
    fx_roles,
    over_views,
    registered,
    table,
)
from rolehabit.session import shared_folder
from rolehabit.settings import DAY, HOUR
from rolehabit.sources.baseline import BaselineStore, live
from rolehabit.sources.inventory import selected_accounts

BEFORE = datetime(2024, 1, 15)
RUN = datetime(2024, 1, 16)

STORED = """
stored AS (
  SELECT role_id, action, max(tick) + 604800 AS ttl FROM occ WHERE tick <= 1705276800
  GROUP BY ALL HAVING max(tick) + 604800 >= 1705276800),
seen AS (SELECT * FROM occ WHERE tick = 1705363200),
live AS (SELECT * FROM stored WHERE ttl >= 1705363200)"""


def daily_occurrences(spark, sf_dir):
    return history.occurrences(fx_calls(spark, sf_dir), fx_roles(spark, sf_dir), DAY)


def occurrences_between(spark, sf_dir, first: datetime, last: datetime):
    """Daily occurrences of the calls from first to last; the scan reads no others."""
    calls = fx_calls(spark, sf_dir)
    dtype = calls.schema["event_ts"].dataType.simpleString()
    event_ts = F.col("event_ts")
    calls = calls.where((event_ts >= moment(first, dtype)) & (event_ts < moment(last, dtype)))
    return history.occurrences(calls, fx_roles(spark, sf_dir), DAY)


def before_and_seen(spark, sf_dir):
    """The baseline left by the runs up to BEFORE, and what the run at RUN sees."""
    day = timedelta(seconds=DAY)
    past = occurrences_between(spark, sf_dir, BEFORE - timedelta(seconds=WEEKLY.ttl) - day, BEFORE)
    stored = novelty.baseline_as_of(past, epoch_of(BEFORE), WEEKLY.ttl)
    return stored, occurrences_between(spark, sf_dir, RUN - day, RUN)


@registered(
    over_views(
        "SELECT role_id, action, tick FROM seen ANTI JOIN live USING (role_id, action)",
        DAILY,
        STORED,
    )
)
def new_actions_tick(spark, sf_dir):
    """Actions of one run that the live baseline lacks."""
    stored, seen = before_and_seen(spark, sf_dir)
    return novelty.new_actions(seen, stored, epoch_of(RUN))


@registered(
    over_views(
        "SELECT role_id, action, tick FROM seen SEMI JOIN live USING (role_id, action)",
        DAILY,
        STORED,
    )
)
def known_actions_tick(spark, sf_dir):
    """Actions of one run that the live baseline has."""
    stored, seen = before_and_seen(spark, sf_dir)
    return novelty.known_actions(seen, stored, epoch_of(RUN))


@registered(
    over_views(
        """
SELECT s.role_id, s.action, s.tick, l.role_id IS NULL AS is_new
FROM seen s LEFT JOIN live l ON s.role_id = l.role_id AND s.action = l.action""",
        DAILY,
        STORED,
    )
)
def decisions_tick(spark, sf_dir):
    """J2 and J3 in one join, as the tick runs them."""
    stored, seen = before_and_seen(spark, sf_dir)
    return novelty.decide(seen, stored, epoch_of(RUN))


@registered(
    over_views(
        """
SELECT role_id, action, max(ttl) AS ttl FROM (
  SELECT role_id, action, ttl FROM live
  UNION ALL SELECT role_id, action, tick + 604800 AS ttl FROM seen)
GROUP BY role_id, action""",
        DAILY,
        STORED,
    )
)
def baseline_upsert(spark, sf_dir):
    """The baseline after the run."""
    stored, seen = before_and_seen(spark, sf_dir)
    return novelty.merge(stored, seen, epoch_of(RUN), WEEKLY.ttl)


@registered(
    over_views(
        """
SELECT role_id, action, max(tick) + 604800 AS ttl FROM occ
GROUP BY ALL HAVING max(tick) + 604800 >= 1706572800""",
        DAILY,
    )
)
def baseline_live_rows(spark, sf_dir):
    """What is still live on the last day; the row's last second counts."""
    occurrences = daily_occurrences(spark, sf_dir)
    stored = occurrences.groupBy("role_id", "action").agg(
        (F.max("tick") + WEEKLY.ttl).alias("ttl")
    )
    return live(stored, epoch_of(datetime(2024, 1, 30)))


ORDERS = """
WITH occ AS (
  SELECT DISTINCT o_custkey, o_orderpriority, CAST(epoch_us(o_orderdate) // 1000000 AS BIGINT) AS tick
  FROM orders),
lagged AS (
  SELECT *, lag(tick) OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY tick) AS prev
  FROM occ),"""
ORDER_KEY = ["o_custkey", "o_orderpriority"]


def order_occurrences(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return orders.select(*ORDER_KEY, seconds_of(F.col("o_orderdate")).alias("tick")).distinct()


@registered(
    ORDERS
    + """
news AS (SELECT * FROM lagged WHERE prev IS NULL OR tick - prev > 7776000)
SELECT o_custkey, o_orderpriority, tick FROM news"""
)
def baseline_expiry_replay(spark, sf_dir):
    """W1 with 90 days, over years of orders."""
    return novelty.first_or_lapsed(order_occurrences(spark, sf_dir), 90 * DAY, ORDER_KEY)


@registered(
    ORDERS
    + """
cut AS (
  SELECT *, sum(CASE WHEN prev IS NULL OR tick - prev > 7776000 THEN 1 ELSE 0 END)
              OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY tick) AS session
  FROM lagged)
SELECT o_custkey, o_orderpriority, min(tick) AS tick, max(tick) AS last_tick, count(*) AS ticks
FROM cut GROUP BY o_custkey, o_orderpriority, session"""
)
def baseline_sessions(spark, sf_dir):
    """The same as sessions."""
    return novelty.sessions(order_occurrences(spark, sf_dir), 90 * DAY, ORDER_KEY)


@registered(over_views("SELECT role_id, action, tick FROM news", DAILY))
def replay_daily_7d(spark, sf_dir):
    """W1 on events with daily runs and a week's memory."""
    return history.replay(fx_calls(spark, sf_dir), fx_roles(spark, sf_dir), DAY, WEEKLY)


@registered(
    over_views(
        """
SELECT role_id, action, tick FROM (
  SELECT *, lag(tick) OVER (PARTITION BY role_id, action ORDER BY tick) AS prev FROM (
    SELECT DISTINCT principal_id AS role_id, event_source || ':' || event_name AS action,
           CAST((epoch_us(event_ts) // 3600000000 + 1) * 3600 AS BIGINT) AS tick
    FROM fx_audit
    WHERE identity_type = 'AssumedRole' AND principal_id IN (SELECT role_id FROM fx_roles)))
WHERE prev IS NULL OR tick - prev > 7776000"""
    )
)
def replay_hourly_90d(spark, sf_dir):
    """W1 with the default settings: hourly runs, 90 days."""
    return history.replay(fx_calls(spark, sf_dir), fx_roles(spark, sf_dir), HOUR)


@registered(
    """
SELECT l_suppkey, tick FROM (
  SELECT *, lag(tick) OVER (PARTITION BY l_suppkey ORDER BY tick) AS prev FROM (
    SELECT DISTINCT l_suppkey, CAST(epoch_us(l_shipdate) // 1000000 AS BIGINT) AS tick
    FROM lineitem))
WHERE prev IS NULL OR tick - prev > 864000"""
)
def replay_in_blocks(spark, sf_dir):
    """W1 for few keys with long histories: windows per block of time."""
    ticks = table(spark, sf_dir, "lineitem").select(
        "l_suppkey", seconds_of(F.col("l_shipdate")).alias("tick")
    )
    return novelty.first_or_lapsed_in_blocks(
        ticks.distinct(), 10 * DAY, 365 * DAY, ["l_suppkey"]
    )


@registered(
    over_views(
        """
SELECT role_id, action, max(tick) + 604800 AS ttl FROM occ o
WHERE tick <= 1705276800 AND role_id IN (
  SELECT role_id FROM fx_roles r JOIN fx_accounts a ON r.account = a.account
  WHERE a.status = 'ACTIVE')
GROUP BY ALL HAVING max(tick) + 604800 >= 1705276800""",
        DAILY,
    )
)
def baseline_snapshot(spark, sf_dir):
    """K2, Q11: a warm-up written to the store as a snapshot and read back."""
    accounts = selected_accounts(fx_accounts(spark, sf_dir))
    roles = roles_in_scope(fx_roles(spark, sf_dir), accounts)
    root = f"{shared_folder(spark)}/snapshot-{uuid.uuid4().hex}"
    store = BaselineStore(spark, root)
    version = history.warm_up(fx_calls(spark, sf_dir), roles, store, BEFORE, DAY, WEEKLY)
    return store.load(version)

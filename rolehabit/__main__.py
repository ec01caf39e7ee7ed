"""Jobs from the command line, for spark-submit:

    spark-submit --py-files rolehabit.zip rolehabit/__main__.py tick --table … --roles … …
"""

from __future__ import annotations

import argparse
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rolehabit.functions.moments import as_utc, moment
from rolehabit.operators.activity import calls_of
from rolehabit.plans.ingest import ingest_days
from rolehabit.plans.replay import replay_alerts, warm_up
from rolehabit.plans.tick import roles_in_scope, run_tick
from rolehabit.session import build_session
from rolehabit.settings import HOUR, REGIONS, Settings
from rolehabit.sinks.emission import alert_lines, error_lines, write_lines
from rolehabit.sinks.tables import written
from rolehabit.sources import audit, inventory
from rolehabit.sources.baseline import BaselineStore
from rolehabit.sources.versions import InventoryVersions
from rolehabit.streaming import jobs, late
from rolehabit.streaming.progress import ProgressLog

DEFAULTS = Settings()


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="rolehabit")
    sub = top.add_subparsers(dest="job", required=True)

    def job(name: str, needs: str, text: str) -> None:
        command = sub.add_parser(name, help=text)
        for option in needs.split():
            command.add_argument(f"--{option}", required=True)
        if "baseline" not in needs:
            command.add_argument("--baseline", help="snapshots a stream starts from")
        command.add_argument("--run-ts", type=_time, default=None, help="ISO time; now if left out")
        command.add_argument("--business", default="", help="label of all accounts")
        command.add_argument("--business-token", default=None)
        command.add_argument("--usual-regions", action="store_true", help="only the usual list")
        command.add_argument("--idp-token", default=DEFAULTS.idp_token)
        command.add_argument("--index", default=DEFAULTS.index)
        for option in ("accounts", "roles", "actions", "services"):
            verb = "skip" if option == "accounts" else "ignore"
            command.add_argument(f"--{verb}-{option}", nargs="*", default=[])
        if name.startswith("stream"):
            command.add_argument("--files-per-trigger", type=int, default=None, help="all if left out")
        command.add_argument("--once", action="store_true", help="end a stream when caught up")
        command.add_argument("--today-only", action="store_true")
        command.add_argument("--owner-as-list", action="store_true")
        command.add_argument("--topic", action="store_true", help="wrap lines as topic messages")
        if name == "stream-alerts":
            command.add_argument("--inventory", help="versions to follow, instead of exports")
            command.add_argument("--roles", help="role export of the stream's start")
            command.add_argument("--accounts", help="account export of the stream's start")
        if name == "stream-windows":
            command.add_argument("--delay", type=int, default=6 * HOUR, help="seconds an event may be late")
            command.add_argument("--progress", required=True, help="folder of counters by micro-batch")

    job("ingest", "logs table output", "audit files of the run's dates to the table")
    job("tick", "table roles accounts baseline output", "one run against the baseline")
    job("warm-up", "table roles accounts baseline", "fill an empty baseline from the table")
    job("replay", "table roles accounts output", "alerts of all hourly runs of the table")
    job("stream-ingest", "logs table checkpoint", "audit files to the table, each once")
    job(
        "stream-alerts",
        "logs output checkpoint",
        "audit files to alerts, hour by hour, from keyed state",
    )
    job("publish-inventory", "roles accounts inventory", "exports to a new version for streams")
    job("stream-windows", "logs roles accounts output checkpoint", "calls of roles by hour of the events")
    return top


def _time(text: str) -> datetime:
    return as_utc(datetime.fromisoformat(text))


def settings_of(options: argparse.Namespace) -> Settings:
    return Settings(
        idp_token=options.idp_token,
        index=options.index,
        business_token=options.business_token,
        regions=REGIONS if options.usual_regions else (),
        skipped_accounts=tuple(options.skip_accounts),
        ignored_roles=tuple(options.ignore_roles),
        ignored_actions=tuple(options.ignore_actions),
        ignored_services=tuple(options.ignore_services),
        # a live run takes what has arrived; a run of the past must not see ahead
        bound_above=options.run_ts is not None,
        today_only=options.today_only,
        owner_as_list=options.owner_as_list,
        topic=options.topic,
    )


def exports(spark: SparkSession, options) -> tuple[DataFrame, DataFrame]:
    accounts = inventory.read_accounts(spark, options.accounts)
    return inventory.read_roles(spark, options.roles), accounts.withColumn("business", F.lit(options.business))


def inventories(spark: SparkSession, options, settings, run_ts: datetime) -> tuple[DataFrame, DataFrame]:
    """Roles and accounts in scope, parsed once and kept with the output."""
    folder = f"{getattr(options, 'output', None) or options.baseline}/inventory"
    found, accounts = exports(spark, options)
    accounts = written(inventory.selected_accounts(accounts, settings), f"{folder}/accounts")
    # roles nothing can be learned of are reported, not passed over in silence
    faults = error_lines(inventory.roles_without_principal(found), moment(run_ts), settings)
    write_lines(faults, f"{folder}/errors")
    roles = roles_in_scope(found, accounts)
    return written(roles, f"{folder}/roles"), accounts


def stream_alerts(spark: SparkSession, options, settings, run_ts: datetime, trigger: dict) -> None:
    files = audit.stream_audit_files(spark, options.logs, options.files_per_trigger)
    errors = jobs.start_errors(files, f"{options.output}/errors", f"{options.checkpoint}-errors", trigger, settings)
    calls = calls_of(audit.readable(audit.flatten(files)))
    seed = BaselineStore(spark, options.baseline) if options.baseline else None
    shared = dict(settings=settings, evict=True, seed=seed)
    if options.inventory:
        versions = InventoryVersions(spark, options.inventory)
        query = jobs.start_alerts_following(calls, versions, options.output, options.checkpoint, trigger, **shared)
    else:
        roles, accounts = inventories(spark, options, settings, run_ts)
        query = jobs.start_alerts(calls, roles, accounts, options.output, options.checkpoint, trigger, **shared)
    query.awaitTermination()
    errors.awaitTermination()


def stream_windows(spark: SparkSession, options, roles: DataFrame, settings, trigger: dict) -> None:
    files = audit.stream_audit_files(spark, options.logs, options.files_per_trigger)
    calls = calls_of(audit.readable(audit.flatten(files)), "eventId")
    with ProgressLog(spark, options.progress) as log:
        log.wait(
            late.start_role_windows(
                calls, roles, f"{options.output}/windows", options.checkpoint, trigger, options.delay, "eventId", settings=settings
            )
        )


def main(arguments: list[str] | None = None) -> None:
    options = parser().parse_args(arguments)
    settings = settings_of(options)
    run_ts = options.run_ts or datetime.now(timezone.utc)
    spark = build_session(f"rolehabit {options.job}")

    if options.job == "ingest":
        days = audit.spanned_days(run_ts, settings)
        ingest_days(spark, options.logs, days, options.table, options.output, run_ts, settings)
        return
    trigger = jobs.until_caught_up() if options.once else jobs.hourly()
    if options.job == "stream-ingest":
        files = audit.stream_audit_files(spark, options.logs, options.files_per_trigger)
        jobs.start_ingest(
            files, options.table, options.checkpoint, trigger, settings
        ).awaitTermination()
        return

    if options.job == "stream-alerts":
        if not (options.inventory or (options.roles and options.accounts)):
            raise SystemExit("stream-alerts needs --inventory, or --roles and --accounts")
        stream_alerts(spark, options, settings, run_ts, trigger)
        return
    if options.job == "publish-inventory":
        roles, accounts = exports(spark, options)
        print(InventoryVersions(spark, options.inventory).publish(roles, accounts, settings))
        return

    roles, accounts = inventories(spark, options, settings, run_ts)
    if options.job == "stream-windows":
        stream_windows(spark, options, roles, settings, trigger)
        return
    days = None
    if options.job == "tick":
        days = audit.spanned_days(run_ts, settings)
    elif options.job == "warm-up":
        # a file's date may be a day off that of its records
        first = as_utc(run_ts) - timedelta(seconds=settings.ttl + HOUR)
        count = (as_utc(run_ts).date() - first.date()).days
        days = [first.date() + timedelta(days=n) for n in range(-1, count + 2)]
    calls = calls_of(audit.read_audit_table(spark, options.table, days))
    if options.job == "replay":
        found = replay_alerts(calls, roles, accounts, settings=settings)
        lines = alert_lines(found, F.timestamp_seconds("tick"), settings)
        write_lines(lines, f"{options.output}/replay")
        return
    store = BaselineStore(spark, options.baseline)
    if options.job == "warm-up":
        warm_up(calls, roles, store, run_ts, settings=settings)
    else:
        print(run_tick(calls, roles, accounts, store, options.output, run_ts, settings))


if __name__ == "__main__":
    main()

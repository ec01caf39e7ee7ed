import gzip
import json
from datetime import date, datetime, timedelta, timezone

import pytest

from rolehabit.operators import activity
from rolehabit.plans.ingest import ingest_days
from rolehabit.registry import inputs
from rolehabit.schemas import AUDIT_RECORD, AUDIT_TABLE
from rolehabit.settings import REGIONS, Settings
from rolehabit.sources import audit
from tests.samples import FIRST, RUN, SECOND, plan_of, put_audit_file

DAY = date(2024, 1, 2)


@pytest.fixture
def files(spark, tmp_path):
    base = tmp_path / "logs"
    put_audit_file(base, [FIRST, SECOND])
    return base


def flat(spark, base, days=(DAY,), **options):
    paths = audit.day_folders(str(base), days, **options)
    return audit.flatten(audit.read_audit_files(spark, paths))


def test_records_keep_their_declared_columns(spark, files):
    rows = {r.eventName: r for r in flat(spark, files).collect()}
    frame = flat(spark, files)
    assert frame.columns == [*AUDIT_TABLE.names, "reason", "origin", "content"]
    assert frame.columns[: len(AUDIT_RECORD)] == AUDIT_RECORD.names
    first = rows["GetObject"]
    assert json.loads(first.requestParameters) == {"bucketName": "b", "n": {"x": 1}}
    assert first.readOnly == "true"
    assert (first.sourceIpAddress, first.requestId, first.eventId) == ("10.0.0.1", "req-1", "ev-1")
    assert first.resources[0].accountId == "1"
    assert first.userIdentity.sessionContext.attributes.mfaAuthenticated == "false"
    assert (first.account, first.region) == ("1", "us-east-1")
    assert (first.year, first.month, first.day, first.hour) == ("2024", "01", "02", "11")
    assert rows["ListRoles"].userIdentity.sessionContext is None


def test_window_keeps_the_cutoffs_own_second(spark, files):
    calls = activity.trailing_window(activity.calls_of(flat(spark, files)), RUN)
    assert [r.event_name for r in calls.collect()] == ["GetObject"]


def test_typed_window_equals_the_text_comparison(spark):
    cutoff = RUN - timedelta(hours=1)
    text = cutoff.strftime("%Y-%m-%dT%H:%M:%S.") + f"{cutoff.microsecond // 1000:03d}Z"
    base = datetime(2024, 1, 2, 10, 59, 57, tzinfo=timezone.utc)
    times = [base + timedelta(seconds=n) for n in range(6)]
    frame = spark.createDataFrame([(t,) for t in times], "event_ts timestamp")
    kept = {r.event_ts for r in activity.trailing_window(frame, RUN).collect()}
    wanted = [t for t in times if t.strftime("%Y-%m-%dT%H:%M:%SZ") > text]
    assert len(kept) == len(wanted) == 3


@pytest.mark.parametrize(
    "today_only, expected", [(False, {"late", "early"}), (True, {"early"})]
)
def test_midnight(spark, today_only, expected):
    rows = [
        (datetime(2024, 1, 1, 23, 45, tzinfo=timezone.utc), "late"),
        (datetime(2024, 1, 2, 0, 15, tzinfo=timezone.utc), "early"),
        (datetime(2024, 1, 2, 0, 45, tzinfo=timezone.utc), "ahead"),
    ]
    frame = spark.createDataFrame(rows, "event_ts timestamp, event_name string")
    run = datetime(2024, 1, 2, 0, 30, tzinfo=timezone.utc)
    kept = activity.trailing_window(frame, run, Settings(today_only=today_only))
    assert {r.event_name for r in kept.collect()} == expected
    open_above = Settings(today_only=today_only, bound_above=False)
    kept = activity.trailing_window(frame, run, open_above)
    assert {r.event_name for r in kept.collect()} == expected | {"ahead"}


def test_folders_can_be_limited(spark, files):
    put_audit_file(files, [SECOND], account="2", region="mars-1")
    assert flat(spark, files).count() == 3
    assert flat(spark, files, accounts=["2"]).count() == 1
    assert flat(spark, files, regions=REGIONS).count() == 2
    assert flat(spark, files, days=[date(2024, 1, 3)]).count() == 0


def test_ingest_is_repeatable_and_quarantines(spark, files, tmp_path):
    put_audit_file(files, "{not json", name="bad.json")
    put_audit_file(files, [{**SECOND, "eventTime": "yesterday", "eventID": "ev-9"}], name="y.json")
    table, out = str(tmp_path / "table"), str(tmp_path / "out")
    for _ in range(2):
        ingest_days(spark, str(files), [DAY], table, out, RUN)
    assert audit.read_audit_table(spark, table).count() == 2
    lines = [json.loads(r.value) for r in spark.read.text(f"{out}/errors").collect()]
    assert {line["sourcetype"] for line in lines} == {"lambda:cloudtrailanomaly:error"}
    events = sorted(
        (json.loads(line["event"]) for line in lines), key=lambda e: e["error_note"]
    )
    assert [e["error_note"] for e in events] == ["unreadable file", "unreadable time"]
    assert events[0]["query_response"] == "{not json"
    assert events[0]["note"].endswith("bad.json")
    assert (events[1]["query_response"], events[1]["note"]) == ("yesterday", "ev-9")

    put_audit_file(files, [], name="bad.json")  # repaired, and empty
    ingest_days(spark, str(files), [DAY], table, out, RUN)
    assert spark.read.text(f"{out}/errors").count() == 1
    assert audit.read_audit_table(spark, table).count() == 2


def test_replacing_a_day_leaves_the_others(spark, files, tmp_path):
    put_audit_file(files, [{**FIRST, "eventTime": "2024-01-01T23:59:59Z"}], day="2024/01/01")
    table, out = str(tmp_path / "table"), str(tmp_path / "out")
    ingest_days(spark, str(files), [date(2024, 1, 1), DAY], table, out, RUN)
    # a file of the second day that holds a call of the evening before
    put_audit_file(files, [{**FIRST, "eventTime": "2024-01-01T23:59:58Z"}], name="late.json")
    ingest_days(spark, str(files), [DAY], table, out, RUN)
    assert audit.read_audit_table(spark, table).count() == 4


def test_table_scan_is_pruned(spark, files, tmp_path):
    table = str(tmp_path / "table")
    audit.write_audit_table(flat(spark, files), table)
    records = audit.read_audit_table(spark, table, audit.spanned_days(RUN))
    frame = activity.distinct_calls(
        activity.trailing_window(activity.calls_of(records), RUN)
    )
    assert [r.event_name for r in frame.collect()] == ["GetObject"]
    scan = next(line for line in plan_of(frame).splitlines() if "FileScan" in line)
    partition_filters = scan.split("PartitionFilters:")[1].split("PushedFilters:")[0]
    for name in ("year", "month", "day", "hour"):
        assert name in partition_filters
    assert "GreaterThanOrEqual(event_ts" in scan
    read = scan.split("ReadSchema:")[1]
    assert "requestParameters" not in read and "attributes" not in read
    assert "sessionIssuer:struct<principalId:string>" in read
    assert audit.read_audit_table(spark, table, [date(2023, 1, 1)]).count() == 0


def test_half_read_record_is_quarantined_and_the_rest_kept(spark, tmp_path):
    odd = {**SECOND, "userIdentity": "root", "eventID": "ev-odd"}
    put_audit_file(tmp_path, [FIRST, odd])
    rows = flat(spark, tmp_path).collect()
    assert [r.reason for r in rows].count("half-read record") == 1
    assert {r.eventName for r in rows if r.reason is None} >= {"GetObject"}
    (fault,) = [r for r in rows if r.reason]
    assert "ev-odd" in fault.content and fault.origin.endswith("x.json")


def test_no_record_carries_the_array_of_its_file(spark, files):
    """Else the work grows with the square of a file's records."""
    plan = flat(spark, files)._jdf.queryExecution().optimizedPlan()
    while plan.nodeName() != "Generate":
        plan = plan.children().apply(0)
    kept = plan.output().mkString(",")
    assert "record#" in kept
    assert "Records#" not in kept and "_rows#" not in kept


def test_nested_text_comes_as_written_from_compressed_files(spark, files):
    """The text of nested objects is taken from what was read, without going back to the file."""
    text = '{"n": 1.50,  "t": [1e3]}'
    record = json.dumps({**FIRST, "requestParameters": None}).replace('"requestParameters": null', f'"requestParameters": {text}')
    base = files.parent / "packed"
    put_audit_file(base, [])
    with gzip.open(base / "1/CloudTrail/us-east-1/2024/01/02/y.json.gz", "wt") as file:
        file.write(f'{{"Records":[{record}\n,\n{record}]}}')
    assert [r.requestParameters for r in flat(spark, base).collect()] == [text, text]


def test_audit_files_hold_an_account_and_day(spark, tmp_path, monkeypatch):
    """Their number follows the accounts, days and records, not the range of the ids."""
    spark.sql(
        "SELECT 1000 * id AS event_id, TIMESTAMP_NTZ '2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, id % 48) AS ts,"
        " 1L AS user_id, 'view' AS event_type, 1.0D AS value, '{\"k\": 1}' AS props FROM range(96)"
    ).write.parquet(f"{tmp_path}/events.parquet")
    spark.sql("SELECT 1L AS c_custkey, 'c' AS c_name, 2 AS c_nationkey, 0.0D AS c_acctbal, 'X' AS c_mktsegment").write.parquet(f"{tmp_path}/customer.parquet")

    def written():
        files = audit.read_files_below(spark, inputs.write_audit_files(spark, str(tmp_path)))
        return files.count(), audit.flatten(files).select("eventId").distinct().count()

    assert written() == (2, 96)
    monkeypatch.setattr(inputs, "RECORDS_PER_FILE", 12)
    several, records = written()
    assert 2 < several <= 8 and records == 96

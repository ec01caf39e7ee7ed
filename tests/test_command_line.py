"""The jobs end to end, from audit files and exports to alert lines."""

import json

from rolehabit.__main__ import main
from tests.samples import FIRST, SECOND, put_audit_file


def call(at, name, principal="AROAX"):
    record = json.loads(json.dumps({**FIRST, "eventTime": at, "eventName": name}))
    record["userIdentity"]["sessionContext"]["sessionIssuer"]["principalId"] = principal
    return record


def put_exports(folder, roles):
    rows = {
        "accounts": [{"Id": "1", "Name": "One", "Email": "one@x", "Status": "ACTIVE"}],
        "roles": [
            {
                "account": "1", "Arn": f"arn:aws:iam::1:role/{name}", "RoleName": name, "RoleId": name, "CreateDate": "2020-01-01T00:00:00Z",
                "AssumeRolePolicyDocument": {"Statement": [{"Principal": {"AWS": ["x"]}}]},
            }
            for name in roles
        ],
    }
    for name, found in rows.items():
        (folder / name).mkdir(exist_ok=True)
        (folder / name / "export.json").write_text("\n".join(map(json.dumps, found)))


def test_stream_follows_published_inventories(spark, tmp_path):
    def run(job, *needs, more=()):
        places = [arg for need in needs for arg in (f"--{need}", str(tmp_path / need))]
        main([job, *places, "--business", "retail", "--once", *more])

    def lines(folder):
        return [json.loads(json.loads(r.value)["default"]) for r in spark.read.text(str(tmp_path / "output" / folder)).collect()]

    stream = ("stream-alerts", "logs", "inventory", "output", "checkpoint")
    put_exports(tmp_path, ["AROAX"])
    run("publish-inventory", "roles", "accounts", "inventory")
    put_audit_file(tmp_path / "logs", [call("2024-01-02T11:00:00Z", "A"), call("2024-01-02T11:00:00Z", "B", "LATER")])
    put_audit_file(tmp_path / "logs", "{not json", name="bad.json")
    run(*stream, more=["--topic"])
    put_exports(tmp_path, ["AROAX", "LATER"])
    run("publish-inventory", "roles", "accounts", "inventory")
    put_audit_file(tmp_path / "logs", [call("2024-01-02T12:00:00Z", "B", "LATER"), call("2024-01-02T12:00:00Z", "A")], name="y.json")
    run(*stream, more=["--topic"])
    events = [json.loads(line["event"]) for line in lines("alerts")]
    assert sorted((e["principalId"], e["role_actions"]) for e in events) == [
        ("AROAX", ["s3.amazonaws.com:A"]),
        ("LATER", ["s3.amazonaws.com:B"]),
    ]
    (error,) = lines("errors")  # a file that cannot be read is a line of its own
    assert error["sourcetype"] == "lambda:cloudtrailanomaly:error" and "not json" in error["event"]

    run("stream-windows", "logs", "roles", "accounts", "output", more=["--checkpoint", str(tmp_path / "c2"), "--progress", str(tmp_path / "p"), "--delay", "60"])
    assert [r.input_rows for r in spark.read.json(str(tmp_path / "p")).collect()] == [3]  # files


def test_files_to_alerts(spark, tmp_path):
    logs = tmp_path / "logs"
    names = ["PutObject", "GetObject", "ListBucket", "DeleteObject", "GetAcl"]
    put_audit_file(logs, [call("2024-01-02T09:10:00Z", "GetObject")], name="a.json")
    put_audit_file(
        logs, [SECOND] + [call(f"2024-01-02T11:{n:02d}:00Z", v) for n, v in enumerate(names)]
    )
    # the same principal id in another account's log belongs to no role there
    put_audit_file(logs, [call("2024-01-02T11:30:00Z", "Elsewhere")], account="2")
    for name, rows in {
        "accounts": [
            {"Id": "1", "Name": "One", "Email": "one@x", "Status": "ACTIVE"},
            {"Id": "2", "Name": "Two", "Email": "two@x", "Status": "ACTIVE"},
        ],
        "roles": [
            {
                "account": "1",
                "Arn": "arn:aws:iam::1:role/r",
                "RoleName": "r",
                "RoleId": "AROAX",
                "CreateDate": "2020-01-01T00:00:00Z",
                "AssumeRolePolicyDocument": {"Statement": [{"Principal": {"AWS": ["x"]}}]},
            }
        ],
    }.items():
        (tmp_path / name).mkdir()
        (tmp_path / name / "export.json").write_text("\n".join(map(json.dumps, rows)))

    def run(job, run_ts, *needs, once=False):
        places = [arg for need in needs for arg in (f"--{need}", str(tmp_path / need))]
        main([job, *places, "--run-ts", run_ts, "--business", "retail", *["--once"] * once])

    inputs = ("table", "roles", "accounts")
    run("ingest", "2024-01-02T12:00:00", "logs", "table", "output")
    run("warm-up", "2024-01-02T11:00:00", *inputs, "baseline")
    run("tick", "2024-01-02T12:00:00", *inputs, "baseline", "output")

    def alerts(folder):
        lines = spark.read.text(str(tmp_path / "output" / folder)).collect()
        return [json.loads(json.loads(r.value)["event"]) for r in lines]

    (alert,) = alerts("alerts")
    assert alert["role_actions"] == [
        f"s3.amazonaws.com:{n}" for n in sorted(set(names) - {"GetObject"})
    ]
    assert (alert["severity"], alert["account_name"], alert["business"]) == (
        "Informational",
        "One",
        "retail",
    )
    run("replay", "2024-01-02T12:00:00", *inputs, "output")
    assert sorted(len(a["role_actions"]) for a in alerts("replay")) == [1, 4]

    # the same files as a stream that takes over from the warm-up
    (tmp_path / "baseline/published").joinpath("00000002-4-1704196800").unlink()
    needs = ("logs", "roles", "accounts", "baseline", "output", "checkpoint")
    run("stream-alerts", "2024-01-02T12:00:00", *needs, once=True)
    (alert,) = [
        json.loads(json.loads(r.value)["event"])
        for r in spark.read.text(str(tmp_path / "output/alerts/batch=0")).collect()
    ]
    assert len(alert["role_actions"]) == 4

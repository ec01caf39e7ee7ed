import json

from pyspark.sql import functions as F

from rolehabit.settings import Settings
from rolehabit.sources import inventory


def account(spark, *rows):
    return spark.createDataFrame(
        list(rows), "Id string, Name string, Email string, Status string, seq int"
    )


def test_last_active_record_of_an_account_wins(spark):
    export = account(
        spark,
        ("1", "Old", "o@x", "ACTIVE", 1),
        ("1", "New", "n@x", "ACTIVE", 2),
        ("1", "Gone", "g@x", "SUSPENDED", 3),
        ("2", "Off", "f@x", "SUSPENDED", 4),
    )
    rows = inventory.accounts_of(export, F.col("seq")).collect()
    assert [(r.account, r.account_name, r.account_owner) for r in rows] == [("1", "New", "n@x")]


def test_selection(spark):
    export = account(
        spark,
        ("1", "Retail-One", "a", "ACTIVE", 1),
        ("2", "RETAIL two", "b", "ACTIVE", 2),
        ("3", "Bank", "c", "ACTIVE", 3),
    )
    accounts = inventory.accounts_of(export, F.col("seq"))

    def ids(**options):
        return {r.account for r in inventory.selected_accounts(accounts, Settings(**options)).collect()}

    assert ids() == {"1", "2", "3"}
    assert ids(skipped_accounts=("2",)) == {"1", "3"}
    assert ids(business_token="retail") == {"1", "2"}
    assert ids(business_token="Retail") == set()  # the token itself is not folded


def test_later_lines_of_an_export_win(spark, tmp_path):
    lines = [
        {"Id": "1", "Name": f"v{n}", "Email": "e", "Status": "ACTIVE"} for n in range(50)
    ]
    (tmp_path / "accounts.json").write_text("\n".join(map(json.dumps, lines)))
    rows = inventory.read_accounts(spark, str(tmp_path)).collect()
    assert [r.account_name for r in rows] == ["v49"]


def test_roles_and_quarantine(spark, tmp_path):
    def role(n, statement):
        return {
            "account": "1",
            "Arn": f"arn:aws:iam::1:role/r{n}",
            "RoleName": f"r{n}",
            "RoleId": f"ID{n}",
            "CreateDate": "2024-01-01T00:00:05Z",
            "AssumeRolePolicyDocument": {"Statement": statement},
        }

    rows = [
        role(1, [{"Principal": {"Service": ["a", "b"]}}, {"Principal": {"AWS": "x"}}]),
        role(2, [{"Principal": "*"}]),
        role(3, [{"Action": "sts:AssumeRole"}]),
        role(4, []),
        role(5, {"Principal": {"AWS": "x"}}),
        role(6, [{"Principal": None}]),
    ]
    (tmp_path / "roles.json").write_text("\n".join(map(json.dumps, rows)))
    roles = inventory.read_roles(spark, str(tmp_path))
    good = {r.role_id: r for r in inventory.usable_roles(roles).collect()}
    assert {k: r.principal_json for k, r in good.items()} == {
        "ID1": '{"Service":["a","b"]}',
        "ID2": '"*"',
    }
    assert good["ID1"].create_epoch == 1704067205
    assert json.loads(good["ID2"].role_doc)["RoleName"] == "r2"
    bad = inventory.roles_without_principal(roles).collect()
    assert {r.origin[-2:] for r in bad} == {"r3", "r4", "r5", "r6"}


def test_only_the_first_message_counts(spark):
    message = json.dumps(
        {
            "account": "1",
            "current_date": ["2024", "01", "02"],
            "ct_bucket": "b",
            "business": "u",
            "owner": "o",
            "name": "n",
        }
    )
    other = message.replace('"1"', '"2"')
    items = spark.createDataFrame([([message, other],)], "messages array<string>")
    rows = inventory.parse_work_items(items).collect()
    assert [tuple(r) for r in rows] == [("1", "2024", "01", "02", "b", "u", "o", "n")]

from __future__ import annotations

from dataclasses import replace
from datetime import datetime

import pytest

from cardwarden import schemas
from cardwarden.__main__ import main
from cardwarden.operators import quality
from cardwarden.plans import medallion
from cardwarden.sources import existing, read_table
from frames import ids

HEADER = (
    "tx_id,cust_id,tx_datetime,tx_amount,tx_category,channel,location_city,ip_address,device_id"
)
DAY_ONE = [
    't1,1001,2026-03-30 10:00:00,"12,5",Seguro,App,N/A,1.2.3.4,d1',
    "t2,1001,2026-03-30 10:05:00,5.0,Lazer,Físico,Aveiro,N/A,d1",
    "t3,1002,2026-03-30 10:06:00,7.5,Lazer,Online,N/A,1.2.3.4,d1",
]
DAY_TWO = [
    "u1,1001,2026-03-31 10:00:00,1.0,Seguro,App,N/A,1.2.3.4,d1",
    "u2,1001,2026-03-31 11:00:00,2.0,Seguro,Físico,Braga,N/A,d1",
]
AS_OF = datetime(2026, 4, 1)


def deliver(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join([HEADER, *lines]) + "\n", encoding="utf-8")
    return str(folder)


def contents(spark, layout):
    out = {}
    for name in ("silver", "fraud_alerts", "bi_metrics", "category_kpis", "reward_eligible"):
        rows = read_table(spark, getattr(layout, name)).collect()
        out[name] = sorted(str(sorted(r.asDict().items())) for r in rows)
    return out


def test_run_twice_gives_the_same_tables(spark, tmp_path):
    source = deliver(tmp_path / "in", "transactions_20260330.csv", DAY_ONE)
    out = str(tmp_path / "lake")
    first = medallion.run(spark, source, out, preset="permissive", as_of=AS_OF)
    before = contents(spark, first.layout)
    again = medallion.run(spark, source, out, preset="permissive", as_of=AS_OF)
    assert first.alert_count == again.alert_count == 1
    assert contents(spark, again.layout) == before
    assert all(r["success"] for r in first.results["bronze"] + first.results["silver"])

    silver = read_table(spark, first.layout.silver)
    assert silver.columns[:8] == schemas.SILVER.fieldNames()
    assert ids(silver) == ["t1", "t2", "t3"]
    assert ids(read_table(spark, first.layout.fraud_alerts)) == ["t2"]
    assert ids(read_table(spark, first.layout.reward_eligible)) == ["t1", "t3"]
    kpis = read_table(spark, first.layout.category_kpis).collect()
    assert [tuple(r)[:3] for r in kpis] == [("Lazer", 12.5, 2), ("Seguro", 12.5, 1)]


def test_a_later_file_keeps_the_days_before(spark, tmp_path):
    out = str(tmp_path / "lake")
    source = deliver(tmp_path / "in", "transactions_20260330.csv", DAY_ONE)
    medallion.run(spark, source, out, preset="permissive", as_of=AS_OF)
    later = deliver(tmp_path / "in2", "transactions 20260331.csv", DAY_TWO)
    layout = medallion.run(spark, later, out, preset="permissive", as_of=AS_OF).layout
    assert len(ids(read_table(spark, layout.bronze), "tx_id")) == 5
    assert ids(read_table(spark, layout.silver)) == ["t1", "t2", "t3", "u1", "u2"]
    days = {str(r[0]) for r in read_table(spark, layout.fraud_alerts).select("dt_particao").collect()}
    assert days == {"2026-03-30", "2026-03-31"}


def test_failed_gate_stops_and_holds_rows(spark, tmp_path):
    lines = [*DAY_ONE, DAY_ONE[0], ",1001,2026-03-30 10:00:00,1,Lazer,App,N/A,1.2.3.4,d1"]
    source = deliver(tmp_path / "in", "transactions_20260330.csv", lines)
    out = str(tmp_path / "lake")
    with pytest.raises(quality.QualityGateError, match="bronze quality gate failed"):
        medallion.run(spark, source, out, as_of=AS_OF)
    layout = medallion.Layout(out)
    assert not (tmp_path / "lake" / "silver").exists()
    held = read_table(spark, layout.quarantine("bronze")).collect()
    assert sorted((r["tx_id"] or "", r["failed_rules"]) for r in held) == [
        ("", ["DQ-F01"]),
        ("t1", ["DQ-F02"]),
        ("t1", ["DQ-F02"]),
    ]
    failed = read_table(spark, layout.results("bronze")).filter("NOT success")
    assert ids(failed, "rule_id") == ["DQ-F01", "DQ-F02"]


def test_silver_gate_catches_bad_amounts(spark, tmp_path):
    bad = "t9,1001,2026-03-30 10:00:00,abc,Lazer,App,N/A,1.2.3.4,d1"
    source = deliver(tmp_path / "in", "transactions_20260330.csv", [*DAY_ONE, bad])
    with pytest.raises(quality.QualityGateError, match="silver quality gate failed: DQ-F04"):
        medallion.run(spark, source, str(tmp_path / "lake"), as_of=AS_OF)
    assert medallion.run(spark, source, str(tmp_path / "open"), silver_rules=(), as_of=AS_OF)


def test_malformed_lines_warn_only(spark, tmp_path):
    source = deliver(tmp_path / "in", "transactions_20260330.csv", [*DAY_ONE, DAY_TWO[0] + ",x"])
    summary = medallion.run(spark, source, str(tmp_path / "lake"), as_of=AS_OF)
    warned = [r["rule_id"] for r in summary.results["bronze"] if not r["success"]]
    assert warned == ["DQ-R01"]


def test_bad_text_warns_and_can_be_made_to_stop(spark, tmp_path):
    bad = "t9,1001,31/03/2026,1.0,Lazer,App,N/A,1.2.3.4,d1"
    source = deliver(tmp_path / "in", "transactions_20260330.csv", [*DAY_ONE, bad])
    summary = medallion.run(spark, source, str(tmp_path / "lake"), as_of=AS_OF)
    assert [r["rule_id"] for r in summary.results["bronze"] if not r["success"]] == ["DQ-R03"]

    strict = [replace(r, severity=quality.STOP) for r in medallion.BRONZE_GATE]
    with pytest.raises(quality.QualityGateError, match="DQ-R03 on tx_datetime: 1 of 4"):
        medallion.run(spark, source, str(tmp_path / "stop"), bronze_rules=strict, as_of=AS_OF)
    held = read_table(spark, medallion.Layout(str(tmp_path / "stop")).quarantine("bronze"))
    assert ids(held, "tx_id") == ["t9"]


def test_held_rows_and_the_others_make_up_the_input(spark, tmp_path, all_hot):
    bad = [
        DAY_ONE[0],
        ",1001,2026-03-30 10:00:00,1,Lazer,App,N/A,1.2.3.4,d1",
        "t9,1001,2026-03-30 10:00:00,abc,Lazer,App,N/A,1.2.3.4,d1",
    ]
    source = deliver(tmp_path / "in", "transactions_20260330.csv", DAY_ONE + bad)
    for name, policy in (("plain", {}), ("hot", {"policy": all_hot})):
        out = str(tmp_path / name)
        layout = medallion.run(spark, source, out, hold_bad_rows=True, as_of=AS_OF, **policy).layout
        assert ids(read_table(spark, layout.silver)) == ["t2", "t3"]
        held = read_table(spark, layout.quarantine("bronze")).collect()
        assert sorted((r["tx_id"] or "", r["failed_rules"]) for r in held) == [
            ("", ["DQ-F01"]),
            ("t1", ["DQ-F02"]),
            ("t1", ["DQ-F02"]),
        ]
        held = read_table(spark, layout.quarantine("silver")).collect()
        assert [(r["transaction_id"], r["failed_rules"]) for r in held] == [("t9", ["DQ-F04"])]


def test_large_keys_give_the_same_tables(spark, tmp_path, all_hot):
    source = deliver(tmp_path / "in", "transactions_20260330.csv", DAY_ONE + DAY_TWO)
    tables = []
    for name, policy in (("plain", {}), ("hot", {"policy": all_hot})):
        layout = medallion.run(
            spark, source, str(tmp_path / name), preset="permissive", as_of=AS_OF, **policy
        ).layout
        tables.append(contents(spark, layout))
    assert tables[0] == tables[1]


def test_device_rules_run_with_profiles(spark, tmp_path):
    source = deliver(tmp_path / "in", "transactions_20260330.csv", DAY_ONE + DAY_TWO)
    profiles = tmp_path / "profiles.json"
    profiles.write_text('[{"cust_id": 1001, "known_devices": ["d1"], "active_products": []}]')
    layout = medallion.run(
        spark, source, str(tmp_path / "lake"), profiles=str(profiles), as_of=AS_OF
    ).layout
    hits = {
        rule: [] if (found := existing(spark, layout.device_alerts(rule))) is None else ids(found)
        for rule in ("unknown_device", "shared_device", "shared_ip", "city_change")
    }
    assert hits == {
        "unknown_device": ["t3"],
        "shared_device": ["t1", "t2", "t3"],
        "shared_ip": ["t1", "t3"],
        "city_change": [],
    }


def test_steps_from_the_command_line(spark, tmp_path, capsys):
    source = deliver(tmp_path / "in", "transactions_20260330.csv", DAY_ONE)
    out = str(tmp_path / "lake")
    common = ["--out", out, "--as-of", "2026-04-01"]
    assert main(["bronze", "--transactions", source, *common]) == 0
    assert main(["silver", *common]) == 0
    assert main(["fraud", "--preset", "permissive", *common]) == 0
    assert main(["kpi", *common]) == 0
    assert "1 alerts" in capsys.readouterr().out
    steps = contents(spark, medallion.Layout(out))

    whole = str(tmp_path / "whole")
    arguments = ["--out", whole, "--as-of", "2026-04-01", "--preset", "permissive"]
    assert main(["run", "--transactions", source, *arguments]) == 0
    assert contents(spark, medallion.Layout(whole)) == steps


def test_a_failed_gate_exits_with_1(spark, tmp_path, capsys):
    source = deliver(tmp_path / "in", "transactions_20260330.csv", [*DAY_ONE, DAY_ONE[0]])
    assert main(["run", "--transactions", source, "--out", str(tmp_path / "lake")]) == 1
    assert "DQ-F02" in capsys.readouterr().err


def test_missing_arguments_are_refused():
    with pytest.raises(SystemExit):
        main(["run", "--out", "x"])
    with pytest.raises(SystemExit):
        main(["devices", "--out", "x"])


FAR = ",latitude,longitude"
LISBON, TOKYO = ",38.7,-9.1", ",35.7,139.7"


def place(folder, lines, name="transactions.csv"):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join([HEADER + FAR, *lines]) + "\n", encoding="utf-8")
    return str(folder)


def moves():
    """A move across midnight that only a look at the day before shows."""
    tail = "Seguro,App,N/A,1.2.3.4,d1"
    return (
        [f"m1,1001,2026-03-30 23:59:00,1.0,{tail}{LISBON}", f"m2,1002,2026-03-30 08:00:00,1.0,{tail}{LISBON}"],
        [f"m3,1001,2026-03-31 00:05:00,2.0,{tail}{TOKYO}", f"m4,1002,2026-03-31 23:00:00,1.0,{tail}{LISBON}"],
        [f"m5,1002,2026-04-01 23:00:00,4.0,{tail}{TOKYO}", f"m6,1002,2026-04-01 23:10:00,1.0,{tail}{LISBON}"],
    )


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 0, 1)])
def test_deliveries_in_any_order_equal_one(spark, tmp_path, order):
    days = moves()
    whole = place(tmp_path / "whole", [line for day in days for line in day])
    want = contents(spark, medallion.run(spark, whole, str(tmp_path / "one"), as_of=AS_OF).layout)
    for i in order:
        out = str(tmp_path / "many")
        layout = medallion.run(spark, place(tmp_path / f"d{i}", days[i]), out, as_of=AS_OF).layout
    found = contents(spark, layout)
    assert ids(read_table(spark, layout.fraud_alerts)) == ["m3", "m6"]
    del want["silver"], found["silver"]  # names of files differ
    assert found == want


def test_a_corrected_file_takes_its_alerts_back(spark, tmp_path):
    days, out = moves(), str(tmp_path / "lake")
    for i, day in enumerate(days):
        source = place(tmp_path / f"d{i}", day)
        medallion.run(spark, source, out, as_of=AS_OF)
    layout = medallion.Layout(out)
    corrected = [days[1][0].replace(TOKYO, LISBON), days[1][1]]
    medallion.run(spark, place(tmp_path / "d1", corrected), out, as_of=AS_OF)
    assert ids(read_table(spark, layout.fraud_alerts)) == ["m6"]
    assert ids(read_table(spark, layout.reward_eligible)) == ["m1", "m2", "m3", "m4", "m5"]
    medallion.run(spark, place(tmp_path / "d2", []), out, as_of=AS_OF)
    assert ids(read_table(spark, layout.silver)) == ["m1", "m2", "m3", "m4"]
    assert existing(spark, layout.fraud_alerts) is None
    assert existing(spark, layout.bi_metrics) is None


def test_an_id_delivered_twice_stays_once_and_held_rows_stay_held(spark, tmp_path):
    out = str(tmp_path / "lake")
    bad = ",1001,2026-03-30 10:00:00,1,Lazer,App,N/A,1.2.3.4,d1"
    first = deliver(tmp_path / "a", "x.csv", [*DAY_ONE, bad])
    medallion.run(spark, first, out, hold_bad_rows=True, as_of=datetime(2026, 4, 1))
    second = deliver(tmp_path / "b", "x.csv", [DAY_ONE[1].replace("5.0", "6.0"), bad + "x"])
    layout = medallion.run(spark, second, out, hold_bad_rows=True, as_of=datetime(2026, 4, 2)).layout
    rows = {r.transaction_id: r.amount for r in read_table(spark, layout.silver).collect()}
    assert rows == {"t1": 12.5, "t2": 6.0, "t3": 7.5}
    assert len(read_table(spark, layout.quarantine("bronze")).collect()) == 2
    assert read_table(spark, layout.results("bronze")).select("delivery").distinct().count() == 2
    assert main(["silver", "--out", out]) == 0
    assert ids(read_table(spark, layout.silver)) == ["t1", "t2", "t3"]
    deliver(tmp_path / "a", "x.csv", DAY_ONE)
    medallion.run(spark, first, out, as_of=datetime(2026, 4, 3))
    held = read_table(spark, layout.quarantine("bronze")).collect()
    assert [r.device_id for r in held] == ["d1x"]


def test_a_file_without_a_column_is_refused(spark, tmp_path):
    (tmp_path / "in.csv").write_text("tx_id,cust_id\na,1\n")
    with pytest.raises(ValueError, match="no column tx_datetime"):
        medallion.run(spark, str(tmp_path / "in.csv"), str(tmp_path / "lake"))

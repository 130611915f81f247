"""A lake over several deliveries: what is read, what is rewritten, what a failure leaves."""

from __future__ import annotations

from datetime import date

import pytest

from cardwarden import sources
from cardwarden.plans import medallion
from cardwarden.sources import existing, read_table
from frames import ids
from test_medallion import AS_OF, LISBON, TOKYO, contents, place

TAIL = "Seguro,App,N/A,1.2.3.4,d1"


def row(key, customer, day, hour, where):
    when = f"{day} {hour:02d}:00:00" if day else "no date"
    return f"{key},{customer},{when},1.5,{TAIL}{where}"


def partitions(path):
    """The files of every partition; a rewritten one has others."""
    return {p.name: {f.name for f in p.iterdir()} for p in path.iterdir() if "=" in p.name}


def test_a_late_day_rewrites_itself_and_the_days_of_successors(spark, tmp_path):
    days = [f"2026-03-{d:02d}" for d in range(1, 13)]
    base = [row(f"a{d}", 1, d, 8, LISBON) for d in days if d != "2026-03-05"]
    base += [row(f"b{d}", 2, d, 9, LISBON) for d in days[::4]]  # 1, 5 and 9 March
    base += [row("c1", 3, days[0], 10, LISBON), row("c2", 3, days[10], 10, LISBON)]
    late = [row("x1", 1, days[4], 7, TOKYO), row("x2", 3, days[4], 11, TOKYO), row("n1", 2, "", 0, TOKYO)]
    out = str(tmp_path / "lake")
    run = lambda folder, lines, out: medallion.run(
        spark, place(tmp_path / folder, lines), out, preset="permissive", as_of=AS_OF
    )
    layout = run("base", base, out).layout
    root = tmp_path / "lake"
    tables = {"silver/transactions_refined": "dt", "gold/fraud_alerts": "dt_particao", "gold/kpi_daily": "dt"}
    before = {t: partitions(root / t) for t in tables}
    run("late", late, out)
    nobody = "__HIVE_DEFAULT_PARTITION__"
    changed = {
        t: {p.split("=")[1] for p, files in partitions(root / t).items() if before[t].get(p) != files}
        for t in tables
    }
    # The next rows of the customers of 5 March: 1's on the 6th, 2's on the 9th, 3's on the 11th.
    assert changed["silver/transactions_refined"] == {days[4], nobody}
    assert changed["gold/kpi_daily"] == {days[4], nobody}
    assert changed["gold/fraud_alerts"] == {days[4], days[5], days[8], days[10]}
    one = run("one", base + late, str(tmp_path / "one")).layout
    want, found = contents(spark, one), contents(spark, layout)
    del want["silver"], found["silver"]
    assert found == want
    recent = read_table(spark, layout.customer_recent)
    assert recent.filter("customer_id = '1'").count() == medallion.RECENT_DAYS
    # A change before what the compact table keeps of a customer looks further back.
    older = [row("y1", 1, days[1], 20, TOKYO)]
    run("older", older, out)
    want = contents(spark, run("all", base + late + older, str(tmp_path / "all")).layout)
    found = contents(spark, layout)
    del want["silver"], found["silver"]
    assert found == want


def test_a_run_that_broke_off_is_made_good_by_the_next(spark, tmp_path):
    """A corrected file loses a customer; the run stops after Silver and comes again."""
    out, day = str(tmp_path / "lake"), "2026-03-0{}".format
    first = [row("a1", 1, day(1), 8, LISBON), row("b1", 2, day(1), 8, LISBON)]
    second = [row("a2", 1, day(2), 8, TOKYO), row("b2", 2, day(2), 8, LISBON)]
    third = [row("a3", 1, day(3), 8, TOKYO), row("b3", 2, day(3), 8, LISBON)]
    for name, lines in (("d1", first), ("d2", second), ("d3", third)):
        layout = medallion.run(spark, place(tmp_path / name, lines), out, preset="distance_5km", as_of=AS_OF).layout
    assert ids(read_table(spark, layout.fraud_alerts)) == ["a2"]
    source = place(tmp_path / "d2", second[1:])
    rows, _, delivery = medallion.land_and_gate(spark, source, layout, as_of=AS_OF)
    medallion.build_silver(spark, layout, rows, delivery, as_of=AS_OF)
    assert existing(spark, layout.changes) is not None
    medallion.run(spark, source, out, preset="distance_5km", as_of=AS_OF)
    # Customer 1 now moves on 3 March.
    assert ids(read_table(spark, layout.fraud_alerts)) == ["a3"]
    assert ids(read_table(spark, layout.silver)) == ["a1", "a3", "b1", "b2", "b3"]
    assert existing(spark, layout.changes) is None


def test_only_the_asked_partitions_are_read(spark, tmp_path):
    lake = str(tmp_path / "lake")
    for name in "abc":
        folder = place(tmp_path / name, [row(f"{name}{i}", i, "2026-03-01", i, LISBON) for i in range(3)])
        files = sources.land_transactions(spark, folder, lake)
    found = sources.read_partitions(spark, lake, "source_file", files)
    assert ids(found, "tx_id") == ["c0", "c1", "c2"]
    assert len(found.inputFiles()) == 1 < len(read_table(spark, lake).inputFiles())
    assert sources.read_partitions(spark, lake, "source_file", ["none"]) is None


def test_days_of_a_table_by_its_folders(spark, tmp_path):
    path = str(tmp_path / "daily")
    rows = spark.createDataFrame([(1, date(2026, 3, 1)), (2, None)], "n int, dt date")
    sources.replace_days(rows, path, "dt", set())
    assert sources.partition_days(spark, path, "dt") == {date(2026, 3, 1), None}
    assert sources.partition_days(spark, str(tmp_path / "none"), "dt") == set()
    assert sources.read_partitions(spark, path, "dt", {None}, "date").first()["n"] == 2


def test_files_with_different_headers_are_united_by_name(spark, tmp_path):
    folder = tmp_path / "in [1]"
    folder.mkdir()
    (folder / "a.csv").write_text("tx_id,cust_id\na,1\n")
    (folder / "b {x}.csv").write_text("cust_id,latitude,tx_id\n2,1.5,b\n")
    (folder / "c.csv").write_text("tx_id,cust_id\nc,3\n")
    (folder / "empty.csv").write_text("")
    plain = str(tmp_path / "in ?1?")
    rows, uris = sources.read_transactions_by_header(spark, plain)
    found = {r.tx_id: (r.cust_id, r.latitude, r.source_path[-5:]) for r in rows.collect()}
    assert found["a"] == ("1", None, "a.csv") and found["c"] == ("3", None, "c.csv")
    assert found["b"][:2] == ("2", "1.5")
    assert len(uris) == 4
    with pytest.raises(ValueError, match="no column latitude"):
        sources.read_transactions_by_header(spark, plain, ["latitude"])


def test_a_gate_failure_leaves_no_row_behind(spark, tmp_path):
    """b1 is in no delivered file any more, though Bronze was replaced in between."""
    out = str(tmp_path / "lake")
    b1, b2 = row("b1", 1, "2026-03-01", 8, LISBON), row("b2", 1, "2026-03-02", 8, LISBON)
    medallion.run(spark, place(tmp_path / "in", [b1, b2]), out, as_of=AS_OF)
    with pytest.raises(medallion.quality.QualityGateError):
        medallion.run(spark, place(tmp_path / "in", [b1, b2, b2]), out, as_of=AS_OF)
    layout = medallion.run(spark, place(tmp_path / "in", [b2]), out, as_of=AS_OF).layout
    assert ids(read_table(spark, layout.silver)) == ["b2"]

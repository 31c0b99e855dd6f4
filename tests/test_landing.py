from __future__ import annotations

import datetime as dt
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException

from conftest import row
from dayledger.operators.cleaning import clean
from dayledger.schema import DAY
from dayledger.sources.landing import day_glob
from dayledger.sources.rejected import rejected_cells
from dayledger.sources import calendar, list_days, next_days, read_raw, source_exists

DAY0 = dt.date(2019, 8, 23)

# The edge rows of one daily file: text, and whether the row passes cleaning.
EDGES = [
    ("1,2019-08-23 10:00:00,5,6,10.5,1,0,0,0", True),
    ("2,2019-08-23 24:00:00,5,6,10.5,1,0,0,0", False),
    ("3,2019-08-23 10:61:00,5,6,10.5,1,0,1,2", False),
    ("4,2019-08-23,5,6,NaN,1,0,1,2", True),
    ("5,bad,5,6,1.0,1,0,1,2", False),
    ("6,2019-08-23 10:00:00,abc,6,1.0,1,0,1,2", False),
    ("7,2019-08-23 10:00:00,5,0,1.0,1,0,1,2", False),
    ("8,2019-08-23 10:00:00,5,3,0.0,1,0,1,2", False),
    ("9,2019-08-23 10:00:00,5,3,1.0,1,0", True),
    ("10,2019-08-23 10:00:00,5,3,1.0,1,0,,2,extra", True),
    ("11,2019-08-23 10:00:00,5,3,Inf,1,0,1.0,2", True),
]


def found(listing):
    return [str(r[DAY]) for r in listing.orderBy(DAY).collect()]


def test_edge_rows_parse_and_clean(spark, landing):
    landing("2019-08-23", [text for text, _ in EDGES])
    rows = read_raw(spark, landing.root)
    parsed = {r["tranaction_id"]: r for r in rows.collect()}
    assert len(parsed) == len(EDGES)
    assert parsed[2]["tx_datetime"] is None and parsed[3]["tx_datetime"] is None
    assert parsed[4]["tx_datetime"] == dt.datetime(2019, 8, 23)
    assert parsed[6]["customer_id"] is None
    assert parsed[9]["tx_fraud"] is None and parsed[9]["tx_fraud_scenario"] is None
    assert parsed[10]["tx_fraud"] is None and parsed[10]["tx_fraud_scenario"] == 2
    assert parsed[11]["tx_fraud"] is None and parsed[11]["tx_amount"] == float("inf")
    kept = {r["tranaction_id"] for r in clean(rows).collect()}
    assert kept == {i for i, (_, keep) in enumerate(EDGES, 1) if keep}
    assert 4 not in {r["tranaction_id"] for r in clean(rows, drop_nan=True).collect()}


def test_header_names_do_not_matter(spark, landing):
    landing("2019-08-23", [row(1, "2019-08-23")], header="tx_amount,customer_id,x,y,z,q,w,e,r")
    only = read_raw(spark, landing.root).first()
    assert (only["tranaction_id"], only["tx_amount"]) == (1, 10.5)


def test_day_and_key_come_from_the_path(spark, landing):
    landing("2019-08-23", [row(1, "2019-08-25")])
    only = read_raw(spark, landing.root).first()
    assert (only[DAY], only["_source_key"]) == (DAY0, "2019-08-23.txt")


def test_empty_and_header_only_files_exist(spark, landing):
    landing("2019-08-23", None)
    landing("2019-08-24", [])
    listing = list_days(spark, landing.root)
    assert found(listing) == ["2019-08-23", "2019-08-24"]
    assert read_raw(spark, landing.root).count() == 0


def test_listing_ignores_other_files(spark, landing, tmp_path):
    landing("2019-08-23", [])
    (tmp_path / "landing" / "readme.txt").write_text("x")
    (tmp_path / "landing" / "2019-13-99.txt").write_text("x")
    assert found(list_days(spark, landing.root)) == ["2019-08-23"]


def test_missing_root_is_an_empty_listing(spark, tmp_path):
    assert list_days(spark, str(tmp_path / "none")).count() == 0
    assert list_days(spark, str(tmp_path), [DAY0]).count() == 0


def test_other_failures_are_raised(spark):
    with pytest.raises(Exception) as failure:
        list_days(spark, "nosuchscheme://bucket/landing").count()
    assert not isinstance(failure.value, AnalysisException) or "PATH_NOT_FOUND" not in str(failure.value)


def test_watermark_is_exclusive_and_gaps_are_jumped(spark, landing):
    for day in ("2019-08-22", "2019-08-25", "2019-08-26", "2019-08-30"):
        landing(day, [])
    listing = list_days(spark, landing.root)
    after = dt.date(2019, 8, 22)
    assert found(next_days(listing, after, take_n=2)) == ["2019-08-25", "2019-08-26"]


def test_scan_cap_counts_calendar_days(spark, landing):
    landing("2019-08-30", [])
    listing = list_days(spark, landing.root)
    after = dt.date(2019, 8, 22)
    assert found(next_days(listing, after, 3, max_scan_days=7)) == []
    assert found(next_days(listing, after, 3, max_scan_days=8)) == ["2019-08-30"]


def test_listing_of_chosen_days_only(spark, landing):
    for day in ("2019-08-22", "2019-08-23", "2019-08-24"):
        landing(day, [])
    assert found(list_days(spark, landing.root, [DAY0])) == ["2019-08-23"]


def test_source_exists_flags_each_day(spark, landing):
    landing("2019-08-24", None)
    days = calendar(spark, dt.date(2019, 8, 22), 3)
    rows = source_exists(days, list_days(spark, landing.root)).orderBy(DAY).collect()
    assert [r["file_exists"] for r in rows] == [False, True, False]


@pytest.mark.parametrize("name", ["2019-08-23.txt", "2019-08-23", "src_date=2019-08-23"])
def test_a_day_may_be_a_folder_of_parts(spark, tmp_path, name):
    folder = tmp_path / "landing" / name
    folder.mkdir(parents=True)
    for part in range(2):
        (folder / f"part-{part}.csv").write_text("h\n" + row(part, "2019-08-23") + "\n")
    root = str(tmp_path / "landing")
    listing = list_days(spark, root, [DAY0]).collect()
    assert [r["source_key"] for r in listing] == ["2019-08-23.txt"]
    rows = read_raw(spark, day_glob(root, [DAY0]), base=root).collect()
    assert {(r[DAY], r["_source_key"]) for r in rows} == {(DAY0, "2019-08-23.txt")}
    assert len(rows) == 2


def test_gap_queries_list_their_landing_area_in_full(spark, sf_dir, monkeypatch):
    from dayledger import queries

    listed = []
    monkeypatch.setattr(queries, "list_days", lambda *a: listed.append(list_days(*a)) or listed[-1])
    used = sorted(r[DAY] for r in queries.weekday_listing(spark, sf_dir).collect())
    assert used == sorted(r[DAY] for r in listed[0].collect())
    assert used and all(day.weekday() < 5 for day in used)


def test_rejected_cells_are_those_the_scan_reads_as_null(spark, landing):
    rows = [
        "1,2019-08-23 10:00:00,5,6,10.5,1,0,0,0", "2,2019-08-23 24:00:00,5,6,10.5,1,0,0,0", "4,2019-08-23,5,6,NaN,1,0,1,2",
        "5,bad,5,6,1.0,1,0,1,2", "6,2019-08-23 10:00:00,abc,6,1.0,1,0,1,2", "9,2019-08-23 10:00:00,5,3,1.0,1,0",
        "10,2019-08-23 10:00:00,5,3,1.0,1,0,,2,extra,more", "11,2019-08-23 10:00:00,5,3,Inf,1,0,1.0,2", 'x12,"1,5",,"a \\"q\\"",,,,,',
    ]
    landing("2019-08-23", rows)
    landing("2019-08-24", None)
    folder = Path(landing.root) / "src_date=2019-08-25"
    folder.mkdir()
    (folder / "p.csv").write_text("h\n13,oops,1,1,1,1,1,1,1\n")
    found = {(str(r["src_date"]), r["row"], r["column"], r["text"]) for r in rejected_cells(spark, landing.root).collect()}
    day = "2019-08-23"
    assert found == {
        (day, "2", "tx_datetime", "2019-08-23 24:00:00"), (day, "5", "tx_datetime", "bad"), (day, "6", "customer_id", "abc"),
        (day, "10", "_extra", "extra"), (day, "11", "tx_fraud", "1.0"), (day, "x12", "tranaction_id", "x12"),
        (day, "x12", "tx_datetime", "1,5"), (day, "x12", "terminal_id", 'a "q"'), ("2019-08-25", "13", "tx_datetime", "oops"),
    }
    landing("2019-08-23", rows[:1])
    (folder / "p.csv").unlink()
    assert rejected_cells(spark, landing.root).count() == 0

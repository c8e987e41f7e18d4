import pytest

from shelfprice.operators import load
from shelfprice.schema import RAW_COLUMNS
from shelfprice.sources import csv
from shelfprice.streaming import incremental
from tests.conftest import values

HEADER = ",".join(RAW_COLUMNS) + "\n"


def drop(folder, name, *rows, header=HEADER):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(header + "".join(r + "\n" for r in rows), encoding="utf-8")


def row(name, url, price="1.50", platform="P"):
    return f"{platform},{name},,{price},,,,,{url},2024-01-05T10:00:00,c"


def run(spark, tmp_path, quarantine=True, files_per_load=incremental.FILES_PER_LOAD):
    incremental.load_drops(
        spark,
        str(tmp_path / "landing"),
        str(tmp_path / "table"),
        str(tmp_path / "checkpoint"),
        str(tmp_path / "quarantine") if quarantine else None,
        files_per_load,
    ).awaitTermination()
    return incremental.read_loaded(spark, str(tmp_path / "table"))


def names(df):
    return sorted(r["product_name"] for r in df.collect())


def test_stream_equals_one_batch_load(spark, tmp_path):
    landing = tmp_path / "landing"
    assert incremental.read_loaded(spark, str(tmp_path / "table")).count() == 0
    drop(landing, "a.csv", row("a1", "u1"), row("a2", "u1"), row("a3", ""), row("bad", "u9", platform=""))
    assert names(run(spark, tmp_path)) == ["a1", "a3"]
    drop(landing, "b.csv", row("b1", "u1"), row("b2", "u2"), row("b3", ""))
    url_first = ",".join(["product_url", *[c for c in RAW_COLUMNS if c != "product_url"]]) + "\n"
    rest = ",1,,,,,2024-01-05T10:00:00,c"
    drop(landing, "c.csv", f"u2,P,c1,{rest}", f"u3,P,c2,{rest}", header=url_first)
    loaded = run(spark, tmp_path)
    assert names(loaded) == ["a1", "a3", "b2", "b3", "c2"]
    assert names(run(spark, tmp_path)) == names(loaded)
    batch = load.first_wins(load.apply_contract(load.coerce_types(csv.read_raw_csv(spark, str(landing)))))
    assert names(batch) == names(loaded)
    quarantine = spark.read.parquet(str(tmp_path / "quarantine"))
    assert values(quarantine.select("product_name", "violations")) == [("bad", ["platform missing"])]
    assert loaded.select("load_id").distinct().count() == 2


def test_retried_batch_replaces_its_own_rows(spark, tmp_path):
    landing, table = tmp_path / "landing", str(tmp_path / "table")
    drop(landing, "a.csv", row("a1", "u1"), row("a2", "u2"))
    paths = [f"file://{landing}/a.csv"]
    incremental._load_files(spark, paths, table, None, "q-000000")
    incremental._load_files(spark, paths, table, None, "q-000000")
    assert names(incremental.read_loaded(spark, table)) == ["a1", "a2"]
    incremental._load_files(spark, paths, table, None, "q-000001")
    assert names(incremental.read_loaded(spark, table)) == ["a1", "a2"]


def test_without_quarantine_a_bad_row_fails_the_load(spark, tmp_path):
    drop(tmp_path / "landing", "a.csv", row("ok", "u1"), row("bad", "u2", price="999999999"))
    try:
        run(spark, tmp_path, quarantine=False)
        failed = False
    except Exception as error:
        failed = "current_price not decimal(10,2)" in str(error)
    assert failed
    assert incremental.read_loaded(spark, str(tmp_path / "table")).count() == 0


@pytest.mark.parametrize("files_per_load", [1, 2, 10_000])
def test_cuts_of_a_backlog_change_nothing(spark, tmp_path, files_per_load):
    landing = tmp_path / "landing"
    # Written in the order opposite to that of their names.
    for name, price in (("c", "3"), ("b", "2"), ("a", "1")):
        drop(landing, f"{name}.csv", row(f"{name}1", "u1", price), row(f"{name}2", f"u{name}", price))
    loaded = run(spark, tmp_path, files_per_load=files_per_load)
    assert names(loaded) == ["a1", "a2", "b2", "c2"]
    assert [r["product_name"] for r in loaded.orderBy("order_key").collect()] == ["a1", "a2", "b2", "c2"]
    summary = incremental.read_summary(spark, str(tmp_path / "table")).groupBy("platform").sum("offered", "inserted", "skipped")
    assert [tuple(r) for r in summary.collect()] == [("P", 6, 4, 2)]


def test_later_loads_come_later_in_the_order(spark, tmp_path):
    landing = tmp_path / "landing"
    drop(landing, "z.csv", row("first", "u1"))
    run(spark, tmp_path)
    drop(landing, "a.csv", row("second", "u2"))
    loaded = run(spark, tmp_path)
    assert [r["product_name"] for r in loaded.orderBy("order_key").collect()] == ["first", "second"]


def test_a_retried_batch_removes_loads_of_another_cut(spark, tmp_path):
    for name in "abc":
        drop(tmp_path / "landing", f"{name}.csv", row(name, f"u{name}"))
    run(spark, tmp_path, files_per_load=1)
    commit = tmp_path / "checkpoint" / "commits"
    for file in [*commit.glob("0"), *commit.glob(".0.crc")]:
        file.unlink()
    assert names(run(spark, tmp_path)) == ["a", "b", "c"]


def test_loads_of_a_backlog_are_worked_out_together(spark, tmp_path, monkeypatch):
    """Jobs do not follow the number of loads, and each load has the rows, summary and quarantine that it has by itself."""
    passes = []
    read = incremental.read_raw_csv
    monkeypatch.setattr(incremental, "read_raw_csv", lambda spark_, paths: (passes.append(len(paths)), read(spark_, paths))[1])
    for at, name in enumerate("abcd", 2):
        drop(tmp_path / "landing", f"{name}.csv", row(f"{name}1", "u1"), row(f"{name}2", f"u{at}"), row("bad", "u9", platform=""))
    drop(tmp_path / "landing", "e.csv", row("bad", "u9", platform=""))
    loaded = run(spark, tmp_path, files_per_load=1)
    assert passes == [5]
    assert [tuple(r) for r in loaded.selectExpr("order_key.load", "product_name").orderBy("order_key").collect()] == [
        (0, "a1"), (0, "a2"), (1, "b2"), (2, "c2"), (3, "d2")
    ]
    assert loaded.selectExpr("load_id", "order_key.load").distinct().count() == 4
    summary = incremental.read_summary(spark, str(tmp_path / "table")).orderBy("load_id")
    assert [tuple(r)[:4] for r in summary.collect()] == [("P", 2, 2, 0), ("P", 2, 1, 1), ("P", 2, 1, 1), ("P", 2, 1, 1)]
    quarantine = spark.read.parquet(str(tmp_path / "quarantine"))
    assert quarantine.select("load_id").distinct().count() == 5 and quarantine.schema["order_key"].dataType.names == ["path", "row"]
    # A later drop meets the URLs of all of them.
    drop(tmp_path / "landing", "f.csv", row("f1", "u3"), row("f2", "u6"))
    assert names(run(spark, tmp_path, files_per_load=1)) == ["a1", "a2", "b2", "c2", "d2", "f2"]


def test_without_quarantine_the_loads_before_a_bad_row_stay(spark, tmp_path):
    drop(tmp_path / "landing", "a.csv", row("ok", "u1"))
    drop(tmp_path / "landing", "b.csv", row("bad", "u2", price="999999999"))
    with pytest.raises(Exception, match="current_price not decimal"):
        run(spark, tmp_path, quarantine=False, files_per_load=1)
    assert names(incremental.read_loaded(spark, str(tmp_path / "table"))) == ["ok"]


def test_a_load_checks_its_rows_in_one_pass(spark, tmp_path, monkeypatch):
    looked, checks = [], load.contract_checks
    monkeypatch.setattr(load, "contract_checks", lambda df: (looked.append(load.NOT_FINITE in df.columns), checks(df))[1])
    drop(tmp_path / "landing", "a.csv", row("a1", "u1"), row("bad", "u9", platform=""), row("nan", "u2", price="NaN"), row("a2", "u1"))
    assert names(run(spark, tmp_path)) == ["a1"]
    bad = spark.read.parquet(str(tmp_path / "quarantine"))
    assert sorted((r["product_name"], *r["violations"]) for r in bad.collect()) == [("bad", "platform missing"), ("nan", "current_price not finite")]
    # Whether a row is fit, and why not: both while the rows are staged, none of it when these are read.
    assert looked == [True, True]

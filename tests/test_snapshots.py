"""Committed states of loaded tables, and the index of stored URLs."""

import pytest
from pyspark.sql import functions as F

from shelfprice.operators.load import insert_if_absent
from shelfprice.plans import sketches
from shelfprice.sources import snapshots, urls
from shelfprice.streaming import incremental
from tests.test_explain import plan_of
from tests.test_streaming import drop, names, row, run


def loaded(spark, folder, *batches):
    """A table of URLs only, one load per batch."""
    table = str(folder)
    for number, batch in enumerate(batches):
        snapshot = snapshots.read_snapshot(spark, table)
        load_id = f"l{number}"
        index, notes = urls.add_urls(spark, snapshot, load_id, batch)
        snapshots.commit(spark, snapshot, {"load_id": load_id, "number": number, "parts": ["urls"], **index}, notes)
    return snapshots.read_snapshot(spark, table)


def made(spark, start, end):
    return spark.range(start, end).selectExpr("concat('https://shop.example.com/item-', id, '.html') AS product_url")


def test_a_batch_of_many_new_urls_reads_few_buckets(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(urls, "URLS_PER_BUCKET", 200)
    snapshot = loaded(spark, tmp_path / "t", made(spark, 0, 60_000), made(spark, 60_000, 110_000))
    assert [load["buckets"] for load in snapshot.loads] == [512, 256]
    batch = made(spark, 1_000_000, 1_110_000).unionByName(made(spark, 7, 9))
    known = urls.stored_urls(spark, snapshot, batch)
    plan = plan_of(known, run=True)
    assert sorted(r.product_url for r in known.collect()) == sorted(r.product_url for r in made(spark, 7, 9).collect())
    assert "Exchange hashpartitioning" not in plan and "BroadcastHashJoin" in plan
    # Only the buckets that a possible URL falls into are opened, of 768 that there are.
    read = [f for f in known.inputFiles() if "bucket=" in f]
    assert 2 <= len(read) < 200


def test_possible_urls_are_all_stored_and_few_others(spark, tmp_path):
    snapshot = loaded(spark, tmp_path / "t", made(spark, 0, 30_000))
    notes = snapshot.notes["filters"]
    bits = snapshot.read(spark, notes["part"], urls._BITS, [snapshots.load_folder(snapshot.table, notes["part"], x) for x in notes["loads"]])
    assert urls.possibly_in(made(spark, 0, 30_000), bits, notes["pieces"]).count() == 30_000
    assert urls.possibly_in(made(spark, 100_000, 300_000), bits, notes["pieces"]).count() < 400


def test_filters_grow_with_the_table(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(urls, "URLS_PER_PIECE", 20)
    monkeypatch.setattr(urls, "LEAST_PIECES", 2)
    monkeypatch.setattr(urls, "URLS_PER_BUCKET", 30)
    monkeypatch.setattr(urls, "READ_WHOLE", 0)
    seen = []
    for end in (15, 30, 200, 210, 3000):
        start = seen[-1][0] if seen else 0
        snapshot = loaded_more(spark, tmp_path / "t", made(spark, start, end))
        filters = snapshot.notes["filters"]
        seen.append((end, filters["pieces"], len(filters["loads"])))
        batch = made(spark, end - 10, end + 500)
        assert {r.product_url for r in urls.stored_urls(spark, snapshot, batch).collect()} == {r.product_url for r in made(spark, end - 10, end).collect()}
        # Larger than what may be broadcast.
        assert urls.stored_urls(spark, snapshot, batch, max_broadcast_rows=0).count() == 10
    assert [s[1:] for s in seen] == [(2, 1), (2, 2), (32, 1), (32, 2), (512, 1)]


def loaded_more(spark, folder, batch):
    snapshot = snapshots.read_snapshot(spark, str(folder))
    load_id = f"l{snapshot.version}"
    index, notes = urls.add_urls(spark, snapshot, load_id, batch)
    return snapshots.commit(spark, snapshot, {"load_id": load_id, "number": snapshot.version, "parts": ["urls"], **index}, notes)


@pytest.mark.parametrize("whole", [0, 100_000])
def test_inserts_agree_with_the_whole_table(spark, tmp_path, listings, monkeypatch, whole):
    """What is inserted does not depend on whether stored URLs are looked up or read whole."""
    monkeypatch.setattr(urls, "READ_WHOLE", whole)
    stored = listings(*[{"platform": "P", "product_name": f"s{i}", "product_url": f"u{i}"} for i in range(50)])
    batch = listings(*[{"platform": "P", "product_name": f"b{i}", "product_url": None if i % 7 == 0 else f"u{i % 80}", "order_key": 100 + i} for i in range(200)])
    snapshot = loaded(spark, tmp_path / "t", stored.select("product_url"))
    expected = insert_if_absent(batch, stored).select("product_name")
    assert names(insert_if_absent(batch, urls.stored_urls(spark, snapshot, batch))) == names(expected)
    empty = snapshots.read_snapshot(spark, str(tmp_path / "none"))
    assert urls.stored_urls(spark, empty, batch).count() == 0
    assert urls.stored_urls(spark, snapshot, batch.where("product_url IS NULL")).count() == (50 if whole else 0)


def test_a_reader_in_the_middle_of_a_load_sees_the_state_before(spark, tmp_path, monkeypatch):
    landing, table = tmp_path / "landing", str(tmp_path / "table")
    drop(landing, "a.csv", row("a1", "u1"))
    run(spark, tmp_path)
    before = incremental.read_loaded(spark, table)
    seen = []

    def late(spark_, snapshot, load, notes):
        seen.append((names(incremental.read_loaded(spark, table)), incremental.read_summary(spark, table).count()))
        return snapshots.commit(spark_, snapshot, load, notes)

    monkeypatch.setattr(incremental, "commit", late)
    drop(landing, "b.csv", row("b1", "u1"), row("b2", "u2"))
    after = run(spark, tmp_path)
    # All of the load's folders were there when it was seen.
    assert seen == [(["a1"], 1)]
    assert names(before) == ["a1"] and names(after) == ["a1", "b2"]
    assert names(incremental.read_loaded(spark, table, 1)) == ["a1"] and names(incremental.read_loaded(spark, table, 2)) == names(after)


def test_of_two_writers_one_is_refused(spark, tmp_path, monkeypatch):
    landing, table = tmp_path / "landing", str(tmp_path / "table")
    drop(landing, "a.csv", row("a1", "u1"))
    drop(tmp_path / "other", "x.csv", row("x1", "u1"), row("x2", "u2"))
    files = [f"file://{tmp_path}/other/x.csv"]

    def overtaken(spark_, snapshot, load, notes):
        monkeypatch.setattr(incremental, "commit", snapshots.commit)
        incremental._load_files(spark, files, table, None, "other-000000")
        return snapshots.commit(spark_, snapshot, load, notes)

    monkeypatch.setattr(incremental, "commit", overtaken)
    with pytest.raises(snapshots.StaleSnapshot):
        incremental._load_files(spark, [f"file://{landing}/a.csv"], table, None, "one-000000")
    assert names(incremental.read_loaded(spark, table)) == ["x1", "x2"]
    # Repeated, it sees what the other has stored.
    drop(landing, "a.csv", row("a1", "u1"), row("a3", "u3"))
    incremental._load_files(spark, [f"file://{landing}/a.csv"], table, None, "one-000000")
    assert names(incremental.read_loaded(spark, table)) == ["a3", "x1", "x2"]
    assert [load["number"] for load in snapshots.read_snapshot(spark, table).loads] == [0, 1]


def test_a_batch_goes_on_behind_its_committed_loads(spark, tmp_path, monkeypatch):
    for name in "abc":
        drop(tmp_path / "landing", f"{name}.csv", row(name, f"u{name}"), row(f"{name}-again", "ua"))
    done = []

    def failing(spark_, snapshot, load, notes):
        if len(done) == 2:
            raise RuntimeError("lost")
        done.append(load["load_id"])
        return snapshots.commit(spark_, snapshot, load, notes)

    monkeypatch.setattr(incremental, "commit", failing)
    with pytest.raises(Exception, match="lost"):
        run(spark, tmp_path, files_per_load=1)
    assert names(incremental.read_loaded(spark, str(tmp_path / "table"))) == ["a", "b"]
    monkeypatch.setattr(incremental, "commit", snapshots.commit)
    assert names(run(spark, tmp_path)) == ["a", "b", "c"]
    assert len(snapshots.read_snapshot(spark, str(tmp_path / "table")).loads) == 3


def test_a_file_is_named_once(spark, tmp_path):
    path = f"{tmp_path}/x/000001.json"
    (tmp_path / "x").mkdir()
    assert snapshots.put_json(spark, path, {"a": 1}, replace=False)
    assert not snapshots.put_json(spark, path, {"a": 2}, replace=False)
    assert snapshots.read_json(spark, path) == {"a": 1}
    assert snapshots.put_json(spark, path, {"a": 3}, replace=True) and snapshots.read_json(spark, path) == {"a": 3}
    assert [p.name for p in (tmp_path / "x").iterdir() if not p.name.startswith(".")] == ["000001.json"]
    assert spark.range(1).select(F.lit(1)).count() == 1


def test_quantiles_from_the_sketches_of_the_loads(spark, tmp_path):
    """Merged over loads, each within the stated error of its rank, and without reading a listing."""
    probs = {"q1": 0.25, "median": 0.5, "p99": 0.99}
    for load in range(3):
        rows = [row(f"n{i}", f"u{load}-{i}", f"{(i * 7919 + load) % 5000 + 1}.00", "PQ"[i % 2]) for i in range(2000)]
        drop(tmp_path / "landing", f"{load}.csv", *rows, row("free", f"free{load}", ""))
    loaded = run(spark, tmp_path, files_per_load=1)
    got = incremental.approx_price_quantiles(spark, str(tmp_path / "table"), probs)
    assert all("sketches" in f for f in got.inputFiles())
    prices = {p: sorted(float(r["current_price"]) for r in loaded.where(F.col("platform") == p).collect() if r["current_price"] is not None) for p in "PQ"}
    answers = {r["platform"]: r for r in got.collect()}
    assert set(answers) == {"P", "Q"}
    for p, values_ in prices.items():
        for name, prob in probs.items():
            rank = sum(v <= answers[p][name] for v in values_) / len(values_)
            assert abs(rank - prob) <= sketches.RANK_ERROR + 1 / len(values_)
    assert incremental.approx_price_quantiles(spark, str(tmp_path / "none"), probs).count() == 0

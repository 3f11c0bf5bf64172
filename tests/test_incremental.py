"""Digests, tables rebuilt where they differ, and snapshots kept up to date."""

from datetime import datetime
from pathlib import Path

import pandas as pd
import pytest
from pyspark.sql import functions as F
from test_snapshots import HOME, SCHEMA, random_lines

from tidemark.config import SnapshotSettings
from tidemark.operators import snapshots as S
from tidemark.plans.incremental import SnapshotStore, pieces_of, touched
from tidemark.sources import digests as D

SETTINGS = SnapshotSettings(("2011-04-01", "2011-05-01", "2011-06-01", "2011-08-01"), 30, 10, HOME)


@pytest.fixture(scope="module")
def frame():
    return random_lines(11, 20, 260, 0.3)


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def files(store):
    """Data files per cutoff partition, with the time they were written."""
    found = {}
    for path in Path(store.path, "snapshots").glob("cutoff=*/*.parquet"):
        found.setdefault(path.parent.name[7:17], set()).add((path.name, path.stat().st_mtime_ns))
    return found


def same(store, df):
    def rows(snapshots):
        return (snapshots.toPandas()[["customer_id", "cutoff", *S.FEATURES, "label"]]
                .sort_values(["cutoff", "customer_id"]).reset_index(drop=True))
    pd.testing.assert_frame_equal(rows(store.snapshots()),
                                  rows(S.build_snapshots(df, store.settings)))


def day(text):
    return pd.Timestamp(text)


def test_pieces_and_what_they_touch():
    settings = SnapshotSettings(("2011-02-01", "2011-03-01"), 30)
    pieces = pieces_of(settings)
    assert [(p.start and p.start.day, p.end.day) for p in pieces] == [
        (None, 1), (1, 1), (1, 3), (3, 31)]
    assert [len(touched(p.start, settings)) for p in pieces] == [2, 2, 2, 1]
    assert len({p.name for p in pieces}) == 4


def test_appended_lines_rebuild_what_they_touch(spark, frame, tmp_path):
    store = SnapshotStore(spark, str(tmp_path / "s"), SETTINGS)
    first = frame[frame.invoice_date < day("2011-05-20")]
    second = frame[(frame.invoice_date >= day("2011-05-20"))
                   & (frame.invoice_date < day("2011-07-01"))]
    third = frame[frame.invoice_date >= day("2011-07-01")]
    assert len(store.refresh(table(spark, first))) == 4
    same(store, table(spark, first))
    before = files(store)
    rebuilt = store.append(table(spark, second))
    # From May 20 on: outcomes of May, features from June on.
    assert [m.month for m in rebuilt] == [5, 6, 8]
    same(store, table(spark, pd.concat([first, second])))
    middle = files(store)
    assert middle["2011-04-01"] == before["2011-04-01"]
    assert all(not middle[c] & before[c] for c in ("2011-05-01", "2011-06-01", "2011-08-01"))
    # The outcome window of June has ended on July 1.
    assert [m.month for m in store.append(table(spark, third))] == [8]
    assert {c: f for c, f in files(store).items() if c < "2011-08"} \
        == {c: f for c, f in middle.items() if c < "2011-08"}
    same(store, table(spark, frame))
    assert store.append(table(spark, frame[:0])) == []
    assert store.refresh(table(spark, frame)) == []      # batches add up to the whole


def test_lines_split_over_batches_merge(spark, frame, tmp_path):
    """Orders, products and days that come in parts, and pieces in many batches."""
    store = SnapshotStore(spark, str(tmp_path / "s"), SETTINGS)
    shuffled = frame.sample(frac=1, random_state=5)
    store.refresh(table(spark, shuffled[:200]))
    from tidemark.plans import incremental
    incremental.MOST_BATCHES, most = 2, incremental.MOST_BATCHES
    try:
        for start in range(200, len(shuffled), 150):
            store.append(table(spark, shuffled[start:start + 150]))
    finally:
        incremental.MOST_BATCHES = most
    assert all(len(found) <= 2 for found in store._note()[1]["batches"].values())
    same(store, table(spark, frame))


def test_changed_and_removed_lines(spark, frame, tmp_path):
    store = SnapshotStore(spark, str(tmp_path / "s"), SETTINGS)
    store.refresh(table(spark, frame))
    before = files(store)
    changed = frame.copy()
    late = changed.index[changed.invoice_date.between("2011-06-05", "2011-06-20")][0]
    changed.loc[late, ["quantity", "line_revenue"]] = 77, 77.0
    assert [m.month for m in store.refresh(table(spark, changed))] == [6, 8]
    assert {c for c, f in files(store).items() if f == before[c]} == {"2011-04-01", "2011-05-01"}
    same(store, table(spark, changed))
    fewer = changed[changed.invoice_date < day("2011-07-15")]
    assert [m.month for m in store.refresh(table(spark, fewer))] == [8]
    same(store, table(spark, fewer))
    assert store.refresh(table(spark, fewer)) == []


def test_further_cutoffs_and_other_rules(spark, frame, tmp_path):
    path = str(tmp_path / "s")
    df = table(spark, frame)
    SnapshotStore(spark, path, SETTINGS).refresh(df)
    more = SnapshotStore(spark, path, SnapshotSettings(
        (*SETTINGS.cutoffs, "2011-10-01"), 30, 10, HOME))
    assert [m.month for m in more.refresh(df)] == [10]
    same(more, df)
    between = SnapshotStore(spark, path, SnapshotSettings(
        ("2011-05-01", "2011-07-10", "2011-08-01", "2011-10-01"), 30, 10, HOME))
    assert datetime(2011, 7, 10) in between.refresh(df)
    same(between, df)
    longer = SnapshotStore(spark, path, SnapshotSettings(SETTINGS.cutoffs, 60, 10, HOME))
    with pytest.raises(ValueError, match="same cutoffs"):
        longer.append(df)
    assert len(longer.refresh(df)) == 4
    same(longer, df)
    with pytest.raises(ValueError, match="no history before 2010-12-31"):
        SnapshotStore(spark, path, SnapshotSettings(("2010-12-31",), 30, 10, HOME)).refresh(df)


@pytest.mark.parametrize("step", ["_rebuild", "_commit"])
def test_a_run_that_breaks_off_is_run_again(spark, frame, tmp_path, monkeypatch, step):
    store = SnapshotStore(spark, str(tmp_path / "s"), SETTINGS)
    first, later = (frame[frame.invoice_date < day("2011-06-10")],
                    frame[frame.invoice_date >= day("2011-06-10")])
    store.refresh(table(spark, first))

    def breaks(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(store, step, breaks)
        with pytest.raises(RuntimeError):
            store.append(table(spark, later))
    assert [m.month for m in store.append(table(spark, later))] == [6, 8]
    same(store, table(spark, frame))


def test_digests_add_up_and_name_changes(spark, frame):
    df = table(spark, frame)
    month = F.date_format("invoice_date", "yyyy-MM")
    whole = D.collected(D.partition_digests(df, month))
    halves = [D.collected(D.partition_digests(df.filter(c), month))
              for c in ("quantity > 2", "not quantity > 2")]
    assert whole == {p: halves[0].get(p, D.Digest()) + halves[1].get(p, D.Digest())
                     for p in whole}
    other = df.filter(month != "2011-02").withColumn(
        "country", F.when(month == "2011-03", F.lit("x")).otherwise(F.col("country")))
    found = {tuple(r) for r in D.changed_parts(
        D.partition_digests(df, month), D.partition_digests(other, month)).collect()}
    assert found == {("2011-02", "removed"), ("2011-03", "changed")}


def test_tables_are_rebuilt_where_they_differ(spark, tmp_path):
    rows = [(f"2011-0{m}", k, None if k == 3 else m * k) for m in (1, 2, 3) for k in range(5)]
    df = spark.createDataFrame([*rows, (None, 9, 9)], "month string, k int, v int")
    built = []

    def build(source):
        built.append(sorted({r["month"] or "none" for r in source.collect()}))
        return source.select("month", "k", (F.col("v") * 2).alias("twice"))

    def refreshed(source):
        built.clear()
        found = D.refresh_table(spark, str(tmp_path / "t"), source, F.col("month"), build,
                                F.col("month"))
        want = source.select("month", "k", (F.col("v") * 2).alias("twice"))
        assert sorted(map(tuple, found.table.drop("part").collect()), key=str) \
            == sorted(map(tuple, want.collect()), key=str)
        return found.rebuilt

    assert refreshed(df) == ["2011-01", "2011-02", "2011-03", "none"]
    stamps = {p: p.stat().st_mtime_ns for p in Path(tmp_path, "t/rows").glob("*/*.parquet")}
    assert refreshed(df) == [] and built == [[]]
    changed = df.withColumn("v", F.when(F.expr("month = '2011-02' and k = 1"), 50)
                            .otherwise(F.col("v")))
    assert refreshed(changed) == ["2011-02"] and built[0] == ["2011-02"]
    kept = {p for p, t in stamps.items() if p.exists() and p.stat().st_mtime_ns == t}
    assert {p.parent.name for p in kept} == {"part=2011-01", "part=2011-03", "part=none"}
    assert refreshed(changed.filter("month is not null and month <> '2011-03'")) \
        == ["2011-03", "none"]
    assert refreshed(df.limit(0)) == ["2011-01", "2011-02"]


def test_ledger_keeps_lines_of_a_customer_side_by_side(spark, tmp_path):
    frame = random_lines(12, 40, 900, 0.3)
    store = SnapshotStore(spark, str(tmp_path / "s"), SETTINGS)
    store.refresh(table(spark, frame))
    places = {}
    for path in Path(store.path, "ledger").rglob("*.parquet"):
        found = pd.read_parquet(path, columns=["customer_id", "invoice_no"], partitioning=None)
        customers = list(found.customer_id)
        assert customers == sorted(customers)
        for customer in set(customers):
            places.setdefault((path.parent, customer), set()).add(path.name)
    assert places and all(len(names) == 1 for names in places.values())
    same(store, table(spark, frame))


def test_ledger_of_customers_with_very_many_lines(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(S, "CELL_LINES", 40)
    frame = random_lines(13, 8, 400, 0.3)
    store = SnapshotStore(spark, str(tmp_path / "s"), SETTINGS)
    late = frame.invoice_date >= day("2011-05-20")
    store.refresh(table(spark, frame[~late]))
    store.append(table(spark, frame[late]))
    same(store, table(spark, frame))
    grain = ["piece", "batch", *[c for c in S.GRAIN if c != "epoch"]]
    ledger = spark.read.parquet(f"{store.path}/ledger")
    assert ledger.count() == ledger.select(*grain).distinct().count()

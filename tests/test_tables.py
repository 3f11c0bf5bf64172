from datetime import datetime

import pytest

from tidemark.sources import tables


def frame(spark, values):
    return spark.createDataFrame(values, "a bigint, b string")


def test_fingerprint_ignores_order_and_sees_changes(spark):
    base = frame(spark, [(1, "x"), (2, None), (3, "z")])
    same = frame(spark, [(3, "z"), (1, "x"), (2, None)]).repartition(3)
    pin = tables.fingerprint(base).first()
    assert tables.fingerprint(same).first() == pin
    tables.require_fingerprint(same, pin["n_rows"], pin["hash_sum"])
    for changed in ([(1, "x"), (2, ""), (3, "z")], [(1, "x"), (2, None)]):
        with pytest.raises(RuntimeError, match="fingerprint mismatch"):
            tables.require_fingerprint(frame(spark, changed), pin["n_rows"], pin["hash_sum"])


def test_load_or_build_reads_stored_copy_unless_forced(spark, tmp_path):
    path, calls = str(tmp_path / "t"), []

    def build():
        calls.append(1)
        return frame(spark, [(len(calls), "x")])

    def read(force=False):
        return tables.load_or_build(spark, path, build, force=force).first()["a"]

    assert (read(), read(), len(calls)) == (1, 1, 1)
    assert read(force=True) == 2 and read() == 2 and len(calls) == 2


def test_csv_round_trip_keeps_padding_and_rejects_malformed_lines(spark, tmp_path):
    row = ("A1", "\tP1 ", "a, \"b\"", 2, datetime(2011, 1, 5, 9, 30), 1.5, 7, "France")
    tables.write_report(spark.createDataFrame([row], tables.RAW_SCHEMA), str(tmp_path / "csv"))
    assert tuple(tables.read_raw(spark, str(tmp_path / "csv"), "csv").first()) == row
    bad = tmp_path / "bad.csv"
    bad.write_text(",".join(tables.RAW_SCHEMA.names) + "\nA1,P1,mug,two,2011-01-05,1.5,7,France\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        tables.read_raw(spark, str(bad), "csv").collect()


def test_transactions_are_stored_in_customer_order(spark, tmp_path):
    rows = [(c, f"{c}-{i}", datetime(2011, 1, 1 + i), "P", 1, 1.0, "France", 1.0)
            for i in (2, 0, 1) for c in (3, 1, 2)]
    df = spark.createDataFrame(rows, "customer_id bigint, invoice_no string, "
                               "invoice_date timestamp_ntz, stock_code string, quantity bigint, "
                               "unit_price double, country string, line_revenue double")
    path = str(tmp_path / "tx")
    tables.write_transactions(df, path)
    stored = [r.asDict() for r in spark.read.parquet(path).coalesce(1).collect()]
    assert len(stored) == 9
    for file_rows in {r["customer_id"] for r in stored}:
        dates = [r["invoice_date"] for r in stored if r["customer_id"] == file_rows]
        assert dates == sorted(dates)

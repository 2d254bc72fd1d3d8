"""Landed indicator files: quoted records in any encoding, rejected rows, broken files."""
import datetime

import pytest

from panelforge.sources.series import cash_rule, read_series, rejected_rows, write_series_records

HEADER = ('Title,"Cash Rate Target; ""old"", 1,000s","Cash Rate\r\nTarget \u2013 caf\u00e9"\r\n'
          'Description,Cash Rate Target,"Cash Rate Target, per cent"\r\nFrequency,Monthly,Daily\r\n'
          'Type,Original,Original\r\nUnits,%,"Per cent, \u20ac"\r\n')
ROWS = ('04-Jan-2021,1,"1,234.50"\r\n\r\n05-Jan-2021,2,\r\nsoon,3,4\r\n,5,6\r\n"1/25/2021",7,"(8)"\r\n"2021-01-26",9,0.25\r\n'
        '27-Jan-2021,9,"12,34"\r\n28-Jan-2021,1,"1,000,000"\r\n29-Jan-2021\r\n')


@pytest.mark.parametrize("encoding", ["windows-1252", "utf-8"])
def test_quoted_cells_and_audit(spark, tmp_path, encoding):
    path = tmp_path / "cash.csv"
    path.write_bytes((HEADER + ROWS).encode(encoding))
    got = read_series(spark, str(path), cash_rule, "rate", encoding=encoding).collect()
    assert [(r["date"].date(), r["rate"]) for r in got] == [
        (datetime.date(2021, 1, 4), 1234.5), (datetime.date(2021, 1, 26), 0.25), (datetime.date(2021, 1, 28), 1_000_000.0)]
    audit = rejected_rows(spark, str(path), cash_rule, encoding=encoding).orderBy("pos").collect()
    assert [(r["date_text"], r["value_text"], r["reason"]) for r in audit] == [
        ("05-Jan-2021", None, "missing value"), ("soon", "4", "unparsable date"), (None, "6", "missing date"),
        ("1/25/2021", "(8)", "unparsable value"), ("27-Jan-2021", "12,34", "unparsable value"), ("29-Jan-2021", None, "missing value")]


def test_short_files_and_missing_series_raise(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Title,x\n")
    with pytest.raises(RuntimeError, match="fewer than 5"):
        read_series(spark, str(tmp_path / "a.csv"), cash_rule, "rate")
    (tmp_path / "b.csv").write_text("Title,x\n" * 5 + "2021-01-01,1\n")
    with pytest.raises(RuntimeError, match="cash rate"):
        read_series(spark, str(tmp_path / "b.csv"), cash_rule, "rate")


def test_written_records_come_back(spark, tmp_path):
    header = [["Title", "a, b", 'Cash "Rate" Target'], ["Description", "", "Cash Rate Target"], ["Frequency", "x\ny", "Daily"],
              ["Type", "", ""], ["Units", "", ""]]
    df = spark.createDataFrame([("2021-01-02", "x,y", "2,500"), ("2021-01-01", None, "1")], "d string, o string, v string")
    path = write_series_records(df, str(tmp_path / "out"), header)
    assert [r["rate"] for r in read_series(spark, path, cash_rule, "rate", encoding="utf-8").collect()] == [1.0, 2500.0]

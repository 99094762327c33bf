"""Raw CSV scan and records with the declared 151-column schema."""

from riskframe.schema import RAW_COLUMNS, raw_schema
from riskframe.sources.loans import read_loans_csv, records_to_table


def test_csv_scan_keeps_leading_blank(spark, tmp_path):
    header = ",".join(RAW_COLUMNS)
    vals = {c: "" for c in RAW_COLUMNS}
    vals.update({"id": "7", "loan_amnt": "3600", "term": " 36 months", "int_rate": "13.99",
                 "issue_d": "Dec-2015", "loan_status": "Fully Paid", "annual_inc": "NaN"})
    line = ",".join(f'"{vals[c]}"' if vals[c].startswith(" ") else vals[c] for c in RAW_COLUMNS)
    p = tmp_path / "apps.csv"
    p.write_text(header + "\n" + line + "\n")
    df = read_loans_csv(spark, str(p))
    r = df.first()
    assert len(df.columns) == 151
    assert r["term"] == " 36 months" and r["loan_amnt"] == 3600.0 and r["annual_inc"] is None
    assert r["desc"] is None


def test_records_absent_keys_null(spark):
    df = records_to_table(spark, [{"loan_amnt": "1000", "term": " 60 months"}, {"grade": "B"}])
    assert df.schema == raw_schema()
    rows = df.collect()
    assert rows[0]["loan_amnt"] == 1000.0 and rows[1]["loan_amnt"] is None and rows[1]["grade"] == "B"


def test_missing_csv_reports_path(spark, tmp_path):
    import pytest
    with pytest.raises(FileNotFoundError) as e:
        read_loans_csv(spark, str(tmp_path / "nope.csv"))
    assert "nope.csv" in str(e.value)

"""Quoted CSV cut by many tasks: equal to Spark's one-task reader on hostile text."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.sources import csv_records as R
from riskframe.sources.loans import read_loans_csv, write_loans_csv

SCHEMA = T.StructType([T.StructField("id", T.StringType()), T.StructField("loan_amnt", T.DoubleType()),
                       T.StructField("desc", T.StringType()), T.StructField("title", T.StringType())])


@pytest.fixture
def small_blocks(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    cost = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700b")
    spark.conf.set("spark.sql.files.openCostInBytes", "1b")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    spark.conf.set("spark.sql.files.openCostInBytes", cost)


def field(rng):
    return "".join(rng.choices(['"', ",", "\n", "\n\n", "a", "é", " ", 'x"y', "\r\n", "12"],
                               k=rng.randint(0, 8)))


def quoted(v):
    return '"' + v.replace('"', '""') + '"'


def plain(v):
    return quoted(v) if any(c in v for c in '",\n\r') or not v else v


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_hostile_text_in_one_file(spark, small_blocks, tmp_path):
    rng = random.Random(4)
    rows = [(str(i), float(i), field(rng), field(rng) or "t") for i in range(900)]
    rows[400] = ("400", 400.0, "line\n" * 900, "one record over several blocks")
    text = "id,loan_amnt,desc,title\n" + "".join(
        ",".join([i, str(a), quoted(d), plain(t)]) + "\n" + ("\n" if int(i) % 50 == 0 else "")
        for i, a, d, t in rows)
    path = tmp_path / "one.csv"
    path.write_bytes(text.encode())
    df = read_loans_csv(spark, str(path), SCHEMA)
    # An empty text is NULL, quoted or not.
    assert rows_of(df) == sorted(((i, a, d or None, t) for i, a, d, t in rows), key=str)
    assert rows_of(df) == rows_of(read_loans_csv(spark, str(path), SCHEMA, split=False))
    lines = R.file_lines(spark, str(path))
    blocks = lines.select("start").distinct().count()
    assert blocks > 20
    entry = R.block_entries(lines).agg(F.sum("entry"), F.count("entry")).first()
    assert 0 < entry[0] < entry[1] == blocks
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Scan text" in plan and "Scan csv" not in plan


def test_files_without_last_line_end_with_crlf_and_quotes_in_unquoted_text(
        spark, small_blocks, tmp_path):
    folder = tmp_path / "many"
    folder.mkdir()
    head = "title,id,loan_amnt,desc"
    one = [f'5" pipe,{i},{i},"a ""b"" {"x" * (i % 70)}"' for i in range(120)]
    two = [f'Jo "J" Do,{i},NaN,"several\r\nlines {i}"' for i in range(200, 320)]
    (folder / "1.csv").write_bytes(("﻿" + head + "\n" + "\n".join(one)).encode())
    (folder / "2.csv").write_bytes("\r\n".join([head, *two, ""]).encode())
    got = {r.id: (r.loan_amnt, r.title, r.desc)
           for r in read_loans_csv(spark, str(folder), SCHEMA).collect()}
    assert len(got) == 240
    assert got["7"] == (7.0, '5" pipe', 'a "b" xxxxxxx')
    assert got["210"] == (None, 'Jo "J" Do', "several\r\nlines 210")


def test_other_header_raises_and_malformed_rows_are_kept(spark, tmp_path):
    folder = tmp_path / "heads"
    folder.mkdir()
    (folder / "1.csv").write_text("id,loan_amnt\n1,abc\n2,5\n")
    df = read_loans_csv(spark, str(folder), SCHEMA, corrupt_col="bad")
    assert [(r.id, r.loan_amnt, r.bad) for r in df.orderBy("id").collect()] == [
        ("1", None, "1,abc"), ("2", 5.0, None)]
    (folder / "2.csv").write_text("loan_amnt,id\n5,3\n")
    with pytest.raises(Exception, match="header differs"):
        read_loans_csv(spark, str(folder), SCHEMA).collect()


def test_round_trip_of_written_loans(spark, small_blocks, tmp_path):
    rng = random.Random(9)
    df = spark.createDataFrame([(str(i), float(i), field(rng) or None, field(rng))
                                for i in range(300)], SCHEMA)
    write_loans_csv(df.coalesce(1), str(tmp_path / "w"))
    got = read_loans_csv(spark, str(tmp_path / "w"), SCHEMA)
    assert rows_of(got) == rows_of(read_loans_csv(spark, str(tmp_path / "w"), SCHEMA, split=False))


def test_unclosed_quote_is_named(spark, small_blocks, tmp_path):
    path = tmp_path / "open.csv"
    path.write_text('id,desc\n1,"never closed\n' + "2,text and more text\n" * 6000)
    with pytest.raises(Exception, match="not closed"):
        read_loans_csv(spark, str(path), SCHEMA).collect()


def test_empty_and_header_only_files(spark, tmp_path):
    (tmp_path / "head.csv").write_text("id,loan_amnt\n")
    assert read_loans_csv(spark, str(tmp_path / "head.csv"), SCHEMA).count() == 0


def loop_states(opens, stays, entry):
    out = []
    for a, b in zip(opens, stays):
        entry = b if entry else a
        out.append(entry)
    return out


def test_states_compose():
    for n in (1, 4):
        for bits in itertools.product((0, 1), repeat=2 * n):
            opens, stays = np.array(bits[:n]), np.array(bits[n:])
            for entry in (0, 1):
                assert R.states_after(opens, stays, entry).tolist() == loop_states(
                    opens, stays, entry)


@pytest.mark.parametrize("line, opens, stays", [
    ("a,b", 0, 1), ("", 0, 1), ('a,"b', 1, 0), ('a","b"', 0, 0), ('"a ""b"" c",d', 0, 0),
    ('5" pipe,x', 0, 0), ('a,"b""', 1, 0), ('"', 1, 0), ('""', 0, 1), ('"""', 1, 0),
    ('",""",', 0, 1), ('x"y,"z', 1, 1)])
def test_line_functions(spark, line, opens, stays):
    got = spark.createDataFrame([(line,)], "v string").select(
        F.col("v").rlike(R.OPENS), F.col("v").rlike(R.STAYS)).first()
    assert tuple(map(int, got)) == (opens, stays)

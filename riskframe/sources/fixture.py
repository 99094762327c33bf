"""The ``loans`` table derived by Spark from the driver tables, plus score fixtures.

The driver tables hold no loan data, so a deterministic loan table is derived
from ``orders ⋈ customer ⋈ nation ⟕ lineitem(aggregated per order)``. Its work
grows with ``orders`` and ``lineitem``; nothing is synthesised on the driver.

Plan at scale: ``lineitem`` is aggregated per order with a map-side partial
aggregate, so the hash exchange on ``l_orderkey`` carries one row per order and
partition; ``orders`` joins it on the same key (sort-merge, or shuffle-hash
under AQE); ``customer`` joins on ``custkey`` (AQE splits a hot customer's
partition for the inner join); ``nation`` is tiny and left to the size-checked
broadcast threshold.

``DUCKDB_VIEWS`` holds the same derivation in DuckDB SQL for the oracle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import BAD_STATUSES, GOOD_STATUSES
from .tables import read_table

# --- fixed values: fixture rules (see FIXTURES.md §2) -------------------------
GRADE_LETTERS = ["A", "B", "C", "D", "E"]
ORDER_STATUS_TO_LOAN_STATUS = {"F": "Fully Paid", "P": "Charged Off", "O": "Current"}
SPLIT_YEAR = 2000
DRIFT_EXPECTED = ("2024-01-01", "2024-01-16")   # [start, end) of the expected side
DRIFT_ACTUAL = ("2024-01-16", "2024-02-01")


def _month_text(d: Column) -> Column:
    return F.date_format(d, "MMM-yyyy")


def loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order, raw-application column names and text formats."""
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
        "o_orderpriority")
    customer = read_table(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    lines = (read_table(spark, sf_dir, "lineitem")
             .groupBy("l_orderkey")
             .agg(F.sum("l_quantity").alias("li_qty"),
                  F.count(F.lit(1)).alias("li_lines"),
                  F.count_if(F.col("l_returnflag") == "R").alias("li_r"),
                  F.count_if(F.col("l_linestatus") == "O").alias("li_o")))

    joined = (orders
              .join(lines, orders.o_orderkey == lines.l_orderkey, "left")
              .join(customer, orders.o_custkey == customer.c_custkey, "inner")
              .join(nation, customer.c_nationkey == nation.n_nationkey, "inner"))

    oid = F.col("o_orderkey")
    digit = F.substring("o_orderpriority", 1, 1).cast("int")
    order_date = F.to_date("o_orderdate")
    recent = F.year(order_date) >= SPLIT_YEAR
    # The last letter turns into one that no earlier year has: a level unseen in training.
    letter = F.when(recent & (digit == 5) & (oid % 3 == 0), F.lit("F")).otherwise(
        F.element_at(F.array(*[F.lit(x) for x in GRADE_LETTERS]), digit))
    cust_mod = F.col("o_custkey") % 12
    status_map = F.create_map(*[F.lit(x) for kv in ORDER_STATUS_TO_LOAN_STATUS.items() for x in kv])
    null_d = F.lit(None).cast("double")
    null_l = F.lit(None).cast("bigint")

    return joined.select(
        oid.alias("id"),
        F.col("o_totalprice").alias("loan_amnt"),
        F.when(oid % 2 == 0, " 36 months").otherwise(" 60 months").alias("term"),
        (F.lit(5.0) + F.lit(3.0) * (digit - 1) + F.lit(0.1) * (oid % 7)
         + F.when(F.col("o_orderstatus") == "P", F.lit(2.0)).otherwise(F.lit(0.0))).alias("int_rate"),
        F.when(oid % 23 != 0, letter).alias("grade"),
        F.when(oid % 29 != 0, F.concat(letter, (F.lit(1) + oid % 5).cast("string")))
         .alias("sub_grade"),
        F.when(cust_mod == 0, "< 1 year").when(cust_mod == 1, "1 year")
         .when(cust_mod == 10, "10+ years").when(cust_mod == 11, F.lit(None).cast("string"))
         .otherwise(F.concat(cust_mod.cast("string"), F.lit(" years"))).alias("emp_length"),
        F.when(recent & (oid % 31 == 0), F.lit("ANY")).when(oid % 37 != 0, F.col("c_mktsegment"))
         .alias("home_ownership"),
        F.col("n_name").alias("addr_state"),
        F.when(oid % 11 == 0, null_d).otherwise(F.col("c_acctbal")).alias("annual_inc"),
        _month_text(order_date).alias("issue_d"),
        F.when(oid % 19 == 0, F.lit("bad"))
         .otherwise(_month_text(F.add_months(order_date, -((F.col("o_custkey") % 400) - 5).cast("int"))))
         .alias("earliest_cr_line"),
        F.try_element_at(status_map, F.col("o_orderstatus")).alias("loan_status"),
        F.when(oid % 13 == 0, null_d).otherwise(F.col("li_qty")).alias("revol_util"),
        F.col("li_lines").alias("open_acc"),
        F.col("li_r").alias("pub_rec"),
        F.when(oid % 17 == 0, null_l).otherwise(F.col("li_o")).alias("mort_acc"),
        F.when(oid % 2 == 0, null_d).otherwise(F.col("li_qty")).alias("mths_since_last_delinq"),
        # A heavy right tail and a long left one.
        (F.col("o_totalprice") * F.lit(50.0) / (F.lit(1) + oid % 997)).alias("revol_bal"),
        (F.lit(100.0) - F.lit(60.0) / (F.lit(1) + oid % 41)).alias("pct_tl_nvr_dlq"),
        F.lit(1.0).alias("policy_code"),
    )


def definitive_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loans with a final outcome, ``is_bad`` attached (the cleaned EDA frame)."""
    from ..operators.clean import definitive_outcomes, label_loans, parse_dates
    return parse_dates(definitive_outcomes(label_loans(loans(spark, sf_dir))))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, side, label, score): a deterministic score with ties, in [0, 1]."""
    from ..operators.clean import issue_year_col
    df = definitive_loans(spark, sf_dir)
    return df.select(
        "id",
        F.when(issue_year_col() < SPLIT_YEAR, "train").when(issue_year_col() >= SPLIT_YEAR, "test")
         .alias("side"),
        F.col("is_bad").alias("label"),
        (F.col("int_rate") / F.lit(25.0)).alias("score"),
    )


def drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(side, value) from ``events``: first half of January 2024 vs the second half."""
    ev = read_table(spark, sf_dir, "events").select("ts", "value")
    ts = F.col("ts")
    side = (F.when((ts >= F.lit(DRIFT_EXPECTED[0]).cast("timestamp_ntz"))
                   & (ts < F.lit(DRIFT_EXPECTED[1]).cast("timestamp_ntz")), "expected")
            .when((ts >= F.lit(DRIFT_ACTUAL[0]).cast("timestamp_ntz"))
                  & (ts < F.lit(DRIFT_ACTUAL[1]).cast("timestamp_ntz")), "actual"))
    return (ev.filter((ts >= F.lit(DRIFT_EXPECTED[0]).cast("timestamp_ntz"))
                      & (ts < F.lit(DRIFT_ACTUAL[1]).cast("timestamp_ntz")))
            .select(side.alias("side"), "value"))


# --- the same derivation for DuckDB (oracle side) -----------------------------
_BAD = ", ".join("'" + s + "'" for s in BAD_STATUSES)
_GOOD = ", ".join("'" + s + "'" for s in GOOD_STATUSES)

DUCKDB_VIEWS = {
    "loans": """
SELECT
  o.o_orderkey AS id,
  o.o_totalprice AS loan_amnt,
  CASE WHEN o.o_orderkey % 2 = 0 THEN ' 36 months' ELSE ' 60 months' END AS term,
  5::DOUBLE + 3::DOUBLE * (CAST(substr(o.o_orderpriority, 1, 1) AS INTEGER) - 1)
    + 0.1::DOUBLE * (o.o_orderkey % 7)
    + CASE WHEN o.o_orderstatus = 'P' THEN 2::DOUBLE ELSE 0::DOUBLE END AS int_rate,
  CASE WHEN o.o_orderkey % 23 <> 0 THEN {letter} END AS grade,
  CASE WHEN o.o_orderkey % 29 <> 0 THEN {letter} || CAST(1 + o.o_orderkey % 5 AS VARCHAR) END
    AS sub_grade,
  CASE o.o_custkey % 12 WHEN 0 THEN '< 1 year' WHEN 1 THEN '1 year' WHEN 10 THEN '10+ years'
    WHEN 11 THEN NULL ELSE CAST(o.o_custkey % 12 AS VARCHAR) || ' years' END AS emp_length,
  CASE WHEN year(o.o_orderdate) >= {split} AND o.o_orderkey % 31 = 0 THEN 'ANY'
    WHEN o.o_orderkey % 37 <> 0 THEN c.c_mktsegment END AS home_ownership,
  n.n_name AS addr_state,
  CASE WHEN o.o_orderkey % 11 = 0 THEN NULL ELSE c.c_acctbal END AS annual_inc,
  strftime(o.o_orderdate, '%b-%Y') AS issue_d,
  CASE WHEN o.o_orderkey % 19 = 0 THEN 'bad'
    ELSE strftime(o.o_orderdate - to_months(CAST(o.o_custkey % 400 - 5 AS INTEGER)), '%b-%Y')
  END AS earliest_cr_line,
  CASE o.o_orderstatus WHEN 'F' THEN 'Fully Paid' WHEN 'P' THEN 'Charged Off'
    WHEN 'O' THEN 'Current' END AS loan_status,
  CASE WHEN o.o_orderkey % 13 = 0 THEN NULL ELSE li.li_qty END AS revol_util,
  li.li_lines AS open_acc,
  li.li_r AS pub_rec,
  CASE WHEN o.o_orderkey % 17 = 0 THEN NULL ELSE li.li_o END AS mort_acc,
  CASE WHEN o.o_orderkey % 2 = 0 THEN NULL ELSE li.li_qty END AS mths_since_last_delinq,
  o.o_totalprice * 50::DOUBLE / (1 + o.o_orderkey % 997) AS revol_bal,
  100::DOUBLE - 60::DOUBLE / (1 + o.o_orderkey % 41) AS pct_tl_nvr_dlq,
  1::DOUBLE AS policy_code
FROM orders o
LEFT JOIN (
  SELECT l_orderkey, sum(l_quantity) AS li_qty, CAST(count(*) AS BIGINT) AS li_lines,
         CAST(count_if(l_returnflag = 'R') AS BIGINT) AS li_r,
         CAST(count_if(l_linestatus = 'O') AS BIGINT) AS li_o
  FROM lineitem GROUP BY l_orderkey
) li ON li.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey""".format(split=SPLIT_YEAR, letter=f"""CASE
    WHEN year(o.o_orderdate) >= {SPLIT_YEAR} AND substr(o.o_orderpriority, 1, 1) = '5'
      AND o.o_orderkey % 3 = 0 THEN 'F'
    ELSE substr('ABCDE', CAST(substr(o.o_orderpriority, 1, 1) AS INTEGER), 1) END"""),
    "labeled": f"""
SELECT *, CAST(CASE WHEN loan_status IN ({_BAD}) THEN 1 WHEN loan_status IN ({_GOOD}) THEN 0
  ELSE -1 END AS INTEGER) AS is_bad
FROM loans""",
    "definitive": """
SELECT l.* REPLACE (
    CASE WHEN regexp_matches(issue_d, '^[A-Za-z]{3}-[0-9]{4}$')
      THEN CAST(try_strptime(issue_d, '%b-%Y') AS DATE) END AS issue_d,
    CASE WHEN regexp_matches(earliest_cr_line, '^[A-Za-z]{3}-[0-9]{4}$')
      THEN CAST(try_strptime(earliest_cr_line, '%b-%Y') AS DATE) END AS earliest_cr_line),
  CAST(year(CASE WHEN regexp_matches(issue_d, '^[A-Za-z]{3}-[0-9]{4}$')
      THEN CAST(try_strptime(issue_d, '%b-%Y') AS DATE) END) AS INTEGER) AS issue_year,
  CAST(date_trunc('month', CASE WHEN regexp_matches(issue_d, '^[A-Za-z]{3}-[0-9]{4}$')
      THEN CAST(try_strptime(issue_d, '%b-%Y') AS DATE) END) AS DATE) AS issue_month_yr
FROM labeled l WHERE is_bad <> -1""",
    "scored": f"""
SELECT id,
  CASE WHEN issue_year < {SPLIT_YEAR} THEN 'train' WHEN issue_year >= {SPLIT_YEAR} THEN 'test' END AS side,
  is_bad AS label, int_rate / 25::DOUBLE AS score
FROM definitive""",
    "drift": f"""
SELECT CASE WHEN ts >= TIMESTAMP '{DRIFT_EXPECTED[0]}' AND ts < TIMESTAMP '{DRIFT_EXPECTED[1]}'
  THEN 'expected' ELSE 'actual' END AS side, value
FROM events
WHERE ts >= TIMESTAMP '{DRIFT_EXPECTED[0]}' AND ts < TIMESTAMP '{DRIFT_ACTUAL[1]}'""",
}

_VIEW_DEPENDS = {"loans": [], "labeled": ["loans"], "definitive": ["labeled"],
                 "scored": ["definitive"], "drift": []}


def duckdb_with(*views: str) -> str:
    """``WITH`` clause defining the named fixture views (and what they need)."""
    order: list[str] = []

    def visit(v: str) -> None:
        for d in _VIEW_DEPENDS[v]:
            visit(d)
        if v not in order:
            order.append(v)

    for v in views:
        visit(v)
    return "WITH " + ",\n".join(f"{v} AS ({DUCKDB_VIEWS[v]})" for v in order) + "\n"

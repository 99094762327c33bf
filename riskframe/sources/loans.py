"""Loan application sources: raw CSV scan, records, Parquet copy.

The raw file is read with the declared 151-column schema (never inferred);
``term``'s leading blank is significant, so whitespace is kept. Large files are
read by many tasks (``csv_records``); a gzip CSV is not splittable and is one
task. Convert to Parquet once (``to_parquet``) so later scans prune columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import nan_to_null
from ..schema import raw_schema
from .csv_records import read_records


#: How loan CSVs are written: quotes are doubled inside quoted text, and quoted text may hold
#: line breaks. Spark's own reader takes one task for a file that may hold them.
CSV_OPTIONS = {"header": True, "quote": '"', "escape": '"', "multiLine": True,
               "mode": "PERMISSIVE", "ignoreLeadingWhiteSpace": False,
               "ignoreTrailingWhiteSpace": False, "nanValue": "NaN", "enforceSchema": False}
CORRUPT = "_corrupt_record"


def read_loans_csv(spark: SparkSession, path: str, schema: T.StructType | None = None,
                   repartition: int | None = None, corrupt_col: str | None = None,
                   split: bool = True) -> DataFrame:
    """Scan loan CSV(s) with the declared schema, columns matched by header name.

    Quoted text may hold doubled quotes and line breaks. The header's order is free; a
    declared column that it lacks is NULL, an undeclared one is left out. Files whose headers
    differ from the first one's raise when they are read. A malformed number is NULL, and
    ``corrupt_col`` then holds the row's text (see :func:`malformed_rows`). A missing path
    raises ``FileNotFoundError`` naming it (the caller decides whether to continue without a
    frame).

    A large file is read by many tasks: where records begin is found by two scans when this is
    called (:mod:`csv_records`). ``split=False`` reads with Spark's own reader instead, a file
    per task and no scan ahead.
    """
    from pyspark.errors import AnalysisException
    schema = schema or raw_schema()
    declared = {f.name: f.dataType for f in schema.fields}
    reader = spark.read.options(**CSV_OPTIONS)
    try:
        header = reader.csv(path).columns   # names only: without inferSchema no row is parsed
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            raise FileNotFoundError(f"loan file not found: {path}") from e
        raise
    found = T.StructType([T.StructField(h, declared.get(h, T.StringType())) for h in header])
    if corrupt_col:
        found = found.add(CORRUPT, T.StringType())
    if split and header:
        df = _parsed(read_records(spark, path), found, header)
    else:
        df = reader.option("columnNameOfCorruptRecord", CORRUPT).schema(found).csv(path)
    df = to_null_markers(df.select(
        *[F.col(f"`{c}`") if c in header else F.lit(None).cast(t).alias(c)
          for c, t in declared.items()],
        *([F.col(CORRUPT).alias(corrupt_col)] if corrupt_col else [])))
    return df.repartition(repartition) if repartition else df


def _ddl(fields: list[tuple[str, str]]) -> str:
    return ", ".join("`" + n.replace("`", "``") + f"` {t}" for n, t in fields)


def _parsed(records: DataFrame, found: T.StructType, header: list[str]) -> DataFrame:
    """Columns of ``found`` from the text of each record; a header that is not ``header`` raises."""
    options = {k: str(v).lower() if isinstance(v, bool) else v for k, v in CSV_OPTIONS.items()
               if k not in ("header", "enforceSchema")}
    # Spark numbers names that repeat or are empty: what it made of a name tells what it was.
    names = F.array(*[F.array(*[F.lit(x) for x in sorted(
        {h.lower()} | ({h[:-len(str(i))].lower()} if h.endswith(str(i)) else set())
        | ({""} if h == f"_c{i}" else set()))]) for i, h in enumerate(header)])
    given = F.from_csv(F.regexp_replace("record", "^\ufeff", ""), _ddl(
        [(f"c{i}", "string") for i in range(len(header) + 1)]), options)
    tokens = F.array(*[F.lower(F.coalesce(given[f"c{i}"], F.lit(""))) for i in range(len(header))])
    same = given[f"c{len(header)}"].isNull() & F.forall(
        F.arrays_zip(names.alias("names"), tokens.alias("token")),
        lambda z: F.array_contains(z["names"], z["token"]))
    is_row = F.when(~F.col("first"), F.lit(True)).when(same, F.lit(False)).otherwise(
        F.raise_error(F.concat(F.lit("CSV header differs from the first file's: "),
                               F.col("record"))).cast("boolean"))
    fields = _ddl([(f.name, f.dataType.simpleString()) for f in found.fields])
    return records.filter(is_row).select(F.from_csv("record", fields, options | {
        "columnNameOfCorruptRecord": CORRUPT}).alias("r")).select("r.*")


def malformed_rows(df: DataFrame, corrupt_col: str = CORRUPT) -> DataFrame:
    """One row: all rows, and those in which some value could not be read as declared."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.count(corrupt_col).alias("n_malformed"))


def write_loans_csv(df: DataFrame, path: str) -> None:
    """Write loans as CSV in the form that :func:`read_loans_csv` reads, text kept as it is."""
    df.write.options(header=True, quote='"', escape='"', quoteAll=True, emptyValue="",
                     ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)


def to_null_markers(df: DataFrame) -> DataFrame:
    """NaN -> NULL in every DOUBLE column (NULL is the one missing marker)."""
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns({c: nan_to_null(c) for c in doubles}) if doubles else df


def records_to_table(spark: SparkSession, records: list[dict],
                     schema: T.StructType | None = None) -> DataFrame:
    """In-memory application records -> DataFrame; absent keys become NULL (S3)."""
    schema = schema or raw_schema()
    names = schema.fieldNames()
    rows = [tuple(_coerce(r.get(n), schema[n].dataType) for n in names) for r in records]
    return spark.createDataFrame(rows, schema)


def _coerce(v, dt: T.DataType):
    if v is None:
        return None
    if isinstance(dt, T.DoubleType):
        try:
            return float(v)
        except (TypeError, ValueError):
            return None
    return str(v)


def to_parquet(df: DataFrame, path: str, partition_by: str | None = "issue_year") -> None:
    """Write a Parquet copy; partitioned by issue year so the time split prunes files."""
    w = df.write.mode("overwrite")
    if partition_by and partition_by in df.columns:
        w = w.partitionBy(partition_by)
    w.parquet(path)


def scan_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


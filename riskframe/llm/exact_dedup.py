"""Exact dedup: group by a 128-bit content hash, compare the bytes, keep one stable id.

Two aggregates over the same key. The narrow one (id and hashes only) finds size and keeper of
each group; the wide one groups by hash *and* text, so Spark's hash aggregate compares the bytes
of all texts that share a hash. Both combine on the map side, so a group that holds a third of
all rows reaches the shuffle as one row per task. A SHA-256 beside the 128-bit hash separates
texts whose 128-bit hashes collide; should both collide, the query fails instead of merging
different texts. Everything is DataFrame expressions; no Python runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.tables import text_or_empty, written


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 keep: str = "min") -> DataFrame:
    """One row per input row: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``, ``row_uid``.

    ``keep`` is ``min`` or ``max``: the smallest or largest id of a group stays. Null texts count
    as empty. A null id loses against any other (a group of null ids keeps a null). Of repeated
    rows with the same id and text exactly one stays. Extra columns are not carried (join on
    the id, or use :func:`drop_exact`). An empty table gives an empty result.
    """
    if keep not in ("min", "max"):
        raise ValueError("keep must be 'min' or 'max'")
    rows = written(docs.select(
        F.col(id_col).alias("doc_id"), F.unhex(F.md5(text_or_empty(text_col))).alias("h128"),
        F.sha2(text_or_empty(text_col), 256).alias("text_sha256"),
        F.monotonically_increasing_id().alias("row_uid")), "exact-rows")
    return _with_groups(rows, docs.select(text_or_empty(text_col).alias("body")), keep)


def _with_groups(rows: DataFrame, bodies: DataFrame, keep: str) -> DataFrame:
    present = F.col("doc_id").isNotNull()
    best = (F.min("doc_id") if keep == "min" else F.max("doc_id")).alias("keep_id")
    narrow = rows.groupBy("h128", "text_sha256", "doc_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("row_uid").alias("first_uid"))
    groups = narrow.groupBy("h128", "text_sha256").agg(
        F.sum("n").alias("group_size"), best,
        (F.min_by if keep == "min" else F.max_by)("first_uid", F.when(present, F.col("doc_id")))
        .alias("keep_uid"), F.min("first_uid").alias("any_uid"))
    # Hash aggregate keyed by (hash, text): equal keys are equal bytes.
    by_bytes = (bodies.withColumn("h128", F.unhex(F.md5("body")))
                .groupBy("h128", "body").agg(F.count(F.lit(1)).alias("n_bytes"))
                .select("h128", F.sha2("body", 256).alias("text_sha256"), "n_bytes"))
    checked = (groups.join(by_bytes, ["h128", "text_sha256"])
               .withColumn("group_size", F.when(F.col("n_bytes") == F.col("group_size"),
                                                F.col("group_size"))
                           .otherwise(F.raise_error(F.lit(
                               "texts with equal 128-bit and SHA-256 hashes differ"))
                               .cast("bigint")))
               .withColumn("keep_uid", F.coalesce("keep_uid", "any_uid"))
               .select("h128", "text_sha256", "group_size", "keep_id", "keep_uid"))
    # Rows of a hot group meet one row of the other side: AQE splits that join's partition.
    return (rows.join(checked, ["h128", "text_sha256"])
            .select("doc_id", "keep_id", "group_size",
                    (F.col("row_uid") == F.col("keep_uid")).alias("kept"), "text_sha256",
                    "row_uid"))


def drop_exact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               keep: str = "min") -> DataFrame:
    """The kept rows of ``docs`` with all of their columns, one per distinct text.

    Column names are free: working columns are kept apart from the input's, so clashing names
    such as ``h128`` or ``kept`` survive unchanged.
    """
    packed = written(docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.monotonically_increasing_id().alias("row_uid")), "exact-docs")
    body = F.coalesce(F.col("row").getField(text_col).cast("string"), F.lit(""))
    rows = packed.select(F.col("row").getField(id_col).alias("doc_id"),
                         F.unhex(F.md5(body)).alias("h128"),
                         F.sha2(body, 256).alias("text_sha256"), "row_uid")
    kept = _with_groups(rows, packed.select(body.alias("body")), keep).filter("kept").select(
        "row_uid")
    return packed.join(kept, "row_uid", "left_semi").select("row.*")

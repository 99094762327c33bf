"""Document fingerprints: the k smallest hashes of a text's word shingles (bottom-k sketch).

Sketches of parts merge into the sketch of the whole (the k smallest of the union) and estimate
resemblance, containment and the number of distinct shingles. Everything is Spark SQL functions
on arrays of longs; no Python runs on the executors.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.llm.tables import text_or_empty

HASH_BITS = 48


def sketch(text: Column, k: int = 128, words: int = 5) -> Column:
    """Ascending array of the ``k`` smallest distinct 48-bit hashes of the text's shingles.

    Words are runs without white space, lower-cased; a text of fewer than ``words`` words is one
    shingle, one without words has an empty sketch.
    """
    tokens = F.array_remove(F.split(F.lower(text), r"\s+"), "")
    return F.transform(F.array(tokens), lambda w: _of_words(w, k, words))[0]


def _of_words(tokens: Column, k: int, words: int) -> Column:
    # Arrays of one element carry an intermediate array into the next lambda, so each is
    # computed once per row.
    hashed = F.transform(tokens, lambda w: F.xxhash64(w))
    values = F.transform(F.array(hashed), lambda h: F.when(
        F.size(h) >= words,
        F.transform(F.sequence(F.lit(0), F.size(h) - words), lambda i: _short_hash(
            *[F.get(h, i + j) for j in range(words)])))
        .when(F.size(h) > 0, F.array(_short_hash(h)))
        .otherwise(F.array().cast("array<bigint>")))[0]
    return F.slice(F.sort_array(F.array_distinct(values)), 1, k)


def _short_hash(*cols: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*cols), 64 - HASH_BITS)


def merged(a: Column, b: Column, k: int = 128) -> Column:
    """The sketch of two parts together."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def merge_groups(df: DataFrame, group_cols: list[str], sketch_col: str = "sketch",
                 k: int = 128) -> DataFrame:
    """One sketch per group, empty for a group of empty (or null) sketches. Values are made
    distinct before the shuffle's end and ranked; Spark keeps the k smallest per task before it
    shuffles, so a large group does not meet one task. Names of group columns are free."""
    values = df.select(F.struct(*[F.col(f"`{c}`") for c in group_cols]).alias("group"),
                       F.explode_outer(F.col(f"`{sketch_col}`")).alias("value")).distinct()
    rank = Window.partitionBy("group").orderBy(F.col("value").asc_nulls_last())
    merged_rows = (values.withColumn("rank", F.row_number().over(rank)).filter(F.col("rank") <= k)
                   .groupBy("group").agg(F.sort_array(F.collect_list("value")).alias("sketch")))
    return merged_rows.select(*[F.col("group").getField(c).alias(c) for c in group_cols],
                              F.col("sketch").alias(sketch_col))


def resemblance(a: Column, b: Column, k: int = 128) -> Column:
    """Estimated Jaccard similarity: the share of the union's sketch found in both sketches."""
    union = merged(a, b, k)
    both = F.size(F.array_intersect(union, F.array_intersect(a, b)))
    return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(both / F.size(union))


def distinct_shingles(a: Column, k: int = 128) -> Column:
    """Estimated number of distinct shingles; exact below ``k``."""
    top = F.element_at(a, -1).cast("double")
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise(
        (k - 1) * float(1 << HASH_BITS) / top)


def containment(a: Column, b: Column, k: int = 128) -> Column:
    """Estimated share of a's shingles that b holds, from resemblance and the counts."""
    r = resemblance(a, b, k)
    both = r / (1 + r) * (distinct_shingles(a, k) + distinct_shingles(b, k))
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(
        F.least(F.lit(1.0), both / distinct_shingles(a, k)))


def hex_string(a: Column) -> Column:
    """A sketch as text: 12 lowercase hex digits per hash."""
    return F.array_join(F.transform(a, lambda v: F.lower(F.lpad(F.hex(v), HASH_BITS // 4, "0"))),
                        "")


def _rank_among(col: Column, cuts: list[int]) -> Column:
    """How many of the ascending ``cuts`` lie below the value, by a search on two levels."""
    if not cuts:
        return F.lit(0)
    width = math.isqrt(len(cuts) - 1) + 1
    parts = [cuts[i:i + width] for i in range(0, len(cuts), width)]
    ends = F.array(*[F.lit(p[-1]) for p in parts])
    full = F.size(F.filter(ends, lambda c: c < col))
    inner = F.get(F.array(*[F.array(*[F.lit(c) for c in p]) for p in parts]), full)
    return full * width + F.coalesce(F.size(F.filter(inner, lambda c: c < col)), F.lit(0))


def with_next(docs: DataFrame, id_col: str = "doc_id", partitions: int | None = None,
              carried: tuple[str, ...] = ("body",)) -> DataFrame:
    """Every row with the ``next_*`` columns of the row that follows in descending id order.

    The last row is followed by the first. Rows are cut into ranges of the id by approximate
    quantiles (a few numbers on the driver), each range is ordered in its own task, and a copy
    of each range's first row closes the range before it; no task sees all rows. Null ids come
    last; rows with the same id are ordered by the carried columns.
    """
    n = partitions or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    got = docs.agg(F.percentile_approx(id_col, [i / n for i in range(1, n)] or [0.5],
                                       max(10_000, 20 * n)).alias("c")).first()["c"]
    cuts = sorted(set(got or []))
    ranked = docs.withColumn("__range", F.when(
        F.col(id_col).isNull(), F.lit(-1)).otherwise(_rank_among(F.col(id_col), cuts)))
    heads = sorted((r["__range"], r["head"]) for r in ranked.groupBy("__range").agg(
        F.max(id_col).alias("head")).collect())  # a row per range
    if not heads:
        return ranked.drop("__range").select("*", *[F.col(c).alias(f"next_{c}") for c in carried])
    above = {heads[i][1]: heads[(i + 1) % len(heads)][0] for i in range(len(heads))}
    closing = (docs.filter(F.col(id_col).eqNullSafe(F.lit(None)) if None in above else F.lit(False))
               .unionByName(docs.filter(F.col(id_col).isin([h for h in above if h is not None])))
               .groupBy(id_col).agg(F.min(F.struct(*carried)).alias("__row"))
               .select(id_col, *[F.col("__row").getField(c).alias(c) for c in carried]))
    to = F.lit(None).cast("int")
    for head, target in above.items():
        to = F.when(F.col(id_col).eqNullSafe(F.lit(head)), F.lit(target)).otherwise(to) \
            if len(above) <= 2 else to
    if len(above) > 2:
        pairs = F.map_from_arrays(F.array(*[F.lit(h) for h in above if h is not None]),
                                  F.array(*[F.lit(t) for h, t in above.items() if h is not None]))
        to = F.when(F.col(id_col).isNull(), F.lit(above.get(None))).otherwise(
            F.try_element_at(pairs, F.col(id_col)))
    closing = closing.withColumn("__range", to).withColumn("__closing", F.lit(True))
    rows = ranked.withColumn("__closing", F.lit(False)).select(
        id_col, *carried, "__range", "__closing")
    order = Window.partitionBy("__range").orderBy(
        "__closing", F.col(id_col).desc_nulls_last(), *carried)
    return (rows.unionByName(closing)
            .select(id_col, *carried, "__closing",
                    *[F.lead(c).over(order).alias(f"next_{c}") for c in carried])
            .filter("not __closing").drop("__closing"))


def fingerprint_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      k: int = 128, words: int = 5) -> DataFrame:
    """Fingerprints of every text and of its edited text, and likeness to it and to the next.

    The edited text has its last third (``floor(n_chars / 3)`` code points) replaced by the
    first as many of the next document's text, in descending id order. Null texts count as
    empty; an empty table gives an empty result; extra columns are ignored.
    """
    base = docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                       text_or_empty(text_col).alias("body"))
    base = base.withColumn("sketch", sketch(F.col("body"), k, words))
    near = with_next(base, carried=("body", "sketch"))
    n = F.char_length("body")
    third = F.floor(n / 3).cast("int")
    edited = near.select(
        "doc_id", n.cast("bigint").alias("n_chars"), "sketch", "next_sketch",
        F.concat(F.substring("body", F.lit(1), n - third),
                 F.substring("next_body", F.lit(1), third)).alias("edited"))
    edited = edited.withColumn("edited_sketch", sketch(F.col("edited"), k, words))
    return edited.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        hex_string(F.col("sketch")).alias("fingerprint"),
        hex_string(F.col("edited_sketch")).alias("edited_fingerprint"),
        resemblance(F.col("sketch"), F.col("edited_sketch"), k).alias("near_edited"),
        resemblance(F.col("sketch"), F.col("next_sketch"), k).alias("near_next"),
        distinct_shingles(F.col("sketch"), k).alias("shingles"))

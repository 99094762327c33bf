"""Registered queries of the training-data operators and the SQL of those that SQL can express.

Each query applies its operator with production parameters to its whole table.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.llm import (byte_bpe, decontaminate, exact_dedup, fingerprint, html_content,
                           lexical_search, neardup, packing, records, sharding, token_tree,
                           toxicity, whitening)
from riskframe.sources.tables import read_table

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.tiktoken")


TOXIC_FROM = 0.7  # a document with this score or more is rejected


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents").select("doc_id", "text")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(_documents(spark, sf_dir), 24)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three edits per text: its middle word repeated twice as long, its beginning moved to the
    end, and a run of characters after its first third deleted."""
    docs = _documents(spark, sf_dir).withColumn("n", F.coalesce(F.char_length("text"), F.lit(0)))
    half, third = F.floor(F.col("n") / 2), F.floor(F.col("n") / 3)
    head = F.coalesce(F.substring("text", F.lit(1), F.lit(40)), F.lit(""))

    def edit(start, stop, new):
        return F.struct(start.cast("bigint").alias("start"), stop.cast("bigint").alias("stop"),
                        new.alias("new"))

    edits = F.array(edit(half, half + 5, F.concat(F.lit(" "), head, F.lit(" "), head)),
                    edit(F.col("n") + 80, F.col("n") + 80, F.concat(F.lit("\n"), head)),
                    edit(third, third + 25, F.lit("")))
    return token_tree.count_edits(docs.withColumn("edits", edits), BYTE_BPE,
                                  public_tokenizers.PATTERN, edits_col="edits")


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprint_edits(_documents(spark, sf_dir))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.encode_documents(_documents(spark, sf_dir), BYTE_BPE,
                                     public_tokenizers.PATTERN)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels come from rows outside the held-out third only; text alone is scored."""
    docs = _documents(spark, sf_dir)
    labels = read_table(spark, sf_dir, "labels").filter(~toxicity.held_out())
    model = toxicity.fit_on(docs, labels)
    return toxicity.score(docs, model, ["doc_id"]).select(
        "doc_id", toxicity.held_out().alias("held_out"), "score",
        (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"))


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_groups(_documents(spark, sf_dir))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_documents(spark, sf_dir), WORD_BPE)


def op8_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    return html_content.extract(pages, ["page_id", "url"]).withColumn(
        "n_chars", F.char_length("text").cast("bigint"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(_documents(spark, sf_dir), keep="max").select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op10_record_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    folder = records.record_folder(docs)
    return records.read_records(records.write_records(docs, folder, WORD_BPE), folder)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read_table(spark, sf_dir, "embeddings"), 32)


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_passages(_documents(spark, sf_dir), read_table(
        spark, sf_dir, "benchmark")).select("doc_id", "n_words", "n_hit", "n_items",
                                            "items_sha256", "contaminated")


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.rank(_documents(spark, sf_dir), read_table(spark, sf_dir, "benchmark"))


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = f"regexp_extract_all({_LOWER.format('text')}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

_TERMS = f"regexp_extract_all({_LOWER.format('text')}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"

_ORACLE = {
    "op13_lexical_search": f"""
        WITH d AS (SELECT row_number() OVER () AS uid, doc_id, {_TERMS} AS terms FROM documents),
        all_docs AS (SELECT CAST(count(*) AS BIGINT) AS nd, CAST(sum(len(terms)) AS BIGINT) AS nt
                     FROM d WHERE len(terms) > 0),
        i AS (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark),
        wanted AS (SELECT item_id, term, count(*) AS times FROM i GROUP BY ALL),
        counts AS (SELECT uid, term, count(*) AS tf FROM (SELECT uid, unnest(terms) AS term FROM d)
                   WHERE term IN (SELECT term FROM wanted) GROUP BY ALL),
        weights AS (SELECT term, CAST(floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * count(*) + 1)))
                                      AS BIGINT) AS w
                    FROM counts, all_docs GROUP BY term, nd),
        scores AS (
            SELECT item_id, d.uid, d.doc_id, CAST(sum(times * w * ((1000000000 * tf) // (
                       1000 * tf + 12 * (75 + (25 * len(terms) * nd) // nt)))) AS BIGINT) AS score
            FROM wanted JOIN counts USING (term) JOIN weights USING (term) JOIN d USING (uid),
                 all_docs
            GROUP BY ALL),
        ranked AS (SELECT item_id, CAST(row_number() OVER (
                       PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER)
                       AS rank, doc_id, score
                   FROM scores WHERE score > 0)
        SELECT * FROM ranked WHERE rank <= 20""",
    "op12_decontamination": f"""
        WITH d AS (SELECT row_number() OVER () AS uid, doc_id, coalesce({_WORDS}, []) AS w
                   FROM documents),
        i AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_WORDS} AS w FROM benchmark),
        windows AS (
            SELECT DISTINCT item, n, array_to_string(w[p:p + n - 1], ' ') AS win
            FROM (SELECT item, w, least(len(w), 10) AS n,
                         unnest(range(1, len(w) - least(len(w), 10) + 2)) AS p
                  FROM i WHERE len(w) > 0)),
        places AS (
            SELECT uid, w, n, unnest(range(1, len(w) - n + 2)) AS p
            FROM d, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n),
        found AS (
            SELECT uid, p, item, windows.n
            FROM places JOIN windows ON windows.n = places.n
             AND win = array_to_string(w[p:p + places.n - 1], ' ')),
        hit AS (SELECT uid, count(DISTINCT q) AS n_hit
                FROM (SELECT uid, unnest(range(p, p + n)) AS q FROM found) GROUP BY uid),
        items AS (SELECT uid, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS s
                  FROM (SELECT DISTINCT uid, item FROM found) GROUP BY uid)
        SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit,
               coalesce(n_items, 0) AS n_items, coalesce(s, sha256('')) AS items_sha256,
               n_hit IS NOT NULL AS contaminated
        FROM d LEFT JOIN hit USING (uid) LEFT JOIN items USING (uid)""",
    "op9_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))""",
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_sharding, op2_token_counts, op3_fingerprints, op4_byte_bpe, op5_toxicity,
        op6_near_duplicates, op7_packing, op8_main_text, op9_exact_dedup, op10_record_files,
        op11_whitening, op12_decontamination, op13_lexical_search)}


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLE)

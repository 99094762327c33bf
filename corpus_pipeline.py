"""The corpus pipeline: toxic documents go, copies go, near copies go, the rest is packed.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; what it returns is written
as Parquet and reread as the next stage's ``docs``. All stages but the last return the columns
of ``documents``, whatever they are; their names are free, as the operators keep working columns
apart. Null texts count as empty, null and repeated ids are rows like any other, and an empty
table gives an empty result. Scratch tables of a stage called by hand stay until
``tables.release``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.llm import exact_dedup, neardup, packing, toxicity
from riskframe.llm.queries import TOXIC_FROM, WORD_BPE
from riskframe.llm.tables import Scratch, shared_folder, short_batches
from riskframe.sources.tables import read_table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity is below the threshold; labels outside the held-out third teach.

    Empty texts get the score of a text without terms. Without labelled rows nothing is learnt.
    """
    labels = read_table(spark, sf_dir, "labels").filter(~toxicity.held_out())
    model = toxicity.fit_on(docs, labels)
    scored = toxicity.score(docs, model, docs.columns, score_col="__toxicity")
    return scored.filter(F.col("__toxicity") < TOXIC_FROM).drop("__toxicity")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document per distinct text: the one with the largest id (of repeated rows one; a null
    id loses against any other). All empty and null texts are one text."""
    return exact_dedup.drop_exact(docs, keep="max")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document per class of near copies: the one with the least id (null ids last). Texts
    without any word are near copies of equal texts only."""
    return neardup.drop_near(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents that stay, with their sequences of 2048 tokens; an empty text
    is its end id."""
    return packing.pack_documents(docs, WORD_BPE)


STAGES = [("toxicity", drop_toxic), ("exact_dedup", drop_copies),
          ("near_dedup", drop_near_copies), ("packing", pack)]

#: A learned score and a hash-based search cannot be written as SQL; tests compare ``run`` with
#: a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last one.

    A stage's scratch tables go as soon as its result is stored; tables of other queries stay.
    """
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        scratch = Scratch(spark)
        with scratch:
            out = stage(spark, docs, sf_dir)
        path = shared_folder(spark, f"pipeline-{name}")
        with short_batches(spark):
            out.write.parquet(path)
        scratch.delete()
        docs = spark.read.schema(out.schema).parquet(path)
    return docs

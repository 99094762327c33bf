"""What a worker holds at once does not grow with a task's rows."""

import tracemalloc

import numpy as np
import pyarrow as pa

from riskframe.llm import neardup, tables, toxicity
from riskframe.llm.tables import map_arrow, release, short_batches, written

from helpers import odd_docs, prose

KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"


def test_written_tables_come_from_short_batches(spark):
    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64())], ["n"])

    before = spark.conf.get(KEY)
    df = map_arrow(spark.range(0, 5000, 1, 1), sizes, "n bigint")
    got = [r.n for r in written(df, "sizes").collect()]
    assert sum(got) == 5000 and max(got) <= tables.ROWS_PER_BATCH
    assert spark.conf.get(KEY) == before
    release(spark)


def test_a_smaller_limit_of_the_session_stays(spark):
    before = spark.conf.get(KEY)
    spark.conf.set(KEY, "7")
    try:
        with short_batches(spark):
            assert spark.conf.get(KEY) == "7"
        spark.conf.set(KEY, "0")  # Spark's way to say: no limit
        with short_batches(spark):
            assert spark.conf.get(KEY) == str(tables.ROWS_PER_BATCH)
    finally:
        spark.conf.set(KEY, before)


def _peak(run):
    tracemalloc.start()
    try:
        for _ in run():
            pass
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_blocks_of_texts_are_small():
    texts = [prose(i, 400) for i in range(1000)]  # some 2.6 million characters
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(len(texts)), pa.int64()), pa.array(texts)], ["uid", "body"])
    assert _peak(lambda: neardup._sign(4, 5, 5)(iter([batch]))) < 30
    machine = toxicity.FactorizationMachine(
        0.0, np.zeros(1 << toxicity.BITS, np.float32),
        np.zeros((1 << toxicity.BITS, 1), np.float32))
    assert _peak(lambda: (machine.score(texts[i:j]) for i, j in tables.byte_blocks(
        texts, toxicity.BLOCK_CHARS))) < 20


def test_a_text_among_the_columns_is_sent_once(spark):
    docs = odd_docs(spark)
    machine = toxicity.fit_on(docs, spark.createDataFrame(
        [(4, 1), (5, 0), (20, 1)], "doc_id bigint, toxic int"))
    both = toxicity.score(docs, machine, ["doc_id", "text"])
    assert "body" not in both._jdf.queryExecution().optimizedPlan().toString()
    alone = toxicity.score(docs.withColumnRenamed("text", "t"), machine, ["doc_id"], "t")
    assert (sorted((str(r.doc_id), r.score) for r in both.collect())
            == sorted((str(r.doc_id), r.score) for r in alone.collect()))

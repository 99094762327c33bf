"""The registered queries and the pipeline over the smallest tables, against brute force."""

import base64
import collections
import hashlib
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

import corpus_pipeline
from riskframe.llm import queries as Q
from riskframe.llm import toxicity
from riskframe.llm.tables import Scratch, written
from riskframe.llm.words import Words
from scripts.check_oracle import rows_of

from helpers import BYTE_BPE, SMALL, WORD_BPE, odd_docs


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(
        f"{SMALL}/documents.parquet").collect()}


@pytest.mark.parametrize("name", sorted(Q.queries()))
def test_query_covers_its_table(spark, name):
    table, key = {"op8_": ("pages", "page_id"), "op11": ("embeddings", "vec_id"),
                  "op13": ("benchmark", "item_id")}.get(name[:4], ("documents", "doc_id"))
    ids = {r[0] for r in spark.read.parquet(f"{SMALL}/{table}.parquet").select(key).collect()}
    df = Q.queries()[name](spark, SMALL)
    assert {r[0] for r in df.select(df.columns[0]).collect()} == ids


def test_oracles(spark):
    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    for name, sql in Q.oracle_sql().items():
        df, rel = Q.queries()[name](spark, SMALL), con.sql(sql)
        assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(
            rel.columns, rel.fetchall())


def test_packing_and_records_digest_the_library_ids(spark, docs):
    hf = Tokenizer.from_file(WORD_BPE)
    ids = {i: np.array([*hf.encode(t, add_special_tokens=False).ids, 1], "<u4")
           for i, t in docs.items()}
    at = 0
    got = {r.doc_id: r for r in Q.op10_record_files(spark, SMALL).collect()}
    for i in sorted(ids):
        assert tuple(got[i])[1:] == (at, len(ids[i]), zlib.crc32(ids[i].tobytes()))
        at += len(ids[i])
    total, seqs = 0, set()
    for r in Q.op7_packing(spark, SMALL).collect():
        part = ids[r.doc_id][r.start:r.start + r.length]
        assert r.ids_crc32 == zlib.crc32(part.tobytes()) and r.doc_tokens == len(ids[r.doc_id])
        total += r.length
        seqs.add(r.sequence_id)
    assert total == at and total / 2048 / len(seqs) > 0.97


def test_pipeline_stages(spark, docs):
    """Each stage against brute force on its own input; the pipeline against all of them."""
    source = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet").filter(~toxicity.held_out())
    model = toxicity.fit_on(source, labels)
    stay = {i: t for i, t in docs.items() if model.score([t])[0] < Q.TOXIC_FROM}
    by_text = {}
    for i, t in sorted(stay.items()):
        by_text[t] = i
    stay = {i: t for t, i in by_text.items()}
    sets = {i: set(Words([t]).shingles(5)[1].tolist()) for i, t in stay.items()}
    parent = {i: i for i in stay}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    marks = {}
    for i in sorted(stay):
        for j in sorted(stay):
            if j < i and sets[i] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    want = {find(i) for i in stay}
    got = collections.Counter()
    for r in corpus_pipeline.run(spark, SMALL).collect():
        got[r.doc_id] += r.length
    hf = Tokenizer.from_file(WORD_BPE)
    assert got == {i: len(hf.encode(docs[i], add_special_tokens=False).ids) + 1 for i in want}
    assert marks == {}


def test_token_queries_against_the_library(spark, docs):
    with open(BYTE_BPE, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    tik = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                            special_tokens={})
    ids = {i: tik.encode_ordinary(t) for i, t in docs.items()}
    for r in Q.op4_byte_bpe(spark, SMALL).collect():
        want = " ".join(map(str, ids[r.doc_id])).encode()
        assert tuple(r) == (r.doc_id, len(ids[r.doc_id]), hashlib.sha256(want).hexdigest(),
                            hashlib.sha256(docs[r.doc_id].encode()).hexdigest())
    got = Q.op2_token_counts(spark, SMALL)
    before = next(c for c in got.columns if "before" in c or c == "n_tokens")
    assert {r.doc_id: r[before] for r in got.collect()} == {i: len(x) for i, x in ids.items()}


def test_shards_of_the_query_fill_without_gaps(spark, docs):
    slots = collections.defaultdict(list)
    for r in Q.op1_sharding(spark, SMALL).collect():
        slots[r.shard].append(r.slot)
        assert r.grown_shard in (r.shard, 24)
        assert r.size == len(docs[r.doc_id].encode()) + 8
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and max(slots) <= 23


def test_pipeline_leaves_tables_of_other_results(spark):
    before = Q.op9_exact_dedup(spark, SMALL)
    with Scratch(spark) as scratch:
        written(spark.range(3).toDF("x"), "own")
    assert len(scratch.paths) == 1
    corpus_pipeline.run(spark, SMALL).count()
    scratch.delete()
    assert before.count() == spark.read.parquet(f"{SMALL}/documents.parquet").count()


def test_stages_stand_awkward_tables(spark):
    odd = odd_docs(spark, extra=True)
    for table in (odd.unionByName(odd), odd.limit(0)):
        texts = sorted({r.text or "" for r in table.collect()})
        for name, stage in corpus_pipeline.STAGES:
            got = stage(spark, table, SMALL)
            rows = got.collect()
            if name == "packing":
                assert sum(r.length for r in rows) >= table.count()
                continue
            assert got.columns == table.columns
            if name == "exact_dedup":
                assert sorted(r.text or "" for r in rows) == texts
            elif name == "toxicity":
                assert len(rows) == table.count()
            else:
                assert {r.text or "" for r in rows} <= set(texts) and bool(rows) == bool(texts)


def test_stage_columns(spark):
    source = spark.read.parquet(f"{SMALL}/documents.parquet").limit(40)
    docs = source
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, source, SMALL)
        assert docs.columns == source.columns
        assert docs.count() > 0
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup",
                                                      "packing"]


def test_hashes_of_fingerprint_query(spark, docs):
    ids = sorted(docs, reverse=True)
    nxt = dict(zip(ids, ids[1:] + ids[:1]))
    for r in Q.op3_fingerprints(spark, SMALL).collect():
        t = docs[r.doc_id]
        n = len(t) // 3
        assert r.edited_sha256 == hashlib.sha256(
            (t[:len(t) - n] + docs[nxt[r.doc_id]][:n]).encode()).hexdigest()

import collections
import hashlib
import zlib

import numpy as np
import pytest

from riskframe.llm import exact_dedup, sharding

from helpers import empty_docs, odd_docs


@pytest.mark.parametrize("keep", ["min", "max"])
def test_exact_groups_match_brute_force(spark, keep):
    df = odd_docs(spark, extra=True)
    src = [(r.doc_id, r.text or "") for r in df.collect()]
    groups = collections.defaultdict(list)
    for i, t in src:
        groups[t].append(i)
    got = exact_dedup.exact_groups(df, keep=keep).collect()
    assert len(got) == len(src)
    by_hash = {hashlib.sha256(t.encode()).hexdigest(): v for t, v in groups.items()}
    kept = collections.Counter()
    for r in got:
        ids = by_hash[r.text_sha256]
        known = [i for i in ids if i is not None]
        assert r.group_size == len(ids)
        assert r.keep_id == ((min if keep == "min" else max)(known) if known else None)
        if r.kept:
            kept[r.text_sha256] += 1
            assert r.doc_id == r.keep_id
    assert kept == {h: 1 for h in by_hash}


def test_drop_exact_keeps_columns_and_one_row_per_text(spark):
    df = odd_docs(spark, extra=True)
    got = exact_dedup.drop_exact(df, keep="max")
    assert got.columns == df.columns
    rows = got.collect()
    assert sorted((r.text or "") for r in rows) == sorted({(r.text or "") for r in df.collect()})
    assert all(r.kept == "kept" and r.h128 == "h128" and r["row"] == "row" for r in rows)


def test_exact_empty_table_and_no_python(spark):
    assert exact_dedup.exact_groups(empty_docs(spark)).collect() == []
    assert exact_dedup.drop_exact(empty_docs(spark)).collect() == []
    plan = exact_dedup.exact_groups(odd_docs(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def _jump(key, n):  # the published algorithm, one key at a time
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        j = int((b + 1) * ((1 << 31) / ((key >> 33) + 1)))
    return b


def test_jump_hash_matches_the_published_loop_and_moves_little():
    keys = np.random.default_rng(0).integers(0, 1 << 63, 3000).astype(np.uint64)
    for n in (1, 2, 7, 24, 1000):
        got = sharding.jump_hash(keys, n)
        assert got.tolist() == [_jump(int(k), n) for k in keys]
        grown = sharding.jump_hash(keys, n + 1)
        assert set(grown[grown != got].tolist()) <= {n}


def test_shards_of_odd_rows(spark):
    df = odd_docs(spark, extra=True)
    rows = sharding.assign_shards(df, 5).collect()
    src = collections.Counter((r.doc_id, len((r.text or "").encode()) + 8,
                               zlib.crc32((r.text or "").encode())) for r in df.collect())
    assert collections.Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == src
    slots = collections.defaultdict(list)
    for r in rows:
        slots[r.shard].append((r.slot, r.doc_id is not None, r.doc_id or 0, r.size))
        assert r.grown_shard in (r.shard, 5) and r.law == "key"
    for v in slots.values():
        v.sort()
        assert [s for s, *_ in v] == list(range(len(v)))
        assert [x[1:] for x in v] == sorted(x[1:] for x in v)  # slots follow the id's order
    assert sharding.assign_shards(empty_docs(spark), 5).collect() == []


def test_one_id_holding_a_third_of_the_rows(spark):
    df = spark.range(3000).selectExpr("if(id % 3 = 0, 7, id) as doc_id", "cast(id as string) text")
    rows = sharding.assign_shards(df.repartition(4), 4).collect()
    assert len(rows) == 3000 and len({r.shard for r in rows if r.doc_id == 7}) == 1
    for s in range(4):
        assert sorted(r.slot for r in rows if r.shard == s) == list(
            range(sum(r.shard == s for r in rows)))


def test_shard_is_that_of_the_id_as_text(spark):
    from pyspark.sql import functions as F
    ids = spark.range(500).withColumn("text", F.lit("x")).withColumn(
        "key", F.xxhash64(F.col("id").cast("string")))
    key = {r.id: r.key % (1 << 64) for r in ids.collect()}
    for kind in ("int", "bigint", "string"):
        got = sharding.assign_shards(ids.withColumn("id", F.col("id").cast(kind)), 24, "id")
        assert {(int(r.doc_id), r.shard, r.grown_shard) for r in got.collect()} == {
            (i, _jump(k, 24), _jump(k, 25)) for i, k in key.items()}

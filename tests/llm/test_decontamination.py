"""Benchmark passages against a brute-force search on short and awkward tables."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from riskframe.llm import decontaminate as D

from helpers import ODD, empty_docs, odd_docs

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items, window=10):
    out = []
    for doc_id, text in docs:
        w, hit, ids = words(text), set(), set()
        for item_id, item in items:
            v = words(item)
            n = min(window, len(v))
            for a in range(len(v) - n + 1 if v else 0):
                for p in range(len(w) - n + 1):
                    if w[p:p + n] == v[a:a + n]:
                        hit.update(range(p, p + n))
                        ids.add("" if item_id is None else str(item_id))
        out.append((doc_id, len(w), len(hit), len(ids),
                    hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def run(spark, docs, items, **settings):
    d = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    i = spark.createDataFrame(items, "item_id bigint, text string")
    return sorted((tuple(r)[:6] for r in D.find_passages(d, i, **settings).collect()), key=str)


@pytest.fixture(scope="module")
def tables():
    rng = random.Random(5)
    pool = ["ab", "Cd", "é", "x1", "Éa", "日本", "ab"]

    def text(n):
        return rng.choice([" ", ", ", "_", "\n"]).join(rng.choices(pool, k=n))

    items = [(i, text(rng.choice([1, 2, 4, 5, 7, 10, 11, 14]))) for i in range(12)]
    items += [(3, text(12)), (None, text(6)), (90, None), (91, ""), (92, "..."),
              (93, "ab " * 13), (94, items[5][1]), (95, items[5][1].upper())]
    docs = [(i, text(rng.randint(0, 60))) for i in range(25)]
    docs += [(100 + i, f"{text(4)} {t} {text(3)} {t}") for i, (_, t) in enumerate(items)]
    docs += [(7, None), (None, items[9][1]), (8, docs[8][1]), (8, docs[8][1]), (101, "ab " * 40)]
    return docs, items


@pytest.mark.parametrize("settings", [
    {}, {"broadcast_bytes": 0}, {"window": 4, "shingle": 4}, {"window": 6, "shingle": 1}])
def test_against_brute_force(spark, tables, settings):
    docs, items = tables
    want = brute(docs, items, settings.get("window", 10))
    assert sum(r[5] for r in want) > 10
    assert run(spark, docs, items, **settings) == want


def test_full_bitmap_only_adds_candidates(spark, tables, monkeypatch):
    monkeypatch.setattr(D, "LEAST_BITS", 64)
    monkeypatch.setattr(D, "MOST_BITS", 64)
    assert run(spark, *tables) == brute(*tables)


def test_empty_tables_and_odd_texts(spark):
    items = [(1, "z" * 700), (2, "İI ΑΣ"), (3, "日本語 テキスト"), (4, "w " * 12)]
    odd = [(r.doc_id, r.text) for r in odd_docs(spark).collect()]
    assert run(spark, odd, items) == brute(odd, items)
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert D.find_passages(empty_docs(spark), none).count() == 0
    got = D.find_passages(odd_docs(spark, extra=True), none).collect()
    assert len(got) == len(ODD) + 3 and not any(r.contaminated or r.n_items for r in got)


def test_drop_keeps_columns_and_clean_rows(spark):
    items = spark.createDataFrame([(1, " ".join(f"q{i}" for i in range(12)))],
                                  "item_id int, text string")
    leak = " ".join(f"q{i}" for i in range(1, 11))
    docs = spark.createDataFrame([(1, leak, 5), (1, "clean", 6), (None, None, 7), (2, leak, 8)],
                                 "uid int, text string, spans int")
    got = D.drop_contaminated(docs, items)
    assert got.columns == docs.columns
    assert sorted(r.spans for r in got.collect()) == [6, 7]
    some = D.drop_contaminated(docs.withColumn("text", F.concat("text", F.lit(" and" * 90))),
                               items, most_share=0.5)
    assert some.count() == 4


def test_spans(spark):
    v = [f"q{i}" for i in range(12)]
    d = spark.createDataFrame([(1, "a b " + " ".join(v))], "doc_id int, text string")
    i = spark.createDataFrame([(1, " ".join(v))], "item_id int, text string")
    row = D.find_passages(d, i).first()
    assert [(s.start, s.stop) for s in row.spans] == [(2, 12), (3, 13), (4, 14)]
    assert row.n_hit == 12


def test_no_python_in_the_plan(spark, tables):
    docs, items = tables
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    i = spark.createDataFrame(items, "item_id bigint, text string")
    plan = D.find_passages(d, i)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan

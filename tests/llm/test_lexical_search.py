"""Ranked search against a plain scorer over small and awkward tables."""

import collections
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from riskframe.llm import lexical_search as S

from helpers import LONG, ODD, empty_docs, odd_docs, prose

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_terms(text):
    return [t.translate(LOWER) for t in TERM.findall(text or "")]


def brute(docs, items, k):
    counts = [(i, collections.Counter(plain_terms(t))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    n_docs, n_terms = len(counts), sum(sum(c.values()) for _, c in counts)
    df = collections.Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        rows = []
        for i, c in counts:
            m = 75 + (25 * sum(c.values()) * n_docs) // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    * ((10 ** 9 * c[t]) // (1000 * c[t] + 12 * m))
                    for t in plain_terms(text) if c[t])
            if s > 0:
                rows.append((-s, i is None, i or 0))
        out += [(item, r + 1, None if null else i, -s)
                for r, (s, null, i) in enumerate(sorted(rows)[:k])]
    return sorted(out, key=str)


def run(spark, docs, items, k, **settings):
    d = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    i = spark.createDataFrame(items, "item_id bigint, text string")
    return sorted((tuple(r) for r in S.rank(d, i, k, **settings).collect()), key=str)


def test_terms():
    for t in [*ODD, LONG, "A_b-C9 É\x85x\xa0y Ⅷ"]:
        assert [x.decode() for x in S.terms(t or "")] == plain_terms(t)


@pytest.fixture(scope="module")
def tables():
    rng = random.Random(8)
    pool = [f"t{i}" for i in range(90)] + ["The", "the", "É", "x_y"]
    weights = [1 / (i + 1) for i in range(len(pool))]

    def text(n):
        return " ".join(rng.choices(pool, weights, k=n))

    docs = [(i, text(rng.randint(0, 80))) for i in range(160)]
    docs += [(500 - i, docs[5][1]) for i in range(40)]  # ties, ids falling
    docs += [(None, docs[5][1]), (7, docs[7][1]), (900, None), (901, "..."), (902, text(900))]
    items = [(i, text(rng.choice([1, 3, 8, 20]))) for i in range(12)]
    items += [(20, docs[5][1]), (21, None), (22, ""), (23, "nowhere"), (None, text(5)),
              (24, " ".join(pool)), (25, items[3][1]), (3, items[3][1]), (26, "t1 t1 t1 t0")]
    return docs, items


@pytest.mark.parametrize("k, settings", [(20, {}), (1, {"block_bytes": 60}), (500, {})])
def test_against_brute_force(spark, tables, k, settings):
    assert run(spark, *tables, k, **settings) == brute(*tables, k)


def test_many_blocks_of_documents(spark, tables, monkeypatch):
    """State carries over blocks; wide queries have masks of more than 64 bits."""
    docs, items = tables
    vocabulary = {t: i for i, t in enumerate(sorted({x for _, b in items for x in S.terms(b or "")}))}
    rows = [(i, collections.Counter(S.terms(t or ""))) for i, t in docs]
    rows = [(i, c) for i, c in rows if c]
    n_terms = sum(sum(c.values()) for _, c in rows)
    df = collections.Counter(t for _, c in rows for t in c)
    want = collections.defaultdict(list)
    for item, rank, i, s in sorted(brute(docs, items, 20), key=lambda r: (str(r[0]), r[1])):
        want[item].append((s, i))
    evaluated = 0
    for item, text in items[:12] + [(24, items[17][1])]:
        counts = collections.Counter(t for t in S.terms(text) if df[t])
        query = S.Query(0, np.array([vocabulary[t] for t in counts]), np.array(
            [c * S.term_weight(len(rows), df[t]) for t, c in counts.items()], np.int64), [])
        for at in range(0, len(rows), 50):
            part = [(i, sum(c.values()), [(vocabulary[t], x) for t, x in c.items()
                                          if t in vocabulary]) for i, c in rows[at:at + 50]]
            flat = [p for *_, ps in part for p in ps]
            block = S.DocBlock(pa.array([i for i, *_ in part], pa.int64()),
                               np.array([n for _, n, _ in part]),
                               np.array([t for t, _ in flat], np.int64),
                               np.array([x for _, x in flat], np.int64),
                               np.cumsum([0] + [len(ps) for *_, ps in part]), len(rows), n_terms,
                               len(vocabulary))
            evaluated += S.search_block(block, query, 20, batch=4)
        got = [(-s, i) for s, _, i in query.best]
        if item != 3:  # asked twice
            assert got == want[item]
    assert evaluated < 0.9 * 13 * len(rows)  # groups below the bound are left out


def test_bounds_hold_scores():
    rng = np.random.default_rng(3)
    sizes = rng.integers(0, 30, 200)
    term = np.concatenate([rng.choice(100, s, replace=False) for s in sizes])
    block = S.DocBlock(pa.array(range(200)), rng.integers(30, 90, 200), term,
                       rng.integers(1, 9, len(term)), np.cumsum([0, *sizes]), 200, 12_000, 100)
    query = S.Query(0, np.arange(0, 90), rng.integers(1, 9000, 90), [])
    masks = block.masks(query.term)
    distinct, group = S._groups(masks)
    bound = S._bounds(distinct, query.weight * block.most[query.term])
    has = np.flatnonzero(group >= 0)
    score = block.scores(has, query)
    assert (score <= bound[group[has]]).all() and (score > 0).all()
    assert (masks[group < 0] == 0).all()


def test_empty_tables_and_odd_texts(spark):
    items = spark.createDataFrame([(i, t) for i, t in enumerate(ODD)],
                                  "item_id int, text string")
    none = spark.createDataFrame([], "item_id int, text string")
    assert S.rank(empty_docs(spark), items).count() == 0
    assert S.rank(odd_docs(spark), none).count() == 0
    docs = odd_docs(spark, extra=True)
    got = sorted((tuple(r) for r in S.rank(docs, items, 5).collect()), key=str)
    assert got == brute([(r.doc_id, r.text) for r in docs.collect()], list(enumerate(ODD)), 5)


def test_text_ids(spark):
    docs = spark.createDataFrame([(f"d{i}", prose(1, 5)) for i in range(30)] + [(None, prose(1, 5))],
                                 "doc_id string, text string")
    docs = docs.unionByName(spark.createDataFrame([("z", "other words here")] * 70, docs.schema))
    items = spark.createDataFrame([(1, prose(1, 9))], "item_id int, text string")
    got = S.rank(docs, items, 31).orderBy("rank").collect()
    assert [r.doc_id for r in got] == [*sorted(f"d{i}" for i in range(30)), None]

import collections
import random

import numpy as np
import pytest

from riskframe.llm import neardup
from riskframe.llm.words import Words, counted

from helpers import LONG, empty_docs, odd_docs, prose


def jaccard(a, b):
    x, y = (set(Words([t]).shingles(5)[1].tolist()) for t in (a, b))
    return len(x & y) / len(x | y) if x | y else float(a == b)


def classes(docs, threshold=0.8):
    """Brute force over all pairs: least id of the connected component."""
    parent = {i: i for i, _ in docs}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, a) in enumerate(docs):
        for j, b in docs[:k]:
            if jaccard(a, b) >= threshold:
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i, _ in docs}


def edited(text, share, seed):
    rng, w = random.Random(seed), text.split()
    for i in rng.sample(range(len(w)), int(len(w) * share)):
        w[i] = f"edit{seed}x{i}"
    return " ".join(w)


def probability_jaccard(a, b):
    ca, cb = collections.Counter(a), collections.Counter(b)
    every = set(ca) | set(cb)
    return sum(1 / sum(max(ca[e] / ca[d], cb[e] / cb[d]) for e in every)
               for d in set(ca) & set(cb))


def test_signatures_estimate_probability_jaccard():
    a = ["x", "x", "x", *"abcdefghijklmnop", "y", "y"]
    b = ["x", *"abcdefghijkl", "y", "y", "y", "q", "r"]
    value = {w: np.uint64(i * 7919 + 11) for i, w in enumerate(sorted(set(a + b)))}
    doc, val, n = [], [], []
    for k, words in enumerate((a, b)):
        for w, c in collections.Counter(words).items():
            doc.append(k), val.append(value[w]), n.append(c)
    sig = neardup.prob_minhash(np.array(doc), np.array(val, np.uint64), np.array(n), 2, 20_000)
    assert abs((sig[0] == sig[1]).mean() - probability_jaccard(a, b)) < 0.012


def test_signature_does_not_depend_on_the_block():
    texts = [prose(i, n) for i, n in enumerate((3, 5, 50, 700, 0, 9))]
    whole = neardup.text_signatures(texts, 24, 5, 5)
    for i, t in enumerate(texts):
        mark, keys = neardup.text_signatures([t], 24, 5, 5)
        assert mark[0] == whole[0][i]
        assert (keys[0] is None and whole[1][i] is None) or (keys[0] == whole[1][i]).all()


def test_shingles_match_a_plain_loop():
    texts = ["One two, three four FIVE six", "one two", "", "?!", "a b c d e", prose(4, 30)]
    w = Words(texts)
    doc, value, count = counted(*w.shingles(5))
    sizes = np.bincount(doc, minlength=len(texts)).tolist()
    assert sizes == [2, 1, 0, 0, 1, 26]
    same = Words(["one TWO three; four five six"]).shingles(5)[1]
    assert sorted(same.tolist()) == sorted(value[doc == 0].tolist())


@pytest.mark.parametrize("centers", [256, 1])
def test_classes_equal_brute_force(spark, centers):
    docs, base = [], [prose(100 + i, 120) for i in range(6)]
    for k, t in enumerate(base):
        docs += [(len(docs) + j, edited(t, share, 10 * k + j)) for j, share in
                 enumerate((0, 0.01, 0.02, 0.03, 0.05, 0.08))]
    chain = prose(500, 200).split()  # each link is near its neighbour, the ends are far apart
    for s in range(8):
        docs.append((len(docs), " ".join(chain[s * 8:s * 8 + 130])))
    docs += [(len(docs), base[0]), (len(docs) + 1, base[0].upper().replace(" ", ", "))]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4)
    got = {r.doc_id: r for r in neardup.near_groups(df, centers=centers).collect()}
    want = classes(docs)
    assert {i: r.class_id for i, r in got.items()} == want
    sizes = collections.Counter(want.values())
    assert all(r.class_size == sizes[r.class_id] and r.kept == (r.doc_id == r.class_id)
               for r in got.values())


def test_classes_equal_brute_force_where_repeats_are_uneven(spark):
    docs = []
    for k in range(6):  # the same article with a line twice, or many times, or edited as well
        line, text = prose(900 + k, 12), prose(800 + k, 200)
        for j, n in enumerate((2, 20, 40, 80)):
            docs.append((len(docs), f"{text} " + f"{line} " * n))
            docs.append((len(docs), f"{edited(text, 0.015, 10 * k + j)} " + f"{line} " * n))
    want = classes(docs)
    assert set(want.values()) == set(range(0, 48, 8))
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4)
    assert {r.doc_id: r.class_id for r in neardup.near_groups(df).collect()} == want


def test_uneven_repeats_have_bands_of_the_set_and_of_the_counts():
    line, text = prose(1, 12), prose(2, 200)
    two, many, even = neardup.text_signatures(
        [f"{text} " + f"{line} " * 2, f"{text} " + f"{line} " * 80, text], 24, 5, 5)[1]
    assert len(even) == 24 < len(many) <= 48 and len(np.unique(many)) == len(many)
    assert len(np.intersect1d(two, many)) >= 24


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    got = {r.uid: r.comp for r in neardup.components(
        spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)}


def test_odd_rows(spark):
    df = odd_docs(spark, extra=True)
    rows = neardup.near_groups(df).collect()
    assert len(rows) == df.count()
    by = collections.defaultdict(list)
    for r in rows:
        by[r.class_id].append(r)
    assert all(sum(r.kept for r in v) == 1 and len(v) == v[0].class_size for v in by.values())
    ids = {r.doc_id: r.class_id for r in rows}
    assert ids[0] == ids[1] == 0 and ids[2] == 2 and ids[18] == ids[19] == 18
    left = neardup.drop_near(df)
    assert left.columns == df.columns and left.count() == len(by)
    assert all(r.uid == "uid" and r.kept == "kept" for r in left.collect())


def test_empty_table_and_repeated_long_rows(spark):
    assert neardup.near_groups(empty_docs(spark)).collect() == []
    assert neardup.drop_near(empty_docs(spark)).collect() == []
    df = spark.createDataFrame([(1, LONG)] * 3 + [(1, edited(LONG, 0.01, 3))],
                               "doc_id bigint, text string")
    rows = neardup.near_groups(df).collect()
    assert [r.class_id for r in rows] == [1] * 4 and sum(r.kept for r in rows) == 1

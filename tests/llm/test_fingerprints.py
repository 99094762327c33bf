import hashlib

from pyspark.sql import functions as F

from riskframe.llm import fingerprint

from helpers import empty_docs, odd_docs, prose


def shingles(t):
    w = t.lower().split()
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_estimates_against_exact_sets(spark):
    a, b = prose(1, 900), prose(1, 900)[:4000] + " " + prose(2, 300)
    A, B = shingles(a), shingles(b)
    sa, sb = (fingerprint.sketch(F.col(c), 256) for c in "ab")
    df = spark.createDataFrame([(a, b)], "a string, b string").select(sa.alias("x"), sb.alias("y"))
    x, y = F.col("x"), F.col("y")
    r = df.select(fingerprint.resemblance(x, y, 256).alias("r"),
                  fingerprint.containment(y, x, 256).alias("c"),
                  fingerprint.distinct_shingles(x, 256).alias("n")).first()
    assert abs(r.r - len(A & B) / len(A | B)) < 0.12
    assert abs(r.c - len(A & B) / len(B)) < 0.2
    assert abs(r.n / len(A) - 1) < 0.25


def test_merged_parts_equal_the_whole(spark):
    parts = [prose(i, 60) for i in range(5)]
    df = spark.createDataFrame([(1, p) for p in parts], "g int, text string").select(
        "g", fingerprint.sketch(F.col("text"), 64).alias("sketch"))
    whole = sorted({v for r in df.collect() for v in r.sketch})[:64]
    assert fingerprint.merge_groups(df, ["g"], k=64).first().sketch == whole
    two = df.limit(2).collect()
    both = spark.createDataFrame([(two[0].sketch, two[1].sketch)], "x array<long>, y array<long>")
    assert both.select(fingerprint.merged(F.col("x"), F.col("y"), 64)).first()[0] == sorted(
        {*two[0].sketch, *two[1].sketch})[:64]


def test_fingerprint_edits_brute_force(spark):
    rows = [(i * 3, t) for i, t in enumerate([prose(7, 50), "", None, "ab", "é ü ß x y z q w",
                                              prose(8, 300), prose(8, 300), "a b c d e f"])]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("body", F.lit(1))
    by_id = sorted(((i, t or "") for i, t in rows), reverse=True)
    for parts in (1, 2, 5):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        try:
            got = {r.doc_id: r for r in fingerprint.fingerprint_edits(df).collect()}
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", 8)
        assert len(got) == len(rows)
        for (i, t), (_, nxt) in zip(by_id, by_id[1:] + by_id[:1]):
            n = len(t) // 3
            edited = t[:len(t) - n] + nxt[:n]
            r = got[i]
            assert r.n_chars == len(t)
            assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
            for est, (x, y) in ((r.near_edited, (t, edited)), (r.near_next, (t, nxt))):
                X, Y = shingles(x), shingles(y)
                assert abs(est - (len(X & Y) / len(X | Y) if X | Y else 1.0)) < 0.15
        assert got[15].fingerprint == got[18].fingerprint != got[0].fingerprint


def test_odd_rows_empty_table_and_no_python(spark):
    df = odd_docs(spark, extra=True)
    out = fingerprint.fingerprint_edits(df)
    rows = out.collect()
    assert len(rows) == df.count()
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    assert fingerprint.fingerprint_edits(empty_docs(spark)).collect() == []
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_single_row_follows_itself(spark):
    df = spark.createDataFrame([(5, "one two three four five six")], "doc_id bigint, text string")
    r = fingerprint.fingerprint_edits(df).first()
    t = "one two three four five six"
    assert r.near_next == 1.0
    assert r.edited_sha256 == hashlib.sha256((t[:-9] + t[:9]).encode()).hexdigest()


def test_groups_of_empty_sketches_stay(spark):
    df = spark.createDataFrame([("a", [3, 1], 1), ("a", [2, 1], 1), ("b", [], 1), ("c", None, 1),
                                (None, [5], 1)], "value string, sketch array<bigint>, rank int")
    got = fingerprint.merge_groups(df, ["value", "rank"], k=2)
    assert got.columns == ["value", "rank", "sketch"]
    assert {r.value: r.sketch for r in got.collect()} == {
        "a": [1, 2], "b": [], "c": [], None: [5]}

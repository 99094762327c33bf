"""Near-duplicate classes by ProbMinHash over weighted word shingles (Ertl, 2020).

Signature: every distinct shingle of a text, weighted by its count, emits arrivals of a Poisson
process whose rate is the weight; each arrival falls on a random component, and a component
keeps the shingle that arrives first. A shingle stops as soon as its next arrival comes after
all components of the text are taken. The share of equal components estimates the probability
Jaccard similarity of two texts. Bands of components that agree make candidates, and candidates
are verified by the exact Jaccard similarity of their shingle sets. With weight 1 per distinct
shingle the probability Jaccard similarity is that of the sets, so every text has the bands of
this signature, and a text whose shingles repeat unevenly has those of its counts besides. Both
share their buckets: where repeats are even the two signatures are one.

From candidates to classes, without listing all pairs of a bucket:

1. texts with the same words are one node (a copied group is one node, whatever its size);
2. in every bucket each node is compared with the bucket's first node (its star);
3. components of the verified links; buckets inside one component are settled;
4. in the others, nodes outside the largest component (up to ``centers`` per bucket and round)
   are compared with all nodes of other components, then leave the bucket; back to 3.

When no bucket is left, every pair that shared a bucket was compared or lies in one class, so no
link is lost. In step 4 a bucket's nodes are dealt into blocks of about ``centers`` nodes, every
block gets the round's chosen nodes and compares them in memory by an index of their shingles:
a round moves about twice a bucket's rows, however large, and emits links of components alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskframe.llm.tables import byte_blocks, forget, map_arrow, ship_package, written
from riskframe.llm.words import Words, counted, mix, unit

GOLDEN = np.uint64(0x9E3779B97F4A7C15)
BLOCK_CHARS = 1 << 18  # a block's numbers take some sixty bytes a character


def prob_minhash(doc: np.ndarray, value: np.ndarray, weight: np.ndarray, n_docs: int,
                 components: int) -> np.ndarray:
    """(n_docs, components) signature of distinct weighted (doc, value) pairs; docs ascend.

    All texts of a block advance together; each step draws several arrivals per active shingle
    (arrivals past the end change nothing) and drops the shingles that are done.
    """
    best = np.full(n_docs * components, np.inf)
    sig = np.zeros(n_docs * components, np.uint64)
    last = np.full(n_docs, np.inf)
    time = np.zeros(len(value))
    doc, value, weight = doc.astype(np.int64), value, weight.astype(np.float64)
    drawn = np.uint64(0)
    while len(value):
        steps = int(np.clip(60_000 // len(value), 1, 256))
        k = drawn + np.arange(1, steps + 1, dtype=np.uint64)
        drawn += np.uint64(steps)
        draw = mix(value[:, None] + k * GOLDEN)
        arrival = time[:, None] + np.cumsum(-np.log(unit(draw)), 1) / weight[:, None]
        slot = doc[:, None] * components + (mix(draw) % np.uint64(components)).astype(np.int64)
        early = arrival < best[slot]
        at, when = slot[early], arrival[early]
        # Written latest first, so the earliest arrival of a component stays.
        order = np.argsort(-when, kind="stable")
        best[at[order]] = when[order]
        sig[at[order]] = np.broadcast_to(value[:, None], early.shape)[early][order]
        time = arrival[:, -1]
        touched = np.unique(doc)
        last[touched] = best.reshape(n_docs, components)[touched].max(1)
        go = time < last[doc]
        doc, value, weight, time = doc[go], value[go], weight[go], time[go]
    return sig.reshape(n_docs, components)


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """(n_docs, bands) 64-bit bucket keys; equal keys mean the same band with equal rows."""
    key = np.broadcast_to(mix(np.arange(1, bands + 1, dtype=np.uint64)), (len(sig), bands)).copy()
    for r in range(rows):
        key = mix(key * GOLDEN + sig[:, r:bands * rows:rows])
    return key.view(np.int64)


def text_signatures(texts: list[str], bands: int, rows: int, words: int
                    ) -> tuple[list[bytes], list[np.ndarray | None]]:
    """Per text: 128-bit hash of its words (of its bytes if it has none), band keys or None.

    ``bands`` keys of its shingle set; of uneven counts up to as many more, none twice.
    """
    w = Words(texts)
    doc, value, count = counted(*w.shingles(words))
    keys = list(band_keys(prob_minhash(doc, value, np.ones(len(value)), len(texts), bands * rows),
                          bands, rows))
    uneven = np.unique(doc[count != count[np.searchsorted(doc, doc)]])
    pick = np.isin(doc, uneven)
    weighted = prob_minhash(np.searchsorted(uneven, doc[pick]), value[pick], count[pick],
                            len(uneven), bands * rows)
    for i, more in zip(uneven, band_keys(weighted, bands, rows)):
        keys[i] = np.unique(np.concatenate((keys[i], more)))
    raw = w.hash.tobytes()
    marks, out = [], []
    for i, t in enumerate(texts):
        lo, n = int(w.first[i]), int(w.count[i])
        marks.append(hashlib.md5(raw[8 * lo:8 * (lo + n)] if n
                                 else b"\0" + t.encode("utf-8", "surrogatepass")).digest())
        out.append(keys[i] if n else None)
    return marks, out


def _sign(bands: int, rows: int, words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bodies = b.column("body").to_pylist()
            for i, j in byte_blocks(bodies, BLOCK_CHARS):
                marks, keys = text_signatures(bodies[i:j], bands, rows, words)
                part = b.slice(i, j - i)
                yield pa.RecordBatch.from_arrays(
                    [part.column("uid"), pa.array(marks, pa.binary()),
                     pa.array(keys, pa.list_(pa.int64()))], ["uid", "mark", "keys"])

    return run


def _shingle_sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bodies = b.column("body").to_pylist()
            for i, j in byte_blocks(bodies, BLOCK_CHARS):
                doc, value, _ = counted(*Words(bodies[i:j]).shingles(words))
                cut = np.searchsorted(doc, np.arange(j - i + 1))
                yield pa.RecordBatch.from_arrays(
                    [b.column("uid").slice(i, j - i),
                     pa.array([value[s:e].tobytes() for s, e in zip(cut, cut[1:])],
                              pa.binary())], ["uid", "shingles"])

    return run


def _similar(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for x, y in zip(b.column("sa"), b.column("sb")):
                p = np.frombuffer(x.as_buffer(), np.uint64)
                q = np.frombuffer(y.as_buffer(), np.uint64)
                if min(len(p), len(q)) < threshold * max(len(p), len(q)):
                    keep.append(False)
                    continue
                both = np.sort(np.concatenate((p, q)), kind="stable")
                same = int((both[1:] == both[:-1]).sum())
                keep.append(same >= threshold * (len(p) + len(q) - same) - 1e-9)
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column("a").filter(mask),
                                              b.column("b").filter(mask)], ["a", "b"])

    return run


def _compare_block(threshold: float):
    """Links between the chosen nodes and the others of one block of one bucket, once per pair
    of components."""

    def run(table: pa.Table) -> pa.Table:
        chosen = np.array(table.column("chosen").to_pylist(), bool)
        comp = table.column("comp").to_numpy()
        sets = [np.frombuffer(x, np.uint64) for x in table.column("shingles").to_pylist()]
        rows = np.flatnonzero(~chosen)
        size = np.array([len(sets[i]) for i in rows], np.int64)
        value = np.concatenate([np.zeros(0, np.uint64), *[sets[i] for i in rows]])
        order = np.argsort(value, kind="stable")
        value, owner = value[order], np.repeat(np.arange(len(rows)), size)[order]
        links = set()
        for c in np.flatnonzero(chosen):
            lo = np.searchsorted(value, sets[c], "left")
            n = np.searchsorted(value, sets[c], "right") - lo
            hit = owner[np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())]
            same = np.bincount(hit, minlength=len(rows))
            near = same >= threshold * (len(sets[c]) + size - same) - 1e-9
            for other in np.unique(comp[rows[near]]).tolist():
                if other != comp[c]:
                    links.add((min(other, int(comp[c])), max(other, int(comp[c]))))
        a, b = zip(*sorted(links)) if links else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def components(edges: DataFrame) -> DataFrame:
    """(uid, comp) of every node of the undirected ``edges`` (a, b): comp is its least node.

    Labels spread to neighbours and jump to their own label's label, so the number of rounds is
    logarithmic for long chains; every round is written, which cuts the lineage.
    """
    both = written(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "near-edges")
    labels = written(both.groupBy(F.col("a").alias("uid"))
                     .agg(F.least(F.min("b"), F.first("a")).alias("comp")), "near-labels")
    while True:
        near = (both.join(labels.select(F.col("uid").alias("b"), "comp"), "b")
                .groupBy(F.col("a").alias("uid")).agg(F.min("comp").alias("near")))
        step = labels.join(near, "uid").select(
            "uid", F.col("comp").alias("old"), F.least("comp", "near").alias("comp"))
        up = step.select(F.col("uid").alias("comp"), F.col("comp").alias("up"))
        done = labels
        step = written(step.join(up, "comp", "left").select(
            "uid", "old", F.least("comp", F.coalesce("up", "comp")).alias("comp")), "near-labels")
        labels = step.select("uid", "comp")
        labels.scratch_path = step.scratch_path
        forget(done)
        if step.filter("comp <> old").isEmpty():
            forget(both)
            return labels


def near_rows(docs: DataFrame, text_col: str = "text", threshold: float = 0.8, words: int = 5,
              bands: int = 24, rows: int = 5, centers: int = 512) -> DataFrame:
    """One row per input row: ``uid``, ``row`` (all input columns as a struct), ``class_uid``.

    Rows of one class share ``class_uid`` (the least uid of the class): texts with the same
    words, and texts linked by similarities of ``threshold`` or more. Null texts count as empty;
    texts without any word join only exact copies of themselves; texts of fewer than ``words``
    words are one shingle. Input columns sit inside ``row``, so their names are free. An empty
    table gives an empty result.
    """
    base = written(docs.select(
        F.monotonically_increasing_id().alias("uid"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")), "near-rows")
    texts = base.select("uid", F.coalesce(F.col("row").getField(text_col).cast("string"),
                                          F.lit("")).alias("body"))
    signed = written(map_arrow(texts, _sign(bands, rows, words),
                               "uid bigint, mark binary, keys array<bigint>"), "near-signed")

    # 1. One node per distinct word sequence: its least uid.
    nodes = written(signed.groupBy("mark").agg(F.min("uid").alias("node")), "near-marks")
    of_node = written(signed.select("uid", "mark").join(nodes, "mark").select("uid", "node"),
                      "near-nodes")
    forget(nodes)
    heads = of_node.filter("uid = node").select("uid")

    # 2. Buckets of at least two nodes, and the star of each.
    spread = signed.select("uid", "keys").join(heads, "uid", "left_semi").select(
        "uid", F.explode("keys").alias("key"))
    sizes = (spread.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("uid").alias("first"))
             .filter("n > 1").select("key", "first"))
    buckets = written(spread.join(sizes, "key").select("key", "uid", "first"), "near-buckets")
    forget(signed)
    sets = written(map_arrow(
        texts.join(buckets.select("uid").distinct(), "uid", "left_semi"),
        _shingle_sets(words), "uid bigint, shingles binary"), "near-sets")

    def verified(pairs: DataFrame) -> DataFrame:
        sa = sets.select(F.col("uid").alias("a"), F.col("shingles").alias("sa"))
        sb = sets.select(F.col("uid").alias("b"), F.col("shingles").alias("sb"))
        joined = pairs.join(sa, "a").join(sb, "b").select("a", "b", "sa", "sb")
        return written(map_arrow(joined, _similar(threshold), "a bigint, b bigint"),
                       "near-links")

    links = verified(buckets.filter("uid <> first").select(
        F.col("first").alias("a"), F.col("uid").alias("b")).distinct())
    comps = components(links)
    forget(links)

    # 3 and 4. Buckets that span components, until none is left.
    open_rows = buckets.select("key", "uid")
    while True:
        placed = open_rows.join(comps, "uid", "left").select(
            "key", "uid", F.coalesce("comp", "uid").alias("comp"))
        mixed = (placed.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"),
                                           F.count(F.lit(1)).alias("n"))
                 .filter("lo <> hi").select("key", "n"))
        placed = written(placed.join(mixed, "key"), "near-open")
        if placed.isEmpty():
            forget(placed)
            break
        parts = placed.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("m"))
        largest = parts.groupBy("key").agg(
            F.max(F.struct("m", "comp")).getField("comp").alias("largest"))
        rank = Window.partitionBy("key").orderBy("m", "comp", "uid")
        chosen = written(placed.join(parts.join(largest, "key").filter("comp <> largest"),
                                     ["key", "comp"])
                         .withColumn("rank", F.row_number().over(rank))
                         .filter(F.col("rank") <= centers).select("key", "uid", "comp", "n"),
                         "near-chosen")
        blocks = F.ceil(F.col("n") / centers).cast("int")
        sides = (placed.select("key", "uid", "comp", F.lit(False).alias("chosen"),
                               F.pmod(F.xxhash64("uid"), blocks).cast("int").alias("block"))
                 .unionByName(chosen.select(
                     "key", "uid", "comp", F.lit(True).alias("chosen"),
                     F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"))))
        ship_package(docs.sparkSession)
        found = written(sides.join(sets, "uid").groupBy("key", "block").applyInArrow(
            _compare_block(threshold), "a bigint, b bigint").distinct(), "near-links")
        joined = components(found)  # of components, which are named by their least nodes
        merged = written(comps.join(joined.select(F.col("uid").alias("comp"),
                                                  F.col("comp").alias("up")), "comp", "left")
                         .select("uid", F.coalesce("up", "comp").alias("comp"))
                         .unionByName(joined.join(comps, "uid", "left_anti")), "near-comps")
        open_rows = written(placed.join(chosen, ["key", "uid"], "left_anti")
                            .select("key", "uid"), "near-left")
        forget(comps, found, joined, placed, chosen)
        comps = merged

    forget(sets, buckets)
    classes = of_node.join(comps.withColumnRenamed("uid", "node"), "node", "left").select(
        "uid", F.coalesce("comp", "node").alias("class_uid"))
    return base.select("uid", "row").join(classes, "uid")


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                **params) -> DataFrame:
    """One row per input row: id, ``class_id`` (least id of its class), ``class_size``, ``kept``.

    Exactly one row of a class is kept: the one with the least id (null ids last; of repeated
    rows the first in the input). Parameters as in :func:`near_rows`.
    """
    got = near_rows(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")),
                    "text", **params).select("uid", F.col("row.doc_id").alias("doc_id"),
                                             "class_uid")
    got = written(got, "near-classes")
    heads = got.groupBy("class_uid").agg(
        F.count(F.lit(1)).alias("class_size"),
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "uid")).alias("head"))
    return (got.join(heads, "class_uid")
            .select("doc_id", F.col("head.doc_id").alias("class_id"), "class_size",
                    (F.col("uid") == F.col("head.uid")).alias("kept")))


def drop_near(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              **params) -> DataFrame:
    """The kept row of every class with all of its columns (see :func:`near_groups`)."""
    got = near_rows(docs, text_col, **params)
    heads = got.select("uid", "class_uid", F.col("row").getField(id_col).alias("doc_id")).groupBy(
        "class_uid").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "uid"))
                         .alias("head")).select(F.col("head.uid").alias("uid"))
    return got.join(heads, "uid", "left_semi").select("row.*")

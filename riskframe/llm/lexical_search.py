"""Ranked lexical search by groups of documents that hold the same terms of a query.

For one query a document's *presence mask* has a bit per query term. The terms' bitmaps over a
block of documents are combined into these masks; documents with equal masks form a group, whose
scores cannot exceed the sum, over the mask's terms, of the weight times the largest share that
the term reaches in the block. Groups are evaluated by falling bound, and a query is finished
when the next bound is below its k-th best score so far: no document of the rest can enter.

1. One scan of the texts writes, per document, its length and the counts of the terms that some
   query has (the postings). Queries come in blocks of bounded size, one scan for each block.
2. The postings give document counts; weights go to the tasks with the block of queries.
3. Every task runs all queries of the block over its documents, keeping k per query across its
   blocks; Spark merges the tasks' lists in two steps, so no task gets all of them.

Scores are whole numbers, so the result does not depend on the order of additions.
"""

from __future__ import annotations

import heapq
import math
import string
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskframe.llm.tables import lookup, map_arrow, text_or_empty, written

#: Letters, digits and bytes beyond ASCII stay (A to Z as a to z), all else separates terms.
_TERM_BYTES = bytes.maketrans(string.ascii_uppercase.encode(), string.ascii_lowercase.encode())
_TERM_BYTES = bytes(c if b >= 128 or chr(b).isalnum() else 32 for b, c in enumerate(_TERM_BYTES))
BLOCK_DOCS = 4096
CELLS = 1 << 22  # entries of one group-by-term table in memory
FAN = 64         # lists of a query are merged by this many tasks before the last one


def terms(text: str) -> list[bytes]:
    """The terms of a whole text, in order, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").translate(_TERM_BYTES).split()


# --- postings ---------------------------------------------------------------------------

def postings(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, term, tf) per row of (doc_id, body) with a term at all: its number of terms
    and, for those in the vocabulary, their numbers and counts."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = vocabulary.get
        for b in batches:
            rows, size, found, times, ends = [], [], [], [], [0]
            for i, body in enumerate(b.column("body")):
                all_terms = terms(body.as_py())
                if not all_terms:
                    continue
                counts = Counter(map(number, all_terms))
                counts.pop(None, None)
                rows.append(i)
                size.append(len(all_terms))
                found.extend(counts.keys())
                times.extend(counts.values())
                ends.append(len(found))
            ends = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").take(pa.array(rows, pa.int64())), pa.array(size, pa.int64()),
                 pa.ListArray.from_arrays(ends, pa.array(found, pa.int32())),
                 pa.ListArray.from_arrays(ends, pa.array(times, pa.int32()))],
                ["doc_id", "n", "term", "tf"])

    return map_arrow(docs, run, f"doc_id {kind}, n bigint, term array<int>, tf array<int>")


def term_weight(n_docs: int, with_term: int) -> int:
    """floor(1000 ln((2 N + 2) / (2 df + 1)))."""
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * with_term + 1)))


# --- evaluation of one block of documents -----------------------------------------------

@dataclass
class Query:
    """Terms of a query and their weights times their repeats, with the best rows so far."""

    number: int
    term: np.ndarray
    weight: np.ndarray
    best: list  # (-score, id is null, id), best first

    def least(self, k: int) -> int:
        """A document below this score cannot enter the k best."""
        return max(1, -self.best[-1][0]) if len(self.best) == k else 1


class DocBlock:
    """Postings of a block of documents, by document and by term, with the terms' shares."""

    def __init__(self, ids: pa.Array, n: np.ndarray, term: np.ndarray, tf: np.ndarray,
                 ends: np.ndarray, n_docs: int, n_terms: int, n_vocabulary: int):
        self.ids, self.size, self.ends, self.term = ids, len(n), ends, term
        length = 75 + (25 * n * n_docs) // n_terms
        self.doc = np.repeat(np.arange(self.size), np.diff(ends))
        self.share = (1_000_000_000 * tf) // (1000 * tf + 12 * length[self.doc])
        order = np.argsort(term, kind="stable")
        self.by_term = self.doc[order]
        self.first = np.searchsorted(term[order], np.arange(n_vocabulary + 1))
        self.most = np.zeros(n_vocabulary, np.int64)  # largest share of each term
        np.maximum.at(self.most, term, self.share)
        self.gain = np.zeros(n_vocabulary, np.int64)  # weights of the query at work

    def with_term(self, t: int) -> np.ndarray:
        return self.by_term[self.first[t]:self.first[t + 1]]

    def masks(self, term: np.ndarray) -> np.ndarray:
        """(documents, words of 64 bits): bit j is set where the document has the j-th term."""
        out = np.zeros((self.size, -(-len(term) // 64)), np.uint64)
        for j, t in enumerate(term):
            out[self.with_term(t), j >> 6] |= np.uint64(1 << (j & 63))
        return out

    def scores(self, docs: np.ndarray, query: Query) -> np.ndarray:
        """Exact scores of some documents, from their own postings."""
        sizes = self.ends[docs + 1] - self.ends[docs]
        at = np.repeat(self.ends[docs] - (np.cumsum(sizes) - sizes), sizes) + np.arange(
            int(sizes.sum()))
        self.gain[query.term] = query.weight
        parts = np.concatenate(([0], np.cumsum(self.gain[self.term[at]] * self.share[at])))
        self.gain[query.term] = 0
        stop = np.cumsum(sizes)
        return parts[stop] - parts[stop - sizes]


def _groups(masks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct non-zero masks, and per document the number of its mask (-1: no term)."""
    if masks.shape[1] == 1:
        distinct, group = np.unique(masks[:, 0], return_inverse=True)
        distinct = distinct[:, None]
    else:
        distinct, group = np.unique(masks, axis=0, return_inverse=True)
    group = group.reshape(-1)
    if len(distinct) and not distinct[0].any():  # zero sorts first
        return distinct[1:], group - 1
    return distinct, group


def _bounds(distinct: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Largest score that a document with each mask can have."""
    out = np.empty(len(distinct), np.int64)
    step = max(1, CELLS // len(most))
    for i in range(0, len(distinct), step):
        bits = np.unpackbits(distinct[i:i + step].astype("<u8").view(np.uint8), axis=1,
                             bitorder="little")[:, :len(most)]
        out[i:i + step] = bits.astype(np.int64) @ most
    return out


def search_block(block: DocBlock, query: Query, k: int, batch: int = 64) -> int:
    """Let the block's documents into the query's best; how many documents were evaluated."""
    most = query.weight * block.most[query.term]
    if most.sum() < query.least(k):
        return 0
    distinct, group = _groups(block.masks(query.term))
    if not len(distinct):
        return 0
    bound = _bounds(distinct, most)
    falling = np.argsort(-bound, kind="stable")
    place = np.empty(len(distinct) + 1, np.int64)
    place[falling] = np.arange(len(distinct))
    place[-1] = len(distinct)  # documents without a term come last and are never reached
    docs = np.argsort(place[group], kind="stable")
    edge = np.searchsorted(place[group][docs], np.arange(len(distinct) + 1))
    done = evaluated = 0
    while done < len(distinct) and bound[falling[done]] >= query.least(k):
        # Whole groups of about `batch` documents, twice as many each time, all within bound.
        stop = int(np.searchsorted(edge, edge[done] + batch, "left"))
        stop = min(max(stop, done + 1), len(distinct))
        stop = min(stop, int(np.searchsorted(-bound[falling], -query.least(k), "right")))
        some = docs[edge[done]:edge[stop]]
        score = block.scores(some, query)
        evaluated += len(some)
        good = np.flatnonzero(score >= query.least(k))
        if len(good):
            ids = block.ids.take(pa.array(some[good])).to_pylist()
            query.best = heapq.nsmallest(k, query.best + [
                (-int(s), i is None, i) for s, i in zip(score[good], ids)], key=_order)
        done, batch = stop, 2 * batch
    return evaluated


def _order(row: tuple) -> tuple:
    return row[:2] if row[1] else row


def _search(queries: list[tuple[int, np.ndarray, np.ndarray]], k: int, n_docs: int, n_terms: int,
            n_vocabulary: int):
    """Task function: postings to the k best rows of every query."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = [Query(q, t, w, []) for q, t, w in queries]
        kind = None
        for b in batches:
            kind = b.column("doc_id").type
            for at in range(0, b.num_rows, BLOCK_DOCS):
                part = b.slice(at, BLOCK_DOCS)
                term = part.column("term")
                ends = term.offsets.to_numpy().astype(np.int64)
                block = DocBlock(
                    part.column("doc_id"), part.column("n").to_numpy(),
                    term.flatten().to_numpy().astype(np.int64),
                    part.column("tf").flatten().to_numpy().astype(np.int64), ends - ends[0],
                    n_docs, n_terms, n_vocabulary)
                for query in state:
                    search_block(block, query, k)
        rows = [(s.number, i, -score) for s in state for score, _, i in s.best]
        if rows:
            q, ids, score = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(q, pa.int64()), pa.array(ids, kind), pa.array(score, pa.int64())],
                ["q", "doc_id", "score"])

    return run


# --- the operator -----------------------------------------------------------------------

def _best(rows: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(),
                                              F.col("doc_id").asc_nulls_last())
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _search_queries(docs: DataFrame, queries: list, k: int) -> DataFrame:
    """(q, doc_id, score) of one block of (q, body) queries: k rows per query and task."""
    counted = [(r["q"], Counter(terms(r["body"]))) for r in queries]
    vocabulary = {t: i for i, t in enumerate(sorted({t for _, c in counted for t in c}))}
    table = written(postings(docs, vocabulary), "postings")
    total = table.agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("terms")).first()
    with_term = {r["t"]: r["df"] for r in table.select(F.explode("term").alias("t")).groupBy(
        "t").agg(F.count(F.lit(1)).alias("df")).collect()}  # at most the block's vocabulary
    ready = []
    for q, counts in counted:
        own = [(vocabulary[t], c) for t, c in counts.items() if vocabulary[t] in with_term]
        weights = [c * term_weight(total["docs"], with_term[t]) for t, c in own]
        if own:
            ready.append((q, np.array([t for t, _ in own]), np.array(weights, np.int64)))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_arrow(table, _search(ready, k, total["docs"], total["terms"] or 1,
                                    len(vocabulary)), f"q bigint, doc_id {kind}, score bigint")


def rank(docs: DataFrame, items: DataFrame, k: int = 20, id_col: str = "doc_id",
         text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text",
         block_bytes: int = 4 << 20) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id``, ``score``: every item's ``k`` best documents.

    Only documents with a score above 0 are listed; equal scores rank by ascending id, null ids
    last (among equal ids in any order). Null and empty texts have no terms: such documents do
    not count, such items have no rows, nor has any item if ``docs`` is empty. Documents that
    are repeated rows are ranked each by itself. Every item row is a query of its own; items
    with the same text are searched once, and their rows have the same ranks (so a repeated
    item row has its ranks twice). Extra columns are ignored. Items are searched in blocks of
    about ``block_bytes`` of text, each by a scan of the documents; a block's terms and
    queries are what the driver and each task hold.
    """
    asked = items.select(F.col(item_id_col).alias("item_id"),
                         text_or_empty(item_text_col).alias("body"))
    texts = written(asked.select("body").distinct().withColumn(
        "q", F.monotonically_increasing_id()), "queries")
    rows = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("body"))
    total = texts.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    n_blocks = max(1, -(-total // block_bytes))
    lists = None
    for i in range(n_blocks):
        block = texts.filter(F.pmod(F.xxhash64("body"), F.lit(n_blocks)) == i).collect()
        found = written(_search_queries(rows, block, k), "found")
        lists = found if lists is None else lists.unionByName(found)
    dealt = lists.withColumn("part", F.pmod(F.xxhash64("doc_id", "score"), F.lit(FAN)))
    best = _best(_best(dealt, ["q", "part"], k).drop("rank"), ["q"], k)
    of_text = best.join(texts, "q").select("body", "rank", "doc_id", "score")
    return lookup(asked, of_text, ["body"], F.rand(13)).select(
        "item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
